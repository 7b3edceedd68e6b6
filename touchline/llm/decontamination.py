"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

Words are runs of letters, digits and non-ASCII characters with A-Z in lower case. A window is
``width`` consecutive words of a benchmark item; an item with fewer words, but not none, is one
window. Documents are scanned token window by token window: words outside the benchmark's
vocabulary cut a text into runs, a rolling hash of each window in a run is looked up, and hits are
verified word by word.

The windows travel in blocks of at most ``most`` windows (12 bytes each, and 4 for each word) and about
``most`` x 32 bytes of words. A larger benchmark takes one pass over the documents for each block, whose hits
are carried in a written table; items are cut between windows to fill blocks, so an item may be of any length.

Defined results: a missing text has no words; an item without id still marks words but is not
counted among the items, repeated items count once; an item without words has no window; ids may
be missing or repeat in documents (each row is judged on its own); extra columns stay; an empty
table gives no rows, an empty benchmark no hits.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from touchline.llm.batches import free_name, per_text, shipped
from touchline.session import scratch_dir

WIDTH = 13
MOST_WINDOWS = 2_000_000
REMEMBERED = 50_000
# fixed values: ASCII characters that are no part of a word (A-Z are, as they become a-z)
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
BASE = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


class WindowSet:
    """Benchmark windows by length, ready for scanning lists of texts."""

    def __init__(self, items: Sequence[tuple[str | None, list[bytes]]], width: int):
        self.number: dict[bytes, int] = {}
        self.ids: list[str | None] = []
        held: dict[int, list[tuple[int, int]]] = {}
        every: list[int] = []
        firsts: list[int] = []
        for name, words in items:
            numbers = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            self.ids.append(name)
            firsts.append(len(every))
            every.extend(numbers)
            size = min(width, len(words))
            if size:
                held.setdefault(size, []).append((firsts[-1], len(words) - size + 1))
        self.every, self.firsts = np.array(every, np.uint32), np.array(firsts, np.int64)
        # for each length of window: its hashes in order, and where in ``every`` each window begins
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, places in held.items():
            starts = np.concatenate([np.arange(first, first + n) for first, n in places])
            hashes = self.rolled(self.every, starts, size)
            order = np.argsort(hashes, kind="stable")
            self.windows[size] = hashes[order], starts[order].astype(np.uint32)
        self.same: dict[tuple[int, int], tuple[np.ndarray, frozenset[int]]] = {}

    @staticmethod
    def rolled(numbers: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        for i in range(size):
            out = out * np.uint64(BASE) + numbers[starts + i].astype(np.uint64)
        return out ^ (out >> np.uint64(29))

    def items_of(self, size: int, place: int, found: np.ndarray) -> frozenset[int] | None:
        """Items with this window, whose hash stands at ``place`` first; None if only the hash is the same."""
        hashes, starts = self.windows[size]
        if (size, place) not in self.same:
            if len(self.same) >= REMEMBERED:
                self.same.clear()
            alike = starts[place:place + int(np.searchsorted(hashes[place:], hashes[place], "right"))].astype(np.int64)
            rows = self.every[alike[:, None] + np.arange(size)]
            if not (rows == rows[0]).all():  # two windows with one hash: never remembered
                alike = alike[(rows == found).all(1)]
                return frozenset((np.searchsorted(self.firsts, alike, "right") - 1).tolist()) or None
            self.same[size, place] = rows[0], frozenset((np.searchsorted(self.firsts, alike, "right") - 1).tolist())
        window, items = self.same[size, place]
        return items if (window == found).all() else None

    def scan(self, texts: Sequence[str | None]) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
        """For each text: its number of words, hit runs as (first word, word after the last), and the items that occur."""
        get, numbers, sizes = self.number.get, [], []
        for text in texts:
            words = words_of(text)
            sizes.append(len(words))
            numbers.extend([get(w, 0) for w in words])
            numbers.append(0)  # no window goes on into the next text
        codes = np.array(numbers, np.uint64)
        firsts = np.cumsum([0] + [s + 1 for s in sizes])
        outside = np.flatnonzero(codes == 0)
        inside = np.flatnonzero(codes)
        room = outside[np.searchsorted(outside, inside)] - inside if len(inside) else inside
        marks = np.zeros(len(codes) + 1, np.int32)
        items: dict[int, set[int]] = {}
        for size, (known, _) in self.windows.items():
            starts = inside[room >= size]
            if not len(starts):
                continue
            hashed = self.rolled(codes, starts, size)
            place = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
            same = known[place] == hashed
            for start, at in zip(starts[same].tolist(), place[same].tolist()):
                found = self.items_of(size, at, codes[start:start + size])
                if found is not None:
                    marks[start] += 1
                    marks[start + size] -= 1
                    items.setdefault(int(np.searchsorted(firsts, start, "right")) - 1, set()).update(found)
        hit = np.cumsum(marks[:-1]) > 0
        edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        runs: dict[int, list[tuple[int, int]]] = {}
        for b, e in zip(begins.tolist(), ends.tolist()):
            row = int(np.searchsorted(firsts, b, "right")) - 1
            runs.setdefault(row, []).append((b - int(firsts[row]), e - int(firsts[row])))
        return [(n, runs.get(i, []), items.get(i, set())) for i, n in enumerate(sizes)]


HITS = StructType([
    StructField("n_words", LongType()),
    StructField("runs", ArrayType(StructType([StructField("first", IntegerType()), StructField("after", IntegerType())]))),
    StructField("items", ArrayType(StringType())),
])


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, after in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(after, out[-1][1]))
        else:
            out.append((first, after))
    return out


def _scanned(df: DataFrame, text: str, keep: Sequence[str], items: list, width: int, name: str) -> DataFrame:
    shared = shipped(df.sparkSession, WindowSet(items, width))

    def work():
        windows = shared.value

        def compute(texts):
            found = windows.scan(texts)
            return [[{"n_words": n, "runs": [{"first": a, "after": b} for a, b in runs],
                      "items": sorted({windows.ids[i] for i in some} - {None})} for n, runs, some in found]]

        return compute

    return per_text(df, text, keep, [StructField(name, HITS)], work)


def _joined_hits(old: str, new: str) -> Column:
    """Hits of two passes over the same row: runs laid together, items of both."""
    runs = F.array_sort(F.concat(F.col(f"{old}.runs"), F.col(f"{new}.runs")))
    return F.struct(
        F.col(f"{new}.n_words").alias("n_words"), runs.alias("runs"),
        F.array_sort(F.array_union(F.col(f"{old}.items"), F.col(f"{new}.items"))).alias("items"))


def blocks(items: Iterable[tuple[str | None, list[bytes]]], width: int, most: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in blocks of at most ``most`` windows and about 32 bytes of words for each, cut between windows where a
    block is full: the next piece begins with the words of the window behind the last one."""
    held, windows, size = [], 0, 0
    for name, words in items:
        start, n = 0, max(1, len(words) - width + 1)
        while start < n:
            if windows >= most or size >= 32 * most:
                yield held
                held, windows, size = [], 0, 0
            taken = min(n - start, most - windows)
            piece = words[start:start + taken + width - 1]
            held.append((name, piece))
            windows, size, start = windows + taken, size + sum(map(len, piece)), start + taken
    if held:
        yield held


def hits(
    df: DataFrame, benchmark: DataFrame, keep: Sequence[str], text: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = WIDTH, most: int = MOST_WINDOWS, name: str = "hits",
) -> DataFrame:
    """Columns ``keep`` and a struct of n_words, hit runs (word numbers) and item ids for every text."""
    spark = df.sparkSession

    def work():
        def compute(texts):
            found = [words_of(t) for t in texts]
            return [[b" ".join(w) for w in found], [max(0, len(w) - width + 1) or (1 if w else 0) for w in found]]

        return compute

    kinds = [StructField("words", BinaryType()), StructField("windows", LongType())]
    items = per_text(benchmark, item_text, [item_id], kinds, work).where("windows > 0")
    counted = items.select(F.col(item_id).cast("string").alias("item"), "words", "windows").distinct()
    path = scratch_dir(spark, "benchmark-words")
    counted.write.parquet(path)
    counted = spark.read.parquet(path)
    source, old = df, free_name(df, name + "_before")
    filled = blocks(((r["item"], bytes(r["words"]).split(b" ")) for r in counted.select("item", "words").toLocalIterator()), width, most)
    rows, after, block = next(filled, []), next(filled, None), 0
    while True:
        last = after is None
        wanted = list(keep) if last else list(dict.fromkeys([*keep, text]))
        now = free_name(source, name + "_now")
        scanned = _scanned(source, text, wanted + ([old] if block else []), rows, width, now)
        combined = _joined_hits(old, now) if block else F.col(now)
        source = scanned.select(*[F.col(f"`{c}`") for c in wanted], combined.alias(name if last else old))
        if not last:
            path = scratch_dir(spark, "benchmark-hits")
            source.write.parquet(path)
            source = spark.read.parquet(path)
        else:
            return source
        rows, after, block = after, next(filled, None), block + 1


def n_hit(name: str = "hits") -> Column:
    """Words inside any run; runs are in order and may overlap."""
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda s, r: F.struct(
        (s["n"] + F.greatest(F.lit(0), r["after"] - F.greatest(r["first"], s["end"]))).alias("n"), F.greatest(s["end"], r["after"]).alias("end"))
    return F.aggregate(F.col(f"{name}.runs"), state, step, lambda s: s["n"])


def verdicts(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", share: int = 20, **settings) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256 and contaminated (hit words are a ``share``-th of all, or more)."""
    found = hits(df, benchmark, [id_column], text, **settings).select(
        id_column, F.col("hits.n_words").alias("n_words"), n_hit().alias("n_hit"), F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def clean_documents(df: DataFrame, benchmark: DataFrame, text: str = "text", share: int = 20, **settings) -> DataFrame:
    """All columns of the documents that are not contaminated. No shuffle."""
    name = free_name(df, "benchmark_hits")
    found = hits(df, benchmark, df.columns, text, name=name, **settings)
    hit = n_hit(name)
    return found.where(~((hit > 0) & (share * hit >= F.col(f"{name}.n_words")))).select(*[F.col(f"`{c}`") for c in df.columns])


def cut_spans(df: DataFrame, benchmark: DataFrame, text: str = "text", **settings) -> DataFrame:
    """All columns, with every run of hit words cut out of the text (from its first to its last character)."""
    name, key = free_name(df, "benchmark_hits"), free_name(df, "benchmark_runs")
    found = hits(df, benchmark, df.columns, text, name=name, **settings)
    clean = found.where(F.size(f"{name}.runs") == 0).select(*[F.col(f"`{c}`") for c in df.columns])
    # only texts with hits go to the workers again; runs travel beside their text
    dirty = found.where(F.size(f"{name}.runs") > 0).withColumn(key, F.to_json(F.struct(F.col(f"`{text}`").alias("t"), F.col(f"{name}.runs").alias("r"))))

    def work():
        def cut(pair):
            held = json.loads(pair)
            return _without(held["t"], [(r["first"], r["after"]) for r in held["r"]])

        return lambda pairs: [[cut(p) for p in pairs]]

    others = [c for c in df.columns if c != text]
    mended = per_text(dirty, key, others, [StructField(text, StringType())], work).select(*[F.col(f"`{c}`") for c in df.columns])
    return clean.union(mended)


def _without(text: str, runs: Sequence[tuple[int, int]]) -> str:
    spans = [m.span() for m in WORDS.finditer(text)]
    out, at = [], 0
    for first, after in _merged(list(runs)):
        out.append(text[at:spans[first][0]])
        at = spans[after - 1][1]
    return "".join([*out, text[at:]])
