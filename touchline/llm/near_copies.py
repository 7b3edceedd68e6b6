"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``distance`` bits have a value between them that is within half the
distance of both: every fingerprint emits all values in its half ball, and fingerprints that emit
the same value collide. For 3 bits the halves are 1 and 2; a pair at 3 bits differs in parity, so
only fingerprints of odd parity emit the 2016 values at two bits.

Values are dealt by their leading bits ("cells"). A fingerprint is sent once to every cell that
holds values of its ball and the values are made there, in blocks; so the shuffle holds tens of
rows for each distinct fingerprint instead of thousands. Cells with too many members are dealt
again by more bits, down to single values, which at most 2081 distinct fingerprints can emit.
Within one value all fingerprints that emitted it at one bit are within 2 bits of each other, and
within 3 of those that emitted it at two bits; so links to one of them keep every component, and
dense groups give no squares of pairs. Each link's bit distance is verified.

Defined results: a missing text has no words, and a text without words has fingerprint zero,
linked like any other. Equal texts share a fingerprint. A component's id is its smallest document
id; documents without an id belong to components but don't name them. Extra columns are ignored,
an empty table gives no rows.
"""
from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from touchline.llm.batches import free_name, per_text
from touchline.llm.links import components
from touchline.session import cut_lineage

BITS = 64
BLOCK_ROWS = 65_536
MEMBERS = 20_000
FEW = 512


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the shingles' XXH64; words are runs without white space, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(line, seed)]
    else:
        hashes = [digest(line[a:b - 1], seed) for a, b in zip(starts, ends[shingle - 1:])]
    hashes, ones = np.array(hashes, np.uint64), np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK_ROWS):
        block = hashes[at:at + BLOCK_ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", shingle: int = 3, name: str = "fingerprint") -> DataFrame:
    """Columns ``keep`` and the 64-bit fingerprint (as a signed long) of every whole text."""

    def work():
        return lambda texts: [[simhash(t, shingle) for t in texts]]

    return per_text(df, text, keep, [StructField(name, LongType())], work)


def as_hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def odd(column: Column) -> Column:
    return F.bit_count(column) % 2 == 1


def _dealt(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Rows (fingerprint, spent, cell) sent on to the cells of their values' bits low..high-1 (from the top).

    ``spent`` counts bits flipped so far, ``cell`` holds the leading bits of the value.
    """
    bits = range(low, high)
    flips = [0] + [1 << (high - 1 - b) for b in bits] + [1 << (high - 1 - a) | 1 << (high - 1 - b) for a, b in combinations(bits, 2)]
    width = high - low
    table = F.array(*[F.lit(f).cast("long") for f in flips])
    allowed = F.when(odd(F.col("fingerprint")), 2).otherwise(1) - F.col("spent")
    some = F.when(allowed == 0, F.slice(table, 1, 1)).when(allowed == 1, F.slice(table, 1, 1 + width)).otherwise(table)
    own = F.shiftrightunsigned("fingerprint", BITS - high).bitwiseAND(F.lit((1 << width) - 1))
    moved = rows.select("fingerprint", "spent", "cell", own.alias("own"), F.explode(some).alias("flip"))
    return moved.select(
        "fingerprint", (F.col("spent") + F.bit_count("flip")).cast("int").alias("spent"),
        F.shiftleft("cell", width).bitwiseOR(F.col("own").bitwiseXOR(F.col("flip"))).alias("cell"),
    )


def _met(cell: int, prints: np.ndarray, spent: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints that emit equal values in one cell of ``depth`` leading bits."""
    low = BITS - depth
    one = np.uint64(1)
    mask = np.uint64((1 << low) - 1)
    base = (prints & mask) | (np.uint64(int(cell) % (1 << depth)) << np.uint64(low))
    singles = np.array([one << np.uint64(i) for i in range(low)], np.uint64)
    doubles = np.array([a | b for a, b in combinations(singles.tolist(), 2)], np.uint64)
    own, next_ = np.flatnonzero(spent == 0), np.flatnonzero(spent == 1)
    values = np.concatenate([base[own], (base[own][:, None] ^ singles).ravel(), base[next_]])
    owners = np.concatenate([own, np.repeat(own, low), next_])
    order = np.lexsort((prints[owners], values))
    values, owners = values[order], owners[order]
    first = np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)
    heads, head_owner = values[first], owners[first]
    lead = head_owner[np.cumsum(first) - 1] if len(values) else owners
    links = [(prints[lead], prints[owners])]
    # values at two bits, only of odd fingerprints: a table of marks drops nearly all before the exact search
    size = 1 << max(10, int(np.ceil(np.log2(max(1, len(heads)) * 16))))
    spread, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(BITS - size.bit_length() + 1)
    marks = np.zeros(size, bool)
    marks[(heads * spread >> shift).astype(np.int64)] = True
    ones = np.bitwise_count(prints) % 2 == 1
    rest = np.flatnonzero(spent == 2)
    for who, flips in ((np.flatnonzero(ones & (spent == 0)), doubles), (np.flatnonzero(ones & (spent == 1)), singles), (rest[ones[rest]], np.zeros(1, np.uint64))):
        step = max(1, 262_144 // max(1, len(flips)))
        for at in range(0, len(who) if len(flips) and len(heads) else 0, step):
            some = who[at:at + step]
            made = (base[some][:, None] ^ flips).ravel()
            kept = np.flatnonzero(marks[(made * spread >> shift).astype(np.int64)])
            place = np.minimum(np.searchsorted(heads, made[kept]), len(heads) - 1)
            same = heads[place] == made[kept]
            links.append((prints[head_owner[place[same]]], prints[some[kept[same] // len(flips)]]))
    a, b = (np.concatenate(x) for x in zip(*links))
    near = (a != b) & (np.bitwise_count(a ^ b) <= 3)
    if not near.any():
        return a[:0], b[:0]
    pairs = np.unique(np.stack([np.minimum(a, b)[near], np.maximum(a, b)[near]], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def ball_links(prints: DataFrame, members: int = MEMBERS) -> DataFrame:
    """Links (a, b) between distinct fingerprints within 3 bits that keep every component of that graph.

    ``prints`` has one row for each distinct fingerprint. ``members`` is the number of rows from
    which a cell is dealt on by more bits; the links' components are the same for any value.
    """
    import pandas as pd

    total = prints.count()
    depth = max(8, int(np.ceil(np.log2(max(1, total) / FEW))))
    first = depth
    rows = _dealt(prints.select("fingerprint", F.lit(0).alias("spent"), F.lit(0).cast("long").alias("cell")), 0, depth)
    found = None
    while True:
        sizes = rows.groupBy("cell").agg(F.count("*").alias("n"))
        large = cut_lineage(sizes.where(F.col("n") > members).select("cell")) if depth < BITS else None
        more = large is not None and not large.isEmpty()
        small = rows.join(large, "cell", "left_anti") if more else rows
        if depth > first:  # most cells of a second deal have one member: nothing to meet
            small = small.join(sizes.where("n > 1").select("cell"), "cell", "left_semi")
        now = depth

        def meet(group: pd.DataFrame) -> pd.DataFrame:
            a, b = _met(int(group["cell"].iloc[0]), group["fingerprint"].to_numpy(np.int64).view(np.uint64), group["spent"].to_numpy(), now)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        part = small.groupBy("cell").applyInPandas(meet, "a long, b long")
        found = part if found is None else found.union(part)
        if not more:
            return found
        deeper = min(BITS, depth + 8)
        rows = _dealt(rows.join(large, "cell", "left_semi"), depth, deeper)
        depth = deeper


def classes(prints: DataFrame, id_column: str, members: int = MEMBERS) -> DataFrame:
    """One row for each distinct fingerprint of rows (id, fingerprint): ``first`` (its smallest id) and
    ``root`` (the smallest fingerprint of its component)."""
    firsts = cut_lineage(prints.groupBy("fingerprint").agg(F.min(id_column).alias("first")))
    roots = components(ball_links(firsts, members), "a", "b")
    return cut_lineage(firsts.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")))


def near_copies(df: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3, members: int = MEMBERS) -> DataFrame:
    """Every document's id, fingerprint (16 hex digits) and component_id."""
    prints = cut_lineage(fingerprints(df, [id_column], text, shingle))
    led = classes(prints, id_column, members)
    least = led.groupBy("root").agg(F.min("first").alias("component_id"))
    named = led.join(least, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(id_column, as_hex("fingerprint").alias("fingerprint"), "component_id")


def without_copies(df: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3, members: int = MEMBERS) -> DataFrame:
    """All columns of one document of each component: that with the smallest id (missing ids last),
    then the smallest fingerprint. Of repeated rows with that id and fingerprint one stays.

    Texts are shuffled once, by a key that repeats only for repeated rows.
    """
    prints = cut_lineage(fingerprints(df, [id_column], text, shingle))
    led = classes(prints, id_column, members)
    one = led.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "fingerprint")).alias("one"))
    mark, key, place = (free_name(df, n) for n in ("near_copy_print", "near_copy_key", "near_copy_place"))

    def joined(id_value: Column, value: Column) -> Column:
        return F.concat(F.when(id_value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("i"), id_value.cast("string"))), F.lit(":"), value.cast("string"))

    kept = one.select(joined(F.col("one.first"), F.col("one.fingerprint")).alias(key))
    marked = fingerprints(df, df.columns, text, shingle, mark).withColumn(key, joined(F.col(f"`{id_column}`"), F.col(mark)))
    again = Window.partitionBy(key).orderBy(F.col(f"`{text}`"))
    return marked.join(kept, key, "left_semi").withColumn(place, F.row_number().over(again)).where(F.col(place) == 1).select(
        *[F.col(f"`{c}`") for c in df.columns])
