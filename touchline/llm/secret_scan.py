"""Secret scanning: wide candidate patterns, then a random forest that removes false positives.

Candidates are runs of key characters that hold a digit, values assigned to a credential word,
and private-key blocks. A random forest, trained on labelled findings, judges each by its length,
character classes and transitions between letters, the share of it that is made of dictionary words
and of words of the same text, the path or address around it and the words next to it (hashed). The
dictionary holds the corpus words that stand in most documents, counted over all of them; its size is bounded by the
parameter ``size`` of ``dictionary``. Trees (at most trees x 2^(depth + 1) nodes) and dictionary travel
with the tasks, so texts are scanned and judged in one pass without a shuffle.

Labelled findings may come from anywhere (``features`` and ``label``); ``rule_findings`` makes them
from a bounded sample of documents by rules: known key formats and values assigned to credential
words are findings, place holders and all other candidates are not. What these rules look at (EVIDENCE) is
hidden from the forest that learns from them (``trained``): it must tell findings by their shape and
surroundings, and so takes back what the rules flag but what looks like all that they don't. The sample's bound is the
parameter ``most``. Only fitting uses a sample; scanning covers every whole text.

Defined results: a missing text has no candidates and stays missing; equal texts get equal
findings; ids may be missing or repeat; extra columns stay; an empty table gives no rows. If the
labelled findings hold only one class, every candidate gets that class; without any, candidates
are judged by the rules that make labels.
"""
from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Sequence, Set

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from touchline.llm.batches import per_text, shipped
from touchline.session import cut_lineage, scratch_dir

RUN = re.compile(r"(?<![A-Za-z0-9+/_~.-])(?=[A-Za-z+/_~.-]*[0-9])[A-Za-z0-9+/_~.-]{8,}={0,2}")
# fixed values: credential words, what may follow them in a name, place holders and published key formats
KEYED = re.compile(
    r"(?i)(password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credentials?)(?:[_-]?(?:key|value|base|old|new|prod|dev|test|live|v?[0-9]{1,4})){0,2}"
    r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?([^\s\"']{6,})")
HOLDER = re.compile(r"(?i)example|changeme|placeholder|dummy|your[_-]|xxxx|\*\*\*|^[<${]")
FORMATS = re.compile(
    r"AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[0-9A-Za-z_-]{35}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*")
BLOCK_BEGIN, BLOCK_END = (re.compile(rf"-----{mark} [A-Z ]{{0,40}}PRIVATE KEY-----") for mark in ("BEGIN", "END"))
AROUND = 48
WORD = re.compile(r"[^\W\d_]+")
WORDS_BEFORE, WORDS_AFTER = (3, 32), (2, 16)  # how many neighbouring words, and into how many hashed columns
FEATURES = (
    "log_length", "digits", "capitals", "small_letters", "marks", "class_changes", "entropy", "distinct", "hex_only", "digits_only",
    "letter_pairs", "own_words", "dictionary", "dots", "slashes", "in_address", "quoted", "credential_word", "assigned", "holder", "known_format",
    "words_before", "words_after", *[f"before_{i}" for i in range(WORDS_BEFORE[1])], *[f"after_{i}" for i in range(WORDS_AFTER[1])],
)
EVIDENCE = ("credential_word", "holder", "known_format")
TREES, DEPTH, MOST, SEED = 24, 8, 20_000, 11
DICTIONARY, LONGEST_WORD = 50_000, 32


def key_blocks(text: str) -> list[tuple[int, int]]:
    """From each begin mark outside a block to the first end mark behind it; both kinds of marks are found once."""
    out: list[tuple[int, int]] = []
    ends = BLOCK_END.finditer(text)
    end = next(ends, None)
    for begin in BLOCK_BEGIN.finditer(text):
        if out and begin.start() < out[-1][1]:
            continue
        while end is not None and end.start() < begin.end():
            end = next(ends, None)
        if end is None:
            break
        out.append((begin.start(), end.end()))
    return out


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of all candidates, leftmost first; of overlapping ones the earlier, longer stays."""
    found = [m.span() for m in RUN.finditer(text)] if any(d in text for d in "0123456789") else []
    if "=" in text or ":" in text:
        found += [m.span(2) for m in KEYED.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += key_blocks(text)
    out: list[tuple[int, int]] = []
    for start, end in sorted(found, key=lambda s: (s[0], -s[1])):
        if not out or start >= out[-1][1]:
            out.append((start, end))
    return out


def hashed(words: Sequence[str], columns: int) -> list[float]:
    """How often each column is hit by the words in small letters."""
    out = [0.0] * columns
    for word in words:
        out[zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % columns] += 1.0
    return out


def described(text: str, start: int, end: int, own: set[str], words: Set[str] = frozenset()) -> list[float]:
    """FEATURES of one candidate; ``own`` are the words of the text, ``words`` those of the dictionary, in small letters."""
    value = text[start:end]
    before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m" for c in value]
    share = Counter(kinds)
    times = Counter(value)
    letters = [w.lower() for w in WORD.findall(value)]
    pairs = [a + b for w in letters for a, b in zip(w, w[1:])]
    vowels = sum((a in "aeiouy") != (b in "aeiouy") for a, b in pairs)
    known, listed = (sum(len(w) for w in letters if len(w) >= 3 and w in some) for some in (own, words))
    key = re.search(r"([A-Za-z0-9_-]+)[\"']?\s{0,3}[=:]\s{0,3}[\"']?$", before)
    # the name that the value is assigned to is evidence of its own, no neighbouring word
    left, right = WORD.findall(before[:key.start()] if key else before), WORD.findall(after)
    return [
        math.log(n), share["d"] / n, share["u"] / n, share["l"] / n, share["m"] / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n, -sum(k / n * math.log2(k / n) for k in times.values()), len(times) / n,
        float(all(c in "0123456789abcdefABCDEF" for c in value)), float(value.isdigit()), vowels / max(1, len(pairs)), known / n, listed / n,
        value.count(".") / n, value.count("/") / n, float("@" in before[-1:] + after[:1] + value or "://" in before),
        float(before[-1:] in "\"'" and before != "" and after[:1] in "\"'" and after != ""),
        float(bool(key and KEYED.search(key[1] + "=xxxxxx"))), float(bool(key)), float(bool(HOLDER.search(value))),
        float(bool(FORMATS.search(value)) or value.startswith("-----BEGIN")), float(len(left)), float(len(right)),
        *hashed(left[-WORDS_BEFORE[0]:], WORDS_BEFORE[1]), *hashed(right[:WORDS_AFTER[0]], WORDS_AFTER[1]),
    ]


def scanned(text: str | None, words: Set[str] = frozenset()) -> tuple[list[tuple[int, int]], list[list[float]]]:
    spans = candidates(text) if text else []
    if not spans:
        return [], []
    # a candidate's own letters don't make it a word of the text
    rest = [text[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(text)])]
    own = {w for part in rest for w in WORD.findall(part.lower())}
    return spans, [described(text, s, e, own, words) for s, e in spans]


def by_rule(features: np.ndarray) -> np.ndarray:
    """1 for known formats and for values of credential words that are no place holders."""
    at = {n: i for i, n in enumerate(FEATURES)}
    keyed = (features[:, at["credential_word"]] > 0) & (features[:, at["holder"]] == 0)
    return ((features[:, at["known_format"]] > 0) | keyed).astype(np.float64)


def dictionary(df: DataFrame, text: str = "text", size: int = DICTIONARY) -> frozenset[str]:
    """Words (of 3 to 32 letters, in small letters) of the corpus, those in most texts: all that stand in as many texts as a cutoff
    says, two at least. The cutoff is the lowest of sixteen steps for each power of two that leaves ``size`` words at most."""
    words = F.array_distinct(F.split(F.lower(F.col(f"`{text}`")), r"[^\p{L}]+"))
    every = df.select(F.explode(F.filter(words, lambda w: F.char_length(w).between(3, LONGEST_WORD))).alias("word"))
    counted = every.groupBy("word").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    counted = cut_lineage(counted.select("word", F.floor(F.log2("texts") * 16).alias("step")))
    taken, cutoff = 0, None
    for step, n in sorted(counted.groupBy("step").count().collect(), reverse=True):  # a thousand rows at most
        if taken + n > size:
            break
        taken, cutoff = taken + n, step
    return frozenset(r["word"] for r in counted.where(F.col("step") >= cutoff).collect()) if taken else frozenset()


def rule_findings(df: DataFrame, text: str = "text", most: int = MOST, words: Set[str] = frozenset()) -> DataFrame:
    """Labelled findings (features, label) of a sample of about ``most`` texts, chosen by their hash."""
    total = df.count()
    shared = shipped(df.sparkSession, words)
    chosen = F.xxhash64(F.col(f"`{text}`")).bitwiseAND(F.lit((1 << 30) - 1))
    some = df.where(chosen < int((1 << 30) * min(1.0, most / max(1, total)) + 1)) if total > most else df
    kind = ArrayType(StructType([StructField("features", ArrayType(DoubleType())), StructField("label", DoubleType())]))

    def work():
        known = shared.value

        def compute(texts):
            out = []
            for t in texts:
                made = scanned(t, known)[1]
                labels = by_rule(np.array(made)).tolist() if made else []
                out.append([{"features": f, "label": v} for f, v in zip(made, labels)])
            return [out]

        return compute

    return per_text(some.dropDuplicates([text]), text, [], [StructField("found", kind)], work).select(F.inline("found"))


class Forest:
    """Trained trees as arrays, judged many rows at a time."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(rows), np.int64)
            while True:
                inner = np.flatnonzero(left[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                small = rows[inner, feature[node]] <= threshold[node]
                at[inner] = np.where(small, left[node], right[node])
            total += share[at]
        return total / max(1, len(self.trees))


class Rules:
    """Judges by the rules that make labels."""

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return by_rule(rows)


class Constant:
    def __init__(self, value: float):
        self.value = value

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return np.full(len(rows), self.value)


def fitted(findings: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED, hidden: Sequence[str] = ()):
    """The forest for labelled findings (features, label); it doesn't see the features ``hidden``."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    spark = findings.sparkSession
    seen = [i for i, name in enumerate(FEATURES) if name not in hidden]
    own = F.array(*[F.col("features")[i] for i in seen]) if hidden else F.col("features")
    ready = cut_lineage(findings.orderBy("features", "label").select(array_to_vector(own).alias("features"), "label"))
    classes = [r["label"] for r in ready.select("label").distinct().limit(2).collect()]
    if len(classes) < 2:
        return Constant(classes[0]) if classes else Rules()
    grown = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt", minInstancesPerNode=1)
    path = scratch_dir(spark, "forest")
    grown.fit(ready).write().save(path)
    return Forest(_trees(spark.read.parquet(f"{path}/data"), seen))


def trained(df: DataFrame, text: str = "text") -> tuple[object, frozenset[str]]:
    """The forest that learns from rule findings without what the rules see, and its dictionary."""
    words = dictionary(df, text)
    return fitted(rule_findings(df, text, words=words), hidden=EVIDENCE), words


def _trees(saved: DataFrame, seen: Sequence[int] = range(len(FEATURES))) -> list[tuple[np.ndarray, ...]]:
    """The saved nodes of all trees as arrays (feature, threshold, left, right, share of findings); ``seen`` are the forest's features."""
    nodes: dict[int, dict[int, object]] = {}
    for row in saved.collect():
        nodes.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    trees = []
    for tree in (nodes[k] for k in sorted(nodes)):
        place = {node: i for i, node in enumerate(sorted(tree))}
        order = [tree[node] for node in sorted(tree)]
        stats = np.array([n["impurityStats"] for n in order], float)
        trees.append((
            np.array([seen[max(0, n["split"]["featureIndex"])] for n in order]),
            np.array([n["split"]["leftCategoriesOrThreshold"][0] if n["leftChild"] >= 0 else 0.0 for n in order]),
            np.array([place[n["leftChild"]] if n["leftChild"] >= 0 else -1 for n in order]),
            np.array([place[n["rightChild"]] if n["rightChild"] >= 0 else -1 for n in order]),
            stats[:, 1] / stats.sum(1),
        ))
    return trees


FINDING = ArrayType(StructType([
    StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("probability", DoubleType()),
    StructField("secret", BooleanType()),
]))


def findings(df: DataFrame, model, keep: Sequence[str], text: str = "text", limit: float = 0.5, name: str = "findings",
             words: Set[str] = frozenset()) -> DataFrame:
    """Columns ``keep`` and all candidates of each text (code points), with the forest's verdict. ``words``: the dictionary it was trained with."""
    shared = shipped(df.sparkSession, (model, words))

    def work():
        forest, known = shared.value

        def compute(texts):
            made = [scanned(t, known) for t in texts]
            rows = np.array([f for _, fs in made for f in fs]).reshape(-1, len(FEATURES))
            judged = iter(forest.probability(rows).tolist())
            return [[[{"start": s, "end": e, "probability": p, "secret": p >= limit} for (s, e), p in zip(spans, judged)] for spans, _ in made]]

        return compute

    return per_text(df, text, keep, [StructField(name, FINDING)], work)


def covered(text: str, spans: Sequence[tuple[int, int]], mask: str) -> str:
    """The text with the spans, in order and apart, replaced."""
    out, at = [], 0
    for start, end in spans:
        out += [text[at:start], mask]
        at = end
    return "".join([*out, text[at:]])


def without_secrets(df: DataFrame, model=None, text: str = "text", mask: str = "[SECRET]", limit: float = 0.5, words: Set[str] = frozenset()) -> DataFrame:
    """All rows and columns, with secrets replaced in the text. Without a model it is trained on rule findings."""
    shared = shipped(df.sparkSession, (model, words) if model else trained(df, text))

    def work():
        forest, known = shared.value

        def compute(texts):
            made = [scanned(t, known) for t in texts]
            rows = np.array([f for _, fs in made for f in fs]).reshape(-1, len(FEATURES))
            secret = iter((forest.probability(rows) >= limit).tolist())
            out = []
            for t, (spans, _) in zip(texts, made):
                kept = [s for s in spans if next(secret)]
                out.append(covered(t, kept, mask) if kept else t)
            return [out]

        return compute

    others = [c for c in df.columns if c != text]
    return per_text(df, text, others, [StructField(text, StringType())], work).select(*[F.col(f"`{c}`") for c in df.columns])
