"""Quality rules whose cutoffs come from labelled documents with a bound on false rejections.

Each rule is a share of a text (0 to 1) that rejects above a cutoff. In every stratum the
documents labelled good are the holdout: a cutoff is certified if the exact binomial test rejects
"the rule's false rejection rate is above ``risk``" (the same as a Clopper-Pearson upper bound below
it). Cutoffs of one rule are tested from the loosest to the tightest and the testing stops at the first failure, so
they need no correction among themselves; the level is divided by the number of rules times
strata (Bonferroni). With probability 1 - ``doubt`` all chosen cutoffs keep their limit at once, and
a stratum loses at most rules x risk of its good documents. Among certified cutoffs the one is
chosen that best separates the labels. A stratum with too few labels certifies none: the rule
then rejects nothing there.

Defined results: a missing text has no words; missing strata are a stratum of their own; a document
labelled several times counts as good only if all labels say so; labels without id or value are
left out; extra columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from touchline.llm.batches import free_name, per_text
from touchline.session import cut_lineage

# fixed values: characters counted as symbols, and white space between words
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
# rule: (counted, out of)
RULES = {
    "symbols": ("n_symbols", "word_chars"), "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"), "capitals": ("n_capitals", "n_words"),
}
STEPS = 200
RISK, DOUBT, WEIGHT = 0.005, 0.05, 10
MANY_WORDS = 100_000
FEW = 10_000


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    if len(words) < width:
        return 0
    if len(words) > MANY_WORDS:  # the same count on arrays, for texts whose windows would take much memory as objects
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        windows = np.stack([ids[i:len(ids) - width + 1 + i] for i in range(width)], 1)
        _, place, times = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[place.ravel()] > 1).tolist()
    else:
        windows = list(zip(*[words[i:] for i in range(width)]))
        if len(set(windows)) == len(windows):
            return 0
        times = Counter(windows)
        starts = [i for i, w in enumerate(windows) if times[w] > 1]
    covered = end = 0
    for start in starts:
        covered += start + width - max(start, end)
        end = start + width
    return covered


def measured(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return (
        len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), sum(map(bytes.isupper, words)),
    )


def measures(df: DataFrame, keep: Sequence[str], text: str = "text", name: str = "counts") -> DataFrame:
    """Columns ``keep`` and a struct of COUNTS for every whole text."""
    kind = StructType([StructField(c, LongType()) for c in COUNTS])

    def work():
        return lambda texts: [[dict(zip(COUNTS, measured(t))) for t in texts]]

    return per_text(df, text, keep, [StructField(name, kind)], work)


def base_failed(counts: str) -> Column:
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


def level(counts: str, rule: str) -> Column:
    """A rule's share in STEPS, rounded up: the rule rejects at cutoff k / STEPS where this is above k."""
    part, whole = (F.col(f"{counts}.{c}") for c in RULES[rule])
    return F.when(whole > 0, F.floor((STEPS * part + whole - 1) / whole)).otherwise(0).cast("int")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p)."""
    if k >= n:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    if k > n * p:  # sum the other side, whose terms fall
        total, i, term = 0.0, k + 1, term * (n - k) / (k + 1) * p / (1 - p)
        while i <= n and term > total * 1e-17:
            total += term
            term *= (n - i) / (i + 1) * p / (1 - p)
            i += 1
        return 1 - total
    total, i = 0.0, k
    while i >= 0 and term > total * 1e-17:
        total += term
        term *= i / (n - i + 1) * (1 - p) / p
        i -= 1
    return min(1.0, total)


def upper_bound(k: int, n: int, doubt: float) -> float:
    """Clopper-Pearson upper bound of a rate seen k times in n."""
    low, high = k / n if n else 0.0, 1.0
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(k, n, middle) > doubt else (low, middle)
    return high


def best_cutoff(levels: Sequence[int], good: Sequence[int], bad: Sequence[int], risk: float, doubt: float, weight: float):
    """(cutoff, good documents, falsely rejected, bound) among cutoffs certified in sequence, or None."""
    goods, bads = np.zeros(STEPS + 1, np.int64), np.zeros(STEPS + 1, np.int64)
    np.add.at(goods, levels, good)
    np.add.at(bads, levels, bad)
    n, best = int(goods.sum()), None
    lost = caught = 0
    for cutoff in range(STEPS - 1, -1, -1):
        lost += int(goods[cutoff + 1])
        caught += int(bads[cutoff + 1])
        if not n or binomial_tail(lost, n, risk) > doubt:
            break
        gain = caught - weight * lost
        if best is None or gain > best[0]:
            best = (gain, cutoff, lost)
    return None if best is None else (best[1], n, best[2], upper_bound(best[2], n, doubt))


def cutoffs(
    counted: DataFrame, labels: DataFrame, id_column: str = "doc_id", stratum: str = "lang", counts: str = "counts",
    quality: str = "quality", risk: float = RISK, doubt: float = DOUBT, weight: float = WEIGHT,
) -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_lost, bound): the certified cutoff of each rule in each stratum.

    All labelled documents are used. They are counted by level before anything is gathered, so a
    group has at most STEPS + 1 rows however many documents a stratum has.
    """
    import pandas as pd

    said = labels.where(F.col(quality).isNotNull()).groupBy(F.col(id_column).alias("labelled")).agg(F.min(quality).alias("good"))
    held = counted.join(said, F.col(id_column) == F.col("labelled"))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), level(counts, r).alias("level")) for r in RULES]))
    table = held.select(F.col(stratum).alias("stratum"), "good", each.alias("r")).groupBy("stratum", "r.rule", "r.level").agg(
        F.sum((F.col("good") == 1).cast("long")).alias("good"), F.sum((F.col("good") != 1).cast("long")).alias("bad"))
    strata = held.select(stratum).distinct().count()
    part = doubt / (max(1, strata) * len(RULES))

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        found = best_cutoff(group["level"].tolist(), group["good"].tolist(), group["bad"].tolist(), risk, part, weight)
        row = {"stratum": group["stratum"].iloc[0], "rule": group["rule"].iloc[0]}
        row |= dict(zip(("cutoff", "n_good", "n_lost", "bound"), found or (None,) * 4))
        return pd.DataFrame({k: pd.Series([v], dtype=object) for k, v in row.items()})

    kind = table.schema["stratum"].dataType.simpleString()
    found = table.groupBy("stratum", "rule").applyInPandas(choose, f"stratum {kind}, rule string, cutoff int, n_good long, n_lost long, bound double")
    return cut_lineage(found.where(F.col("cutoff").isNotNull()))


def judged(counted: DataFrame, chosen: DataFrame, stratum: str = "lang", counts: str = "counts", name: str = "kept") -> DataFrame:
    """The counted documents with a verdict: false if the base rules fail or a certified cutoff is passed.

    Up to FEW cutoffs (they are counted) go to the rows, so that texts stay in place; more are joined by shuffle.
    """
    key, limits = free_name(counted, "rule_stratum"), free_name(counted, "rule_limits")
    wide = chosen.groupBy(F.col("stratum").alias(key)).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias(limits))
    above = [F.coalesce(level(counts, r) > F.col(limits)[r], F.lit(False)) for r in RULES]
    kept = ~base_failed(counts)
    for a in above:
        kept = kept & ~a
    wide = F.broadcast(wide) if chosen.limit(FEW + 1).count() <= FEW else wide
    joined = counted.join(wide, F.col(f"`{stratum}`").eqNullSafe(F.col(key)), "left")
    return joined.withColumn(name, kept).drop(key, limits)


def kept_documents(
    df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", stratum: str = "lang", **settings
) -> DataFrame:
    """All columns of the documents that no rule rejects. Texts are read twice and never shuffled."""
    chosen = cutoffs(measures(df, list(dict.fromkeys([id_column, stratum])), text), labels, id_column, stratum, **settings)
    name, verdict = free_name(df, "quality_counts"), free_name(df, "quality_kept")
    counted = measures(df, df.columns, text, name)
    return judged(counted, chosen, stratum, name, verdict).where(F.col(verdict)).select(*[F.col(f"`{c}`") for c in df.columns])
