"""Exact quantiles (linear interpolation) that never gather a large group."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.ordered import attach, hot_split, scan


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """One row per group with a column per probability.

    Groups within the hot-group size use the built-in exact ``percentile``. With a
    larger group all are counted by distinct value, the counts summed up in value
    order over split ranges, and the two rows around each position picked.
    """
    keys = list(keys)
    present = df.select(*keys, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    split = hot_split(present, keys, ["__v"])
    if not (split.active or split.large):
        picks = F.percentile("__v", F.array(*[F.lit(float(p)) for p in probs.values()]))
        rows = present.groupBy(*keys).agg(picks.alias("__p"))
        return rows.select(*keys, *[F.col("__p")[i].alias(name) for i, name in enumerate(probs)])
    counts = present.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    summed = scan(counts, keys, ["__v"], running={"__upto": "__c"}, split=split)
    sizes = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    placed = attach(summed, sizes, keys, measure=True)
    before = F.col("__upto") - F.col("__c")
    picks = []
    for i, p in enumerate(probs.values()):
        at = (F.col("__n") - 1) * F.lit(float(p))
        for end, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (before <= index) & (index < F.col("__upto"))
            picks.append(F.max(F.when(holds, F.col("__v"))).alias(f"__{end}{i}"))
        picks += [F.max(at - F.floor(at)).alias(f"__f{i}"), F.max(F.ceil(at) - at).alias(f"__c{i}")]
    found = placed.groupBy(*keys).agg(*picks)
    mixed = []
    for i, name in enumerate(probs):  # the sums of the built-in function, to the last bit
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        between = F.col(f"__c{i}") * low + F.col(f"__f{i}") * high
        mixed.append(F.when(low == high, low).otherwise(between).alias(name))
    return found.select(*keys, *mixed)


def quantiles_long(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Mapping[str, float]
) -> DataFrame:
    """The same for several columns at once: one row per group and ``measure``."""
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), list(columns), "measure", "value"
    )
    return quantiles(long, [*keys, "measure"], "value", probs)
