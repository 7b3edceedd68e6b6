"""Joins that treat a missing key as a value, and join comparisons.

No broadcast hints: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and merges, splitting skew, otherwise.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]
    )


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return shared


def natural_left(left: DataFrame, right: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Left join on all shared columns, missing matching missing."""
    keys = list(by or common_columns(left, right))
    extra = [c for c in right.columns if c not in keys]
    joined = left.alias("l").join(right.alias("r"), _same(keys), "left")
    return joined.select(*[F.col(f"l.`{c}`") for c in left.columns], *[F.col(f"r.`{c}`") for c in extra])


def natural_full(left: DataFrame, right: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Full join on all shared columns, missing matching missing."""
    keys = list(by or common_columns(left, right))
    left = left.withColumn("__left", F.lit(True))
    right = right.withColumn("__right", F.lit(True))
    joined = left.alias("l").join(right.alias("r"), _same(keys), "full")
    side = F.col("__left").isNotNull()
    out = [F.when(side, F.col(f"l.`{k}`")).otherwise(F.col(f"r.`{k}`")).alias(k) for k in keys]
    out += [F.col(f"l.`{c}`") for c in left.columns if c not in keys and c != "__left"]
    out += [F.col(f"r.`{c}`") for c in right.columns if c not in keys and c != "__right"]
    order = [c for c in left.columns if c != "__left"]
    order += [c for c in right.columns if c not in order and c != "__right"]
    return joined.select(*out).select(*[F.col(f"`{c}`") for c in order])


def stack(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; absent columns are missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def semi(df: DataFrame, keys_of: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys_of.select(*on), list(on), "left_semi")


def without(df: DataFrame, keys_of: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys_of.select(*on), list(on), "left_anti")


def match_classes(
    left: DataFrame, right: DataFrame, on: Sequence[str], labels=("left only", "right only")
) -> DataFrame:
    """Keys of both tables with their rows per side and the match class.

    No join is run: the keys of both sides are stacked and counted in one pre-aggregated
    shuffle, so neither duplicates nor hot keys multiply. The join sizes follow from the
    counts: inner is ``left_rows * right_rows``.
    """
    on = list(on)
    a = left.select(*on, F.lit(1).alias("__l"), F.lit(0).alias("__r"))
    b = right.select(*on, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    counted = a.unionByName(b).groupBy(*on).agg(
        F.sum("__l").alias("left_rows"), F.sum("__r").alias("right_rows")
    )
    found = (
        F.when(F.col("right_rows") == 0, labels[0])
        .when(F.col("left_rows") == 0, labels[1])
        .otherwise("both")
    )
    return counted.withColumn("match", found)


def join_sizes(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that each join type of the two tables would give, without running them."""
    a, b = F.col("left_rows"), F.col("right_rows")
    sizes = {
        "inner": a * b,
        "left": F.when(a > 0, a * F.greatest(b, F.lit(1))),
        "right": F.when(b > 0, b * F.greatest(a, F.lit(1))),
        "full": F.greatest(a, F.lit(1)) * F.greatest(b, F.lit(1)),
        "semi": F.when(b > 0, a),
        "anti": F.when(b == 0, a),
    }
    wide = match_classes(left, right, on).agg(
        *[F.coalesce(F.sum(size), F.lit(0)).cast("long").alias(kind) for kind, size in sizes.items()]
    )
    return wide.unpivot([], list(sizes), "join_type", "result_rows")


def both_sides(
    games: DataFrame, teams: DataFrame, home: Sequence[str], away: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Look a table up twice, for the home and the away key, with prefixed columns."""
    extra = [c for c in teams.columns if c not in keys]
    out = games
    for prefix, on in (("home_", home), ("away_", away)):
        renamed = teams.select(
            *[F.col(k).alias(f"__{prefix}{k}") for k in keys],
            *[F.col(c).alias(prefix + c) for c in extra],
        )
        matched = [F.col(g) == F.col(f"__{prefix}{k}") for g, k in zip(on, keys)]
        out = out.join(renamed, matched, "inner").drop(*[f"__{prefix}{k}" for k in keys])
    return out
