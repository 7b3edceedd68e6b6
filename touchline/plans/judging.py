"""Judged sports: trimmed dive scores, fight decisions, agreement between judges."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.numeric import ratio, trimmed_sum


def dive_points(df: DataFrame, judges: Sequence[str], difficulty: str, drop_each_side: int = 2) -> DataFrame:
    """Middle scores times difficulty."""
    return df.withColumn("points", trimmed_sum(judges, drop_each_side) * F.col(difficulty))


def dive_totals(scored: DataFrame, diver: Sequence[str]) -> DataFrame:
    return scored.groupBy(*diver).agg(
        F.count(F.lit(1)).alias("dives"), F.sum("points").alias("total_points")
    )


def _side(margin: Column) -> Column:
    return F.when(margin > 0, "fighter1").when(margin < 0, "fighter2").when(margin == 0, "draw")


def fight_decisions(df: DataFrame, scores: Sequence[tuple[str, str]]) -> DataFrame:
    """Per judge: margin, percent margin, deviation from colleagues, outcome; and agreement.

    ``scores`` are the (fighter 1, fighter 2) columns of three judges.
    """
    n = len(scores)
    margins = [F.col(a) - F.col(b) for a, b in scores]
    total = margins[0]
    for margin in margins[1:]:
        total = total + margin
    out = df
    for i, (margin, (_, b)) in enumerate(zip(margins, scores), 1):
        out = out.withColumn(f"judge{i}_margin", margin)
        out = out.withColumn(f"judge{i}_perc", ratio(margin, b, 100))
        out = out.withColumn(f"judge{i}_dev", margin - (total - margin) / (n - 1))
        out = out.withColumn(f"judge{i}_out", _side(margin))
    one, two, three = (F.col(f"judge{i}_out") for i in (1, 2, 3))
    agreement = (
        F.when((one == two) & (two == three), "Agree")
        .when(one == two, "judge3").when(one == three, "judge2").when(two == three, "judge1")
        .otherwise("Disagree")
    )
    return out.withColumn("agreement", agreement)


def judge_rows(decisions: DataFrame, fight: str, judges: int = 3) -> DataFrame:
    """One row per fight and judge."""
    rows = [
        F.struct(F.lit(i).alias("judge"), F.col(f"judge{i}_margin").alias("margin"),
                 F.col(f"judge{i}_dev").alias("dev"), F.col(f"judge{i}_out").alias("outcome"))
        for i in range(1, judges + 1)
    ]
    return decisions.select(fight, F.explode(F.array(*rows)).alias("__j")).select(fight, "__j.*")


def judge_variability(rows: DataFrame) -> DataFrame:
    """Spread of each judge's margins and mean absolute deviation from colleagues."""
    return rows.groupBy("judge").agg(
        F.count(F.lit(1)).alias("fights"), F.avg("margin").alias("mean_margin"),
        F.stddev_samp("margin").alias("sd_margin"), F.avg(F.abs("dev")).alias("mean_abs_dev"),
    )


def fleiss_kappa(rows: DataFrame, subject: str, category: str) -> DataFrame:
    """Agreement of several raters: observed, by chance, kappa.

    Subjects are rated equally often; those with one rating say nothing and are left out.
    One pass of map-side combined counts: a subject keeps its counts by category in a small
    array, of which the first entry also carries the subject's own agreement.
    """
    cells = rows.where(F.col(category).isNotNull()).groupBy(subject, category).agg(F.count(F.lit(1)).alias("__c"))
    pairs = F.sum(F.col("__c") * (F.col("__c") - 1))
    subjects = cells.groupBy(subject).agg(
        F.sum("__c").alias("__n"), pairs.alias("__pairs"), F.collect_list(F.struct(category, "__c")).alias("__cells")
    ).where(F.col("__n") > 1)
    agreed = F.col("__pairs") / (F.col("__n") * (F.col("__n") - 1))
    each = subjects.select(agreed.alias("__agreed"), F.posexplode("__cells").alias("__place", "__cell"))
    once = F.col("__place") == 0
    shares = each.groupBy(f"__cell.{category}").agg(
        F.sum("__cell.__c").cast("double").alias("__k"), F.count_if(once).alias("__subjects"),
        F.sum(F.when(once, F.col("__agreed"))).alias("__agreed"))
    k = F.col("__k")
    table = shares.agg(
        F.sum("__subjects").alias("subjects"), (F.sum("__agreed") / F.sum("__subjects")).alias("observed"),
        (F.sum(k * k) / (F.sum(k) * F.sum(k))).alias("chance"))
    return table.withColumn("kappa", F.try_divide(F.col("observed") - F.col("chance"), 1 - F.col("chance")))


def cohen_kappa(df: DataFrame, first: str, second: str) -> DataFrame:
    """Agreement of two raters over rows with both ratings."""
    both = df.where(F.col(first).isNotNull() & F.col(second).isNotNull())
    cells = both.groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    sides = cells.select(
        F.explode(F.array(F.struct(F.lit(1).alias("r"), F.col("a").alias("v"), "c"),
                          F.struct(F.lit(2).alias("r"), F.col("b").alias("v"), "c"))).alias("s")
    ).select("s.*")
    margins = sides.groupBy("v").agg(
        F.sum(F.when(F.col("r") == 1, F.col("c")).otherwise(0)).alias("m1"),
        F.sum(F.when(F.col("r") == 2, F.col("c")).otherwise(0)).alias("m2"),
    )
    product = margins.agg(F.sum(F.col("m1").cast("double") * F.col("m2")).alias("p")).scalar()
    table = cells.agg(
        F.sum("c").alias("n"),
        (F.sum(F.when(F.col("a") == F.col("b"), F.col("c")).otherwise(0)) / F.sum("c")).alias("observed"),
    ).withColumn("chance", product / (F.col("n").cast("double") * F.col("n")))
    return table.withColumn("kappa", F.try_divide(F.col("observed") - F.col("chance"), 1 - F.col("chance")))
