"""Two-way tables: shares, chi-square, expected counts, exact tests, lumping, proportions."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.numeric import ratio
from touchline.functions.tails import area, hypergeometric_draw, log_factorial_gain
from touchline.operators.joins import natural_left
from touchline.operators.ordered import attach, scan
from touchline.session import cut_lineage

SPREAD = 16


def cell_counts(df: DataFrame, row: str, column: str, weight: str | None = None) -> DataFrame:
    """Counts (or summed weights) of the seen cells, missing levels left out."""
    known = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    size = F.sum(weight) if weight else F.count(F.lit(1))
    return known.groupBy(row, column).agg(size.cast("long").alias("n"))


def _margins(cells: DataFrame, row: str, column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        cells.groupBy(row).agg(F.sum("n").alias("row_n")),
        cells.groupBy(column).agg(F.sum("n").alias("column_n")),
        cells.agg(F.sum("n").alias("total")),
    )


def every_cell(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each level of one factor next to each level of another, spread over tasks.

    The result is the full table by definition. Left levels fall into ``SPREAD`` parts,
    right levels are copied to each part, and the parts meet in an equi-join.
    """
    part = F.pmod(F.xxhash64(*left.columns), F.lit(SPREAD))
    a = left.withColumn("__part", part)
    b = right.withColumn("__part", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SPREAD)])))
    return a.join(b, "__part").drop("__part")


def two_way(df: DataFrame, row: str, column: str, weight: str | None = None) -> DataFrame:
    """Seen cells with row, column and table shares."""
    cells = cell_counts(df, row, column, weight)
    rows, columns, total = _margins(cells, row, column)
    table = attach(attach(attach(cells, rows, [row]), columns, [column]), total, [])
    n = F.col("n")
    return table.select(
        row, column, "n", (n / F.col("row_n")).alias("row_share"),
        (n / F.col("column_n")).alias("column_share"), (n / F.col("total")).alias("table_share"),
    )


def with_margins(df: DataFrame, row: str, column: str) -> DataFrame:
    """Cells plus row, column and grand totals, labelled ``All``."""
    known = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    cube = known.cube(row, column).agg(F.count(F.lit(1)).alias("n"))
    return cube.select(F.coalesce(row, F.lit("All")).alias(row), F.coalesce(column, F.lit("All")).alias(column), "n")


def expected_counts(df: DataFrame, row: str, column: str, weight: str | None = None) -> DataFrame:
    """Every cell, unseen ones too: expected count, Pearson residual, share of chi-square."""
    cells = cell_counts(df, row, column, weight)
    rows, columns, total = _margins(cells, row, column)
    grid = attach(every_cell(rows, columns), total, [])
    full = natural_left(grid, cells, [row, column]).fillna(0, ["n"])
    expected = F.col("row_n") * F.col("column_n").cast("double") / F.col("total")
    full = full.withColumn("expected", expected)
    residual = (F.col("n") - F.col("expected")) / F.sqrt("expected")
    full = full.withColumn("residual", residual).withColumn("contribution", residual * residual)
    return full.select(row, column, "n", "expected", "residual", "contribution")


def chi_square(df: DataFrame, row: str, column: str, weight: str | None = None, p_value: bool = True) -> DataFrame:
    """Test of independence, from the seen cells only: n (sum o^2 / (r c) - 1)."""
    cells = cell_counts(df, row, column, weight)
    rows, columns, total = _margins(cells, row, column)
    joined = attach(attach(cells, rows, [row]), columns, [column])
    n = F.col("n").cast("double")
    core = joined.agg(
        F.sum("n").alias("n"), F.sum(n * n / F.col("row_n") / F.col("column_n")).alias("__s"),
        F.count_distinct(row).alias("__r"), F.count_distinct(column).alias("__c"),
    )
    test = core.select(
        "n", (F.col("n") * (F.col("__s") - 1)).alias("chi_square"),
        ((F.col("__r") - 1) * (F.col("__c") - 1)).alias("df"),
    )
    return test.withColumn("p_value", area("chi2", "chi_square", F.col("df").cast("double"))) if p_value else test


def fisher_2x2(
    df: DataFrame, row: str, column: str, levels: tuple[tuple, tuple], keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact two-sided test and sample odds ratio per group; counts (or summed weights) come from one pass."""
    (r1, r2), (c1, c2) = levels

    def count(r, c):
        here = (F.col(row) == r) & (F.col(column) == c)
        return F.coalesce(F.sum(F.when(here, F.col(weight))), F.lit(0)).cast("long") if weight else F.count_if(here)

    table = df.groupBy(*keys).agg(
        count(r1, c1).alias("a"), count(r1, c2).alias("b"), count(r2, c1).alias("c"), count(r2, c2).alias("d")
    )
    odds = F.try_divide(F.col("a") * F.col("d").cast("double"), F.col("b") * F.col("c").cast("double"))
    return table.withColumn("odds_ratio", odds).withColumn("p_value", area("fisher", "a", "b", "c", "d"))


def fisher_monte_carlo(df: DataFrame, row: str, column: str, tables: int, seed: int, weight: str | None = None) -> DataFrame:
    """Exact test of an r x c table by random tables with the same margins.

    Only the margins reach the driver; the random tables are drawn and scored in tasks, the seen one in
    Spark. A table of more than ``MAX_CELLS`` cells raises an error. Tables are scored by their distance from the expected one in log factorials, which keeps its digits for
    counts of any size.
    """
    cells = cut_lineage(cell_counts(df, row, column, weight))
    rows, columns, _ = _margins(cells, row, column)
    row_n = _level_sizes(rows, row, "row_n")
    column_n = _level_sizes(columns, column, "column_n")
    if len(row_n) * len(column_n) > MAX_CELLS:
        raise ValueError(f"{row} and {column} make more than {MAX_CELLS} cells")
    total = sum(row_n)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            middle = np.array([int(r) * int(c) // total for r, c in zip(batch["row_n"], batch["column_n"])], dtype=float)
            yield pd.DataFrame({"score": [float(log_factorial_gain(middle, batch["n"].to_numpy(float) - middle).sum())]})

    # log-probability of a table given its margins, up to a constant: - sum log n!, as gains over a middle table; unseen cells count too
    grid = natural_left(every_cell(rows, columns), cells, [row, column]).fillna(0, ["n"])
    seen = grid.select("row_n", "column_n", "n").mapInPandas(score, "score double").agg(F.sum("score")).first()[0] or 0.0

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        middle = np.array([[r * c // total for c in column_n] for r in row_n], dtype=float)
        for batch in batches:
            scores = []
            for number in batch["id"]:
                random = np.random.default_rng([seed, int(number)])
                left, made = list(column_n), []
                for size in row_n:
                    rest, taken = sum(left), []
                    for have in left:
                        rest -= have
                        one = hypergeometric_draw(random, have, rest, size) if size else 0
                        taken.append(one)
                        size -= one
                    left = [a - b for a, b in zip(left, taken)]
                    made.append(taken)
                scores.append(float(log_factorial_gain(middle, np.array(made, dtype=float) - middle).sum()))
            yield pd.DataFrame({"score": scores})

    drawn = df.sparkSession.range(tables).mapInPandas(draw, "score double")
    hits = F.count_if(F.col("score") >= seen - 1e-7)
    return drawn.agg(((hits + 1) / (F.count(F.lit(1)) + 1)).alias("p_value"), F.count(F.lit(1)).alias("tables"))


MAX_LEVELS, MAX_CELLS = 10_000, 1_000_000


def _level_sizes(margin: DataFrame, level: str, size: str) -> list[int]:
    found = margin.orderBy(level).limit(MAX_LEVELS + 1).collect()
    if len(found) > MAX_LEVELS:
        raise ValueError(f"{level} has more than {MAX_LEVELS} levels")
    return [int(r[size]) for r in found]


def proportions(df: DataFrame, keys: Sequence[str], success: str, level: float, null: float) -> DataFrame:
    """Proportion of a boolean per group with its normal interval and test against ``null``."""
    counted = df.where(F.col(success).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(success)).alias("successes")
    )
    p = F.col("successes") / F.col("n")
    from statistics import NormalDist

    z = NormalDist().inv_cdf((1 + level) / 2)
    margin = z * F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("n"))
    table = counted.withColumn("p", p).withColumn("low", F.col("p") - margin).withColumn("high", F.col("p") + margin)
    score = (F.col("p") - null) / F.sqrt(F.lit(null * (1 - null)) / F.col("n"))
    return table.withColumn("z", score).withColumn("p_value", area("normal", "z"))


def odds_ratio(df: DataFrame, exposed: str, success: str, level: float = 0.95) -> DataFrame:
    """Odds ratio of two booleans with its log-scale interval."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf((1 + level) / 2)

    def count(e, s):
        return F.count_if((F.col(exposed) == F.lit(e)) & (F.col(success) == F.lit(s))).cast("double")

    table = df.agg(count(True, True).alias("a"), count(True, False).alias("b"),
                   count(False, True).alias("c"), count(False, False).alias("d"))
    table = table.withColumn("odds_ratio", F.try_divide(F.col("a") * F.col("d"), F.col("b") * F.col("c")))
    table = table.withColumn("log_se", F.sqrt(1 / F.col("a") + 1 / F.col("b") + 1 / F.col("c") + 1 / F.col("d")))
    log = F.ln("odds_ratio")
    return table.withColumn("low", F.exp(log - z * F.col("log_se"))).withColumn(
        "high", F.exp(log + z * F.col("log_se"))
    )


def lump(cells: DataFrame, column: str, weight: str, keep: int, other: str = "Other") -> DataFrame:
    """Keep the ``keep`` heaviest levels of a column, name the rest ``other``.

    Ties are settled by the level's name. The table is re-aggregated afterwards.
    """
    levels = cells.groupBy(column).agg(F.sum(weight).alias("__w"))
    top = levels.orderBy(F.col("__w").desc(), F.col(column)).limit(keep)
    top = top.select(column, F.lit(True).alias("__top"))
    marked = attach(cells, top, [column])
    named = marked.withColumn(column, F.when(F.col("__top"), F.col(column)).otherwise(other)).drop("__top")
    rest = [c for c in cells.columns if c != weight]
    return named.groupBy(*rest).agg(F.sum(weight).alias(weight))


def lump_counts(value, limit: int):
    """0, 1, .. as text with ``limit`` and above in one level: ``3+``."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value >= limit, F.lit(f"{limit}+")).otherwise(value.cast("string"))


def cumulative_share(cells: DataFrame, label: str, weight: str) -> DataFrame:
    """Levels from heaviest to lightest with their share and running share."""
    cells = cut_lineage(cells)
    whole = cells.agg(F.sum(weight).alias("__all"))
    run = attach(scan(cells, [], [f"-{weight}", label], running={"__upto": weight}), whole, [])
    return run.select(label, weight, ratio(weight, "__all").alias("share"),
                      ratio("__upto", "__all").alias("running_share"))
