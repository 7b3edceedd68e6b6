"""Intervals and tests on means. Spark adds up moments; tails are taken on the result."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.tails import area
from touchline.operators.ordered import attach
from touchline.operators.quantiles import quantiles
from touchline.operators.sampling import bootstrap_means
from touchline.plans.contingency import every_cell
from touchline.plans.solvers import conjugate_gradients, connected
from touchline.session import cut_lineage


def _moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")
    )


def mean_interval(df: DataFrame, keys: Sequence[str], value: str, level: float = 0.95) -> DataFrame:
    """t interval for the mean per group."""
    table = _moments(df, keys, value)
    table = table.withColumn("se", F.col("sd") / F.sqrt("n"))
    t = area("t_quantile", F.lit((1 + level) / 2), F.when(F.col("n") > 1, F.col("n") - 1).cast("double"))
    table = table.withColumn("__m", t * F.col("se"))
    return table.withColumn("low", F.col("mean") - F.col("__m")).withColumn(
        "high", F.col("mean") + F.col("__m")
    ).drop("__m")


def two_samples(
    df: DataFrame, value: str, group: str, first, second, keys: Sequence[str] = (), level: float = 0.95
) -> DataFrame:
    """Welch and pooled t tests of two groups' means with intervals, long by ``method``."""
    known = df.where(F.col(group).isin(first, second))
    one, two = (F.when(F.col(group) == g, F.col(value)) for g in (first, second))
    table = known.groupBy(*keys).agg(
        *[f(side).alias(f"{name}{i}") for i, side in ((1, one), (2, two))
          for name, f in (("n", F.count), ("mean", F.avg), ("v", F.var_samp))]
    )
    n1, n2, v1, v2 = (F.col(c) for c in ("n1", "n2", "v1", "v2"))
    e1, e2 = v1 / n1, v2 / n2
    welch_df = F.try_divide((e1 + e2) * (e1 + e2), e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1))
    pooled = F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, n1 + n2 - 2)
    methods = F.array(
        F.struct(F.lit("welch").alias("method"), F.sqrt(e1 + e2).alias("se"), welch_df.alias("df")),
        F.struct(F.lit("pooled").alias("method"), F.sqrt(pooled * (1 / n1 + 1 / n2)).alias("se"),
                 (n1 + n2 - 2).cast("double").alias("df")),
    )
    rows = table.where((n1 > 1) & (n2 > 1)).select(*keys, "n1", "n2", "mean1", "mean2",
                                                   F.explode(methods).alias("m"))
    rows = rows.select(*keys, "m.method", "n1", "n2", "mean1", "mean2",
                       (F.col("mean1") - F.col("mean2")).alias("difference"), "m.se", "m.df")
    rows = rows.withColumn("t", F.try_divide("difference", "se"))
    margin = area("t_quantile", F.lit((1 + level) / 2), "df") * F.col("se")
    rows = rows.withColumn("__m", margin).withColumn("low", F.col("difference") - F.col("__m"))
    rows = rows.withColumn("high", F.col("difference") + F.col("__m")).drop("__m")
    return rows.withColumn("p_value", area("t", "t", "df"))


def paired(df: DataFrame, first: str, second: str, keys: Sequence[str] = (), level: float = 0.95) -> DataFrame:
    """Paired t test on rows with both values."""
    both = df.withColumn("__d", F.col(first) - F.col(second)).where(F.col("__d").isNotNull())
    table = mean_interval(both, keys, "__d", level)
    table = table.withColumn("t", F.try_divide("mean", "se"))
    return table.withColumn("p_value", area("t", "t", (F.col("n") - 1).cast("double")))


def group_squares(df: DataFrame, factor: str, response: str, keys: Sequence[str] = ()) -> DataFrame:
    """Level sizes, means and inner sums of squares, the base of ANOVA."""
    known = df.where(F.col(factor).isNotNull() & F.col(response).isNotNull())
    return known.groupBy(*keys, factor).agg(
        F.count(F.lit(1)).alias("n"), F.avg(response).alias("mean"),
        (F.var_pop(response) * F.count(F.lit(1))).alias("inner_ss"),
    )


def anova(df: DataFrame, factor: str, response: str, keys: Sequence[str] = ()) -> DataFrame:
    """One-way analysis of variance with its sums of squares."""
    levels = group_squares(df, factor, response, keys)
    overall = levels.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("__mean"))
    gap = F.col("mean") - F.col("__mean")
    table = attach(levels, overall, keys).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("levels"),
        F.sum(F.col("n") * gap * gap).alias("between_ss"), F.sum("inner_ss").alias("within_ss"),
    )
    table = table.withColumn("df_between", F.col("levels") - 1).withColumn("df_within", F.col("n") - F.col("levels"))
    between = F.try_divide(F.col("between_ss"), F.col("df_between"))
    within = F.try_divide(F.col("within_ss"), F.col("df_within"))
    table = table.withColumn("mse", within).withColumn("f", F.try_divide(between, within))
    p = area("f", "f", F.col("df_between").cast("double"), F.col("df_within").cast("double"))
    return table.withColumn("p_value", p)


def pairwise(df: DataFrame, factor: str, response: str, level: float = 0.95) -> DataFrame:
    """All pairs of level means: difference, LSD interval and p, Tukey's HSD p.

    Works on one row per level. The pairs are the result; they are formed by an
    equi-join over several parts, so no task holds them all.
    """
    levels = group_squares(df, factor, response)
    pooled = anova(df, factor, response).select("mse", "df_within", F.col("levels").alias("__k"))
    a = levels.select(F.col(factor).alias("first"), F.col("n").alias("n1"), F.col("mean").alias("mean1"))
    b = levels.select(F.col(factor).alias("second"), F.col("n").alias("n2"), F.col("mean").alias("mean2"))
    pairs = every_cell(a, b).where(F.col("first") < F.col("second"))
    rows = attach(pairs, pooled, [])
    rows = rows.withColumn("difference", F.col("mean1") - F.col("mean2"))
    rows = rows.withColumn("se", F.sqrt(F.col("mse") * (1 / F.col("n1") + 1 / F.col("n2"))))
    df_ = F.col("df_within").cast("double")
    rows = rows.withColumn("t", F.try_divide("difference", "se"))
    rows = rows.withColumn("__m", area("t_quantile", F.lit((1 + level) / 2), df_) * F.col("se"))
    rows = rows.withColumn("lsd_low", F.col("difference") - F.col("__m"))
    rows = rows.withColumn("lsd_high", F.col("difference") + F.col("__m"))
    rows = rows.withColumn("lsd_p", area("t", "t", df_))
    spread = F.abs("t") * F.sqrt(F.lit(2.0))
    rows = rows.withColumn("hsd_p", area("range", spread, F.col("__k").cast("double"), df_))
    return rows.drop("__m", "__k", "mse", "df_within")


def two_way_anova(df: DataFrame, first: str, second: str, response: str) -> DataFrame:
    """Unbalanced two-way ANOVA: each main effect beside the other (``ss``, type II), and
    in the given order (``ss_in_order``, type I), and the interaction.

    Works on the counted cells (level by level), whatever the number of levels. The second factor beside the first is one
    sparse system, with an unknown for each of its levels, solved by conjugate gradients whose products are joins and sums over
    the cells; degrees of freedom come from the connected parts of the graph of levels that occur together.
    """
    used = df.where(F.col(response).isNotNull()).dropna(subset=[first, second])
    middle = used.agg(F.avg(response)).first()[0]
    if middle is None:
        raise ValueError("no complete cases")
    y = F.col(response).cast("double") - F.lit(float(middle))
    cells = cut_lineage(used.groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(y).alias("s"), (F.var_pop(response) * F.count(F.lit(1))).alias("ss")))
    levels = {c: cells.groupBy(c).agg(F.sum("n").alias(f"n_{c}"), F.sum("s").alias(f"s_{c}")) for c in "ab"}
    alone = {c: t.agg(F.count(F.lit(1)).alias("k"), F.sum(F.col(f"s_{c}") * F.col(f"s_{c}") / F.col(f"n_{c}")).alias("ss")).first() for c, t in levels.items()}
    whole = cells.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("ss").alias("within"),
                      F.sum(F.col("s") * F.col("s") / F.col("n")).alias("ss")).first()
    # what the second factor's sums still say once every level of the first has its own mean
    beside = cut_lineage(cells.join(levels["a"], "a"))
    left = F.col("s") - F.col("n") * F.col("s_a") / F.col("n_a")
    system = beside.groupBy("b").agg(
        F.sum(left).alias("right"), F.lit(0.0).alias("mean"), F.sum(F.col("n") - F.col("n") * F.col("n") / F.col("n_a")).alias("diagonal"))

    def product(vector: DataFrame) -> DataFrame:
        rows = beside.join(vector, "b")
        shared = rows.groupBy("a").agg(F.sum(F.col("n") * F.col("p")).alias("u"))
        return rows.join(shared, "a").groupBy("b").agg(F.sum(F.col("n") * (F.col("p") - F.col("u") / F.col("n_a"))).alias("q"))

    solved = conjugate_gradients(system, "b", product, tolerance=1e-11)
    second_beside = float(solved.agg(F.sum(F.col("x") * F.col("right"))).first()[0])
    first_beside = alone["a"]["ss"] + second_beside - alone["b"]["ss"]
    parts = connected(cells.select(F.to_json(F.struct("a")).alias("a"), F.to_json(F.struct("b")).alias("b")), "a", "b").select("label").distinct().count()
    both = whole["ss"] - alone["a"]["ss"] - second_beside
    rank, df_within = alone["a"]["k"] + alone["b"]["k"] - parts, int(whole["n"]) - whole["k"]
    within = whole["within"]
    rows = [(first, alone["a"]["ss"], first_beside, rank - alone["b"]["k"]), (second, second_beside, second_beside, rank - alone["a"]["k"]),
            (f"{first}:{second}", both, both, whole["k"] - rank), ("residual", within, within, df_within)]
    table = df.sparkSession.createDataFrame(
        [(t, float(in_order), float(ss), int(d), within / df_within if df_within else None) for t, in_order, ss, d in rows],
        "term string, ss_in_order double, ss double, df long, __mse double",
    )
    f = F.when(F.col("term") != "residual", F.try_divide(F.col("ss"), F.col("df") * F.col("__mse")))
    table = table.withColumn("f", f)
    p = area("f", "f", F.col("df").cast("double"), F.lit(float(df_within)))
    return table.withColumn("p_value", p).drop("__mse")


def correlation_test(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    table = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("r"))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    table = table.withColumn("t", t)
    return table.withColumn("p_value", area("t", "t", (F.col("n") - 2).cast("double")))


def bootstrap_interval(
    df: DataFrame, keys: Sequence[str], value: str, ids: Sequence[str], copies: int, seed: int, level: float = 0.95
) -> DataFrame:
    """Percentile interval of the mean over bootstrap copies."""
    means = cut_lineage(bootstrap_means(df, keys, value, ids, copies, seed))  # a few rows per group
    ends = {"low": (1 - level) / 2, "high": (1 + level) / 2}
    spread = means.groupBy(*keys).agg(F.avg("mean").alias("center"), F.stddev_samp("mean").alias("se"))
    return attach(spread, quantiles(means, keys, "mean", ends), keys)
