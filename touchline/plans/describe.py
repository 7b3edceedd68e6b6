"""Descriptive statistics and plot data. Each is an aggregate over map-side partial sums."""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.tails import area
from touchline.operators.joins import natural_left
from touchline.operators.ordered import attach, scan, whole_keys
from touchline.operators.quantiles import quantiles, quantiles_long

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def histogram(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over each group's range, empty bins included."""
    keys = list(keys)
    present = df.select(*keys, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    limits = present.groupBy(*keys).agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    placed = attach(present, limits, keys, measure=True)
    spread = F.col("__high") - F.col("__low")
    step = F.coalesce(F.floor(F.try_divide(F.col("__v") - F.col("__low"), spread) * bins), F.lit(0))
    counts = placed.groupBy(*keys, (F.least(step, F.lit(bins - 1)) + 1).cast("int").alias("bin"))
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    spine = limits.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    width = spread / bins
    spine = spine.select(
        *keys, "bin", (F.col("__low") + width * (F.col("bin") - 1)).alias("bin_from"),
        (F.col("__low") + width * F.col("bin")).alias("bin_to"),
    )
    return natural_left(spine, counts, [*keys, "bin"]).fillna(0, ["n"])


def summary(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """n, mean, sd, five numbers, range and IQR per group and column, in long form."""
    keys = list(keys)
    stats = {"n": F.count, "mean": F.avg, "sd": F.stddev_samp, "lowest": F.min, "highest": F.max}
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        keys, list(columns), "measure", "value"
    )
    moments = long.groupBy(*keys, "measure").agg(*[f("value").alias(name) for name, f in stats.items()])
    cuts = quantiles_long(df, keys, columns, QUARTILES)
    table = natural_left(moments, cuts, [*keys, "measure"])
    return table.withColumn("range", F.col("highest") - F.col("lowest")).withColumn(
        "iqr", F.col("q3") - F.col("q1")
    )


def fences(df: DataFrame, keys: Sequence[str], value: str, factor: float = 1.5) -> DataFrame:
    cuts = quantiles(df, keys, value, QUARTILES)
    iqr = F.col("q3") - F.col("q1")
    return cuts.withColumn("low_fence", F.col("q1") - factor * iqr).withColumn(
        "high_fence", F.col("q3") + factor * iqr
    )


def outliers(df: DataFrame, keys: Sequence[str], value: str, factor: float = 1.5) -> DataFrame:
    """Rows outside the fences of their group (factor 3 for extreme ones)."""
    limits = fences(df, keys, value, factor).drop("q1", "median", "q3")
    marked = attach(df, limits, keys, measure=True)
    return marked.where((F.col(value) < F.col("low_fence")) | (F.col(value) > F.col("high_fence")))


def boxplot(df: DataFrame, keys: Sequence[str], value: str, factor: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and number of outliers per group."""
    limits = fences(df, keys, value, factor)
    marked = attach(df.select(*keys, value).where(F.col(value).isNotNull()), limits, keys, measure=True)
    inside = F.col(value).between(F.col("low_fence"), F.col("high_fence"))
    return marked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in QUARTILES],  # one value per group
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col(value))).alias("low_whisker"),
        F.max(F.when(inside, F.col(value))).alias("high_whisker"),
        F.count_if(~inside).alias("n_outliers"),
    )


def z_scores(df: DataFrame, keys: Sequence[str], value: str, out: str = "z") -> DataFrame:
    """Standardise within groups: aggregate first, then join the moments back."""
    moments = df.groupBy(*keys).agg(F.avg(value).alias("__mean"), F.stddev_samp(value).alias("__sd"))
    scored = attach(df, moments, keys, measure=True)
    z = F.try_divide(F.col(value) - F.col("__mean"), F.col("__sd"))
    return scored.withColumn(out, z).drop("__mean", "__sd")


def band_shares(df: DataFrame, keys: Sequence[str], value: str, bands: Mapping[str, tuple]) -> DataFrame:
    """Share of rows in each band (low inclusive, high exclusive; ``None`` for open)."""

    def inside(low, high) -> Column:
        test = F.col(value).isNotNull()
        if low is not None:
            test = test & (F.col(value) >= low)
        return test & (F.col(value) < high) if high is not None else test

    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(inside(*limits).cast("double")).alias(name) for name, limits in bands.items()],
    )


def normal_shares(df: DataFrame, keys: Sequence[str], value: str, cut: float) -> DataFrame:
    """Share above a cut: seen, and under a normal model with the group's mean and sd."""
    table = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
        F.avg((F.col(value) > cut).cast("double")).alias("share_above"),
    )
    z = F.try_divide(F.lit(float(cut)) - F.col("mean"), F.col("sd"))
    return table.withColumn("z", z).withColumn("normal_above", 1 - area("normal_cdf", z))


def shape(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Population skewness and excess kurtosis."""
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), list(columns), "measure", "value"
    )
    return long.groupBy(*keys, "measure").agg(
        F.count("value").alias("n"), F.skewness("value").alias("skewness"), F.kurtosis("value").alias("kurtosis")
    )


def modes(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Local peaks of the histogram: bins higher than both neighbours."""
    counts = histogram(df, value, bins, keys)
    split = whole_keys(counts, keys, ["bin"])  # a key has as many rows as bins
    near = scan(counts, keys, ["bin"], lag={"__before": "n"}, lead={"__after": "n"}, split=split)
    higher = (F.col("n") > F.coalesce("__before", F.lit(0))) & (F.col("n") > F.coalesce("__after", F.lit(0)))
    return near.where(higher).drop("__before", "__after")


def correlations(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Every pair's Pearson correlation over rows with both values, in long form; one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs += [F.corr(a, b).alias(f"r{i}"), F.count_if(both).alias(f"n{i}")]
    wide = df.groupBy(*keys).agg(*aggs)
    rows = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(*keys, F.explode(F.array(*rows)).alias("__p")).select(*keys, "__p.*")


def screen(df: DataFrame, responses: Sequence[str], predictors: Sequence[str]) -> DataFrame:
    """Correlation, R squared and slope of each response on each predictor; one pass."""
    aggs, rows = [], []
    for i, y in enumerate(responses):
        for j, x in enumerate(predictors):
            at = f"{i}_{j}"
            aggs += [F.corr(y, x).alias(f"r{at}"), F.regr_slope(y, x).alias(f"b{at}")]
            r = F.col(f"r{at}")
            rows.append(F.struct(F.lit(y).alias("response"), F.lit(x).alias("predictor"), r.alias("r"),
                                 (r * r).alias("r2"), F.col(f"b{at}").alias("slope")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("__p")).select("__p.*")


def scatter_grid(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Scatter as cell counts with the least-squares line at each cell's middle."""
    cells = joint_frequency(df, x, y, x_width, y_width)
    line = df.agg(F.regr_slope(y, x).alias("__b"), F.regr_intercept(y, x).alias("__a"))
    middle = (F.col("x_cell") + 0.5) * x_width
    fitted = attach(cells, line, []).withColumn("fitted", F.col("__a") + F.col("__b") * middle)
    return fitted.drop("__a", "__b")


def joint_frequency(
    df: DataFrame, x: str, y: str, x_width: float, y_width: float, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows per grid cell (and per outcome, team, ...), with the share within the key."""
    counts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(
        *keys, F.floor(F.col(x) / x_width).alias("x_cell"), F.floor(F.col(y) / y_width).alias("y_cell")
    ).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("__all"))
    shared = attach(counts, totals, keys)
    return shared.withColumn("share", F.col("n") / F.col("__all")).drop("__all")


def _kernel(distance: Column, bandwidth: float) -> Column:
    z = distance / F.lit(float(bandwidth))
    return F.exp(-z * z / 2) / F.lit(bandwidth * math.sqrt(2 * math.pi))


def _cell(value: Column, low: float, step: float, points: int, bandwidth: float) -> Column:
    """Nearest grid cell. Nine bandwidths off the grid the kernel is below 1e-17."""
    beyond = math.ceil(9 * bandwidth / step)
    cell = F.round((value - F.lit(float(low))) / F.lit(step)).cast("double")
    return F.greatest(F.lit(-beyond), F.least(F.lit(points - 1 + beyond), cell)).cast("long")


def density(
    df: DataFrame, value: str, low: float, high: float, points: int, bandwidth: float, keys: Sequence[str] = ()
) -> DataFrame:
    """Gaussian kernel density on ``points`` grid points, from counts at the nearest point.

    Rows are counted per grid point first; only those counts meet the kernel, so work
    after the first aggregate is about ``points`` squared per key. Values beyond the grid
    still count, at the continued grid.
    """
    keys = list(keys)
    step = (high - low) / (points - 1)
    near = _cell(F.col(value), low, step, points, bandwidth).alias("__cell")
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, near).agg(F.count(F.lit(1)).alias("__n"))
    totals = counts.groupBy(*keys).agg(F.sum("__n").alias("__all"))
    reach = counts.select(*keys, "__cell", "__n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    weight = _kernel((F.col("point") - F.col("__cell")) * F.lit(step), bandwidth)
    summed = reach.groupBy(*keys, "point").agg(F.sum(F.col("__n") * weight).alias("__w"))
    at = (F.lit(float(low)) + F.col("point") * F.lit(step)).alias("at")
    return attach(summed, totals, keys).select(*keys, "point", at, (F.col("__w") / F.col("__all")).alias("density"))


def density_2d(
    df: DataFrame, x: str, y: str, x_range: tuple[float, float], y_range: tuple[float, float],
    points: int, x_bandwidth: float, y_bandwidth: float,
) -> DataFrame:
    """The same on a square grid; the kernel is applied one axis at a time."""

    def step(limits):
        return (limits[1] - limits[0]) / (points - 1)

    cells = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(
        _cell(F.col(x), x_range[0], step(x_range), points, x_bandwidth).alias("__x"),
        _cell(F.col(y), y_range[0], step(y_range), points, y_bandwidth).alias("__y"),
    ).agg(F.count(F.lit(1)).cast("double").alias("__w"))
    total = cells.agg(F.sum("__w").alias("__all"))
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    along_x = cells.select("*", grid.alias("x_point"))
    weight = F.col("__w") * _kernel((F.col("x_point") - F.col("__x")) * F.lit(step(x_range)), x_bandwidth)
    along_x = along_x.groupBy("x_point", "__y").agg(F.sum(weight).alias("__w"))
    along_y = along_x.select("*", grid.alias("y_point"))
    weight = F.col("__w") * _kernel((F.col("y_point") - F.col("__y")) * F.lit(step(y_range)), y_bandwidth)
    summed = along_y.groupBy("x_point", "y_point").agg(F.sum(weight).alias("__w"))
    return attach(summed, total, []).select(
        "x_point", "y_point", (F.col("__w") / F.col("__all")).alias("density")
    )


def missing_profile(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Missing values per column and group, and rows kept by complete-case filtering."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(complete).alias("complete_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    long = counted.unpivot([*keys, "n_rows", "complete_rows"], list(columns), "column_name", "missing")
    return long.withColumn("missing_share", F.try_divide(F.col("missing").cast("double"), F.col("n_rows")))


def normal_quantiles(df: DataFrame, value: str, points: int) -> DataFrame:
    """Sample quantiles against those of a normal with the same mean and sd."""
    probs = {f"p{i}": (i - 0.5) / points for i in range(1, points + 1)}
    moments = df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    wide = attach(quantiles(df, [], value, probs), moments, [])
    rows = [F.struct(F.lit(i).alias("point"), F.lit(p).alias("p"), F.col(name).alias("sample"))
            for i, (name, p) in enumerate(probs.items(), 1)]
    long = wide.select("mean", "sd", F.explode(F.array(*rows)).alias("q")).select("q.*", "mean", "sd")
    return long.select(
        "point", "p", "sample", (F.col("mean") + F.col("sd") * area("normal_quantile", "p")).alias("normal")
    )


def against_average(df: DataFrame, value: str, keys: Sequence[str] = (), out: str = "above_average") -> DataFrame:
    """Flag rows above the mean of all rows, or of their group."""
    means = df.groupBy(*keys).agg(F.avg(value).alias("__mean"))
    return attach(df, means, keys, measure=True).withColumn(out, F.col(value) > F.col("__mean")).drop("__mean")


def group_means(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    moments = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    return attach(moments, quantiles(df, keys, value, {"median": 0.5}), keys)


def leader(df: DataFrame, keys: Sequence[str], label: str, measure: str) -> DataFrame:
    """Label with the largest measure per group; the first label wins a tie."""
    top = df.groupBy(*keys).agg(F.max(measure).alias("__top"))
    tied = attach(df, top, keys).where(F.col(measure) == F.col("__top"))
    return tied.groupBy(*keys).agg(F.min(label).alias(label), F.max("__top").alias(measure))
