"""Linear models from one pass of cross moments, and logistic models on grouped cells.

The data are read once per fit, into a k x k table of (co)variances that Spark adds up
partition by partition. Solving it, comparing subsets and picking a penalty never
touch the data again.
"""
from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.tails import area, f_upper, t_quantile, t_two_sided
from touchline.session import cut_lineage


@dataclass(frozen=True)
class Moments:
    """Rows, means and centred cross products of some columns (complete cases)."""

    names: tuple[str, ...]
    n: float
    rows: int
    mean: np.ndarray
    cross: np.ndarray

    def pick(self, names: Sequence[str]) -> "Moments":
        at = [self.names.index(v) for v in names]
        return Moments(tuple(names), self.n, self.rows, self.mean[at], self.cross[np.ix_(at, at)])

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        gap = other.mean - self.mean
        cross = self.cross + other.cross + np.outer(gap, gap) * self.n * other.n / n
        mean = self.mean + gap * other.n / n
        return Moments(self.names, n, self.rows + other.rows, mean, cross)


def _moment_aggs(names: Sequence[str]) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.avg(v).alias(f"m{i}") for i, v in enumerate(names)]
    for i, a in enumerate(names):
        for j in range(i, len(names)):
            aggs.append(F.covar_pop(a, names[j]).alias(f"c{i}_{j}"))
    return aggs


def _read_moments(row, names: Sequence[str]) -> Moments:
    k, n = len(names), row["rows"]
    if not n:
        raise ValueError("no complete cases")
    cross = np.zeros((k, k))
    for i, j in itertools.combinations_with_replacement(range(k), 2):
        cross[i, j] = cross[j, i] = row[f"c{i}_{j}"] * n
    return Moments(tuple(names), float(n), int(n), np.array([row[f"m{i}"] for i in range(k)], float), cross)


def moments(df: DataFrame, names: Sequence[str], weight: str | None = None) -> Moments:
    """Means and centred cross products in one aggregate (two when weighted)."""
    names = list(names)
    used = df.select(*[F.col(v).cast("double").alias(v) for v in names], *([weight] if weight else []))
    used = used.dropna()
    if weight is None:
        return _read_moments(used.agg(*_moment_aggs(names)).first(), names)
    w = F.col(weight).cast("double")
    first = used.agg(F.count(F.lit(1)), F.sum(w), *[F.sum(w * F.col(v)) / F.sum(w) for v in names]).first()
    mean = [float(v) for v in first[2:]]
    centred = [F.col(v) - F.lit(m) for v, m in zip(names, mean)]
    pairs = list(itertools.combinations_with_replacement(range(len(names)), 2))
    sums = used.agg(*[F.sum(w * centred[i] * centred[j]) for i, j in pairs]).first()
    cross = np.zeros((len(names), len(names)))
    for (i, j), value in zip(pairs, sums):
        cross[i, j] = cross[j, i] = value
    return Moments(tuple(names), float(first[1]), int(first[0]), np.array(mean), cross)


def moments_by(df: DataFrame, names: Sequence[str], key: str, most: int) -> dict:
    """Moments per value of a key with at most ``most`` values (folds), still one pass."""
    used = df.select(key, *[F.col(v).cast("double").alias(v) for v in names]).dropna()
    rows = used.groupBy(key).agg(*_moment_aggs(list(names))).limit(most + 1).collect()
    return {r[key]: _read_moments(r, names) for r in rows}


@dataclass(frozen=True)
class Fit:
    """A fitted linear model."""

    response: str
    predictors: tuple[str, ...]
    rows: int
    beta: np.ndarray          # intercept first
    inverse: np.ndarray       # (X'X)^-1, intercept first
    sse: float
    sst: float

    @property
    def df(self) -> int:
        return self.rows - len(self.beta)

    @property
    def sigma(self) -> float:
        return math.sqrt(max(self.sse, 0.0) / self.df) if self.df > 0 else math.nan

    @property
    def r2(self) -> float:
        return 1 - self.sse / self.sst

    @property
    def adjusted(self) -> float:
        return 1 - (1 - self.r2) * (self.rows - 1) / self.df

    @property
    def aic(self) -> float:
        return self.rows * (math.log(2 * math.pi * self.sse / self.rows) + 1) + 2 * (len(self.beta) + 1)

    @property
    def f(self) -> float:
        k = len(self.predictors)
        return (self.sst - self.sse) / k / (self.sse / self.df)

    def coefficients(self, spark: SparkSession, level: float = 0.95) -> DataFrame:
        """Estimate, standard error, t, p and interval per term."""
        cut = t_quantile((1 + level) / 2, self.df)
        rows = []
        for i, term in enumerate(("(Intercept)", *self.predictors)):
            b, se = float(self.beta[i]), self.sigma * math.sqrt(max(self.inverse[i, i], 0.0))
            t = b / se if se else math.inf
            rows.append((term, b, se, t, t_two_sided(t, self.df), b - cut * se, b + cut * se))
        return spark.createDataFrame(
            rows, "term string, estimate double, std_error double, t double, p_value double, low double, high double"
        )

    def quality(self, spark: SparkSession) -> DataFrame:
        k = len(self.predictors)
        row = (self.rows, self.r2, self.adjusted, self.sigma, self.df, self.f, f_upper(self.f, k, self.df), self.aic)
        return spark.createDataFrame(
            [row], "n long, r2 double, adjusted_r2 double, sigma double, df long, f double, p_value double, aic double"
        )

    def fitted(self) -> Column:
        value = F.lit(float(self.beta[0]))
        for name, b in zip(self.predictors, self.beta[1:]):
            value = value + F.lit(float(b)) * F.col(name)
        return value

    def leverage(self) -> Column:
        """x' (X'X)^-1 x of each row, as a sum of k^2 products in generated code."""
        x = [F.lit(1.0), *[F.col(name) for name in self.predictors]]
        value = F.lit(0.0)
        for i, j in itertools.combinations_with_replacement(range(len(x)), 2):
            times = float(self.inverse[i, j]) * (1 if i == j else 2)
            value = value + F.lit(times) * x[i] * x[j]
        return value


def solve(m: Moments, response: str, predictors: Sequence[str]) -> Fit:
    """Least squares from moments."""
    order = [*predictors, response]
    part = m.pick(order)
    k = len(predictors)
    sxx, sxy, sst = part.cross[:k, :k], part.cross[:k, k], float(part.cross[k, k])
    inner = np.linalg.pinv(sxx) if k else np.zeros((0, 0))
    slopes = inner @ sxy
    means = part.mean[:k]
    intercept = float(part.mean[k] - means @ slopes)
    sse = max(sst - float(slopes @ sxy), 0.0)
    inverse = np.zeros((k + 1, k + 1))
    inverse[1:, 1:] = inner
    inverse[0, 1:] = inverse[1:, 0] = -inner @ means
    inverse[0, 0] = 1 / part.n + means @ inner @ means
    return Fit(response, tuple(predictors), part.rows, np.array([intercept, *slopes]), inverse, sse, sst)


def ols(df: DataFrame, response: str, predictors: Sequence[str], weight: str | None = None) -> Fit:
    """Multiple regression; one pass over the data."""
    return solve(moments(df, [*predictors, response], weight), response, predictors)


def simple_fits(df: DataFrame, response: str, predictor: str, keys: Sequence[str] = ()) -> DataFrame:
    """Simple regression per group, all in one aggregate: line, R squared, slope test."""
    both = df.where(F.col(response).isNotNull() & F.col(predictor).isNotNull())
    table = both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(response, predictor).alias("slope"),
        F.regr_intercept(response, predictor).alias("intercept"), F.regr_r2(response, predictor).alias("r2"),
        F.regr_sxx(response, predictor).alias("sxx"), F.regr_syy(response, predictor).alias("syy"),
        F.avg(predictor).alias("mean_x"),
    )
    sigma = F.sqrt(F.try_divide(F.greatest(F.col("syy") * (1 - F.col("r2")), F.lit(0.0)), F.col("n") - 2))
    table = table.withColumn("sigma", sigma)
    table = table.withColumn("slope_se", F.try_divide(F.col("sigma"), F.sqrt("sxx")))
    return table.withColumn("t", F.try_divide("slope", "slope_se")).drop("syy")


def line_intervals(fits: DataFrame, at: float, level: float = 0.95) -> DataFrame:
    """Slope interval, and mean-response and prediction intervals at one predictor value."""
    t = area("t_quantile", F.lit((1 + level) / 2), (F.col("n") - 2).cast("double"))
    made = fits.withColumn("__t", t)
    made = made.withColumn("slope_low", F.col("slope") - F.col("__t") * F.col("slope_se"))
    made = made.withColumn("slope_high", F.col("slope") + F.col("__t") * F.col("slope_se"))
    away = F.lit(float(at)) - F.col("mean_x")
    spread = 1 / F.col("n") + away * away / F.col("sxx")
    made = made.withColumn("fitted", F.col("intercept") + F.col("slope") * at)
    for name, inside in (("mean", spread), ("prediction", 1 + spread)):
        margin = F.col("__t") * F.col("sigma") * F.sqrt(inside)
        made = made.withColumn(f"{name}_low", F.col("fitted") - margin)
        made = made.withColumn(f"{name}_high", F.col("fitted") + margin)
    return made.drop("__t")


def influence(df: DataFrame, fit: Fit) -> DataFrame:
    """Fitted value, residual, leverage, standardised residual and Cook's distance per row."""
    k = len(fit.beta)
    out = df.withColumn("fitted", fit.fitted())
    out = out.withColumn("residual", F.col(fit.response) - F.col("fitted")).withColumn("leverage", fit.leverage())
    scale = F.lit(fit.sigma) * F.sqrt(F.greatest(1 - F.col("leverage"), F.lit(1e-12)))
    out = out.withColumn("standard_residual", F.col("residual") / scale)
    z, h = F.col("standard_residual"), F.col("leverage")
    return out.withColumn("cooks_d", z * z * h / F.greatest(1 - h, F.lit(1e-12)) / k)


def variance_inflation(df: DataFrame, predictors: Sequence[str]) -> DataFrame:
    m = moments(df, predictors)
    sd = np.sqrt(np.diag(m.cross))
    factors = np.diag(np.linalg.inv(m.cross / np.outer(sd, sd)))
    rows = [(p, float(v), float(1 - 1 / v)) for p, v in zip(predictors, factors)]
    return df.sparkSession.createDataFrame(rows, "predictor string, vif double, r2_on_others double")


# Fixed list of candidate transformations, as in a ladder of powers.
LADDER = {"identity": lambda c: c, "log": F.ln, "sqrt": F.sqrt, "square": lambda c: c * c,
          "reciprocal": lambda c: 1 / c}


def transformations(df: DataFrame, response: str, predictor: str) -> DataFrame:
    """R squared of each transformed response on each transformed predictor, in one pass."""
    positive = df.where((F.col(response) > 0) & (F.col(predictor) > 0))
    y, x = F.col(response).cast("double"), F.col(predictor).cast("double")
    made = positive.select(*[f(y).alias(f"y_{name}") for name, f in LADDER.items()],
                           *[f(x).alias(f"x_{name}") for name, f in LADDER.items()])
    names = list(itertools.product(LADDER, LADDER))
    aggs = [F.var_pop(c).alias(c) for c in made.columns]
    aggs += [F.covar_pop(f"y_{a}", f"x_{b}").alias(f"c{i}") for i, (a, b) in enumerate(names)]
    wide = made.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = []
    for i, (a, b) in enumerate(names):
        shared = F.col(f"c{i}")
        r2 = F.try_divide(shared * shared, F.col(f"y_{a}") * F.col(f"x_{b}"))
        rows.append(F.struct(F.lit(a).alias("response_as"), F.lit(b).alias("predictor_as"), r2.alias("r2")))
    return wide.select("n", F.explode(F.array(*rows)).alias("f")).select("f.*", "n")


def with_dummies(df: DataFrame, factor: str, levels: Sequence, interact: str | None = None) -> tuple[DataFrame, list[str]]:
    """0/1 columns for all levels but the first, and their products with a number."""
    made = []
    for i, level in enumerate(levels[1:], 1):
        df = df.withColumn(f"{factor}_{i}", (F.col(factor) == level).cast("double"))
        made.append(f"{factor}_{i}")
        if interact:
            df = df.withColumn(f"{factor}_{i}_{interact}", F.col(f"{factor}_{i}") * F.col(interact))
            made.append(f"{factor}_{i}_{interact}")
    return df, made


def nested_test(full: Fit, part: Fit) -> tuple[float, int, int, float]:
    """F test of a model against a smaller one inside it: F, both df, p."""
    extra = len(full.beta) - len(part.beta)
    f = (part.sse - full.sse) / extra / (full.sse / full.df)
    return f, extra, full.df, f_upper(f, extra, full.df)


def polynomial(df: DataFrame, response: str, predictor: str, degree: int) -> Fit:
    """Powers of the centred-free predictor; ``vertex`` gives the peak of degree 2."""
    powers = [f"{predictor}_{d}" for d in range(1, degree + 1)]
    made = df.select(response, *[F.pow(F.col(predictor), F.lit(float(d))).alias(p) for d, p in enumerate(powers, 1)])
    return ols(made, response, powers)


def vertex(fit: Fit) -> float:
    return float(-fit.beta[1] / (2 * fit.beta[2]))


def subsets(df: DataFrame, response: str, predictors: Sequence[str]) -> DataFrame:
    """Every subset of the predictors by adjusted R squared and AIC, from one data pass."""
    m = moments(df, [*predictors, response])
    rows = []
    for size in range(1, len(predictors) + 1):
        for chosen in itertools.combinations(predictors, size):
            fit = solve(m, response, chosen)
            rows.append((size, " + ".join(chosen), fit.r2, fit.adjusted, fit.aic))
    return df.sparkSession.createDataFrame(rows, "size int, model string, r2 double, adjusted_r2 double, aic double")


def forward(df: DataFrame, response: str, predictors: Sequence[str]) -> DataFrame:
    """Forward selection by AIC; the steps taken."""
    m = moments(df, [*predictors, response])
    chosen: list[str] = []
    best, rows = solve(m, response, []).aic, []
    while len(chosen) < len(predictors):
        tries = [(solve(m, response, [*chosen, p]).aic, p) for p in predictors if p not in chosen]
        aic, pick = min(tries)
        if aic >= best:
            break
        best = aic
        chosen.append(pick)
        rows.append((len(chosen), pick, aic, solve(m, response, chosen).adjusted))
    return df.sparkSession.createDataFrame(rows, "step int, added string, aic double, adjusted_r2 double")


def ridge(m: Moments, response: str, predictors: Sequence[str], penalty: float) -> np.ndarray:
    """Ridge on standardised predictors, coefficients on the original scale, intercept first.

    Minimises squared error / (2 n) + penalty / 2 * (standardised slopes)^2.
    """
    part = m.pick([*predictors, response])
    k = len(predictors)
    sd = np.sqrt(np.diag(part.cross)[:k] / part.n)
    scaled = part.cross[:k, :k] / np.outer(sd, sd) / part.n
    slopes = np.linalg.solve(scaled + penalty * np.eye(k), part.cross[:k, k] / sd / part.n) / sd
    return np.array([part.mean[k] - part.mean[:k] @ slopes, *slopes])


def ridge_path(
    df: DataFrame, response: str, predictors: Sequence[str], penalties: Sequence[float], fold: Column, folds: int
) -> DataFrame:
    """Cross-validated error of each penalty. Moments per fold come from one pass."""
    parts = moments_by(df.withColumn("__fold", fold), [*predictors, response], "__fold", folds)
    if len(parts) != folds:
        raise ValueError(f"{len(parts)} folds hold rows, {folds} asked for")
    rows = []
    for penalty in penalties:
        error, count = 0.0, 0.0
        for held, inside in parts.items():
            rest = [m for key, m in parts.items() if key != held]
            train = rest[0]
            for m in rest[1:]:
                train = train + m
            beta = ridge(train, response, predictors, penalty)
            own = inside.pick([*predictors, response])
            contrast = np.array([*-beta[1:], 1.0])
            gap = float(own.mean @ contrast - beta[0])
            error += float(contrast @ own.cross @ contrast) + own.n * gap * gap
            count += own.n
        rows.append((float(penalty), error / count))
    return df.sparkSession.createDataFrame(rows, "penalty double, cv_mse double")


MOST_STEPS, MOST_REWEIGHTINGS = 5000, 100


def converged(model) -> None:
    """An error if a fit of Spark ML ran out of steps."""
    if model.summary.totalIterations >= MOST_STEPS:
        raise ArithmeticError(f"{type(model).__name__} did not converge in {MOST_STEPS} steps")


def soft(value: float, limit: float) -> float:
    """Pulled towards 0 by the limit."""
    return math.copysign(max(abs(value) - limit, 0.0), value)


def lasso_paths(
    df: DataFrame, response: str, predictors: Sequence[str], penalties: Sequence[float], tolerance: float = 1e-12
) -> DataFrame:
    """(penalty, term, estimate) of every lasso fit on standardised predictors, from one pass over the data.

    Minimises squared error / (2 rows) + penalty * sum of sd * |b|. Coordinates are updated in turn on the k x k table of
    covariances; penalties are fitted from the largest to the smallest, each from the solution before it.
    """
    if min(penalties, default=0.0) < 0:
        raise ValueError("penalties are not negative")
    m = moments(df, [*predictors, response])
    k = len(predictors)
    inside, across = m.cross[:k, :k] / m.n, m.cross[:k, k] / m.n
    own = np.diag(inside).copy()
    sd = np.sqrt(own * m.n / max(1.0, m.n - 1))
    b, rows = np.zeros(k), []
    for penalty in sorted(set(map(float, penalties)), reverse=True):
        for _ in range(MOST_STEPS):
            before = b.copy()
            for j in np.flatnonzero(own > 0):
                b[j] = soft(across[j] - inside[j] @ b + own[j] * b[j], penalty * sd[j]) / own[j]
            if np.abs((b - before) * sd).max(initial=0.0) <= tolerance * max(1.0, np.abs(b * sd).max(initial=0.0)):
                break
        else:
            raise ArithmeticError(f"the lasso did not converge in {MOST_STEPS} steps")
        rows.append((penalty, "(Intercept)", float(m.mean[k] - m.mean[:k] @ b)))
        rows += [(penalty, p, float(v)) for p, v in zip(predictors, b)]
    return df.sparkSession.createDataFrame(rows, "penalty double, term string, estimate double")


def lasso(df: DataFrame, response: str, predictors: Sequence[str], penalty: float) -> DataFrame:
    """The lasso fit of one penalty: (term, estimate)."""
    return lasso_paths(df, response, predictors, [penalty]).select("term", "estimate")


def grouped_cells(df: DataFrame, label: str, predictors: Sequence[str]) -> DataFrame:
    """Equal predictor rows counted, with their 0/1 labels as weights.

    The likelihood is unchanged; discrete predictors shrink to a handful of rows.
    """
    used = df.select(F.col(label).cast("double").alias(label), *[F.col(p).cast("double").alias(p) for p in predictors])
    return used.dropna().groupBy(label, *predictors).agg(F.count(F.lit(1)).cast("double").alias("__weight"))


def logistic(df: DataFrame, label: str, predictors: Sequence[str]):
    """Binomial model with standard errors, fitted by Spark ML on grouped cells."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    cells = grouped_cells(df, label, predictors)
    ready = VectorAssembler(inputCols=list(predictors), outputCol="features").transform(cells)
    model = GeneralizedLinearRegression(
        family="binomial", link="logit", labelCol=label, weightCol="__weight", tol=1e-10, maxIter=MOST_REWEIGHTINGS
    ).fit(ready)
    if model.summary.numIterations >= MOST_REWEIGHTINGS:
        raise ArithmeticError("the logistic model did not converge; the classes may be separable")
    return model


def logistic_table(spark: SparkSession, model, predictors: Sequence[str]) -> DataFrame:
    """Log-odds, odds factor, standard error, z and p per term."""
    estimates = [float(model.intercept), *map(float, model.coefficients)]
    summary = model.summary
    errors = [summary.coefficientStandardErrors[-1], *summary.coefficientStandardErrors[:-1]]
    tests = [summary.tValues[-1], *summary.tValues[:-1]]
    areas = [summary.pValues[-1], *summary.pValues[:-1]]
    rows = [
        (term, b, math.exp(b) if b < 709 else math.inf, float(se), float(z), float(p))
        for term, b, se, z, p in zip(("(Intercept)", *predictors), estimates, errors, tests, areas)
    ]
    return spark.createDataFrame(
        rows, "term string, estimate double, odds double, std_error double, z double, p_value double"
    )


def deviance_test(spark: SparkSession, model, predictors: Sequence[str]) -> DataFrame:
    """Drop in deviance against the model without predictors."""
    drop = float(model.summary.nullDeviance - model.summary.deviance)
    table = spark.createDataFrame([(drop, len(predictors))], "deviance_drop double, df long")
    return table.withColumn("p_value", area("chi2", "deviance_drop", F.col("df").cast("double")))


def logistic_probability(model, predictors: Sequence[str]) -> Column:
    value = F.lit(float(model.intercept))
    for name, b in zip(predictors, model.coefficients):
        value = value + F.lit(float(b)) * F.col(name)
    return 1 / (1 + F.exp(-value))


def spline_columns(df: DataFrame, column: str, low: float, high: float, pieces: int) -> tuple[DataFrame, list[str]]:
    """Cubic B-spline basis over ``pieces`` equal spans, built from column expressions.

    The basis functions add up to 1, so the first one is left to the intercept.
    """
    step = (high - low) / pieces
    made = {}
    for j in range(0, pieces + 2):
        u = F.abs((F.col(column) - F.lit(low + j * step)) / F.lit(step))
        outer, inner = F.greatest(2 - u, F.lit(0.0)), F.greatest(1 - u, F.lit(0.0))
        made[f"s_{column}_{j}"] = (outer * outer * outer - 4 * inner * inner * inner) / 6
    return df.withColumns(made), list(made)


@dataclass(frozen=True)
class AdditiveFit:
    """A fitted additive model: coefficients of its spline columns, and what they cost."""

    intercept: float
    coefficients: np.ndarray
    penalty: float
    freedom: float   # effective degrees of freedom, intercept included
    deviance: float
    score: float     # generalised cross-validation


def difference_penalty(sizes: Sequence[int]) -> np.ndarray:
    """Squared second differences of neighbouring coefficients, for blocks of spline columns whose first
    function was left to the intercept (its coefficient is 0)."""
    whole = np.zeros((sum(sizes), sum(sizes)))
    at = 0
    for size in sizes:
        steps = np.diff(np.eye(size + 1), 2, axis=0)[:, 1:]
        whole[at:at + size, at:at + size] = steps.T @ steps
        at += size
    return whole


def additive_logistic(
    df: DataFrame, label: str, spans: dict[str, tuple[float, float, int]], penalty: float | Sequence[float], tolerance: float = 1e-8
) -> tuple[AdditiveFit, list[str]]:
    """Additive model of a 0/1 label: a sum of smooth curves on the log-odds scale.

    ``spans`` gives (low, high, pieces) of each predictor. The likelihood is penalised by ``penalty`` / 2 times the squared
    second differences of each curve's coefficients, so a large penalty leaves straight lines. Of several penalties
    the one with the least generalised cross-validation is taken. Fitted by reweighted least squares on counted cells: a
    round is one weighted table of moments, penalties go from the largest to the smallest, each from the fit
    before it. Returns the fit and the names of its columns.
    """
    names: list[str] = []
    sizes = []
    cells = grouped_cells(df, label, list(spans))
    for column, span in spans.items():
        cells, made = spline_columns(cells, column, *span)
        names += made
        sizes.append(len(made))
    cells = cut_lineage(cells.select(label, "__weight", *names))
    total = cells.agg(F.sum("__weight").alias("n"), F.sum(F.col("__weight") * F.col(label)).alias("won")).first()
    if not total["n"] or not 0 < total["won"] < total["n"]:
        raise ValueError("both labels must occur")
    rough = difference_penalty(sizes)
    best, share = None, total["won"] / total["n"]
    start, b = math.log(share / (1 - share)), np.zeros(len(names))
    penalties = [penalty] if isinstance(penalty, (int, float)) else penalty
    for weight in sorted(set(map(float, penalties)), reverse=True):
        for _ in range(MOST_REWEIGHTINGS):
            line = F.lit(start)
            for name, value in zip(names, b.tolist()):
                line = line + F.lit(value) * F.col(name)
            mean = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("__line")))))
            rows = cells.withColumn("__line", line).withColumn("__mean", mean)
            spread = F.col("__mean") * (1 - F.col("__mean"))
            rows = rows.withColumn("__z", F.col("__line") + (F.col(label) - F.col("__mean")) / spread).withColumn("__w", F.col("__weight") * spread)
            m = moments(rows, [*names, "__z"], "__w")
            inside = m.cross[:-1, :-1]
            new = np.linalg.lstsq(inside + weight * rough, m.cross[:-1, -1], rcond=None)[0]
            begin = float(m.mean[-1] - m.mean[:-1] @ new)
            moved = max(abs(begin - start), float(np.abs(new - b).max(initial=0.0)))
            start, b = begin, new
            if moved <= tolerance * max(1.0, float(np.abs(b).max(initial=0.0))):
                break
        else:
            raise ArithmeticError("the additive model did not converge; the classes may be separable")
        chance = F.when(F.col(label) == 1, F.col("__mean")).otherwise(1 - F.col("__mean"))
        deviance = float(rows.agg(F.sum(-2 * F.col("__weight") * F.log(chance))).first()[0])
        freedom = 1 + float(np.trace(np.linalg.lstsq(inside + weight * rough, inside, rcond=None)[0]))
        score = total["n"] * deviance / (total["n"] - freedom) ** 2
        fit = AdditiveFit(start, b, weight, freedom, deviance, score)
        best = fit if best is None or score < best.score else best
    return best, names


MAX_CLASSES = 1000


def class_model(df: DataFrame, label: str, predictors: Sequence[str]):
    """Multinomial logistic regression on a text label, fitted on counted cells."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    index = StringIndexer(inputCol=label, outputCol="__label", stringOrderType="alphabetAsc")
    features = VectorAssembler(inputCols=list(predictors), outputCol="features")
    classifier = LogisticRegression(labelCol="__label", family="multinomial", weightCol="__weight", tol=1e-9, maxIter=MOST_STEPS)
    cells = df.select(label, *predictors).dropna().groupBy(label, *predictors).agg(
        F.count(F.lit(1)).cast("double").alias("__weight")
    )
    model = Pipeline(stages=[index, features, classifier]).fit(cells)
    converged(model.stages[-1])
    return model


def class_probabilities(model, df: DataFrame, label: str) -> DataFrame:
    """One row per input row and class."""
    from pyspark.ml.functions import vector_to_array

    names = F.array(*[F.lit(v) for v in model.stages[0].labels])
    scored = model.stages[2].transform(model.stages[1].transform(df)).withColumn("__p", vector_to_array("probability"))
    long = scored.select(*df.columns, F.explode(F.arrays_zip(names.alias("name"), F.col("__p").alias("p"))).alias("__c"))
    return long.select(*df.columns, F.col("__c.name").alias(label), F.col("__c.p").alias("probability"))


def bayes_model(df: DataFrame, label: str, predictors: Sequence[str]) -> list:
    """Gaussian naive Bayes: size, means and variances per class, from one aggregate."""
    moments_ = [f(p).alias(f"{name}{i}") for i, p in enumerate(predictors) for name, f in (("m", F.avg), ("v", F.var_samp))]
    table = df.select(label, *predictors).dropna().groupBy(label).agg(F.count(F.lit(1)).alias("n"), *moments_)
    classes = table.orderBy(label).limit(MAX_CLASSES + 1).collect()
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return classes


def bayes_classes(df: DataFrame, classes: list, label: str, predictors: Sequence[str], out: str = "predicted") -> DataFrame:
    """The likeliest class of each row, as one generated-code expression."""
    scores = []
    for row in classes:
        score = F.lit(math.log(row["n"]))
        for i, p in enumerate(predictors):
            gap = F.col(p) - F.lit(float(row[f"m{i}"]))
            score = score - F.lit(math.log(row[f"v{i}"]) / 2) - gap * gap / F.lit(2.0 * row[f"v{i}"])
        scores.append(F.struct(score.alias("score"), F.lit(row[label]).alias("name")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return df.withColumn(out, best["name"])


def confusion(scored: DataFrame, label: str, predicted: str = "predicted") -> DataFrame:
    """Actual against predicted class counts."""
    return scored.groupBy(F.col(label).alias("actual"), predicted).agg(F.count(F.lit(1)).alias("n"))
