"""Queries over regression, classification, components and clusters."""
from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from touchline.plans import multivariate, ratings, regression
from touchline.queries.common import query, rounded, simpson, t_area_sql, t_quantile_sql
from touchline.queries.flows import _stints
from touchline.plans.stints import signed_lineups
from touchline.session import cut_lineage
from touchline.sources.tables import table

Z95 = repr(NormalDist().inv_cdf(0.975))


def _line(spark, folder):
    return table(spark, folder, "lineitem")


SIMPLE_SQL = """s AS (SELECT l_returnflag, count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
    regr_r2(l_extendedprice, l_quantity) AS r2, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
    avg(l_quantity) AS mx FROM lineitem GROUP BY 1),
  f AS (SELECT *, sqrt(syy * (1 - r2) / (n - 2)) AS sigma, sqrt(syy * (1 - r2) / (n - 2)) / sqrt(sxx) AS se FROM s)"""


@query(f"""WITH {SIMPLE_SQL} SELECT l_returnflag, n, round(b, 4) AS slope, round(a, 4) AS intercept, round(r2, 8) AS r2, round(sxx, 4) AS sxx,
  round(mx, 6) AS mean_x, round(sigma, 4) AS sigma, round(se, 6) AS slope_se, round(b / se, 4) AS t FROM f""")
def simple_regressions(spark, folder):
    """One line per group, all in one aggregate."""
    made = regression.simple_fits(_line(spark, folder), "l_extendedprice", "l_quantity", ["l_returnflag"])
    made = rounded(made, "slope", "intercept", "sxx", "sigma", "t")
    return rounded(rounded(made, "mean_x", "slope_se", places=6), "r2", places=8)


T95 = t_quantile_sql(Z95, "n - 2")


@query(f"""WITH {SIMPLE_SQL}, p AS (SELECT *, a + b * 25 AS y, 1 / n + pow(25 - mx, 2) / sxx AS h, {T95} AS q FROM f)
  SELECT l_returnflag, round(b - q * se, 3) AS slope_low, round(b + q * se, 3) AS slope_high, round(y, 3) AS fitted,
    round(y - q * sigma * sqrt(h), 3) AS mean_low, round(y + q * sigma * sqrt(h), 3) AS mean_high,
    round(y - q * sigma * sqrt(1 + h), 3) AS prediction_low, round(y + q * sigma * sqrt(1 + h), 3) AS prediction_high FROM p""")
def regression_intervals(spark, folder):
    fits = regression.simple_fits(_line(spark, folder), "l_extendedprice", "l_quantity", ["l_returnflag"])
    made = regression.line_intervals(fits, 25.0)
    names = ["slope_low", "slope_high", "fitted", "mean_low", "mean_high", "prediction_low", "prediction_high"]
    return rounded(made.select("l_returnflag", *names), *names, places=3)


def _two_predictor_sql(y, x, z, source="lineitem"):
    return f"""m AS (SELECT count(*) AS n, avg({y}) AS my, avg({x}) AS mx, avg({z}) AS mz, covar_pop({x}, {x}) * count(*) AS xx,
      covar_pop({z}, {z}) * count(*) AS zz, covar_pop({x}, {z}) * count(*) AS xz, covar_pop({x}, {y}) * count(*) AS xy,
      covar_pop({z}, {y}) * count(*) AS zy, covar_pop({y}, {y}) * count(*) AS yy FROM {source}),
    b AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS b2,
      zz / (xx * zz - xz * xz) AS i11, xx / (xx * zz - xz * xz) AS i22, -xz / (xx * zz - xz * xz) AS i12 FROM m),
    r AS (SELECT *, my - b1 * mx - b2 * mz AS b0, yy - b1 * xy - b2 * zy AS sse, n - 3 AS df,
      1 / n + mx * mx * i11 + mz * mz * i22 + 2 * mx * mz * i12 AS i00 FROM b)"""


OLS_SQL = _two_predictor_sql("l_extendedprice", "l_quantity", "l_tax")


@query(f"""WITH {OLS_SQL}, e AS (SELECT '(Intercept)' AS term, b0 AS b, i00 AS i, sse, df FROM r
    UNION ALL SELECT 'l_quantity', b1, i11, sse, df FROM r UNION ALL SELECT 'l_tax', b2, i22, sse, df FROM r),
  t AS (SELECT *, sqrt(i * sse / df) AS se, b / sqrt(i * sse / df) AS t FROM e)
  SELECT term, round(b, 3) AS estimate, round(se, 3) AS std_error, round(t, 4) AS t, round({t_area_sql('t.t', 'df')}, 6) AS p_value,
    round(b - {t_quantile_sql(Z95, 'df')} * se, 3) AS low, round(b + {t_quantile_sql(Z95, 'df')} * se, 3) AS high FROM t""")
def multiple_regression(spark, folder):
    fit = regression.ols(_line(spark, folder), "l_extendedprice", ["l_quantity", "l_tax"])
    made = rounded(fit.coefficients(spark), "estimate", "std_error", "low", "high", places=3)
    return rounded(rounded(made, "t"), "p_value", places=6)


@query(f"""WITH {OLS_SQL} SELECT n, round(1 - sse / yy, 8) AS r2, round(1 - (sse / df) / (yy / (n - 1)), 8) AS adjusted_r2,
  round(sqrt(sse / df), 4) AS sigma, df, round((yy - sse) / 2 / (sse / df), 3) AS f,
  round(n * (ln(2 * pi() * sse / n) + 1) + 2 * 4, 3) AS aic FROM r""")
def regression_quality(spark, folder):
    fit = regression.ols(_line(spark, folder), "l_extendedprice", ["l_quantity", "l_tax"])
    made = rounded(fit.quality(spark).drop("p_value"), "r2", "adjusted_r2", places=8)
    return rounded(rounded(made, "sigma"), "f", "aic", places=3)


@query("""SELECT unnest(['l_quantity', 'l_extendedprice']) AS predictor, round(1 / (1 - pow(corr(l_quantity, l_extendedprice), 2)), 6) AS vif,
  round(pow(corr(l_quantity, l_extendedprice), 2), 8) AS r2_on_others FROM lineitem""")
def variance_inflation(spark, folder):
    made = regression.variance_inflation(_line(spark, folder), ["l_quantity", "l_extendedprice"])
    return rounded(rounded(made, "vif", places=6), "r2_on_others", places=8)


@query("""WITH s AS (SELECT count(*) AS n, regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a,
    regr_sxx(o_totalprice, o_custkey) AS sxx, avg(o_custkey) AS mx,
    sqrt(regr_syy(o_totalprice, o_custkey) * (1 - regr_r2(o_totalprice, o_custkey)) / (count(*) - 2)) AS sigma FROM orders),
  r AS (SELECT o_orderkey, o_totalprice - a - b * o_custkey AS e, 1 / n + pow(o_custkey - mx, 2) / sxx AS h, sigma FROM orders, s)
  SELECT o_orderkey, round(e, 3) AS residual, round(h, 10) AS leverage, round(e / (sigma * sqrt(1 - h)), 6) AS standard_residual,
    round(pow(e / sigma, 2) / 2 * h / pow(1 - h, 2), 10) AS cooks_d FROM r""")
def influence_measures(spark, folder):
    """Residual, leverage and Cook's distance of every row."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    made = regression.influence(orders, regression.ols(orders, "o_totalprice", ["o_custkey"]))
    made = rounded(made.drop("o_custkey", "o_totalprice", "fitted"), "residual", places=3)
    return rounded(rounded(made, "standard_residual", places=6), "leverage", "cooks_d", places=10)


LADDER_SQL = {"identity": "{0}", "log": "ln({0})", "sqrt": "sqrt({0})", "square": "({0} * {0})", "reciprocal": "(1 / {0})"}


@query(" UNION ALL ".join(f"""SELECT '{a}' AS response_as, '{b}' AS predictor_as,
  round(regr_r2({f.format('l_extendedprice')}, {g.format('l_quantity')}), 8) AS r2, count(*) AS n FROM lineitem
  WHERE l_extendedprice > 0 AND l_quantity > 0""" for a, f in LADDER_SQL.items() for b, g in LADDER_SQL.items()))
def transformation_fits(spark, folder):
    return rounded(regression.transformations(_line(spark, folder), "l_extendedprice", "l_quantity"), "r2", places=8)


@query("""WITH s AS (SELECT regr_intercept(l_extendedprice, l_quantity) FILTER (l_linestatus = 'F') AS a0,
    regr_slope(l_extendedprice, l_quantity) FILTER (l_linestatus = 'F') AS b0,
    regr_intercept(l_extendedprice, l_quantity) FILTER (l_linestatus = 'O') AS a1,
    regr_slope(l_extendedprice, l_quantity) FILTER (l_linestatus = 'O') AS b1, regr_slope(l_extendedprice, l_quantity) AS pooled FROM lineitem)
  SELECT '(Intercept)' AS term, round(a0, 3) AS estimate FROM s UNION ALL SELECT 'l_quantity', round(b0, 3) FROM s
  UNION ALL SELECT 'l_linestatus_1', round(a1 - a0, 3) FROM s UNION ALL SELECT 'l_linestatus_1_l_quantity', round(b1 - b0, 3) FROM s
  UNION ALL SELECT 'without group: l_quantity', round(pooled, 3) FROM s""")
def group_interaction(spark, folder):
    """Slopes by group as an interaction model, next to the slope without the group."""
    made, terms = regression.with_dummies(_line(spark, folder), "l_linestatus", ["F", "O"], interact="l_quantity")
    full = regression.ols(made, "l_extendedprice", ["l_quantity", *terms])
    alone = regression.ols(made, "l_extendedprice", ["l_quantity"])
    extra = spark.createDataFrame([("without group: l_quantity", float(alone.beta[1]))], "term string, estimate double")
    return rounded(full.coefficients(spark).select("term", "estimate").union(extra), "estimate", places=3)


@query(f"""WITH q AS (SELECT l_extendedprice, l_quantity, l_quantity * l_quantity AS l_quantity2 FROM lineitem),
  {_two_predictor_sql('l_extendedprice', 'l_quantity', 'l_quantity2', 'q')}
  SELECT round(b0, 2) AS b0, round(b1, 3) AS b1, round(b2, 4) AS b2, round(-b1 / (2 * b2), 2) AS vertex, round(1 - sse / yy, 8) AS r2 FROM r""")
def quadratic_peak(spark, folder):
    """Second-degree regression and where it turns."""
    fit = regression.polynomial(_line(spark, folder), "l_extendedprice", "l_quantity", 2)
    row = [float(b) for b in fit.beta] + [regression.vertex(fit), fit.r2]
    made = spark.createDataFrame([tuple(row)], "b0 double, b1 double, b2 double, vertex double, r2 double")
    return rounded(rounded(rounded(rounded(made, "b0", "vertex", places=2), "b1", places=3), "b2"), "r2", places=8)


@query(f"""WITH {OLS_SQL}, f AS (SELECT 2 AS size, 'l_quantity + l_tax' AS model, sse, yy, n FROM r
    UNION ALL SELECT 1, 'l_quantity', yy - xy * xy / xx, yy, n FROM r UNION ALL SELECT 1, 'l_tax', yy - zy * zy / zz, yy, n FROM r)
  SELECT size, model, round(1 - sse / yy, 8) AS r2, round(1 - sse / yy * (n - 1) / (n - 1 - size), 8) AS adjusted_r2,
    round(n * (ln(2 * pi() * sse / n) + 1) + 2 * (size + 2), 3) AS aic FROM f""")
def best_subsets(spark, folder):
    made = regression.subsets(_line(spark, folder), "l_extendedprice", ["l_quantity", "l_tax"])
    return rounded(rounded(made, "r2", "adjusted_r2", places=8), "aic", places=3)


def _products_sql(names, keys=""):
    """Sums of products of centred columns as rows (i, j, v), by the key columns."""
    pairs = [f"{{'i': '{a}', 'j': '{b}', 'v': covar_pop({min(a, b)}, {max(a, b)}) * count(*)}}" for a in names for b in names]
    return f"{keys and keys + ', '}unnest([{', '.join(pairs)}], recursive := true)"


def _eliminated_sql(source, pivot, keys=()):
    """One step of Gauss-Jordan elimination of the rows (i, j, v)."""
    same = lambda t: "".join(f" AND {t}.{k} = a.{k}" for k in keys)
    return f"""SELECT {''.join(f'a.{k}, ' for k in keys)}a.i, a.j, CASE WHEN a.i = p.i THEN r.v / p.v ELSE a.v - c.v * r.v / p.v END AS v FROM {source} a
      JOIN {source} p ON p.i = {pivot} AND p.j = p.i{same('p')} JOIN {source} r ON r.i = p.i AND r.j = a.j{same('r')}
      JOIN {source} c ON c.j = p.i AND c.i = a.i{same('c')}"""


FORWARD = ["l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]


def _forward_sql():
    """Of the predictors left, the one that takes most of the squared error, until the criterion stops falling."""
    names = [*FORWARD, "revenue"]
    columns = ", ".join(f"{n}::DOUBLE AS {n}" for n in FORWARD)
    steps = [f"x AS (SELECT {columns}, l_extendedprice::DOUBLE * (1 - l_discount::DOUBLE) AS revenue FROM lineitem)",
             f"d0 AS MATERIALIZED (SELECT {_products_sql(names)} FROM x)"]
    for step in range(len(FORWARD)):
        used = "".join(f" AND r.i <> (SELECT k FROM k{i})" for i in range(step))
        steps.append(f"""k{step} AS MATERIALIZED (SELECT r.i AS k FROM d{step} r JOIN d{step} p ON p.i = r.i AND p.j = r.i
          WHERE r.j = 'revenue' AND r.i <> 'revenue'{used} ORDER BY r.v * r.v / p.v DESC, r.i LIMIT 1)""")
        steps.append(f"d{step + 1} AS MATERIALIZED ({_eliminated_sql(f'd{step}', f'(SELECT k FROM k{step})')})")
    sizes = " UNION ALL ".join(
        f"SELECT {i} AS step, {'NULL' if not i else f'(SELECT k FROM k{i - 1})'} AS added, v AS sse FROM d{i} WHERE i = 'revenue' AND j = 'revenue'"
        for i in range(len(FORWARD) + 1))
    return f"""WITH {', '.join(steps)}, s AS ({sizes}), n AS (SELECT count(*)::DOUBLE AS n FROM lineitem),
      f AS (SELECT step, added, n * (ln(2 * pi() * sse / n) + 1) + 2 * (step + 2) AS aic,
        1 - sse / (SELECT sse FROM s WHERE step = 0) * (n - 1) / (n - 1 - step) AS adjusted_r2 FROM s, n),
      g AS (SELECT *, aic < lag(aic) OVER (ORDER BY step) AS falls FROM f)
      SELECT CAST(step AS INTEGER) AS step, added, round(aic, 4) AS aic, round(adjusted_r2, 4) AS adjusted_r2 FROM g
      WHERE step > 0 AND step < (SELECT coalesce(min(step), 99) FROM g WHERE NOT falls)"""


@query(_forward_sql())
def forward_selection(spark, folder):
    line = _line(spark, folder).withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return rounded(regression.forward(line, "revenue", FORWARD), "aic", "adjusted_r2")


RIDGE = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
RIDGE_PENALTIES = [0.0, 0.01, 0.1, 1.0]


def _ridge_sql():
    """Each fold judged by the fit on the others; a penalty on standardised slopes adds its share to the diagonal."""
    names = [*RIDGE, "l_extendedprice"]
    steps = [f"x AS (SELECT l_orderkey % 5 AS fold, {', '.join(f'{n}::DOUBLE AS {n}' for n in names)} FROM lineitem)",
             f"m AS MATERIALIZED (SELECT held, {', '.join(f'avg({n}) AS {n}' for n in names)} FROM x JOIN range(5) h(held) ON fold <> held GROUP BY held)",
             f"s AS MATERIALIZED (SELECT {_products_sql(names, 'held')} FROM x JOIN range(5) h(held) ON fold <> held GROUP BY held)",
             f"""d0 AS MATERIALIZED (SELECT held, penalty, i, j, CASE WHEN i = j AND i <> 'l_extendedprice' THEN v * (1 + penalty) ELSE v END AS v
               FROM s, (SELECT unnest({RIDGE_PENALTIES})::DOUBLE AS penalty) p)"""]
    for step, name in enumerate(RIDGE):
        steps.append(f"d{step + 1} AS MATERIALIZED ({_eliminated_sql(f'd{step}', repr(name), ('held', 'penalty'))})")
    slopes = ", ".join(f"max(v) FILTER (i = '{n}') AS {n}" for n in RIDGE)
    fitted = " - ".join(f"b.{n} * (x.{n} - m.{n})" for n in RIDGE)
    return f"""WITH {', '.join(steps)}, b AS MATERIALIZED (SELECT held, penalty, {slopes} FROM d{len(RIDGE)} WHERE j = 'l_extendedprice' GROUP BY held, penalty)
      SELECT penalty, round(avg(pow(x.l_extendedprice - m.l_extendedprice - {fitted}, 2)), 2) AS cv_mse
      FROM x JOIN b ON x.fold = b.held JOIN m ON m.held = b.held GROUP BY penalty"""


@query(_ridge_sql())
def ridge_cross_validation(spark, folder):
    """Error of each ridge penalty over five folds, from one pass over the data."""
    fold = F.pmod(F.col("l_orderkey"), F.lit(5))
    made = regression.ridge_path(_line(spark, folder), "l_extendedprice", RIDGE, RIDGE_PENALTIES, fold, 5)
    return rounded(made, "cv_mse", places=2)


LASSO = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
PENALTIES = (5000.0, 500.0, 50.0)


def _lasso_sql(rounds=25):
    """Coordinates updated in turn, from 0, for each penalty."""
    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    s = lambda i, j: f"s{min(i, j)}{max(i, j)}"
    x = [f"l.{c}::DOUBLE" for c in LASSO]
    steps = ["b0 AS (SELECT m.*, penalty, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.0::DOUBLE AS b3 FROM m, penalties)"]
    for step in range(1, 4 * rounds + 1):
        j = (step - 1) % 4
        left = " - ".join([f"y{j}", *[f"{s(j, i)} * b{i}" for i in range(4) if i != j]])
        new = f"sign({left}) * greatest(abs({left}) - penalty * sqrt({s(j, j)} * n / (n - 1)), 0) / {s(j, j)}"
        steps.append(f"b{step} AS MATERIALIZED (SELECT * REPLACE ({new} AS b{j}) FROM b{step - 1})")
    terms = " UNION ALL ".join([f"SELECT penalty, '{c}' AS term, round(b{i}, 3) AS estimate FROM b{4 * rounds}" for i, c in enumerate(LASSO)])
    return f"""WITH l AS (SELECT * FROM lineitem), m AS (SELECT count(*) AS n, avg(l_extendedprice) AS my, {', '.join(f'avg({v}) AS m{i}' for i, v in enumerate(x))},
        {', '.join(f'covar_pop({x[i]}, {x[j]}) AS s{i}{j}' for i, j in pairs)}, {', '.join(f'covar_pop({v}, l_extendedprice) AS y{i}' for i, v in enumerate(x))} FROM l),
      penalties AS (SELECT unnest([{', '.join(map(str, PENALTIES))}]::DOUBLE[]) AS penalty), {', '.join(steps)}
      SELECT penalty, '(Intercept)' AS term, round(my - m0 * b0 - m1 * b1 - m2 * b2 - m3 * b3, 3) AS estimate FROM b{4 * rounds} UNION ALL {terms}"""


@query(_lasso_sql())
def lasso_path(spark, folder):
    """Lasso fits from the largest penalty to the smallest, out of one pass over the data."""
    return rounded(regression.lasso_paths(_line(spark, folder), "l_extendedprice", LASSO, PENALTIES), "estimate", places=3)


@query()
def plus_minus_ratings(spark, folder):
    """Weighted ridge of the stint margin on the signed lineups."""
    made = cut_lineage(_stints(spark, folder))  # far smaller than the log, read three times
    keys = ["game_id", "stint_id"]
    entries = signed_lineups(made, keys, "home_lineup", "away_lineup")
    return rounded(ratings.plus_minus(entries, made, keys, "margin", "n_pos", 0.05), "rating")


@query("""WITH x AS (SELECT l_quantity::DOUBLE AS w, l_extendedprice::DOUBLE AS y, CASE l_returnflag WHEN 'R' THEN 1.0 ELSE -1.0 END::DOUBLE AS a,
    CASE l_linestatus WHEN 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS b FROM lineitem),
  m AS (SELECT sum(w) AS w, sum(w * a) / sum(w) AS ma, sum(w * b) / sum(w) AS mb, sum(w * y) / sum(w) AS my FROM x),
  s AS (SELECT sum(x.w * (a - ma) * (a - ma)) / any_value(m.w) + 0.05 AS aa, sum(x.w * (b - mb) * (b - mb)) / any_value(m.w) + 0.05 AS bb,
    sum(x.w * (a - ma) * (b - mb)) / any_value(m.w) AS ab, sum(x.w * (a - ma) * (y - my)) / any_value(m.w) AS ay,
    sum(x.w * (b - mb) * (y - my)) / any_value(m.w) AS by_ FROM x, m)
  SELECT 'returned' AS player, round((ay * bb - by_ * ab) / (aa * bb - ab * ab), 4) AS rating, (SELECT count(*) FROM x) AS n_rows FROM s
  UNION ALL SELECT 'open', round((by_ * aa - ay * ab) / (aa * bb - ab * ab), 4), (SELECT count(*) FROM x WHERE b <> 0) FROM s""")
def two_factor_ratings(spark, folder):
    """Weighted ridge of the price on two signed marks of every line, by conjugate gradients on the long table."""
    line = _line(spark, folder)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    marks = F.array(
        F.struct(F.lit("returned").alias("player"), F.when(F.col("l_returnflag") == "R", 1).otherwise(-1).alias("value")),
        F.struct(F.lit("open").alias("player"), F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("value")))
    entries = line.select(*keys, F.inline(marks)).where("value <> 0")
    return rounded(ratings.plus_minus(entries, line, keys, "l_extendedprice", "l_quantity", 0.05), "rating")


@query("""WITH g AS (SELECT c_nationkey, count(*) AS n, avg(c_acctbal) AS mean, var_pop(c_acctbal) * count(*) AS ss FROM customer GROUP BY 1),
  t AS (SELECT sum(n) AS al, count(*) AS k, sum(n * mean) / sum(n) AS overall, sum(ss) / (sum(n) - count(*)) AS s2,
    sum(n) - sum(n * n) / sum(n) AS base FROM g),
  b AS (SELECT *, greatest(((SELECT sum(n * pow(mean - overall, 2)) FROM g) - (k - 1) * s2) / base, 0) AS between_ FROM t)
  SELECT c_nationkey, n, round(mean, 4) AS mean, round(between_ / (between_ + s2 / n), 6) AS weight,
    round(between_ / (between_ + s2 / n) * mean + (1 - between_ / (between_ + s2 / n)) * overall, 4) AS shrunken_mean FROM g, b""")
def shrunken_group_means(spark, folder):
    """Group means pulled to the overall mean by empirical Bayes."""
    made = ratings.shrunken_means(table(spark, folder, "customer"), "c_nationkey", "c_acctbal")
    return rounded(rounded(made, "mean", "shrunken_mean"), "weight", places=6)


def _late(spark, folder):
    line = _line(spark, folder)
    return line.select((F.col("l_tax") > 0.03).cast("int").alias("won"), (F.col("l_linestatus") == "O").cast("int").alias("open"),
                       "l_quantity", "l_discount", "l_returnflag")


LOGIT_SQL = """c AS (SELECT CAST(count(*) FILTER (o AND w) AS DOUBLE) AS a, CAST(count(*) FILTER (o AND NOT w) AS DOUBLE) AS b,
    CAST(count(*) FILTER (NOT o AND w) AS DOUBLE) AS c, CAST(count(*) FILTER (NOT o AND NOT w) AS DOUBLE) AS d
    FROM (SELECT l_linestatus = 'O' AS o, l_tax > 0.03 AS w FROM lineitem)),
  e AS (SELECT '(Intercept)' AS term, ln(c / d) AS b, sqrt(1 / c + 1 / d) AS se FROM c
    UNION ALL SELECT 'open', ln(a * d / (b * c)), sqrt(1 / a + 1 / b + 1 / c + 1 / d) FROM c)"""


@query(f"""WITH {LOGIT_SQL} SELECT term, round(b, 6) AS estimate, round(exp(b), 6) AS odds, round(se, 6) AS std_error,
  round(b / se, 4) AS z, round(greatest(0, 1 - 2 * {simpson('exp(-x * x / 2) / sqrt(2 * pi())', '0', 'least(abs(b / se), 12)')}), 5) AS p_value FROM e""")
def logistic_regression(spark, folder):
    model = regression.logistic(_late(spark, folder), "won", ["open"])
    made = regression.logistic_table(spark, model, ["open"])
    return rounded(rounded(rounded(made, "estimate", "odds", "std_error", places=6), "z"), "p_value", places=5)


@query(f"""WITH {LOGIT_SQL}, l AS (SELECT 2 * (a * ln(a / (a + b)) + b * ln(b / (a + b)) + c * ln(c / (c + d)) + d * ln(d / (c + d))
    - (a + c) * ln((a + c) / (a + b + c + d)) - (b + d) * ln((b + d) / (a + b + c + d))) AS drop FROM c)
  SELECT round(drop, 5) AS deviance_drop, CAST(1 AS BIGINT) AS df,
    round(greatest(0, 1 - 2 * {simpson('exp(-x * x / 2) / sqrt(2 * pi())', '0', 'sqrt(drop)')}), 5) AS p_value FROM l""")
def deviance_test(spark, folder):
    model = regression.logistic(_late(spark, folder), "won", ["open"])
    return rounded(regression.deviance_test(spark, model, ["open"]), "deviance_drop", "p_value", places=5)


@query("""SELECT CAST(l_linestatus = 'O' AS INTEGER) AS open, l_returnflag,
  round(count(*) / sum(count(*)) OVER (PARTITION BY l_linestatus), 5) AS probability FROM lineitem GROUP BY l_linestatus, l_returnflag""")
def multinomial_probabilities(spark, folder):
    """Class probabilities by predictor value (with a binary predictor, the cell shares)."""
    rows = _late(spark, folder)
    model = regression.class_model(rows, "l_returnflag", ["open"])
    scored = regression.class_probabilities(model, rows.select("open").distinct(), "l_returnflag")
    return rounded(scored, "probability", places=5)


@query("""WITH m AS (SELECT l_linestatus AS k, count(*) AS n, avg(l_quantity) AS mq, avg(l_extendedprice) AS mp,
    var_samp(l_quantity) AS vq, var_samp(l_extendedprice) AS vp FROM lineitem GROUP BY 1),
  s AS (SELECT l_linestatus AS actual, arg_max(k, ln(n) - ln(2 * pi() * vq) / 2 - pow(l_quantity - mq, 2) / (2 * vq)
      - ln(2 * pi() * vp) / 2 - pow(l_extendedprice - mp, 2) / (2 * vp)) AS predicted
    FROM (SELECT *, row_number() OVER () AS id FROM lineitem), m GROUP BY id, l_linestatus)
  SELECT actual, predicted, count(*) AS n FROM s GROUP BY ALL""")
def naive_bayes_confusion(spark, folder):
    line = _line(spark, folder).select("l_linestatus", "l_quantity", "l_extendedprice")
    names = ["l_quantity", "l_extendedprice"]
    classes = regression.bayes_model(line, "l_linestatus", names)
    return regression.confusion(regression.bayes_classes(line, classes, "l_linestatus", names), "l_linestatus")


def _line_sql(rounds=8):
    """Log-odds as a straight line in one predictor, by Newton steps from 0."""
    steps = ["b0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for i in range(rounds):
        steps.append(f"""h{i} AS MATERIALIZED (SELECT any_value(a) AS a, any_value(b) AS b, sum(won - n * p) AS ga, sum(x * (won - n * p)) AS gb, sum(n * p * (1 - p)) AS aa,
          sum(n * x * p * (1 - p)) AS ab, sum(n * x * x * p * (1 - p)) AS bb FROM (SELECT c.*, a, b, 1 / (1 + exp(-a - b * x)) AS p FROM c, b{i})),
        b{i + 1} AS MATERIALIZED (SELECT a + (bb * ga - ab * gb) / (aa * bb - ab * ab) AS a, b + (aa * gb - ab * ga) / (aa * bb - ab * ab) AS b FROM h{i})""")
    return f"""WITH c AS MATERIALIZED (SELECT l_quantity::DOUBLE AS x, count(*) AS n, count(*) FILTER (l_tax > 0.03) AS won FROM lineitem GROUP BY l_quantity),
      {', '.join(steps)} SELECT x AS l_quantity, n, round(1 / (1 + exp(-a - b * x)), 5) AS fitted FROM c, b{rounds}"""


@query(_line_sql())
def additive_model_line(spark, folder):
    """A curve under a very large penalty: the straight line of the log-odds."""
    rows = _late(spark, folder).withColumn("l_quantity", F.col("l_quantity").cast("double"))
    span = (1.0, 50.0, 4)
    model, names = regression.additive_logistic(rows, "won", {"l_quantity": span}, 1e9)
    grid, _ = regression.spline_columns(rows.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n")), "l_quantity", *span)
    return rounded(grid.withColumn("fitted", regression.logistic_probability(model, names)).select("l_quantity", "n", "fitted"), "fitted", places=5)


@query()
def additive_model_curve(spark, folder):
    """Fitted probability over quantity from spline terms of two predictors."""
    rows = _late(spark, folder)
    spans = {"l_quantity": (1.0, 50.0, 4), "l_discount": (0.0, 0.1, 2)}
    model, names = regression.additive_logistic(rows, "won", spans, (0.1, 10.0, 1000.0))
    grid = rows.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"), F.avg("won").alias("seen"))
    grid = grid.withColumn("l_discount", F.lit(0.05))
    for column, span in spans.items():
        grid, _ = regression.spline_columns(grid, column, *span)
    curve = grid.withColumn("fitted", regression.logistic_probability(model, names))
    return rounded(curve.select("l_quantity", "n", "seen", "fitted"), "seen", "fitted")


@query("""WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
  SELECT 1 AS component, round(sqrt(1 + r), 6) AS sd, round((1 + r) / 2, 6) AS share, round((1 + r) / 2, 6) AS cumulative FROM r
  UNION ALL SELECT 2, round(sqrt(1 - r), 6), round((1 - r) / 2, 6), 1.0 FROM r""")
def component_shares(spark, folder):
    made = multivariate.Components(_line(spark, folder), ["l_quantity", "l_extendedprice"]).shares(spark)
    return rounded(made, "sd", "share", "cumulative", places=6)


@query("""WITH m AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_samp(l_extendedprice) AS sp,
    sign(corr(l_quantity, l_extendedprice)) AS way FROM lineitem)
  SELECT l_orderkey, round(((l_quantity - mq) / sq + way * (l_extendedprice - mp) / sp) / sqrt(2), 6) AS pc1 FROM lineitem, m""")
def component_scores(spark, folder):
    """First component score of every row."""
    line = _line(spark, folder).select("l_orderkey", "l_quantity", "l_extendedprice")
    parts = multivariate.Components(line, ["l_quantity", "l_extendedprice"])
    return rounded(parts.scores(line, 1).select("l_orderkey", "pc1"), "pc1", places=6)


@query()
def component_loadings(spark, folder):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(multivariate.Components(_line(spark, folder), names).loading_table(spark), "loading", places=5)


@query()
def clusters_against_labels(spark, folder):
    """K-means on the embeddings, cross-tabulated with their labels."""
    rows, _ = multivariate.clusters(table(spark, folder, "embeddings"), ["embedding"], 10, seed=3)
    return rows.groupBy("label", "cluster").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*)::DOUBLE AS n FROM lineitem GROUP BY ALL),
  x AS (SELECT sum(n) AS n FROM c GROUP BY a), y AS (SELECT sum(n) AS n, max(n) AS top FROM c GROUP BY b),
  t AS (SELECT (SELECT sum(n) FROM c) AS n, (SELECT sum(n * (n - 1) / 2) FROM c) AS p, (SELECT sum(n * (n - 1) / 2) FROM x) AS pa,
    (SELECT sum(n * (n - 1) / 2) FROM y) AS pb, (SELECT sum(n * ln(n)) FROM c) AS l, (SELECT sum(n * ln(n)) FROM x) AS la, (SELECT sum(n * ln(n)) FROM y) AS lb)
  SELECT CAST(n AS BIGINT) AS rows, (SELECT count(*) FROM x) AS groups_a, (SELECT count(*) FROM y) AS groups_b,
    round((p - pa * pb / (n * (n - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (n * (n - 1) / 2)), 8) AS adjusted_rand,
    round((SELECT sum(top) FROM y) / n, 8) AS purity,
    round((ln(n) + (l - la - lb) / n) / ((2 * ln(n) - (la + lb) / n) / 2), 8) AS shared_information FROM t""")
def partition_agreement(spark, folder):
    """How far two groupings of all lines agree."""
    return rounded(multivariate.agreement(table(spark, folder, "lineitem"), "l_returnflag", "l_linestatus"), "adjusted_rand", "purity", "shared_information", places=8)


@query()
def cluster_agreement(spark, folder):
    """Agreement of k-means on the embeddings with their labels."""
    rows, _ = multivariate.clusters(table(spark, folder, "embeddings"), ["embedding"], 10, seed=3)
    return rounded(multivariate.agreement(rows, "label", "cluster"), "adjusted_rand", "purity", "shared_information")


@query()
def cluster_silhouettes(spark, folder):
    """How well three, five and ten clusters part the suppliers' balances."""
    rows = table(spark, folder, "supplier").select("s_suppkey", F.col("s_acctbal").cast("double").alias("s_acctbal"))
    return rounded(multivariate.silhouettes(rows, ["s_acctbal"], [3, 5, 10], seed=5), "silhouette")


@query()
def mixture_clusters(spark, folder):
    rows, _ = multivariate.clusters(table(spark, folder, "supplier").select("s_suppkey", "s_acctbal"), ["s_acctbal"], 3, 5, "mixture")
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("s_acctbal"), 2).alias("mean"))
