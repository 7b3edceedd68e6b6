"""Queries over descriptive statistics and plot data."""
from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import functions as F

from touchline.operators.quantiles import quantiles
from touchline.plans import contingency, describe
from touchline.queries.common import query, rounded, simpson
from touchline.sources.tables import table


@query("""WITH b AS (SELECT o_orderstatus, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1),
  c AS (SELECT o_orderstatus, CAST(least(floor((o_totalprice - lo) / (hi - lo) * 30), 29) + 1 AS INTEGER) AS bin, count(*) AS n
    FROM orders JOIN b USING (o_orderstatus) GROUP BY ALL)
  SELECT o_orderstatus, CAST(i AS INTEGER) AS bin, round(lo + (hi - lo) / 30 * (i - 1), 4) AS bin_from,
    round(lo + (hi - lo) / 30 * i, 4) AS bin_to, coalesce(n, 0) AS n
  FROM b, range(1, 31) AS r(i) LEFT JOIN c ON c.o_orderstatus = b.o_orderstatus AND c.bin = i""".replace(
    "SELECT o_orderstatus, CAST(i", "SELECT b.o_orderstatus, CAST(i"))
def value_histogram(spark, folder):
    made = describe.histogram(table(spark, folder, "orders"), "o_totalprice", 30, ["o_orderstatus"])
    return rounded(made, "bin_from", "bin_to")


MEASURES = ("l_quantity", "l_extendedprice", "l_discount")


@query(" UNION ALL ".join(f"""SELECT l_returnflag, '{m}' AS measure, count({m}) AS n, round(avg({m}), 6) AS mean,
  round(stddev_samp({m}), 6) AS sd, min({m}) AS lowest, max({m}) AS highest, round(quantile_cont({m}, 0.25), 6) AS q1,
  round(quantile_cont({m}, 0.5), 6) AS median, round(quantile_cont({m}, 0.75), 6) AS q3, round(max({m}) - min({m}), 6) AS range,
  round(quantile_cont({m}, 0.75) - quantile_cont({m}, 0.25), 6) AS iqr FROM lineitem GROUP BY l_returnflag""" for m in MEASURES))
def summary_statistics(spark, folder):
    made = describe.summary(table(spark, folder, "lineitem"), ["l_returnflag"], MEASURES)
    return rounded(made, "mean", "sd", "q1", "median", "q3", "range", "iqr", places=6)


FENCES_SQL = """q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)"""


@query(f"""WITH {FENCES_SQL} SELECT event_type, round(min(q1), 6) AS q1, round(min(median), 6) AS median, round(min(q3), 6) AS q3,
    count(*) AS n, min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low_whisker,
    max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high_whisker,
    count(*) FILTER (value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM events JOIN q USING (event_type) GROUP BY event_type""")
def boxplot_statistics(spark, folder):
    made = describe.boxplot(table(spark, folder, "events"), ["event_type"], "value")
    return rounded(made, "q1", "median", "q3", places=6)


@query(f"""WITH {FENCES_SQL} SELECT event_id, event_type, value, value > q3 + 3 * (q3 - q1) AS extreme FROM events JOIN q USING (event_type)
  WHERE value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def outlier_rows(spark, folder):
    """Rows beyond 1.5 IQR, marked when beyond 3 IQR."""
    found = describe.outliers(table(spark, folder, "events"), ["event_type"], "value", 1.5)
    iqr = (F.col("high_fence") - F.col("low_fence")) / 4
    return found.select("event_id", "event_type", "value", (F.col("value") > F.col("high_fence") + 1.5 * iqr).alias("extreme"))


@query("""SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER p) / stddev_samp(o_totalprice) OVER p, 6) AS z
  FROM orders WINDOW p AS (PARTITION BY o_orderpriority)""")
def group_z_scores(spark, folder):
    made = describe.z_scores(table(spark, folder, "orders"), ["o_orderpriority"], "o_totalprice")
    return rounded(made.select("o_orderkey", "z"), "z", places=6)


@query("""SELECT c_mktsegment, round(quantile_cont(c_acctbal, 0.9), 6) AS top_tenth, round(quantile_cont(c_acctbal, 0.25), 6) AS q1,
  round(quantile_cont(c_acctbal, 0.01), 6) AS p01 FROM customer GROUP BY c_mktsegment""")
def quantile_cuts(spark, folder):
    cuts = {"top_tenth": 0.9, "q1": 0.25, "p01": 0.01}
    return rounded(quantiles(table(spark, folder, "customer"), ["c_mktsegment"], "c_acctbal", cuts), *cuts, places=6)


@query("""SELECT c_mktsegment, count(*) AS n, round(avg(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0 END), 6) AS bad,
  round(avg(CASE WHEN c_acctbal >= 0 AND c_acctbal < 5000 THEN 1.0 ELSE 0 END), 6) AS grey,
  round(avg(CASE WHEN c_acctbal >= 5000 THEN 1.0 ELSE 0 END), 6) AS good FROM customer GROUP BY c_mktsegment""")
def band_shares(spark, folder):
    limits = {"bad": (None, 0), "grey": (0, 5000), "good": (5000, None)}
    made = describe.band_shares(table(spark, folder, "customer"), ["c_mktsegment"], "c_acctbal", limits)
    return rounded(made, *limits, places=6)


@query(f"""WITH m AS (SELECT l_linestatus, count(*) AS n, avg(l_quantity) AS mean, stddev_samp(l_quantity) AS sd,
    avg(CASE WHEN l_quantity > 40 THEN 1.0 ELSE 0 END) AS share_above FROM lineitem GROUP BY 1)
  SELECT l_linestatus, n, round(mean, 6) AS mean, round(sd, 6) AS sd, round(share_above, 6) AS share_above,
    round((40 - mean) / sd, 6) AS z, round(0.5 - {simpson("exp(-x * x / 2) / sqrt(2 * pi())", "0", "(40 - mean) / sd")}, 6) AS normal_above
  FROM m""")
def normal_model_shares(spark, folder):
    made = describe.normal_shares(table(spark, folder, "lineitem"), ["l_linestatus"], "l_quantity", 40)
    return rounded(made, "mean", "sd", "share_above", "z", "normal_above", places=6)


@query(" UNION ALL ".join(f"""SELECT event_type, '{m}' AS measure, count(*) AS n,
  round((avg(pow(d, 3)) / pow(avg(d * d), 1.5)), 6) AS skewness, round(avg(pow(d, 4)) / pow(avg(d * d), 2) - 3, 6) AS kurtosis
  FROM (SELECT event_type, {e} - avg({e}) OVER (PARTITION BY event_type) AS d FROM events) GROUP BY event_type"""
                          for m, e in (("value", "value"), ("user_id", "user_id"))))
def distribution_shape(spark, folder):
    made = describe.shape(table(spark, folder, "events"), ["event_type"], ["value", "user_id"])
    return rounded(made, "skewness", "kurtosis", places=6)


@query("""WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
  c AS (SELECT CAST(least(floor((value - lo) / (hi - lo) * 60), 59) + 1 AS INTEGER) AS bin, count(*) AS n FROM events, b GROUP BY 1),
  h AS (SELECT CAST(i AS INTEGER) AS bin, coalesce(n, 0) AS n, lo, hi FROM b, range(1, 61) AS r(i) LEFT JOIN c ON c.bin = i),
  s AS (SELECT *, lag(n, 1, 0) OVER (ORDER BY bin) AS p, lead(n, 1, 0) OVER (ORDER BY bin) AS q FROM h)
  SELECT bin, n, round(lo + (hi - lo) / 60 * (bin - 1), 4) AS bin_from, round(lo + (hi - lo) / 60 * bin, 4) AS bin_to
  FROM s WHERE n > p AND n > q""")
def histogram_peaks(spark, folder):
    return rounded(describe.modes(table(spark, folder, "events"), "value", 60), "bin_from", "bin_to")


@query("""WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
  SELECT o_orderpriority, o_orderstatus, n, round(n / sum(n) OVER (PARTITION BY o_orderpriority), 6) AS row_share,
    round(n / sum(n) OVER (PARTITION BY o_orderstatus), 6) AS column_share, round(n / sum(n) OVER (), 6) AS table_share FROM c""")
def two_way_table(spark, folder):
    made = contingency.two_way(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus")
    return rounded(made, "row_share", "column_share", "table_share", places=6)


@query("""SELECT coalesce(o_orderpriority, 'All') AS o_orderpriority, coalesce(o_orderstatus, 'All') AS o_orderstatus, count(*) AS n
  FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def table_with_margins(spark, folder):
    return contingency.with_margins(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus")


@query("""SELECT c_nationkey, count(*) AS n, round(avg(c_acctbal), 6) AS mean, round(median(c_acctbal), 6) AS median
  FROM customer GROUP BY c_nationkey""")
def group_means(spark, folder):
    made = describe.group_means(table(spark, folder, "customer"), ["c_nationkey"], "c_acctbal")
    return rounded(made, "mean", "median", places=6)


NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" UNION ALL ".join(
    f"SELECT l_returnflag, '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r, count(*) AS n FROM lineitem GROUP BY l_returnflag"
    for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]))
def correlation_matrix(spark, folder):
    return rounded(describe.correlations(table(spark, folder, "lineitem"), NUMBERS, ["l_returnflag"]), "r", places=6)


@query(" UNION ALL ".join(f"""SELECT '{y}' AS response, '{x}' AS predictor, round(corr({y}, {x}), 6) AS r,
  round(regr_r2({y}, {x}), 6) AS r2, round(regr_slope({y}, {x}), 6) AS slope FROM lineitem"""
                          for y in ("l_extendedprice", "l_discount") for x in ("l_quantity", "l_tax", "l_linenumber")))
def predictor_screening(spark, folder):
    made = describe.screen(table(spark, folder, "lineitem"), ["l_extendedprice", "l_discount"],
                           ["l_quantity", "l_tax", "l_linenumber"])
    return rounded(made, "r", "r2", "slope", places=6)


@query("""WITH l AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
  c AS (SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS x_cell, CAST(floor(l_extendedprice / 10000) AS BIGINT) AS y_cell, count(*) AS n
    FROM lineitem GROUP BY ALL)
  SELECT x_cell, y_cell, n, round(n / sum(n) OVER (), 8) AS share, round(a + b * (x_cell + 0.5) * 5, 4) AS fitted FROM c, l""")
def scatter_with_line(spark, folder):
    made = describe.scatter_grid(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", 5, 10000)
    return rounded(rounded(made, "share", places=8), "fitted")


@query("""WITH c AS (SELECT event_type, CAST(floor(value / 20) AS BIGINT) AS x_cell, CAST(floor(user_id / 10) AS BIGINT) AS y_cell,
    count(*) AS n FROM events GROUP BY ALL)
  SELECT event_type, x_cell, y_cell, n, round(n / sum(n) OVER (PARTITION BY event_type), 8) AS share FROM c""")
def joint_frequencies(spark, folder):
    made = describe.joint_frequency(table(spark, folder, "events"), "value", "user_id", 20, 10, ["event_type"])
    return rounded(made, "share", places=8)


def _kernel_sql(distance, bandwidth):
    return f"exp(-pow(({distance}) / {bandwidth}, 2) / 2) / {bandwidth * math.sqrt(2 * math.pi)!r}"


@query(f"""WITH c AS (SELECT CAST(round((c_acctbal + 1000) / (11000 / 63.0)) AS BIGINT) AS cell, count(*) AS n FROM customer GROUP BY 1)
  SELECT CAST(p AS INTEGER) AS point, round(-1000 + p * (11000 / 63.0), 4) AS at,
    round(sum(n * {_kernel_sql('(p - cell) * (11000 / 63.0)', 800.0)}) / sum(n), 10) AS density
  FROM c, range(0, 64) AS r(p) GROUP BY p""")
def density_curve(spark, folder):
    made = describe.density(table(spark, folder, "customer"), "c_acctbal", -1000, 10000, 64, 800.0)
    return rounded(rounded(made, "density", places=10), "at")


@query(f"""WITH c AS (SELECT CAST(round((l_quantity - 1) / (49 / 23.0)) AS BIGINT) AS cx,
    CAST(round(l_discount / (0.1 / 23)) AS BIGINT) AS cy, count(*) AS n FROM lineitem GROUP BY ALL)
  SELECT CAST(px AS INTEGER) AS x_point, CAST(py AS INTEGER) AS y_point,
    round(sum(n * {_kernel_sql('(px - cx) * (49 / 23.0)', 4.0)} * {_kernel_sql('(py - cy) * (0.1 / 23)', 0.01)}) / sum(n), 8) AS density
  FROM c, range(0, 24) AS a(px), range(0, 24) AS b(py) GROUP BY px, py""")
def density_surface(spark, folder):
    made = describe.density_2d(table(spark, folder, "lineitem"), "l_quantity", "l_discount", (1, 50), (0, 0.1), 24, 4.0, 0.01)
    return rounded(made, "density", places=8)


@query("""WITH h AS (SELECT o_orderstatus, nullif(o_custkey % 7, 3) AS a, nullif(o_orderkey % 5, 2) AS b, o_totalprice AS c FROM orders)
  SELECT o_orderstatus, n_rows, complete_rows, column_name, missing, round(missing / n_rows, 6) AS missing_share FROM (
    SELECT o_orderstatus, count(*) AS n_rows, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL) AS complete_rows,
      count(*) FILTER (a IS NULL) AS a, count(*) FILTER (b IS NULL) AS b, count(*) FILTER (c IS NULL) AS c FROM h GROUP BY 1)
  UNPIVOT (missing FOR column_name IN (a, b, c))""")
def missing_profile(spark, folder):
    holed = table(spark, folder, "orders").select(
        "o_orderstatus", F.nullif(F.col("o_custkey") % 7, F.lit(3)).alias("a"),
        F.nullif(F.col("o_orderkey") % 5, F.lit(2)).alias("b"), F.col("o_totalprice").alias("c"))
    return rounded(describe.missing_profile(holed, ["a", "b", "c"], ["o_orderstatus"]), "missing_share", places=6)


QQ = [(i, (i - 0.5) / 19) for i in range(1, 20)]


@query("WITH m AS (SELECT avg(s_acctbal) AS mean, stddev_samp(s_acctbal) AS sd FROM supplier) " + " UNION ALL ".join(
    f"""SELECT {i} AS point, round({p!r}, 6)::DOUBLE AS p, round((SELECT quantile_cont(s_acctbal, {p!r}) FROM supplier), 6) AS sample,
    round(mean + sd * {NormalDist().inv_cdf(p)!r}, 6) AS normal FROM m""" for i, p in QQ))
def normal_quantile_pairs(spark, folder):
    made = describe.normal_quantiles(table(spark, folder, "supplier"), "s_acctbal", 19)
    return rounded(made, "p", "sample", "normal", places=6)
