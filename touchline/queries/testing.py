"""Queries over intervals and tests."""
from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from touchline.plans import contingency, inference
from touchline.queries.common import chi2_area_sql, f_area_sql, query, rounded, simpson, t_area_sql, t_quantile_sql
from touchline.queries.grouping import BOOTSTRAP_SQL
from touchline.sources.tables import table

Z95 = repr(NormalDist().inv_cdf(0.975))
Z90 = repr(NormalDist().inv_cdf(0.95))


@query(f"""WITH m AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS sd FROM orders GROUP BY 1)
  SELECT o_orderpriority, n, round(mean, 4) AS mean, round(sd, 4) AS sd, round(sd / sqrt(n), 4) AS se,
    round(mean - {t_quantile_sql(Z90, 'n - 1')} * sd / sqrt(n), 4) AS low,
    round(mean + {t_quantile_sql(Z90, 'n - 1')} * sd / sqrt(n), 4) AS high FROM m""")
def mean_intervals(spark, folder):
    """90 percent t intervals."""
    made = inference.mean_interval(table(spark, folder, "orders"), ["o_orderpriority"], "o_totalprice", 0.9)
    return rounded(made, "mean", "sd", "se", "low", "high")


TWO_SQL = f"""WITH m AS (SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS n1, count(*) FILTER (l_linestatus = 'O') AS n2,
    avg(l_quantity) FILTER (l_linestatus = 'F') AS mean1, avg(l_quantity) FILTER (l_linestatus = 'O') AS mean2,
    var_samp(l_quantity) FILTER (l_linestatus = 'F') AS v1, var_samp(l_quantity) FILTER (l_linestatus = 'O') AS v2 FROM lineitem GROUP BY 1),
  s AS (SELECT *, 'welch' AS method, sqrt(v1 / n1 + v2 / n2) AS se,
      pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df FROM m
    UNION ALL SELECT *, 'pooled', sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)),
      CAST(n1 + n2 - 2 AS DOUBLE) FROM m),
  t AS (SELECT *, (mean1 - mean2) / se AS t FROM s)
  SELECT l_returnflag, method, n1, n2, round(mean1, 6) AS mean1, round(mean2, 6) AS mean2, round(mean1 - mean2, 6) AS difference,
    round(se, 6) AS se, round(df, 4) AS df, round(t, 6) AS t,
    round(mean1 - mean2 - {t_quantile_sql(Z95, 'df')} * se, 6) AS low, round(mean1 - mean2 + {t_quantile_sql(Z95, 'df')} * se, 6) AS high,
    round({t_area_sql('t.t', 'df')}, 6) AS p_value FROM t"""


@query(TWO_SQL)
def two_sample_tests(spark, folder):
    made = inference.two_samples(table(spark, folder, "lineitem"), "l_quantity", "l_linestatus", "F", "O", ["l_returnflag"])
    return rounded(rounded(made, "mean1", "mean2", "difference", "se", "t", "low", "high", "p_value", places=6), "df")


@query(f"""WITH m AS (SELECT count(*) AS n, avg(d) AS mean, stddev_samp(d) AS sd FROM (SELECT l_discount - l_tax AS d FROM lineitem))
  SELECT n, round(mean, 8) AS mean, round(sd, 8) AS sd, round(sd / sqrt(n), 8) AS se,
    round(mean - {t_quantile_sql(Z95, 'n - 1')} * sd / sqrt(n), 8) AS low, round(mean + {t_quantile_sql(Z95, 'n - 1')} * sd / sqrt(n), 8) AS high,
    round(mean / (sd / sqrt(n)), 4) AS t, round({t_area_sql('mean / (sd / sqrt(n))', 'n - 1')}, 6) AS p_value FROM m""")
def paired_test(spark, folder):
    made = inference.paired(table(spark, folder, "lineitem"), "l_discount", "l_tax")
    made = rounded(made, "mean", "sd", "se", "low", "high", places=8)
    return rounded(rounded(made, "t"), "p_value", places=6)


ANOVA_SQL = """g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) * count(*) AS ss FROM orders GROUP BY 1),
  a AS (SELECT CAST(sum(n) AS BIGINT) AS n, count(*) AS levels,
    sum(n * pow(m - (SELECT avg(o_totalprice) FROM orders), 2)) AS between_ss, sum(ss) AS within_ss FROM g),
  f AS (SELECT *, levels - 1 AS df_between, n - levels AS df_within, within_ss / (n - levels) AS mse,
    (between_ss / (levels - 1)) / (within_ss / (n - levels)) AS f FROM a)"""


@query(f"""WITH {ANOVA_SQL} SELECT n, levels, round(between_ss / 1e6, 2) AS between_ss, round(within_ss / 1e6, 2) AS within_ss,
  df_between, df_within, round(mse / 1e6, 4) AS mse, round(f, 6) AS f, round({f_area_sql('f.f', 'df_between', 'df_within')}, 6) AS p_value FROM f""")
def anova_one_way(spark, folder):
    made = inference.anova(table(spark, folder, "orders"), "o_orderpriority", "o_totalprice")
    made = made.withColumns({c: F.col(c) / 1e6 for c in ("between_ss", "within_ss", "mse")})
    return rounded(rounded(rounded(made, "between_ss", "within_ss", places=2), "mse"), "f", "p_value", places=6)


TWO_WAY_SQL = f"""WITH c AS (SELECT l_returnflag AS b, count(*) FILTER (l_linestatus = 'F') AS n1, count(*) FILTER (l_linestatus = 'O') AS n2,
    avg(l_quantity) FILTER (l_linestatus = 'F') AS m1, avg(l_quantity) FILTER (l_linestatus = 'O') AS m2 FROM lineitem GROUP BY 1),
  w AS (SELECT *, n1 * n2 / (n1 + n2) AS w, m1 - m2 AS d FROM c),
  e AS (SELECT sum(w * d) / sum(w) AS a, sum(w) AS sw FROM w),
  i AS (SELECT sum(w * pow(d - a, 2)) AS ss_int, min(a * a * sw) AS ss_a, count(*) AS k FROM w, e),
  t AS (SELECT count(*) AS n, var_pop(l_quantity) * count(*) AS sst FROM lineitem),
  sa AS (SELECT sum(n * pow(m - (SELECT avg(l_quantity) FROM lineitem), 2)) AS ss FROM
    (SELECT count(*) AS n, avg(l_quantity) AS m FROM lineitem GROUP BY l_linestatus)),
  sw AS (SELECT sum(v) AS ss FROM (SELECT var_pop(l_quantity) * count(*) AS v FROM lineitem GROUP BY l_linestatus, l_returnflag)),
  r AS (SELECT 'l_linestatus' AS term, sa.ss AS one, ss_a AS ss, 1 AS df FROM i, sa
    UNION ALL SELECT 'l_returnflag', sst - sa.ss - sw.ss - ss_int, sst - sa.ss - sw.ss - ss_int, k - 1 FROM i, t, sa, sw
    UNION ALL SELECT 'l_linestatus:l_returnflag', ss_int, ss_int, k - 1 FROM i
    UNION ALL SELECT 'residual', sw.ss, sw.ss, n - 2 * k FROM sw, t, i),
  f AS (SELECT term, one, r.ss, CAST(df AS BIGINT) AS df, CASE WHEN term <> 'residual' THEN r.ss / df / (sw.ss / (n - 2 * k)) END AS f,
    n - 2 * k AS dw FROM r, sw, t, i)
  SELECT term, round(one, 4) AS ss_in_order, round(ss, 4) AS ss, df, round(f, 6) AS f, CASE WHEN f IS NOT NULL THEN round({f_area_sql('f.f', 'df', 'dw')}, 6) END AS p_value FROM f"""


@query(TWO_WAY_SQL)
def anova_two_way(spark, folder):
    """Type II tests of two factors and their interaction, unequal cells."""
    made = inference.two_way_anova(table(spark, folder, "lineitem"), "l_linestatus", "l_returnflag", "l_quantity")
    return rounded(rounded(made, "ss_in_order", "ss"), "f", "p_value", places=6)


@query(f"""WITH {ANOVA_SQL}, p AS (SELECT a.o_orderpriority AS first, b.o_orderpriority AS second, a.n AS n1, b.n AS n2, a.m AS mean1, b.m AS mean2,
    a.m - b.m AS d, sqrt(mse * (1 / a.n + 1 / b.n)) AS se, df_within AS df FROM g a JOIN g b ON a.o_orderpriority < b.o_orderpriority, f)
  SELECT first, second, n1, n2, round(mean1, 4) AS mean1, round(mean2, 4) AS mean2, round(d, 4) AS difference, round(se, 4) AS se,
    round(d / se, 6) AS t, round(d - {t_quantile_sql(Z95, 'df')} * se, 4) AS lsd_low, round(d + {t_quantile_sql(Z95, 'df')} * se, 4) AS lsd_high,
    round({t_area_sql('d / se', 'df')}, 6) AS lsd_p FROM p""")
def pairwise_lsd(spark, folder):
    """All pairs of group means with least significant difference intervals."""
    made = inference.pairwise(table(spark, folder, "orders"), "o_orderpriority", "o_totalprice").drop("hsd_p")
    made = rounded(made, "mean1", "mean2", "difference", "se", "lsd_low", "lsd_high")
    return rounded(made, "t", "lsd_p", places=6)


@query()
def pairwise_tukey(spark, folder):
    """All pairs with honestly significant difference p values."""
    made = inference.pairwise(table(spark, folder, "orders"), "o_orderpriority", "o_totalprice")
    return rounded(made.select("first", "second", "difference", "t", "hsd_p"), "difference", "t", "hsd_p", places=6)


CHI_SQL = """c AS (SELECT o_orderpriority AS a, o_orderstatus AS b, count(*) AS n FROM orders GROUP BY ALL),
  g AS (SELECT x.a, y.b, coalesce(c.n, 0) AS n, x.n * y.n / (SELECT sum(n) FROM c) AS e
    FROM (SELECT a, sum(n) AS n FROM c GROUP BY a) x CROSS JOIN (SELECT b, sum(n) AS n FROM c GROUP BY b) y
    LEFT JOIN c ON c.a = x.a AND c.b = y.b)"""


@query(f"""WITH {CHI_SQL}, t AS (SELECT CAST(sum(n) AS BIGINT) AS n, sum(pow(n - e, 2) / e) AS x2,
    (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS df FROM g)
  SELECT n, round(x2, 6) AS chi_square, df, round({chi2_area_sql('x2', 'df')}, 6) AS p_value FROM t""")
def chi_square_test(spark, folder):
    made = contingency.chi_square(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus")
    return rounded(made, "chi_square", "p_value", places=6)


@query(f"""WITH {CHI_SQL} SELECT a AS o_orderpriority, b AS o_orderstatus, n, round(e, 4) AS expected,
  round((n - e) / sqrt(e), 6) AS residual, round(pow(n - e, 2) / e, 6) AS contribution FROM g""")
def expected_counts(spark, folder):
    made = contingency.expected_counts(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus")
    return rounded(rounded(made, "expected"), "residual", "contribution", places=6)


@query("""WITH t AS (SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS a, count(*) FILTER (quality = 1 AND toxic = 0) AS b,
    count(*) FILTER (quality = 0 AND toxic = 1) AS c, count(*) FILTER (quality = 0 AND toxic = 0) AS d FROM labels),
  h AS (SELECT t.*, x, exp(lgamma(a + c + 1) - lgamma(x + 1) - lgamma(a + c - x + 1) + lgamma(b + d + 1) - lgamma(a + b - x + 1)
      - lgamma(b + d - a - b + x + 1) - lgamma(a + b + c + d + 1) + lgamma(a + b + 1) + lgamma(c + d + 1)) AS p
    FROM t, range(0, 1000000) AS r(x) WHERE x BETWEEN greatest(0, a - d) AND least(a + b, a + c))
  SELECT a, b, c, d, round(a * d / nullif(b * c, 0), 6) AS odds_ratio,
    round(sum(p) FILTER (p <= (SELECT q.p FROM h q WHERE q.x = q.a) * (1 + 1e-7)), 6) AS p_value FROM h GROUP BY a, b, c, d""")
def fisher_exact(spark, folder):
    made = contingency.fisher_2x2(table(spark, folder, "labels"), "quality", "toxic", ((1, 0), (1, 0)))
    return rounded(made, "odds_ratio", "p_value", places=6)


@query()
def fisher_random_tables(spark, folder):
    """r x c table by random tables with the same margins."""
    return contingency.fisher_monte_carlo(table(spark, folder, "customer"), "c_mktsegment", "c_nationkey", 400, 11)


@query(f"""WITH c AS (SELECT l_returnflag, count(*) AS n, corr(l_quantity, l_discount) AS r FROM lineitem GROUP BY 1),
  t AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM c)
  SELECT l_returnflag, n, round(r, 8) AS r, round(t, 6) AS t, round({t_area_sql('t.t', 'n - 2')}, 6) AS p_value FROM t""")
def correlation_tests(spark, folder):
    made = inference.correlation_test(table(spark, folder, "lineitem"), "l_quantity", "l_discount", ["l_returnflag"])
    return rounded(rounded(made, "r", places=8), "t", "p_value", places=6)


@query(f"""WITH c AS (SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS s FROM orders GROUP BY 1),
  p AS (SELECT *, s / n AS p, (s / n - 0.3) / sqrt(0.3 * 0.7 / n) AS z FROM c)
  SELECT o_orderpriority, n, s AS successes, round(p, 6) AS p, round(p - {Z95} * sqrt(p * (1 - p) / n), 6) AS low,
    round(p + {Z95} * sqrt(p * (1 - p) / n), 6) AS high, round(z, 6) AS z,
    round(greatest(0, 1 - 2 * {simpson('exp(-x * x / 2) / sqrt(2 * pi())', '0', 'least(abs(z), 12)')}), 6) AS p_value FROM p""")
def proportion_tests(spark, folder):
    orders = table(spark, folder, "orders").withColumn("done", F.col("o_orderstatus") == "F")
    made = contingency.proportions(orders, ["o_orderpriority"], "done", 0.95, 0.3)
    return rounded(made, "p", "low", "high", "z", "p_value", places=6)


@query(f"""WITH t AS (SELECT CAST(count(*) FILTER (u AND f) AS DOUBLE) AS a, CAST(count(*) FILTER (u AND NOT f) AS DOUBLE) AS b,
    CAST(count(*) FILTER (NOT u AND f) AS DOUBLE) AS c, CAST(count(*) FILTER (NOT u AND NOT f) AS DOUBLE) AS d
    FROM (SELECT o_orderpriority = '1-URGENT' AS u, o_orderstatus = 'F' AS f FROM orders)),
  s AS (SELECT *, a * d / (b * c) AS odds_ratio, sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS log_se FROM t)
  SELECT a, b, c, d, round(odds_ratio, 6) AS odds_ratio, round(log_se, 6) AS log_se,
    round(exp(ln(odds_ratio) - {Z95} * log_se), 6) AS low, round(exp(ln(odds_ratio) + {Z95} * log_se), 6) AS high FROM s""")
def odds_ratios(spark, folder):
    orders = table(spark, folder, "orders").select(
        (F.col("o_orderpriority") == "1-URGENT").alias("u"), (F.col("o_orderstatus") == "F").alias("f"))
    return rounded(contingency.odds_ratio(orders, "u", "f"), "odds_ratio", "log_se", "low", "high", places=6)


@query(f"""WITH copies AS ({BOOTSTRAP_SQL.replace("round(sum(w * o_totalprice) / sum(w), 4)", "sum(w * o_totalprice) / sum(w)")})
  SELECT o_orderpriority, round(avg(mean), 4) AS center, round(stddev_samp(mean), 4) AS se,
    round(quantile_cont(mean, 0.05), 4) AS low, round(quantile_cont(mean, 0.95), 4) AS high FROM copies GROUP BY 1""")
def bootstrap_intervals(spark, folder):
    orders = table(spark, folder, "orders")
    made = inference.bootstrap_interval(orders, ["o_orderpriority"], "o_totalprice", ["o_orderkey"], 200, 7, 0.9)
    return rounded(made, "center", "se", "low", "high")
