"""Registry, shared inputs and shared oracle fragments."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that must give the same rows."""

    def keep(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return keep


def rounded(df: DataFrame, *columns: str, places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


ROWS_A_TASK = 100_000


def spread(df: DataFrame) -> DataFrame:
    """Deal rows for Python work: on all cores, and in tasks of at most about ROWS_A_TASK rows, however few files or row groups
    hold them. Deal what the rows are made from, not what is made: texts are larger."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK))
    return df.repartition(tasks)


def games(spark: SparkSession, folder: str) -> DataFrame:
    """Each line item as a game of customer nation (home) against supplier nation (away)."""
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    nation = table(spark, folder, "nation")
    home = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home"))
    away = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("away"))
    customers = customer.join(home, "c_nationkey")
    suppliers = supplier.join(away, "s_nationkey")
    joined = (
        line.join(suppliers, line.l_suppkey == suppliers.s_suppkey)
        .join(part, line.l_partkey == part.p_partkey)
        .join(orders.join(customers, orders.o_custkey == customers.c_custkey), line.l_orderkey == orders.o_orderkey)
        .where(F.col("home") != F.col("away"))
    )
    return joined.select(
        F.year("l_shipdate").alias("season"), "home", "away",
        F.col("l_quantity").cast("int").alias("home_score"), F.col("p_size").alias("away_score"),
    )


GAMES_SQL = """
games AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS season, hn.n_name AS home, an.n_name AS away,
         CAST(l_quantity AS INTEGER) AS home_score, p_size AS away_score
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation hn ON c_nationkey = hn.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation an ON s_nationkey = an.n_nationkey
  JOIN part ON l_partkey = p_partkey
  WHERE hn.n_name <> an.n_name
)"""

SIDES_SQL = """
sides AS (
  SELECT season, home AS team, away AS opponent, TRUE AS at_home, home_score AS own, away_score AS other FROM games
  UNION ALL
  SELECT season, away, home, FALSE, away_score, home_score FROM games
)"""


def simpson(f: str, low: str, high: str, steps: int = 2000) -> str:
    """SQL for the integral of ``f`` (an expression in ``x``) by Simpson's rule."""
    return f"""(SELECT sum(w * ({f})) * (({high}) - ({low})) / {steps} / 3 FROM (
      SELECT ({low}) + (({high}) - ({low})) * i / {steps} AS x,
             CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
      FROM range(0, {steps} + 1) AS r(i)))"""


def t_area_sql(t: str, df: str) -> str:
    """Two-sided t tail area, by integration over the angle atan(t / sqrt(df))."""
    f = f"pow(cos(x), ({df}) - 1)"
    constant = f"exp(lgamma((({df}) + 1) / 2.0) - lgamma(({df}) / 2.0)) / sqrt(pi())"
    return f"greatest(0, 1 - 2 * {constant} * {simpson(f, '0', f'atan(abs({t}) / sqrt({df}))')})"


def chi2_area_sql(x2: str, df: str) -> str:
    f = f"2 * pow(x, ({df}) - 1) * exp(-x * x / 2)"
    constant = f"exp(-lgamma(({df}) / 2.0)) / pow(2, ({df}) / 2.0)"
    return f"greatest(0, 1 - {constant} * {simpson(f, '0', f'sqrt({x2})')})"


def f_area_sql(f_value: str, d1: str, d2: str) -> str:
    f = f"2 * pow(sin(x), ({d1}) - 1) * pow(cos(x), ({d2}) - 1)"
    constant = f"exp(lgamma((({d1}) + ({d2})) / 2.0) - lgamma(({d1}) / 2.0) - lgamma(({d2}) / 2.0))"
    share = f"({d1}) * ({f_value}) / (({d1}) * ({f_value}) + ({d2}))"
    return f"greatest(0, 1 - {constant} * {simpson(f, '0', f'asin(sqrt({share}))')})"


def t_quantile_sql(z: str, df: str) -> str:
    """t quantile from a normal one by its expansion in 1 / df (good for df above 100)."""
    return f"""({z} + (pow({z}, 3) + {z}) / (4.0 * ({df}))
      + (5 * pow({z}, 5) + 16 * pow({z}, 3) + 3 * {z}) / (96.0 * pow({df}, 2))
      + (3 * pow({z}, 7) + 19 * pow({z}, 5) + 17 * pow({z}, 3) - 15 * {z}) / (384.0 * pow({df}, 3)))"""
