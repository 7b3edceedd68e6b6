"""Queries over joins, set operations and stacking."""
from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import joins
from touchline.plans.games import game_outcomes
from touchline.queries.common import GAMES_SQL, games, query
from touchline.session import cut_lineage
from touchline.sources.tables import in_years, table


@query("""SELECT o_orderkey, o_orderstatus, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def inner_join_names(spark, folder):
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return orders.join(customer, "o_custkey").select("o_orderkey", "o_orderstatus", "c_name", "c_mktsegment")


@query("""WITH s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS season, s_nationkey AS team, count(*) AS supplied
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
  b AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, c_nationkey AS team, count(*) AS ordered
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
  SELECT season, team, supplied, ordered FROM s JOIN b USING (season, team)""")
def composite_join(spark, folder):
    """Two season-by-team summaries with differently named keys."""
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    supplied = table(spark, folder, "lineitem").join(supplier, "l_suppkey").groupBy(
        F.year("l_shipdate").alias("season"), "s_nationkey").agg(F.count(F.lit(1)).alias("supplied"))
    ordered = table(spark, folder, "orders").join(customer, "o_custkey").groupBy(
        F.year("o_orderdate").alias("season"), "c_nationkey").agg(F.count(F.lit(1)).alias("ordered"))
    return supplied.withColumnRenamed("s_nationkey", "team").join(
        ordered.withColumnRenamed("c_nationkey", "team"), ["season", "team"])


@query("""SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3)
  ON c_nationkey = n_nationkey""")
def left_lookup(spark, folder):
    nation = table(spark, folder, "nation").where(F.col("n_regionkey") < 3)
    nation = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return customer.join(nation, "c_nationkey", "left").select("c_custkey", "n_name")


def _user_values(spark, folder, kind, name):
    """Per user (missing for every fifth) the total value of one event type."""
    events = table(spark, folder, "events").where(F.col("event_type") == kind)
    user = F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id")
    return events.groupBy(user).agg(F.count(F.lit(1)).alias(name))


def _user_sql(kind, name, extra=""):
    return f"""(SELECT CASE WHEN user_id % 5 <> 0 THEN user_id END AS user_id, count(*) AS {name} FROM events
      WHERE event_type = '{kind}' {extra} GROUP BY 1)"""


@query(f"""SELECT a.user_id, clicks, views, errors FROM {_user_sql('click', 'clicks')} a
  LEFT JOIN {_user_sql('view', 'views', 'AND value > 120')} b ON a.user_id IS NOT DISTINCT FROM b.user_id
  LEFT JOIN {_user_sql('error', 'errors', 'AND value > 180')} c ON a.user_id IS NOT DISTINCT FROM c.user_id""")
def natural_left_chain(spark, folder):
    clicks = _user_values(spark, folder, "click", "clicks")
    large = table(spark, folder, "events").where((F.col("event_type") == "view") & (F.col("value") > 120))
    largest = table(spark, folder, "events").where((F.col("event_type") == "error") & (F.col("value") > 180))
    user = F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id")
    views = large.groupBy(user).agg(F.count(F.lit(1)).alias("views"))
    errors = largest.groupBy(user).agg(F.count(F.lit(1)).alias("errors"))
    return joins.natural_left(joins.natural_left(clicks, views), errors)


@query("""WITH a AS (SELECT o_custkey, nullif(o_orderstatus, 'P') AS status, count(*) AS n FROM orders
    WHERE year(o_orderdate) = 1996 GROUP BY ALL),
  b AS (SELECT o_custkey, nullif(o_orderstatus, 'P') AS status, count(*) AS m FROM orders
    WHERE year(o_orderdate) = 1997 GROUP BY ALL)
  SELECT CASE WHEN n IS NULL THEN b.o_custkey ELSE a.o_custkey END AS o_custkey,
    CASE WHEN n IS NULL THEN b.status ELSE a.status END AS status, n, m
  FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.status IS NOT DISTINCT FROM b.status""")
def natural_full_join(spark, folder):
    """Two seasons side by side; a missing status matches a missing status."""
    orders = table(spark, folder, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))

    def season(year, name):
        kept = orders.where(in_years("o_orderdate", year, year))
        return kept.groupBy("o_custkey", "status").agg(F.count(F.lit(1)).alias(name))

    return joins.natural_full(season(1996, "n"), season(1997, "m"))


@query("""SELECT year, o_custkey, orders, urgent, low FROM (
    SELECT 1996 AS year, o_custkey, count(*) AS orders, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
      CAST(NULL AS BIGINT) AS low FROM orders WHERE year(o_orderdate) = 1996 GROUP BY o_custkey
    UNION ALL SELECT 1997, o_custkey, count(*), NULL, count(*) FILTER (o_orderpriority = '5-LOW')
    FROM orders WHERE year(o_orderdate) = 1997 GROUP BY o_custkey)""")
def stacked_seasons(spark, folder):
    """Season tables with unlike columns stacked; absent columns are missing."""
    orders = table(spark, folder, "orders")

    def season(year, name, level):
        kept = orders.where(in_years("o_orderdate", year, year)).groupBy("o_custkey")
        counted = kept.agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderpriority") == level).alias(name))
        return counted.withColumn("year", F.lit(year))

    return joins.stack(season(1996, "urgent", "1-URGENT"), season(1997, "low", "5-LOW"))


def _season_customers(spark, folder, year):
    orders = table(spark, folder, "orders").where(in_years("o_orderdate", year, year))
    return orders.select("o_custkey", "o_orderstatus")


MATCH_SQL = """WITH a AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders WHERE year(o_orderdate) = 1996 GROUP BY ALL),
  b AS (SELECT o_custkey, o_orderstatus, count(*) AS m FROM orders WHERE year(o_orderdate) = 1997 GROUP BY ALL),
  f AS (SELECT coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM a FULL JOIN b USING (o_custkey, o_orderstatus))"""


@query(MATCH_SQL + """ SELECT CASE WHEN m = 0 THEN 'left only' WHEN n = 0 THEN 'right only' ELSE 'both' END AS match,
  count(*) AS keys, CAST(sum(n) AS BIGINT) AS left_rows, CAST(sum(m) AS BIGINT) AS right_rows FROM f GROUP BY 1""")
def match_classes(spark, folder):
    a, b = _season_customers(spark, folder, 1996), _season_customers(spark, folder, 1997)
    matched = joins.match_classes(a, b, ["o_custkey", "o_orderstatus"])
    return matched.groupBy("match").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")
    )


@query("""WITH a AS (SELECT o_custkey, o_orderstatus FROM orders WHERE year(o_orderdate) = 1996),
  b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE year(o_orderdate) = 1997)
  SELECT 'inner' AS join_type, count(*) AS result_rows FROM a JOIN b USING (o_custkey, o_orderstatus)
  UNION ALL SELECT 'left', count(*) FROM a LEFT JOIN b USING (o_custkey, o_orderstatus)
  UNION ALL SELECT 'right', count(*) FROM a RIGHT JOIN b USING (o_custkey, o_orderstatus)
  UNION ALL SELECT 'full', count(*) FROM a FULL JOIN b USING (o_custkey, o_orderstatus)
  UNION ALL SELECT 'semi', count(*) FROM a SEMI JOIN b USING (o_custkey, o_orderstatus)
  UNION ALL SELECT 'anti', count(*) FROM a ANTI JOIN b USING (o_custkey, o_orderstatus)""")
def join_sizes(spark, folder):
    a, b = _season_customers(spark, folder, 1996), _season_customers(spark, folder, 1997)
    return joins.join_sizes(a, b, ["o_custkey", "o_orderstatus"])


@query(f"""WITH {GAMES_SQL}, t AS (SELECT season, home AS team, count(*) AS home_games FROM games GROUP BY ALL)
  SELECT g.season, g.home, g.away, count(*) AS n, min(h.home_games) AS home_home_games,
    min(a.home_games) AS away_home_games, CAST(sum(home_score - away_score) AS BIGINT) AS score_diff
  FROM games g JOIN t h ON g.season = h.season AND g.home = h.team JOIN t a ON g.season = a.season AND g.away = a.team
  GROUP BY ALL""")
def both_sides_lookup(spark, folder):
    """Games with the season table of both teams."""
    played = game_outcomes(games(spark, folder), "home", "away", "home_score", "away_score")
    paired = cut_lineage(played.groupBy("season", "home", "away").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score_diff").alias("score_diff")))
    teams = paired.groupBy("season", F.col("home").alias("team")).agg(F.sum("n").alias("home_games"))
    return joins.both_sides(paired, teams, ["season", "home"], ["season", "away"], ["season", "team"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def unmatched_rows(spark, folder):
    finished = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    customer = table(spark, folder, "customer").select("c_custkey")
    return joins.without(customer, finished.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""SELECT kind, key FROM (
  SELECT 'difference' AS kind, * FROM (SELECT s_nationkey AS key FROM supplier EXCEPT
    SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
  UNION ALL SELECT 'both', * FROM (SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer))""")
def set_operations(spark, folder):
    suppliers = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("key"))
    region = table(spark, folder, "nation").where(F.col("n_regionkey") == 2).select("n_nationkey")
    customers = table(spark, folder, "customer").select("c_nationkey")
    difference = suppliers.subtract(region)
    both = suppliers.intersect(customers)
    return difference.select(F.lit("difference").alias("kind"), "key").union(both.select(F.lit("both"), "key"))
