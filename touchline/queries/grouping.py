"""Queries over aggregation, reshaping and sampling."""
from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.numeric import MEDAL_POINTS, ratio, share_true, total, weighted
from touchline.operators.ordered import latest_per_key
from touchline.operators.reshape import indicator, longer, two_sided, wider
from touchline.operators.sampling import POISSON_STEPS, bootstrap_means, sample_per_group
from touchline.plans.describe import leader
from touchline.plans.results import season_totals
from touchline.queries.common import longs, query, rounded
from touchline.sources.tables import table


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity,
  round(sum(l_extendedprice), 2) AS price, round(avg(l_discount), 6) AS discount,
  coalesce(CAST(sum(nullif(l_linenumber % 2, 0)) AS BIGINT), 0) AS odd,
  coalesce(sum(CASE WHEN l_quantity > 99 THEN 1 END), 0)::BIGINT AS none FROM lineitem GROUP BY ALL""")
def group_totals(spark, folder):
    line = table(spark, folder, "lineitem")
    return line.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"), F.round(F.avg("l_discount"), 6).alias("discount"),
        total(F.nullif(F.col("l_linenumber") % 2, F.lit(0))).cast("long").alias("odd"),
        total(F.when(F.col("l_quantity") > 99, 1)).cast("long").alias("none"),
    )


@query("""SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS gold, count(*) FILTER (o_orderstatus = 'O') AS silver,
  count(*) FILTER (o_orderstatus = 'P') AS bronze, CAST(sum(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END)
  AS BIGINT) AS points, round(avg(CASE WHEN o_totalprice > 250000 THEN 1.0 ELSE 0.0 END), 6) AS large_share
  FROM orders GROUP BY o_custkey""")
def conditional_counts(spark, folder):
    """Counts by value, weighted points and the mean of a predicate."""
    medal = F.when(F.col("o_orderstatus") == "F", "Gold").when(F.col("o_orderstatus") == "O", "Silver")
    orders = table(spark, folder, "orders").withColumn("medal", medal.otherwise("Bronze"))
    return orders.groupBy("o_custkey").agg(
        *[F.count_if(F.col("medal") == m).alias(m.lower()) for m in MEDAL_POINTS],
        F.sum(weighted("medal", MEDAL_POINTS)).cast("long").alias("points"),
        F.round(share_true(F.col("o_totalprice") > 250000), 6).alias("large_share"),
    )


@query("""SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS quantity, round(sum(l_extendedprice) / sum(l_quantity), 4)
  AS unit_price, round(sum(l_quantity) / nullif(count(*) FILTER (l_quantity > 49.5), 0), 6) AS per_large
  FROM lineitem GROUP BY l_suppkey""")
def ratio_of_sums(spark, folder):
    sums = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"),
        F.count_if(F.col("l_quantity") > 49.5).alias("large"),
    )
    made = sums.withColumn("unit_price", F.round(ratio("price", "quantity"), 4))
    made = made.withColumn("per_large", F.round(ratio("quantity", "large"), 6))
    return longs(made, "quantity").drop("price", "large")


@query("""SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type,
  arg_min(value, event_id) AS first_value, arg_max(value, event_id) AS last_value,
  count(DISTINCT event_type) AS types, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY user_id""")
def ordered_first_last(spark, folder):
    ends = [f("event_type" if c == "type" else "value", "event_id").alias(f"{name}_{c}")
            for name, f in (("first", F.min_by), ("last", F.max_by)) for c in ("type", "value")]
    return table(spark, folder, "events").groupBy("user_id").agg(
        *ends, F.count_distinct("event_type").alias("types"), F.count_distinct(F.to_date("ts")).alias("days")
    )


@query("""SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS l_quantity, round(sum(l_discount), 4) AS l_discount,
  round(sum(l_tax), 4) AS l_tax, CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber FROM lineitem GROUP BY l_suppkey""")
def every_column_summed(spark, folder):
    names = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    sums = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(*[total(c).alias(c) for c in names])
    return longs(rounded(sums, "l_discount", "l_tax"), "l_quantity", "l_linenumber")


@query("""SELECT key, CAST(sum(a) AS BIGINT) AS amount, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT c_nationkey AS key, count(*) AS n, count(*) * 2 AS a FROM customer GROUP BY 1
  UNION ALL SELECT s_nationkey, count(*), count(*) * 5 FROM supplier GROUP BY 1) GROUP BY key""")
def two_level_totals(spark, folder):
    """Summaries of two tables united and summed: one aggregate over the united rows."""
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("key"), F.lit(2).alias("a"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("key"), F.lit(5).alias("a"))
    return customers.unionByName(suppliers).groupBy("key").agg(
        F.sum("a").alias("amount"), F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, o_orderpriority FROM orders""")
def distinct_keys(spark, folder):
    """One row per key combination."""
    orders = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority")
    return orders.dropDuplicates(["year", "o_orderstatus", "o_orderpriority"])


@query("""WITH t AS (SELECT o_custkey AS player, o_orderpriority AS tm, count(*) AS games,
    round(sum(o_totalprice), 2) AS points FROM orders GROUP BY ALL)
  SELECT * FROM t UNION ALL SELECT player, 'TOT', CAST(sum(games) AS BIGINT), round(sum(points), 2) FROM t
  GROUP BY player HAVING count(*) > 1""")
def traded_player_totals(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("player"), F.col("o_orderpriority").alias("tm"), F.lit(1).alias("games"),
        F.col("o_totalprice").alias("points"))
    return rounded(season_totals(rows, "player", "tm", ["games", "points"]), "points", places=2)


@query("""WITH t AS (SELECT o_orderpriority, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY ALL) SELECT o_orderpriority, min(c_mktsegment) AS c_mktsegment, n FROM t
  WHERE n = (SELECT max(n) FROM t u WHERE u.o_orderpriority = t.o_orderpriority) GROUP BY ALL""")
def group_leaders(spark, folder):
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    counts = table(spark, folder, "orders").join(customer, "o_custkey").groupBy("o_orderpriority", "c_mktsegment")
    return leader(counts.agg(F.count(F.lit(1)).alias("n")), ["o_orderpriority"], "c_mktsegment", "n")


@query("""SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
  arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def latest_rows(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return latest_per_key(events, ["user_id"], ["event_id"])


@query("""SELECT l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS shots,
  CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL""")
def counts_by_team(spark, folder):
    returned = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return returned.groupBy("l_linestatus", F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("shots"), F.sum("l_quantity").cast("long").alias("total"))


@query("""SELECT s_suppkey, measure, value FROM (SELECT s_suppkey, s_acctbal AS balance, CAST(s_nationkey AS DOUBLE) AS nation
  FROM supplier) UNPIVOT (value FOR measure IN (balance, nation))""")
def wide_to_long(spark, folder):
    supplier = table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation"))
    return longer(supplier, ["balance", "nation"], "measure", "value")


@query(f"""SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, {', '.join(
    f"nullif(count(*) FILTER (l_returnflag = '{f}'), 0) AS n_{f}, CAST(sum(l_quantity) FILTER (l_returnflag = '{f}') AS BIGINT) AS quantity_{f}, round(avg(l_extendedprice) FILTER (l_returnflag = '{f}'), 7) AS price_{f}"
    for f in 'ANR')} FROM lineitem GROUP BY ALL""")
def long_to_wide(spark, folder):
    line = table(spark, folder, "lineitem").withColumn("year", F.year("l_shipdate"))
    return wider(line, ["l_suppkey", "year"], "l_returnflag", ["A", "N", "R"], {
        "n": F.count(F.lit(1)), "quantity": F.sum("l_quantity").cast("long"),
        "price": F.round(F.avg("l_extendedprice"), 7)})


@query("""SELECT c_nationkey, """ + ", ".join(
    f'count(*) FILTER (c_mktsegment = \'{s}\') AS "{s}"'
    for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM customer GROUP BY c_nationkey")
def indicator_columns(spark, folder):
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return indicator(table(spark, folder, "customer"), ["c_nationkey"], "c_mktsegment", segments, F.lit(1))


@query("""SELECT o_orderkey, o_custkey AS own, -o_custkey AS other, 'first' AS side FROM orders
  UNION ALL SELECT o_orderkey, -o_custkey, o_custkey, 'second' FROM orders""")
def two_sided_rows(spark, folder):
    orders = table(spark, folder, "orders")
    return two_sided(orders, ["o_orderkey"],
                     {"own": "o_custkey", "other": -F.col("o_custkey"), "side": F.lit("first")},
                     {"own": -F.col("o_custkey"), "other": "o_custkey", "side": F.lit("second")})


def _sample_sql(n, seed):
    return f"""SELECT c_custkey, c_mktsegment FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment
      ORDER BY md5('{seed}|' || c_custkey), c_custkey) AS no FROM customer) WHERE no <= {n}"""


@query(_sample_sql(20, 1832))
def sample_per_group_20(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return sample_per_group(customer, ["c_mktsegment"], ["c_custkey"], 20, 1832)


@query("""SELECT o_orderkey, o_orderpriority, o_orderstatus FROM (SELECT *, row_number() OVER (
  PARTITION BY o_orderpriority, o_orderstatus ORDER BY md5('501|' || o_orderkey), o_orderkey) AS no FROM orders) WHERE no <= 500""")
def capped_groups(spark, folder):
    """At most 500 random rows per group; smaller groups whole."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return sample_per_group(orders, ["o_orderpriority", "o_orderstatus"], ["o_orderkey"], 500, 501)


BOOTSTRAP_SQL = f"""WITH drawn AS (SELECT o_orderpriority, copy, o_totalprice,
    CAST('0x' || substr(md5('7|' || o_orderkey || '|' || ((copy - 1) // 8)), 1 + 4 * ((copy - 1) % 8), 4) AS BIGINT) / 65536.0 AS u
    FROM orders, range(1, 201) AS r(copy)),
  weighted AS (SELECT *, {' + '.join(f'CAST(u >= {s!r} AS INTEGER)' for s in POISSON_STEPS)} AS w FROM drawn)
  SELECT o_orderpriority, CAST(copy AS INTEGER) AS copy, CAST(sum(w) AS BIGINT) AS n,
    round(sum(w * o_totalprice) / sum(w), 4) AS mean FROM weighted GROUP BY ALL"""


@query(BOOTSTRAP_SQL)
def bootstrap_copies(spark, folder):
    orders = table(spark, folder, "orders")
    means = bootstrap_means(orders, ["o_orderpriority"], "o_totalprice", ["o_orderkey"], 200, 7)
    return rounded(means, "mean")
