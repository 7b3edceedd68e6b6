"""Queries over column selection, casts, filters and predicates."""
from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.text import first_last_name, to_number, unite
from touchline.operators import verbs
from touchline.operators.joins import semi
from touchline.operators.ordered import scan
from touchline.plans.describe import against_average
from touchline.queries.common import query
from touchline.sources.tables import table


@query("SELECT p_size, p_partkey, p_type, p_name FROM part")
def keep_drop_move(spark, folder):
    """Drop, keep a range, reorder by position, move in front."""
    part = table(spark, folder, "part").drop("p_retailprice", "p_brand")
    ranged = part.select(verbs.column_range(part, "p_partkey", "p_size"))
    placed = verbs.by_position(ranged, [4, 3, 2, 1])
    return verbs.move(verbs.move(placed, ["p_name"]), ["p_partkey"], before="p_type")


@query("""SELECT o_custkey, count(*) AS offense_n, CAST(sum(o_orderkey) AS BIGINT) AS offense_keys,
  min(o_orderpriority) AS offense_first FROM orders GROUP BY o_custkey""")
def rename_all(spark, folder):
    """Rename by name and position, then prefix all but the key."""
    totals = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("a"), F.sum("o_orderkey").alias("b"), F.min("o_orderpriority").alias("first")
    )
    return verbs.prefix_all(verbs.rename_positions(totals, {2: "n", 3: "keys"}), "offense_", ["o_custkey"])


@query("""SELECT o_orderkey, 'Orders' AS kind, o_orderkey * 2 AS doubled, o_orderkey * 2 + 1 AS after,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
  TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN 'DNF' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS price,
  CAST(o_orderkey % 2 AS BOOLEAN) AS odd FROM orders""")
def derive_and_cast(spark, folder):
    text = F.when(F.col("o_orderstatus") == "F", "DNF").otherwise(F.col("o_totalprice").cast("string"))
    return (
        table(spark, folder, "orders").withColumn("kind", F.lit("Orders"))
        .withColumn("doubled", F.col("o_orderkey") * 2).withColumn("after", F.col("doubled") + 1)
        .withColumn("level", to_number(F.substring("o_orderpriority", 1, 1), "int"))
        .withColumn("price", to_number(text)).withColumn("odd", (F.col("o_orderkey") % 2).cast("boolean"))
        .select("o_orderkey", "kind", "doubled", "after", "level", "price", "odd")
    )


@query("""SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS INTEGER) AS code
  FROM customer""")
def factor_codes(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return verbs.encode_levels(customer, "c_mktsegment", "code")


@query("""SELECT event_id, user_id, event_type FROM events""")
def null_columns_dropped(spark, folder):
    events = table(spark, folder, "events")
    holed = events.select(
        "event_id", "user_id", F.nullif("value", F.lit(0.01)).alias("value"),
        F.when(F.col("event_id") % 10 != 3, F.col("props")).alias("props"), "event_type",
    )
    return verbs.drop_null_columns(holed.withColumn("value", F.when(F.col("event_id") != 0, F.col("value"))))


@query("""SELECT l_orderkey, coalesce(CAST(nullif(l_linenumber % 4, 3) AS VARCHAR), 'NA') || '-' ||
  CAST(CAST(l_quantity % 3 AS INTEGER) AS VARCHAR) AS count FROM lineitem""")
def united_count(spark, folder):
    line = table(spark, folder, "lineitem").select(
        "l_orderkey", F.nullif(F.col("l_linenumber") % 4, F.lit(3)).alias("balls"),
        (F.col("l_quantity") % 3).cast("int").alias("strikes"),
    )
    return unite(line, "count", ["balls", "strikes"], "-")


@query("SELECT DISTINCT p_brand FROM part")
def key_values(spark, folder):
    return verbs.key_values(table(spark, folder, "part"), "p_brand")


@query("""SELECT n_nationkey, 'AFRICA,x' AS x10pct, n_name AS plus_minus, n_regionkey AS a_per_b, n_regionkey AS a_per_b_2
  FROM nation""")
def sanitized_names(spark, folder):
    nation = table(spark, folder, "nation")
    odd = nation.select("n_nationkey", F.lit("AFRICA,x").alias("10%"), F.col("n_name").alias("+/-"),
                        F.col("n_regionkey").alias("a/b"), F.col("n_regionkey").alias("a_per.b"))
    return verbs.sanitize_names(odd)


@query("""SELECT l_orderkey, l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem
  WHERE (l_returnflag = 'R' OR l_linestatus = 'O') AND l_quantity > 10 AND l_discount IN (0.02, 0.05)
    AND NOT (l_returnflag = 'R' AND l_tax = 0) AND l_shipdate >= TIMESTAMP '1996-06-01'""")
def compound_filter(spark, folder):
    line = table(spark, folder, "lineitem")
    kept = line.where(
        ((F.col("l_returnflag") == "R") | (F.col("l_linestatus") == "O")) & (F.col("l_quantity") > 10)
        & F.col("l_discount").isin(0.02, 0.05) & ~((F.col("l_returnflag") == "R") & (F.col("l_tax") == 0))
        & (F.col("l_shipdate") >= F.lit("1996-06-01").cast("timestamp_ntz"))
    )
    return kept.select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity", "l_discount")


PLACES_SQL = """places AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN ''
  WHEN o_orderkey % 5 = 0 THEN 'DQ' WHEN o_orderkey % 3 = 0 THEN 'NS' ELSE '1' END AS place FROM orders)"""


def _places(spark, folder):
    key = F.col("o_orderkey")
    place = (F.when(key % 11 == 0, None).when(key % 7 == 0, "").when(key % 5 == 0, "DQ")
             .when(key % 3 == 0, "NS").otherwise("1"))
    return table(spark, folder, "orders").select("o_orderkey", place.alias("place"))


@query(f"WITH {PLACES_SQL} SELECT * FROM places WHERE place IS NULL OR place NOT IN ('DQ', 'NS', 'G', 'DD')")
def not_in_keeps_missing(spark, folder):
    return _places(spark, folder).where(verbs.not_in("place", ["DQ", "NS", "G", "DD"]))


@query(f"WITH {PLACES_SQL} SELECT * FROM places WHERE place IS NOT NULL AND place <> ''")
def filled_only(spark, folder):
    return _places(spark, folder).where(verbs.filled("place"))


@query("""SELECT l_orderkey, l_linenumber, a, b FROM (SELECT l_orderkey, l_linenumber, nullif(l_linenumber % 7, 3) AS a,
  nullif(l_quantity, 20) AS b FROM lineitem) WHERE a IS NOT NULL AND b IS NOT NULL""")
def complete_cases(spark, folder):
    line = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif(F.col("l_linenumber") % 7, F.lit(3)).alias("a"),
        F.nullif("l_quantity", F.lit(20.0)).alias("b"),
    )
    return line.dropna(subset=["a", "b"])


@query("SELECT event_id, event_type FROM events WHERE value > 50 AND event_type <> 'error' AND user_id IS NOT NULL")
def boolean_column(spark, folder):
    events = table(spark, folder, "events").withColumn("large", (F.col("value") > 50) & (F.col("event_type") != "error"))
    return events.where(F.col("large") & F.col("user_id").isNotNull()).select("event_id", "event_type")


@query("""SELECT c_custkey, c_name FROM customer WHERE EXISTS
  (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def keys_of_another(spark, folder):
    urgent = table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    return semi(customer, urgent.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""SELECT user_id, event_id, CAST(no AS INTEGER) AS no FROM (SELECT user_id, event_id,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS no FROM events) WHERE no BETWEEN 3 AND 6""")
def row_range(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id")
    return scan(events, ["user_id"], ["event_id"], number="no").where(F.col("no").between(3, 6))


@query("""SELECT s_suppkey, s_acctbal, s_acctbal > avg(s_acctbal) OVER () AS above_all,
  s_acctbal > avg(s_acctbal) OVER (PARTITION BY s_nationkey) AS above_nation FROM supplier""")
def better_than_average(spark, folder):
    supplier = table(spark, folder, "supplier")
    marked = against_average(supplier, "s_acctbal", out="above_all")
    marked = against_average(marked, "s_acctbal", ["s_nationkey"], out="above_nation")
    return marked.select("s_suppkey", "s_acctbal", "above_all", "above_nation")


@query("""SELECT p_partkey, regexp_extract(p_name, '^(\\S+)', 1) AS first_name,
  nullif(regexp_extract(p_name, '^\\S+\\s+(.*)$', 1), '') AS last_name,
  TRY_CAST(split_part(p_size || '/' || round(p_size * 3.28084, 1), '/', 1) AS DOUBLE) AS metres FROM part""")
def names_and_units(spark, folder):
    first, last = first_last_name("p_name")
    both = F.concat_ws("/", F.col("p_size").cast("string"), F.round(F.col("p_size") * 3.28084, 1).cast("string"))
    part = table(spark, folder, "part").withColumn("both", both)
    return part.select("p_partkey", first.alias("first_name"), last.alias("last_name"),
                       to_number(F.split_part("both", F.lit("/"), F.lit(1))).alias("metres"))
