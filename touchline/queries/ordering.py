"""Queries over windows, ranks, sorting and limits."""
from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators.ordered import blocks, order_columns, ranks, scan, top_per_key
from touchline.plans.games import qualification
from touchline.queries.common import longs, query, rounded
from touchline.session import cut_lineage
from touchline.sources.tables import table


@query("""SELECT event_id, lag(event_type) OVER w AS before, lead(event_type) OVER w AS after,
  CAST(sum(CAST(event_type = 'error' AS INTEGER)) OVER w + 1 AS BIGINT) AS segment,
  CAST(row_number() OVER w AS INTEGER) AS no,
  last_value(nullif(event_type, 'view') IGNORE NULLS) OVER w AS filled
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""".replace(
    "lead(event_type) OVER w", "lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id)"))
def shifts_and_segments(spark, folder):
    """Previous and next value, segment id by running sum, fill down, row number."""
    events = table(spark, folder, "events").withColumn("opens", (F.col("event_type") == "error").cast("int"))
    events = events.withColumn("shown", F.nullif("event_type", F.lit("view")))
    marked = scan(events, ["user_id"], ["event_id"], lag={"before": "event_type"}, lead={"after": "event_type"},
                  running={"__opened": "opens"}, fill={"filled": "shown"}, number="no")
    return marked.select("event_id", "before", "after", (F.col("__opened") + 1).alias("segment"), "no", "filled")


@query("""SELECT o_orderkey, year, CAST(rank() OVER w AS INTEGER) AS low,
  CAST(floor(rank() OVER w + (count(*) OVER (PARTITION BY year, o_orderstatus, o_custkey) - 1) / 2.0) AS BIGINT) AS middle,
  CAST(dense_rank() OVER w AS INTEGER) AS dense, round(percent_rank() OVER w, 6) AS share,
  round(cume_dist() OVER w, 6) AS upto
  FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
  WINDOW w AS (PARTITION BY year, o_orderstatus ORDER BY o_custkey DESC)""")
def rank_kinds(spark, folder):
    """Lowest, average (cut to whole), dense and percent ranks with ties."""
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    ranked = ranks(orders, ["year", "o_orderstatus"], "-o_custkey", low="low", average="middle", dense="dense",
                   share="share", cumulative="upto")
    ranked = ranked.withColumn("middle", F.floor("middle"))
    return rounded(ranked.select("o_orderkey", "year", "low", "middle", "dense", "share", "upto"), "share", "upto", places=6)


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey) AS no FROM orders) WHERE no = 1""")
def newest_order(spark, folder):
    newest = top_per_key(table(spark, folder, "orders"), ["o_custkey"], ["-o_orderdate", "o_orderkey"], 1)
    return newest.select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT o_custkey, o_orderkey, round(o_totalprice - first_value(o_totalprice) OVER (PARTITION BY o_custkey
  ORDER BY o_orderkey), 4) AS behind FROM orders""")
def behind_leader(spark, folder):
    led = scan(table(spark, folder, "orders"), ["o_custkey"], ["o_orderkey"], first={"lead": "o_totalprice"})
    return led.select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") - F.col("lead"), 4).alias("behind"))


@query("""WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i,
    count(*) OVER (PARTITION BY user_id) // 4 AS len FROM events)
  SELECT user_id, event_id, CAST(i // len + 1 AS INTEGER) AS block, CAST(i % len + 1 AS INTEGER) AS position FROM n
  WHERE i // len < 4 AND i % len < len - 3""")
def checkpoint_blocks(spark, folder):
    """Four equal blocks of each user's rows, the last three of each dropped."""
    events = table(spark, folder, "events").select("user_id", "event_id")
    return blocks(events, ["user_id"], ["event_id"], 4, drop_last=3)


@query("""WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, c_nationkey AS team, o_orderkey,
    CAST(o_totalprice > 250000 AS INTEGER) AS win FROM orders JOIN customer ON o_custkey = c_custkey),
  r AS (SELECT *, row_number() OVER w AS no, sum(win) OVER w AS wins, count(*) OVER (PARTITION BY season, team) AS games
    FROM g WINDOW w AS (PARTITION BY season, team ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)),
  t AS (SELECT season, team, max(games) AS games, max(wins / no) FILTER (no = greatest(games // 2, 1)) AS mid_pct,
    max(wins / games) FILTER (no = games) AS final_pct FROM r GROUP BY ALL),
  p AS (SELECT *, CAST(rank() OVER (PARTITION BY season ORDER BY mid_pct DESC) AS INTEGER) AS mid_place,
    CAST(rank() OVER (PARTITION BY season ORDER BY final_pct DESC) AS INTEGER) AS final_place FROM t)
  SELECT season, team, games, round(mid_pct, 6) AS mid_pct, round(final_pct, 6) AS final_pct, mid_place, final_place,
    mid_place <= 8 AS mid_in, final_place <= 8 AS final_in FROM p""")
def midseason_qualification(spark, folder):
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("team"))
    rows = table(spark, folder, "orders").join(customer, "o_custkey").select(
        F.year("o_orderdate").alias("season"), "team", "o_orderkey", (F.col("o_totalprice") > 250000).cast("int").alias("win"))
    table_ = qualification(rows, "season", "team", ["o_orderkey"], "win", 8)
    return rounded(table_, "mid_pct", "final_pct", places=6)


@query("""WITH r AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY ALL),
  p AS (SELECT *, rank() OVER (PARTITION BY year ORDER BY n DESC) AS place FROM r)
  SELECT a.o_custkey, CAST(a.place AS INTEGER) AS place_1996, CAST(b.place AS INTEGER) AS place_1997,
    CAST(a.place - b.place AS INTEGER) AS change FROM p a JOIN p b ON a.o_custkey = b.o_custkey
  WHERE a.year = 1996 AND b.year = 1997""")
def rank_change(spark, folder):
    """Places of two seasons and their difference."""
    counts = table(spark, folder, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year"))
    placed = ranks(cut_lineage(counts.agg(F.count(F.lit(1)).alias("n"))), ["year"], "-n", low="place")
    one, two = (placed.where(F.col("year") == y).select("o_custkey", F.col("place").alias(f"place_{y}"))
                for y in (1996, 1997))
    return one.join(two, "o_custkey").withColumn("change", F.col("place_1996") - F.col("place_1997"))


@query("""SELECT c_custkey, CAST(rank() OVER (ORDER BY c_acctbal DESC) AS INTEGER) AS overall,
  CAST(rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS INTEGER) AS by_segment,
  CAST(rank() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_acctbal DESC) AS INTEGER) AS by_division FROM customer""")
def nested_places(spark, folder):
    """Places overall, within a group and within a division."""
    out = ranks(table(spark, folder, "customer"), [], "-c_acctbal", low="overall")
    out = ranks(out, ["c_mktsegment"], "-c_acctbal", low="by_segment")
    out = ranks(out, ["c_mktsegment", "c_nationkey"], "-c_acctbal", low="by_division")
    return out.select("c_custkey", "overall", "by_segment", "by_division")


@query("""SELECT o_orderkey, CAST((no - 1) // 30 + 1 AS INTEGER) AS round_picked, CAST((no - 1) % 30 + 1 AS INTEGER) AS pick
  FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS no
    FROM orders)""")
def draft_rounds(spark, folder):
    """Round and pick within it: the running number per season in rounds of 30."""
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    numbered = scan(orders, ["year"], ["-o_totalprice", "o_orderkey"], number="no")
    place = F.col("no") - 1
    return numbered.select("o_orderkey", (F.floor(place / 30) + 1).cast("int").alias("round_picked"),
                           (place % 30 + 1).cast("int").alias("pick"))


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50""")
def top_fifty(spark, folder):
    best = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return best.orderBy(*order_columns(["-o_totalprice", "o_orderkey"])).limit(50)


@query("""SELECT o_orderkey, nullif(o_custkey % 5, 3) AS k FROM orders""")
def missing_sorted_last(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", F.nullif(F.col("o_custkey") % 5, F.lit(3)).alias("k"))
    return rows.orderBy(*order_columns(["k", "-o_orderkey"]))


@query("""SELECT l_returnflag, min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest,
  round(max(l_extendedprice) - min(l_extendedprice), 4) AS spread,
  arg_max(l_orderkey, (l_extendedprice, l_orderkey)) AS highest_order FROM lineitem GROUP BY l_returnflag""")
def extremes(spark, folder):
    price = F.col("l_extendedprice")
    return table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.min(price).alias("lowest"), F.max(price).alias("highest"),
        F.round(F.max(price) - F.min(price), 4).alias("spread"),
        F.max_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey")).alias("highest_order"))


@query("""SELECT user_id, event_id, round(sum(value) OVER w, 2) AS total, count(*) OVER w AS n FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING)""")
def running_from_the_end(spark, folder):
    events = table(spark, folder, "events").withColumn("one", F.lit(1))
    run = scan(events, ["user_id"], ["-ts", "-event_id"], running={"total": "value", "n": "one"})
    return longs(rounded(run.select("user_id", "event_id", "total", "n"), "total", places=2), "n")
