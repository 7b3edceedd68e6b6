"""Queries over raw league tables. The raw texts are built from the tables' rows."""
from __future__ import annotations

from pyspark.sql import functions as F

from touchline.plans import leagues
from touchline.queries.common import query, rounded, spread
from touchline.sources.markup import table_columns, table_rows
from touchline.sources.tables import table


def _text(column):
    return (F.col(column) if isinstance(column, str) else column).cast("string")


SCHOOLS = ["Brown", "Columbia/Barnard", "Duke", "Pennsylvania", "Ohio State", "Yale"]


def _school(key):
    return F.element_at(F.array(*[F.lit(s) for s in SCHOOLS]), (key % 6 + 1).cast("int"))


@query(f"""WITH f AS (SELECT o_orderkey AS k, o_custkey AS c, {SCHOOLS!r}[CAST(o_orderkey % 6 + 1 AS INTEGER)] AS s,
    o_orderpriority[1:1] AS p FROM orders)
  SELECT CAST(k % 90 AS INTEGER) AS "Place", k % 4 = 0 AS "Tied", 'Fencer ' || k AS "Name",
    replace(replace(s, 'Pennsylvania', 'UPenn'), 'Columbia/Barnard', 'Barnard') AS "School", CAST(k % 20 AS INTEGER) AS "Victories",
    CAST(20 + k % 3 AS INTEGER) AS "Bouts", CAST(k % 100 / 100.0 AS DOUBLE) AS "Pct", CAST(c % 80 AS INTEGER) AS "TS", CAST(c % 70 AS INTEGER) AS "TR",
    CAST(c % 80 - c % 70 AS INTEGER) AS "Ind", CASE WHEN p IN ('1', '2') THEN 'Women' ELSE 'Men' END AS "Gender",
    CASE WHEN p IN ('1', '3') THEN 'Sabre' WHEN p = '2' THEN 'Foil' ELSE 'Epee' END AS "Weapon",
    CASE WHEN s IN ('Duke', 'Ohio State') THEN 'Non-Ivy' ELSE 'Ivy' END AS "Ivy" FROM f""")
def fencing_season(spark, folder):
    """Result pages of four events (a header row before each fencer) to one table."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    cells = [(key % 90), F.when(key % 4 == 0, "T").otherwise(""), F.concat(F.lit("Fencer "), _text(key)), _school(key),
             F.concat(_text(key % 20), F.lit("/"), _text(20 + key % 3)), F.format_string("%.2f", key % 100 / 100.0), cust % 80,
             cust % 70, cust % 80 - cust % 70]
    head = "".join(f"<th>{h}</th>" for h in ("Place", "", "Name", "School", "V/B", "Pct", "TS", "TR", "Ind"))
    row = F.concat(*[F.concat(F.lit("<td>"), _text(c), F.lit("</td>")) for c in cells])
    pages = spread(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")).select(
        F.concat(_text(key), F.lit("|"), F.substring("o_orderpriority", 1, 1)).alias("page_id"),
        F.concat(F.lit(f"<table><tr>{head}</tr><tr>"), row, F.lit("</tr></table>")).alias("html"))
    cells = table_columns(table_rows(pages, "page_id", "html"), 1, 9)
    event = F.substring_index("page_id", "|", -1)
    gender = F.when(event.isin("1", "2"), "Women").otherwise("Men")
    weapon = F.when(event.isin("1", "3"), "Sabre").when(event == "2", "Foil").otherwise("Epee")
    return leagues.fencing_season([leagues.fencing_table(cells, gender, weapon)])


@query("""SELECT c_name AS "Rider", CAST(c_custkey % 30 AS DOUBLE) AS "Outs", CAST(c_custkey % 20 AS DOUBLE) AS "Rides",
  CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey % 10 AS DOUBLE) END AS "Buckoffs", CAST(c_custkey % 100 + 0.5 AS DOUBLE) AS "prop_Ridden",
  abs(c_acctbal) AS "Earnings", CASE WHEN c_custkey % 3 > 0 THEN CAST(c_custkey AS DOUBLE) END AS "Points Back" FROM customer""")
def bull_riders(spark, folder):
    key = F.col("c_custkey")
    raw = table(spark, folder, "customer").select(
        F.col("c_name").alias("Name"),
        F.concat_ws(" / ", _text(key % 30), _text(key % 20), F.when(key % 5 > 0, _text(key % 10))).alias("Outs / Rides / Buckoffs"),
        F.concat(_text(key % 100), F.lit(".5 %")).alias("% Ridden"),
        F.concat(F.lit("$"), F.format_number(F.abs("c_acctbal"), 2)).alias("Earnings"),
        F.when(key % 3 > 0, F.concat(F.lit("-"), _text(key))).alias("Points Back"))
    return leagues.rider_table(raw)


@query("""SELECT s_name AS "Bull", CAST(s_suppkey % 30 AS DOUBLE) AS "Outs", CAST(s_suppkey % 20 AS DOUBLE) AS "Rides",
  CAST(s_suppkey % 10 AS DOUBLE) AS "Buckoffs" FROM supplier""")
def bulls(spark, folder):
    key = F.col("s_suppkey")
    packed = F.concat_ws(" / ", _text(key % 30), _text(key % 20), _text(key % 10)).alias("Outs / Ridden / Buckoffs")
    return leagues.bull_table(table(spark, folder, "supplier").select(F.col("s_name").alias("Name"), packed))


@query("""SELECT c_name AS fighter_name, CAST(60 + c_custkey % 24 AS INTEGER) AS "Height", CAST(115 + c_custkey % 150 AS DOUBLE) AS "Weight",
    CAST(60 + c_custkey % 20 AS DOUBLE) AS "Reach", c_mktsegment AS "Stance", CAST(1960 + c_custkey % 40 AS INTEGER) AS "Birthyear",
    c_custkey % 7 AS "SLpM", CAST(c_custkey % 10 AS DOUBLE) AS "Str_Acc", c_custkey % 5 AS "SApM", CAST(c_custkey % 90 AS DOUBLE) AS "Str_Def",
    c_custkey % 3 AS "TD_Avg", CAST(c_custkey % 80 AS DOUBLE) AS "TD_Acc", CAST(c_custkey % 70 AS DOUBLE) AS "TD_Def", c_custkey % 2 AS "Sub_Avg"
  FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 9 <> 0""")
def fighters(spark, folder):
    key = F.col("c_custkey")
    tall = 60 + key % 24
    percent = lambda c: F.concat(_text(c), F.lit("%"))
    raw = table(spark, folder, "customer").select(
        F.col("c_name").alias("fighter_name"),
        F.concat(_text(F.floor(tall / 12)), F.lit("' "), _text(tall % 12), F.lit('"')).alias("Height"),
        F.concat(_text(115 + key % 150), F.lit(" lbs.")).alias("Weight"),
        F.when(key % 9 == 0, "").otherwise(F.concat(_text(60 + key % 20), F.lit('"'))).alias("Reach"),
        F.col("c_mktsegment").alias("Stance"),
        F.date_format(F.make_date((1960 + key % 40).cast("int"), F.lit(7), F.lit(14)), "MMM d, yyyy").alias("DOB"),
        (key % 7).alias("SLpM"), percent(key % 10).alias("Str_Acc"), (key % 5).alias("SApM"), percent(key % 90).alias("Str_Def"),
        (key % 3).alias("TD_Avg"), percent(key % 80).alias("TD_Acc"), percent(key % 70).alias("TD_Def"), (key % 2).alias("Sub_Avg"))
    return leagues.fighter_table(raw)


@query("""SELECT o_orderkey, CAST(1900 + o_orderkey % 130 AS INTEGER) AS "Year", CAST(100 AS DOUBLE) AS dist_m, CAST(50 + o_custkey % 40 AS DOUBLE) AS "Results",
    CASE WHEN o_orderkey % 130 BETWEEN 24 AND 75 THEN 'early' WHEN o_orderkey % 130 BETWEEN 76 AND 120 THEN 'recent' END AS time_period
  FROM orders WHERE o_custkey % 4 = 1 AND o_orderkey % 8 <> 0""")
def swim_finals(spark, folder):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    raw = table(spark, folder, "orders").select(
        "o_orderkey", (1900 + key % 130).cast("int").alias("Year"), F.concat(_text((cust % 4) * 100), F.lit("m")).alias("Distance..in.meters."),
        F.lit(0).alias("Relay."), F.when(key % 8 == 0, "Disqualified").otherwise(_text(50 + cust % 40)).alias("Results"))
    return leagues.swim_table(raw)


@query("""SELECT CAST(c_custkey AS DOUBLE) AS "Rk", c_name AS "Name", CAST(c_custkey % 30 AS DOUBLE) AS "GP", CAST(c_custkey % 9 - 4 AS DOUBLE) AS "Plus_Minus",
  CAST(c_custkey % 8 / 8.0 AS DOUBLE) AS "G_Per_GP" FROM customer""")
def skaters(spark, folder):
    """Three sheets, each with its header as first row and a column with holes."""
    key = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(
        (key + 2).alias("row_no"), _text(key).alias("A"), F.col("c_name").alias("B"), _text(key % 30).alias("C"),
        _text(key % 9 - 4).alias("D"), _text(key % 8 / 8.0).alias("E"), F.when(key % 2 == 0, "x").alias("F"))
    header = table(spark, folder, "region").where("r_regionkey = 0").select(
        F.lit(1).cast("long").alias("row_no"), *[F.lit(n).alias(c) for c, n in zip("ABCDEF", ["Rk", "Name", "GP", "+/-", "G/GP", "Pos"])])
    sheets = [rows.where(F.col("row_no") % 3 == i).union(header) for i in range(3)]
    return leagues.skater_table(sheets)


GOLF = ", ".join(f"""CAST(p_partkey % {i + 7} AS DOUBLE) AS "{n}\"""" for i, n in enumerate(leagues.THROW_STATS[1:13]))


@query(f"""SELECT p_name || ' ' || p_partkey AS player, {GOLF}, CAST(p_partkey % 20 AS INTEGER) AS events, CAST(p_partkey % 60 AS INTEGER) AS rounds,
    CAST(p_partkey % 5 AS INTEGER) AS wins, CAST(p_partkey % 6 AS INTEGER) AS podiums, CAST(p_partkey % 11 AS INTEGER) AS top_10s,
    CAST(p_partkey % 13 AS INTEGER) AS top_20s, CAST(p_partkey % 40 + 0.5 AS DOUBLE) AS avg_place, CAST(p_partkey % 100 AS DOUBLE) AS "top_10%",
    CAST(p_partkey % 90 AS DOUBLE) AS "top_20%", CAST(p_partkey * 1000 AS DOUBLE) AS total_earnings, CAST(3000 + p_partkey AS DOUBLE) AS total_strokes
  FROM part""")
def disc_golf_season(spark, folder):
    """Two published tables with two header rows each, joined by player."""
    key = F.col("p_partkey")
    player = F.concat(F.col("p_name"), F.lit(" "), _text(key))
    first = [player, *[_text(key % (i + 7)) for i in range(12)], F.lit("-"), F.lit("-"), _text(key % 20), _text(key % 60)]
    second = [player, F.lit("9"), _text(key % 5), _text(key % 6), _text(key % 11), _text(key % 13), F.concat(_text(key % 40), F.lit(".5")),
              F.lit("-"), F.lit("-"), F.lit("-"), _text(key % 100), _text(key % 90), F.concat(F.lit("$"), F.format_number(key * 1000, 0)),
              F.lit("-"), F.lit("-"), F.format_number(3000 + key, 0)]
    part = table(spark, folder, "part")

    def sheet(columns, rows):
        body = rows.select((key + 3).alias("row_no"), *[c.alias(f"X{i}") for i, c in enumerate(columns, 1)])
        heads = table(spark, folder, "region").where("r_regionkey < 2").select(
            (F.col("r_regionkey") + 1).cast("long").alias("row_no"), *[F.lit("head").alias(f"X{i}") for i in range(1, len(columns) + 1)])
        return heads.union(body)

    return leagues.disc_golf_table(sheet(first, part), sheet(second, part))


def _skier_sql(no, gap1, gap2, total):
    return f"""SELECT o_orderkey AS page_id, 'Skier {no}' AS "Name", 'N' || o_custkey % 9 AS "Nat", CAST(o_orderkey % 30 + {no} AS INTEGER) AS "Run1_Order",
      round(a + {gap1}, 4) AS "Run1_Time", {no} AS "Run1_Rank", CAST(31 - {no} AS INTEGER) AS "Run2_Order", round(b + {gap2}, 4) AS "Run2_Time",
      {4 - no} AS "Run2_Rank", round(a + b + {total}, 4) AS "Total_Time", {no} AS "Final_Rank", {no - 2} AS "Rank_Diff"
      FROM (SELECT *, CAST(60 + o_orderkey % 50 + 0.25 AS DOUBLE) AS a, CAST(60 + o_custkey % 50 + 0.5 AS DOUBLE) AS b FROM orders)"""


@query(" UNION ALL ".join([_skier_sql(1, 0, 0, 0), _skier_sql(2, 0.4, 1.25, 1.65), _skier_sql(3, 2.1, 0.3, 2.4)]))
def alpine_results(spark, folder):
    """Race pages of three skiers: cells in runs of nine, leader times plus gaps."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    a, b = key % 50 + 0.25, cust % 50 + 0.5
    clock = lambda seconds: F.format_string("%d:%05.2f", F.floor(seconds / 60), seconds % 60)
    heads = ["Rank", "Pr", "Bib", "Name", "Nat", "Total", "N°", "Run 1", "Run 2"]
    cells = [F.lit(h) for h in heads]
    for no, gap1, gap2, total in ((1, None, None, None), (2, "+0.40", "+1.25", "+1.65"), (3, "+2.10", "+0.30", "+2.40")):
        times = [clock(60 + a), clock(60 + b), clock(120 + a + b)] if no == 1 else [F.lit(t) for t in (gap1, gap2, total)]
        cells += [F.lit(str(no)), F.lit(f"{no - 2:+d}" if no != 2 else "0"), _text(key % 30 + no), F.lit(f"Skier {no}"),
                  F.concat(F.lit("N"), _text(cust % 9)), times[2], F.lit(str(31 - no)),
                  F.concat(times[0], F.lit(f" ({no})")), F.concat(times[1], F.lit(f" ({4 - no})"))]
    html = F.concat(*[F.concat(F.lit('<div class="sortable">'), c, F.lit("</div>")) for c in cells])
    pages = spread(table(spark, folder, "orders").select("o_orderkey", "o_custkey")).select(key.alias("page_id"), html.alias("html"))
    return rounded(leagues.alpine_results(pages, "page_id", "html"), "Run1_Time", "Run2_Time", "Total_Time")


@query("""SELECT o_orderkey, CASE o_custkey % 3 WHEN 0 THEN 'US OPEN' WHEN 1 THEN 'WIMBLEDON' ELSE 'ROLAND GARROS' END AS tourney_name,
  o_orderkey % 33 AS winner_rank FROM orders WHERE o_orderstatus = 'F'""")
def grand_slam_matches(spark, folder):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    name = F.when(cust % 3 == 0, "Us Open").when(cust % 3 == 1, "Wimbledon").otherwise("Roland Garros")
    level = F.when(F.col("o_orderstatus") == "F", "G").otherwise("P")
    matches = table(spark, folder, "orders").select(
        "o_orderkey", name.alias("tourney_name"), level.alias("tourney_level"), (key % 33).alias("winner_rank"),
        *[F.lit(1).alias(c) for c in leagues.MATCH_COLUMNS_LEFT_OUT if c != "tourney_level"])
    return leagues.grand_slam_matches(matches)


@query("""SELECT season, team_id, team_name, team_display_name, count(*) AS games, count(*) FILTER (won) AS wins FROM (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_custkey % 24 AS team_id, 'Team ' || o_custkey % 24 AS team_display_name,
      CASE o_custkey % 24 WHEN 3 THEN 'Dallas Wings' WHEN 17 THEN 'Las Vegas Aces' ELSE 'Team ' || o_custkey % 24 END AS team_name,
      o_totalprice > 250000 AS won FROM orders) WHERE season BETWEEN 1996 AND 1998 AND team_id <= 20 GROUP BY ALL""")
def team_box_scores(spark, folder):
    key, team = F.col("o_orderkey"), F.col("o_custkey") % 24
    box = table(spark, folder, "orders").select(
        key.alias("game_id"), F.year("o_orderdate").alias("season"), F.lit(2).alias("season_type"), F.to_date("o_orderdate").alias("game_date"),
        team.alias("team_id"), F.concat(F.lit("Team "), _text(team)).alias("team_display_name"), (F.col("o_totalprice") > 250000).alias("team_winner"),
        (key % 24).alias("opponent_team_id"), F.lit("home").alias("team_home_away"))
    kept = leagues.team_box_scores(box, 1996, 1998)
    return kept.groupBy("season", "team_id", "team_name", "team_display_name").agg(
        F.count(F.lit(1)).alias("games"), F.count_if("team_winner").alias("wins"))


@query("""WITH s AS (SELECT l_suppkey AS team_id, CAST(year(l_shipdate) AS INTEGER) AS season, CAST(sum(l_quantity) AS BIGINT) AS goals,
    CAST(sum(l_linenumber) AS BIGINT) AS goals_conceded FROM lineitem GROUP BY ALL)
  SELECT team_id, s_name AS team_name, season, goals, goals_conceded, goals - goals_conceded AS goal_differential
  FROM s JOIN supplier ON team_id = s_suppkey WHERE season BETWEEN 1995 + s_suppkey % 3 AND 2000 AND season <> 1998
    AND NOT (s_name = 'Supplier#000000004' AND season = 1999)""")
def team_season_goals(spark, folder):
    stats = table(spark, folder, "lineitem").groupBy(F.col("l_suppkey").alias("team_id"), F.year("l_shipdate").alias("season")).agg(
        F.sum("l_quantity").cast("long").alias("goals"), F.sum("l_linenumber").alias("goals_conceded"))
    teams = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("team_id"), F.col("s_name").alias("team_name"), (1995 + F.col("s_suppkey") % 3).cast("int").alias("first_season"),
        F.lit(2000).alias("last_season"))
    return leagues.team_season_goals(stats, teams, [1998], [("Supplier#000000004", 1999)])
