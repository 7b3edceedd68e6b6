"""Queries over composite flows: stints, standings, medals, umpires, judges, races."""
from __future__ import annotations

import json

import numpy as np
from pyspark.sql import functions as F

from touchline.functions.text import piece
from touchline.plans import contingency, games as season, judging, results, stints, teams
from touchline.queries.common import GAMES_SQL, SIDES_SQL, games, longs, query, rounded
from touchline.session import cut_lineage
from touchline.sources.tables import table

STANDINGS_SQL = f"""WITH {GAMES_SQL}, {SIDES_SQL},
  t AS (SELECT season, team, count(*) AS games, count(*) FILTER (own > other) AS wins, count(*) FILTER (own < other) AS losses,
    count(*) FILTER (own = other) AS ties, CAST(sum(own) AS BIGINT) AS points_for, CAST(sum(other) AS BIGINT) AS points_against,
    CAST(sum(own - other) AS BIGINT) AS differential FROM sides GROUP BY ALL)
  SELECT *, CAST(rank() OVER (PARTITION BY season ORDER BY wins DESC, differential DESC) AS INTEGER) AS place FROM t"""


@query(STANDINGS_SQL)
def season_standings(spark, folder):
    return season.standings(games(spark, folder), "season", "home", "away", "home_score", "away_score")


@query(f"""WITH {GAMES_SQL} SELECT season, home, away, CAST(score_diff AS INTEGER) AS score_diff, winner, outcome, count(*) AS n FROM (
    SELECT *, home_score - away_score AS score_diff,
      CASE WHEN home_score > away_score THEN home WHEN home_score < away_score THEN away ELSE 'tie' END AS winner,
      CASE WHEN home_score > away_score THEN 1.0::DOUBLE WHEN home_score = away_score THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS outcome
    FROM games) GROUP BY ALL""")
def game_outcomes(spark, folder):
    played = season.game_outcomes(games(spark, folder), "home", "away", "home_score", "away_score")
    return played.groupBy("season", "home", "away", "score_diff", "winner", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {GAMES_SQL} SELECT season, count(*) AS games, round(avg(home_score - away_score), 6) AS home_margin,
  round(avg(CASE WHEN home_score > away_score THEN 1.0 WHEN home_score = away_score THEN 0.5 ELSE 0 END), 6) AS home_outcome
  FROM games GROUP BY season""")
def home_advantage(spark, folder):
    played = season.game_outcomes(games(spark, folder), "home", "away", "home_score", "away_score")
    return rounded(season.home_advantage(played, "season"), "home_margin", "home_outcome", places=6)


@query(f"""WITH {GAMES_SQL}, s AS (SELECT season, avg(home_score - away_score) AS m FROM games GROUP BY season)
  SELECT count(*) AS seasons, round(regr_slope(m, season), 6) AS slope, round(regr_intercept(m, season), 4) AS intercept,
    round(regr_r2(m, season), 6) AS r2 FROM s""")
def home_advantage_trend(spark, folder):
    played = season.game_outcomes(games(spark, folder), "home", "away", "home_score", "away_score")
    trend = season.advantage_trend(season.home_advantage(played, "season"), "season")
    return rounded(rounded(trend, "slope", "r2", places=6), "intercept")


def play_log(spark, folder):
    """Events of a user as the play-by-play of one game.

    Errors are substitutions; clicks and purchases are home plays, views and signups
    away plays, with texts that depend on the event's number k.
    """
    events = table(spark, folder, "events")
    k, kind = F.get_json_object("props", "$.k").cast("int"), F.col("event_type")
    home = (
        F.when((kind == "click") & (k % 5 == 0), "Smith Free Throw 1 of 2 (1 PTS)")
        .when((kind == "click") & (k % 5 == 1), "Smith Free Throw 2 of 2 (2 PTS)")
        .when((kind == "click") & (k % 5 == 2), "MISS Smith Jump Shot").when(kind == "click", "Smith REBOUND")
        .when((kind == "purchase") & (k % 3 == 0), "Jones Layup (2 PTS)")
        .when((kind == "purchase") & (k % 3 == 1), "Jones Turnover")
        .when(kind == "purchase", "Smith Free Throw 1 of 1 (1 PTS)")
    )
    away = (
        F.when((kind == "view") & (k % 4 == 0), "Lee Rebound").when((kind == "view") & (k % 4 == 1), "MISS Lee Hook")
        .when((kind == "view") & (k % 4 == 2), "Lee Free Throw 3 of 3 (4 PTS)").when(kind == "view", "Lee bad pass turnover")
        .when((kind == "signup") & (k % 10 < 5), "Lee Free Throw 2 of 3 (2 PTS)")
    )
    return events.select(
        F.col("user_id").alias("game_id"), F.col("event_id").alias("event_no"), (kind == "error").alias("is_sub"),
        home.alias("home_text"), away.alias("away_text"),
        F.when((kind == "signup") & (k % 10 >= 5), "End of period").alias("neutral_text"),
        F.when(kind.isin("click", "purchase"), F.floor(F.col("event_id") / 10).cast("int")).alias("home_score"),
        F.when(kind.isin("view"), F.floor(F.col("event_id") / 11).cast("int")).alias("away_score"),
        F.col("value").alias("minute"),
        F.concat_ws("_", (k % 7).cast("string"), (7 + k % 5).cast("string")).alias("home_lineup"),
        F.concat_ws("_", (3 + k % 7).cast("string"), (12 + k % 3).cast("string")).alias("away_lineup"),
    )


LOG_SQL = """
log AS (SELECT user_id AS game_id, event_id AS event_no, event_type = 'error' AS is_sub,
  CASE WHEN t = 'click' AND k % 5 = 0 THEN 'Smith Free Throw 1 of 2 (1 PTS)'
    WHEN t = 'click' AND k % 5 = 1 THEN 'Smith Free Throw 2 of 2 (2 PTS)'
    WHEN t = 'click' AND k % 5 = 2 THEN 'MISS Smith Jump Shot' WHEN t = 'click' THEN 'Smith REBOUND'
    WHEN t = 'purchase' AND k % 3 = 0 THEN 'Jones Layup (2 PTS)' WHEN t = 'purchase' AND k % 3 = 1 THEN 'Jones Turnover'
    WHEN t = 'purchase' THEN 'Smith Free Throw 1 of 1 (1 PTS)' END AS home_text,
  CASE WHEN t = 'view' AND k % 4 = 0 THEN 'Lee Rebound' WHEN t = 'view' AND k % 4 = 1 THEN 'MISS Lee Hook'
    WHEN t = 'view' AND k % 4 = 2 THEN 'Lee Free Throw 3 of 3 (4 PTS)' WHEN t = 'view' THEN 'Lee bad pass turnover'
    WHEN t = 'signup' AND k % 10 < 5 THEN 'Lee Free Throw 2 of 3 (2 PTS)' END AS away_text,
  CASE WHEN t = 'signup' AND k % 10 >= 5 THEN 'End of period' END AS neutral_text,
  CASE WHEN t IN ('click', 'purchase') THEN event_id // 10 END AS home_score,
  CASE WHEN t = 'view' THEN event_id // 11 END AS away_score, value AS minute,
  (k % 7) || '_' || (7 + k % 5) AS home_lineup, (3 + k % 7) || '_' || (12 + k % 3) AS away_lineup
  FROM (SELECT *, event_type AS t, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
p1 AS (SELECT *, row_number() OVER g AS no, lag(is_sub) OVER g AS sub_before, lead(is_sub) OVER g AS sub_after
  FROM log WINDOW g AS (PARTITION BY game_id ORDER BY event_no)),
p2 AS (SELECT *, coalesce((regexp_matches(home_text, 'Free Throw (1 of 1|2 of 2|3 of 3)')
    OR regexp_matches(away_text, 'Free Throw (1 of 1|2 of 2|3 of 3)')) AND sub_before, FALSE) AS throw,
  CASE WHEN no = 1 THEN 0 ELSE home_score END AS h0, CASE WHEN no = 1 THEN 0 ELSE away_score END AS a0 FROM p1),
p3 AS (SELECT *, lag(throw) OVER g AS throw_before, lead(throw) OVER g AS throw_after,
  last_value(h0 IGNORE NULLS) OVER r AS home_now, last_value(a0 IGNORE NULLS) OVER r AS away_now FROM p2
  WINDOW g AS (PARTITION BY game_id ORDER BY event_no),
    r AS (PARTITION BY game_id ORDER BY event_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
p4 AS (SELECT *, CASE WHEN throw_before IS NULL THEN FALSE WHEN throw_before THEN TRUE
  WHEN is_sub AND throw_after THEN FALSE ELSE coalesce(is_sub AND NOT sub_after, FALSE) END AS opens FROM p3),
p5 AS (SELECT *, CAST(sum(CAST(opens AS INTEGER)) OVER r + 1 AS INTEGER) AS stint_id,
  lag(home_text) OVER g AS home_before, lag(away_text) OVER g AS away_before
  FROM p4 WHERE NOT (is_sub AND NOT opens)
  WINDOW g AS (PARTITION BY game_id ORDER BY event_no),
    r AS (PARTITION BY game_id ORDER BY event_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rows_ AS (SELECT *, CASE
  WHEN contains(home_text, ' PTS') AND NOT contains(home_text, 'Free Throw 1 of 2') AND NOT contains(home_text, 'Free Throw 2 of 3') THEN 1
  WHEN contains(away_text, ' PTS') AND NOT contains(away_text, 'Free Throw 1 of 2') AND NOT contains(away_text, 'Free Throw 2 of 3') THEN 1
  WHEN contains(lower(away_text), 'rebound') AND contains(lower(home_before), 'miss ') THEN 1
  WHEN contains(lower(home_text), 'rebound') AND contains(lower(away_before), 'miss ') THEN 1
  WHEN contains(lower(home_text), ' turnover') OR contains(lower(away_text), ' turnover') THEN 1
  WHEN contains(neutral_text, 'End') THEN 1 ELSE 0 END AS ends FROM p5),
stints AS (SELECT game_id, stint_id, arg_min(home_lineup, event_no) AS home_lineup, arg_min(away_lineup, event_no) AS away_lineup,
  sum(ends) AS n_pos, CAST(arg_max(home_now, event_no) - arg_min(home_now, event_no) AS INTEGER) AS home_points,
  CAST(arg_max(away_now, event_no) - arg_min(away_now, event_no) AS INTEGER) AS away_points,
  arg_max(minute, event_no) - arg_min(minute, event_no) AS minutes
  FROM rows_ GROUP BY game_id, stint_id HAVING sum(ends) <> 0)"""


@query(f"""WITH {LOG_SQL} SELECT game_id, event_no, stint_id, CAST(home_now AS INTEGER) AS home_score,
  CAST(away_now AS INTEGER) AS away_score, CAST(ends AS INTEGER) AS ends FROM rows_""")
def stint_rows(spark, folder):
    """Every kept play with its stint, carried scores and possession mark."""
    rows = stints.with_stints(play_log(spark, folder)).withColumn("ends", stints.possession_ends())
    return rows.select("game_id", "event_no", "stint_id", F.col("home_score").cast("int").alias("home_score"),
                       F.col("away_score").cast("int").alias("away_score"), "ends")


def _stints(spark, folder):
    return stints.stint_summary(stints.with_stints(play_log(spark, folder)), keep=("home_lineup", "away_lineup"))


@query(f"""WITH {LOG_SQL} SELECT game_id, stint_id, home_lineup, away_lineup, CAST(n_pos AS BIGINT) AS n_pos, home_points,
  away_points, round(minutes, 4) AS minutes, round(100.0 * (home_points - away_points) / n_pos, 4) AS margin FROM stints""")
def stint_summary(spark, folder):
    made = rounded(_stints(spark, folder), "minutes", "margin")
    return made.withColumns({c: F.col(c).cast("int") for c in ("home_points", "away_points")})


MATRIX_SQL = f"""{LOG_SQL}, long AS (
    SELECT game_id, stint_id, unnest(string_split(home_lineup, '_')) AS player, 1 AS v FROM stints
    UNION ALL SELECT game_id, stint_id, unnest(string_split(away_lineup, '_')), -1 FROM stints),
  matrix AS (SELECT game_id, stint_id, player, CAST(sum(v) AS BIGINT) AS value FROM long GROUP BY ALL HAVING sum(v) <> 0)"""


@query(f"WITH {MATRIX_SQL} SELECT * FROM matrix")
def lineup_matrix(spark, folder):
    """Signed design matrix in long form."""
    return stints.signed_lineups(_stints(spark, folder), ["game_id", "stint_id"], "home_lineup", "away_lineup")


@query(f"""WITH {MATRIX_SQL} SELECT s.game_id, s.stint_id, CAST(n_pos AS BIGINT) AS n_pos, player, value
  FROM stints s LEFT JOIN matrix USING (game_id, stint_id)""")
def lineup_matrix_with_context(spark, folder):
    made = cut_lineage(_stints(spark, folder))  # it feeds both sides
    matrix = stints.signed_lineups(made, ["game_id", "stint_id"], "home_lineup", "away_lineup")
    joined = stints.design_with_context(made, matrix, ["game_id", "stint_id"])
    return joined.select("game_id", "stint_id", "n_pos", "player", "value")


@query("""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
  CASE WHEN event_id % 7 = 0 THEN 'JSONDecodeError' END AS error FROM events""")
def tolerant_apply(spark, folder):
    """A row function over cut-off JSON: failures become error rows."""
    broken = F.when(F.col("event_id") % 7 == 0, F.lit('{"k": ')).otherwise(F.col("props"))
    events = table(spark, folder, "events").select("event_id", broken.alias("props"))
    parsed = stints.tolerant(events, "event_id", lambda row: {"k": str(json.loads(row["props"])["k"])}, "k string")
    return parsed.withColumn("k", F.col("k").cast("long"))


@query("""SELECT l_orderkey, CASE WHEN count(*) % 2 = 0 THEN count(*) END AS lines,
  CASE WHEN count(*) % 2 = 0 THEN CAST(max(l_quantity) - min(l_quantity) AS BIGINT) END AS width,
  CASE WHEN count(*) % 2 = 1 THEN 'ValueError' END AS error FROM lineitem GROUP BY l_orderkey""")
def tolerant_groups(spark, folder):
    """A function of each order's lines (few by nature) that fails for an odd number of them."""

    def width(rows):
        quantity = rows["l_quantity"]
        if len(quantity) % 2:
            raise ValueError("the lines do not pair up")
        return {"lines": [len(quantity)], "width": [int(np.fmax.reduce(quantity) - np.fmin.reduce(quantity))]}  # missing ones are passed over

    line = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    return stints.tolerant_groups(line, ["l_orderkey"], width, "lines long, width long", arrays=True)


def _team_plays(spark, folder):
    """Line items as plays: season, supplier (offence), nation of the buyer (defence)."""
    line = table(spark, folder, "lineitem")
    flag = F.col("l_returnflag")
    plays = line.select(
        F.year("l_shipdate").alias("season"), (F.col("l_suppkey") % 32).cast("string").alias("offense"),
        (F.col("l_partkey") % 32).cast("string").alias("defense"),
        F.when(flag == "A", "pass").when(flag == "R", "run").otherwise("kick").alias("play_type"),
        F.col("l_quantity").alias("yards_gained"), F.when(flag == "A", F.col("l_linenumber")).alias("air_yards"),
        F.when((flag == "A") & (F.col("l_linenumber") > 2), F.col("l_quantity")).alias("yards_after_catch"),
        (F.col("l_discount") - F.col("l_tax")).alias("epa"), (F.col("l_tax") * 2).alias("wpa"),
        F.when(flag == "A", (F.col("l_linestatus") == "O").cast("int")).alias("complete_pass"),
        F.when(flag == "A", (F.col("l_linenumber") == 7).cast("int")).alias("interception"),
        (F.col("l_linenumber") == 1).cast("int").alias("fumble_lost"),
    )
    return plays


def _team_measure_sql(kind):
    f = f"FILTER (play_type = '{kind}')"

    def zero(e):
        return f"CASE WHEN count(*) {f} > 0 THEN coalesce(sum({e}) {f}, 0) END"

    return {
        "completion_percentage": f"round(avg(complete) {f}, 6)",
        "total_yards_gained": f"CAST({zero('yards')} AS DOUBLE)", "ave_yards_gained": f"round(avg(yards) {f}, 6)",
        "total_air_yards": f"CAST({zero('air')} AS BIGINT)", "ave_air_yards": f"round(avg(air) {f}, 6)",
        "total_yac": f"CAST({zero('yac')} AS DOUBLE)", "ave_yac": f"round(avg(yac) {f}, 6)",
        "n_plays": f"CASE WHEN count(*) {f} > 0 THEN count(*) {f} END",
        "n_interceptions": f"CAST({zero('inter')} AS BIGINT)", "n_fumbles_lost": f"CAST({zero('fumble')} AS BIGINT)",
        "total_epa": f"round({zero('epa')}, 6)", "ave_epa": f"round(avg(epa) {f}, 6)",
        "total_wpa": f"round({zero('wpa')}, 6)", "ave_wpa": f"round(avg(wpa) {f}, 6)",
        "success_rate": f"round(avg(CASE WHEN epa > 0 THEN 1.0 ELSE 0.0 END) {f}, 6)",
    }


def _team_side_sql(side):
    out = []
    for name in teams.MEASURES:
        if name in teams.PASS_ONLY:
            out.append(f"{_team_measure_sql('pass')[name]} AS {side}_{name}")
        else:
            out += [f"{_team_measure_sql(k)[name]} AS {side}_{name}_{k}" for k in ("pass", "run")]
    return f"{side}_ AS (SELECT season, {side} AS team, {', '.join(out)} FROM plays WHERE play_type <> 'kick' GROUP BY ALL)"


@query(f"""WITH plays AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS season, CAST(l_suppkey % 32 AS VARCHAR) AS offense,
    CAST(l_partkey % 32 AS VARCHAR) AS defense,
    CASE l_returnflag WHEN 'A' THEN 'pass' WHEN 'R' THEN 'run' ELSE 'kick' END AS play_type, l_quantity AS yards,
    CASE WHEN l_returnflag = 'A' THEN l_linenumber END AS air,
    CASE WHEN l_returnflag = 'A' AND l_linenumber > 2 THEN l_quantity END AS yac, l_discount - l_tax AS epa, l_tax * 2 AS wpa,
    CASE WHEN l_returnflag = 'A' THEN CAST(l_linestatus = 'O' AS INTEGER) END AS complete,
    CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber = 7 AS INTEGER) END AS inter,
    CAST(l_linenumber = 1 AS INTEGER) AS fumble FROM lineitem),
  {_team_side_sql('offense')}, {_team_side_sql('defense')}
  SELECT * FROM offense_ JOIN defense_ USING (season, team)""")
def team_season_summary(spark, folder):
    """54 measures by side and play type."""
    made = teams.team_seasons(_team_plays(spark, folder), "season", "offense", "defense", "play_type")
    floats = [c for c in made.columns if any(x in c for x in ("ave_", "epa", "wpa", "percentage", "rate"))]
    return rounded(made, *floats, places=6)


@query("""WITH p AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS season, CAST(l_suppkey % 32 AS VARCHAR) AS home,
    CAST(l_partkey % 32 AS VARCHAR) AS away, l_returnflag, CAST(l_quantity AS INTEGER) AS h, CAST(l_linenumber * 7 AS INTEGER) AS a
    FROM lineitem WHERE l_suppkey % 32 <> l_partkey % 32),
  s AS (SELECT season, home AS team, h AS own, a AS other FROM p UNION ALL SELECT season, away, a, h FROM p),
  r AS (SELECT season, team, count(*) FILTER (own > other) AS wins, CAST(sum(own - other) AS BIGINT) AS d FROM s GROUP BY ALL),
  o AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS season, CAST(l_suppkey % 32 AS VARCHAR) AS team, count(*) AS n FROM lineitem
    WHERE l_returnflag = 'A' GROUP BY ALL)
  SELECT season, team, n AS offense_n_plays_pass, wins, d AS score_differential FROM o JOIN r USING (season, team)""")
def team_season_results(spark, folder):
    """Team-season summary joined to the season's results."""
    plays = _team_plays(spark, folder)
    summary = teams.team_seasons(plays, "season", "offense", "defense", "play_type")
    line = table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias("season"), (F.col("l_suppkey") % 32).cast("string").alias("home"),
        (F.col("l_partkey") % 32).cast("string").alias("away"), F.col("l_quantity").cast("int").alias("h"),
        (F.col("l_linenumber") * 7).alias("a")).where("home <> away")
    table_ = season.standings(line, "season", "home", "away", "h", "a")
    joined = teams.with_results(summary, table_, "season").where(F.col("offense_n_plays_pass").isNotNull())
    return joined.select("season", "team", "offense_n_plays_pass", "wins", "score_differential")


@query("""WITH m AS (SELECT DISTINCT year(o_orderdate) AS y, o_orderpriority, o_orderstatus, c_nationkey FROM orders
    JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 200000)
  SELECT c_nationkey AS nation, count(*) AS total_medals,
    CAST(sum(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END) AS BIGINT) AS total_points,
    count(*) FILTER (o_orderstatus = 'F') AS total_gold, count(*) FILTER (o_orderstatus = 'O') AS total_silver,
    count(*) FILTER (o_orderstatus = 'P') AS total_bronze FROM m GROUP BY c_nationkey""")
def medal_table(spark, folder):
    """Nations' medals; a year's event counts each colour once, whatever the crew."""
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    status = F.col("o_orderstatus")
    medal = F.when(status == "F", "Gold").when(status == "O", "Silver").otherwise("Bronze")
    athletes = table(spark, folder, "orders").join(customer, "o_custkey").select(
        F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("event"),
        F.when(F.col("o_totalprice") > 200000, medal).alias("medal"), "nation")
    return longs(results.medal_table(athletes, ["year", "event"], "medal", "nation"), "total_points")


BOOSTS = {"K Boost": "k", "BB Boost": "bb", "R Boost": "r", "BA Boost": "ba", "OBP Boost": "obp", "SLG Boost": "slg"}


def _boost_sql(i, stat):
    side = {"k": ("Defensive", "Offensive")}.get(stat, ("Offensive", "Defensive"))
    return f"""SELECT umpire, games, kp AS "k_pct", '{stat.upper()}' AS boost_stat, round((b{i} - 1) * 100, 6) AS boost_pct,
      CASE WHEN b{i} = 1 THEN 'Neither' WHEN b{i} > 1 THEN '{side[0]}' ELSE '{side[1]}' END AS rating FROM u"""


@query("""WITH u AS (SELECT s_name AS umpire, CAST(s_suppkey % 5 AS DOUBLE) AS games, CAST(s_nationkey || '.5' AS DOUBLE) AS kp, """
       + ", ".join(f"(75 + (s_suppkey * {i + 3}) % 51) / 100.0 AS b{i}" for i in range(6))
       + " FROM supplier WHERE s_suppkey % 5 > 1) "
       + " UNION ALL ".join(_boost_sql(i, s) for i, s in enumerate(BOOSTS.values())))
def umpire_boosts(spark, folder):
    """Raw umpire table with trailing ``%`` and ``x`` to the long boost table."""
    key = F.col("s_suppkey")
    raw = table(spark, folder, "supplier").select(
        F.col("s_name").alias("Umpire"), (key % 5).cast("string").alias("Games"),
        F.concat(F.col("s_nationkey").cast("string"), F.lit(".5%")).alias("k_pct"),
        *[F.concat(F.format_string("%.2f", (75 + (key * (i + 3)) % 51) / 100.0), F.lit("x")).alias(c)
          for i, c in enumerate(BOOSTS)])
    made = results.umpire_boosts(raw, "Umpire", "Games", ["k_pct"], BOOSTS)
    return rounded(made.withColumnRenamed("Umpire", "umpire"), "boost_pct", places=6)


LIFTER_BASE = """m AS (SELECT o_custkey AS name, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS tested,
  o_orderpriority AS equipment, nullif(o_orderkey % 9, 4) AS squat, CAST(o_custkey % 3 AS INTEGER) AS age_class FROM orders)"""


def _lifters(spark, folder, latest_first):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("name"), "o_orderkey", F.to_date("o_orderdate").alias("day"),
        F.col("o_orderstatus").alias("tested"), F.col("o_orderpriority").alias("equipment"),
        F.nullif(F.col("o_orderkey") % 9, F.lit(4)).alias("squat"), (F.col("o_custkey") % 3).cast("int").alias("age_class"))
    qualifies = (F.col("tested") != "P") & F.col("equipment").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    return results.lifter_table(orders, "name", ["day", "o_orderkey"], qualifies, ["squat"], ["age_class"], ["name"],
                                60, 501, latest_first)


def _lifter_sql(first, second):
    return f"""WITH {LIFTER_BASE},
      a AS (SELECT * FROM m WHERE {first} QUALIFY row_number() OVER (PARTITION BY name ORDER BY day DESC, o_orderkey DESC) = 1)
      SELECT * FROM a WHERE {second} AND squat IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY age_class ORDER BY md5('501|' || name), name) <= 60"""


QUALIFY_SQL = "(tested <> 'P' AND equipment IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))"


@query(_lifter_sql("TRUE", QUALIFY_SQL))
def latest_then_qualifying(spark, folder):
    return _lifters(spark, folder, True)


@query(_lifter_sql(QUALIFY_SQL, "TRUE"))
def qualifying_then_latest(spark, folder):
    return _lifters(spark, folder, False)


@query("""WITH n AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i,
    count(*) OVER (PARTITION BY user_id) // 4 AS len FROM events),
  b AS (SELECT user_id, i // len + 1 AS block, i % len AS bib, event_id % 100 AS rank,
    round((event_id % 60 * 60 + event_id % 50) / 60.0, 3) AS t, CASE WHEN event_id % 9 <> 0 THEN event_id % 30 / 10.0 END AS diff
    FROM n WHERE i // len < 4 AND i % len < len - 3)
  SELECT user_id, CAST(bib AS BIGINT) AS bib, """ + ", ".join(
    f"""CAST(max(rank) FILTER (block = {i}) AS INTEGER) AS rank{i}, max(t) FILTER (block = {i}) AS time{i},
    CAST(max(diff) FILTER (block = {i}) AS DOUBLE) AS diff{i}, max(CASE WHEN block = {i} THEN {d}::DOUBLE END) AS dist{i}"""
    for i, d in ((1, 2.0), (2, 5.2), (3, 7.5), (4, 11.0))) + " FROM b GROUP BY user_id, bib")
def split_times(spark, folder):
    """Four stacked checkpoint blocks per race to one row per racer."""
    from touchline.operators.ordered import scan

    events = table(spark, folder, "events").select("user_id", "event_id")
    numbered = scan(events, ["user_id"], ["event_id"], number="no", size="rows")
    numbered = numbered.withColumn("len", F.floor(F.col("rows") / 4))
    key = F.col("event_id")
    rows = numbered.select(
        "user_id", "event_id", ((F.col("no") - 1) % F.col("len")).alias("bib"), (key % 100).cast("string").alias("rank"),
        F.concat((key % 60).cast("string"), F.lit(":"), (key % 50).cast("string")).alias("result"),
        F.when(key % 9 != 0, F.format_string("%.1f", key % 30 / 10.0)).otherwise("-").alias("diff"))
    return results.split_times(rows, ["user_id"], ["event_id"], ["bib"], "rank", "result", "diff", [2, 5.2, 7.5, 11], 3)


@query("""WITH r AS (SELECT o_custkey AS race, o_orderkey AS place, 60 + o_custkey % 40 AS lead, (o_orderkey % 500) / 100.0 AS gap,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS no FROM orders)
  SELECT race, place, round(CASE WHEN no = 1 THEN lead ELSE lead + gap END, 4) AS seconds FROM r""")
def gaps_to_leader(spark, folder):
    """First row ``m:s``, later rows ``+gap``, to seconds."""
    from touchline.operators.ordered import scan

    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("race"), F.col("o_orderkey").alias("place"))
    numbered = scan(orders, ["race"], ["place"], number="no")
    lead = F.format_string("1:%02d", F.col("race") % 40)
    gap = F.concat(F.lit("+"), F.format_string("%.2f", (F.col("place") % 500) / 100.0))
    shown = numbered.select("race", "place", F.when(F.col("no") == 1, lead).otherwise(gap).alias("shown"))
    timed = results.gaps_to_times(shown, ["race"], ["place"], {"seconds": "shown"})
    return rounded(timed.select("race", "place", "seconds"), "seconds")


@query("""SELECT o_orderkey, record, round(m, 8) AS minutes, round(d / m, 8) AS speed, round(500 * m / d, 8) AS split_500,
    record <> 'NONE' AS has_record, pos <= 3 AS podium FROM (SELECT o_orderkey,
    CASE WHEN o_orderkey % 6 = 0 THEN 'WR' ELSE 'NONE' END AS record, CASE WHEN o_custkey % 2 = 0 THEN 60 ELSE 0 END
      + 20 + o_orderkey % 30 + (o_orderkey % 60) / 60.0 AS m, 10000 + 10000 * (o_custkey % 2) AS d, o_orderkey % 40 + 1 AS pos FROM orders)""")
def pace_table(spark, folder):
    """``39:56 WR`` and ``1:20:31`` to minutes, speed, split and flags."""
    key, even = F.col("o_orderkey"), F.col("o_custkey") % 2 == 0
    clock = F.concat(F.when(even, F.lit("1:")).otherwise(F.lit("")), F.format_string("%d:%02d", 20 + key % 30, key % 60),
                     F.when(key % 6 == 0, F.lit(" WR")).otherwise(F.lit("")))
    races = table(spark, folder, "orders").select(
        "o_orderkey", clock.alias("time"), (10000 + 10000 * (F.col("o_custkey") % 2)).alias("distance"), (key % 40 + 1).alias("pos"))
    made = results.pace_table(races, "time", "distance", "pos")
    return rounded(made.drop("time", "distance", "pos"), "minutes", "speed", "split_500", places=8)


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'None Listed' ELSE c_mktsegment END AS location,
  CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' END AS verified, CASE WHEN a BETWEEN 1 AND 12 THEN '0-12'
  WHEN a BETWEEN 13 AND 18 THEN '13-18' WHEN a BETWEEN 19 AND 29 THEN '19-29' WHEN a BETWEEN 30 AND 39 THEN '30-39'
  WHEN a BETWEEN 40 AND 49 THEN '40-49' WHEN a BETWEEN 50 AND 54 THEN '50-54' WHEN a BETWEEN 55 AND 59 THEN '55-59'
  WHEN a BETWEEN 60 AND 64 THEN '60-64' WHEN a BETWEEN 65 AND 69 THEN '65-69' END AS age_group
  FROM (SELECT *, c_custkey % 80 AS a FROM customer)""")
def rowing_labels(spark, folder):
    key = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(
        "c_custkey", (key % 80).alias("age"), F.when(key % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("location"),
        F.when(key % 3 == 0, "Race").when(key % 3 == 1, "No").alias("verified"))
    return results.rowing_labels(rows, "age", ["location"], "verified").drop("age")


RANKING_SQL = """l AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CASE l_returnflag WHEN 'A' THEN 'WS' WHEN 'N' THEN 'MD' ELSE 'XD' END AS code,
  (l_suppkey % 50) || CASE WHEN l_returnflag = 'A' THEN '' ELSE ' / ' || (l_suppkey % 7) END AS players, count(*) AS matches,
  count(*) FILTER (l_tax > 0.04) AS wins, CAST(sum(l_linenumber) AS BIGINT) AS pts_for,
  CAST(sum(l_quantity) AS BIGINT) AS pts_agst FROM lineitem GROUP BY ALL)"""


def _ranking_rows(spark, folder):
    flag, key = F.col("l_returnflag"), F.col("l_suppkey")
    code = F.when(flag == "A", "WS").when(flag == "N", "MD").otherwise("XD")
    players = F.concat((key % 50).cast("string"), F.when(flag == "A", F.lit("")).otherwise(
        F.concat(F.lit(" / "), (key % 7).cast("string"))))
    return table(spark, folder, "lineitem").groupBy(
        F.year("l_shipdate").alias("year"), code.alias("code"), players.alias("players")).agg(
        F.count(F.lit(1)).alias("matches"), F.count_if(F.col("l_tax") > 0.04).alias("wins"),
        F.sum("l_linenumber").alias("pts_for"), F.sum("l_quantity").cast("long").alias("pts_agst"))


@query(f"""WITH {RANKING_SQL} SELECT year, players, substr(code, 1, 1) AS sex,
  CASE substr(code, 2) WHEN 'S' THEN 'Singles' ELSE 'Doubles' END AS category, pts_for,
  CAST(floor(rank() OVER (PARTITION BY year, code ORDER BY pts_for DESC)
    + (count(*) OVER (PARTITION BY year, code, pts_for) - 1) / 2.0) AS INTEGER) AS place FROM l""")
def ranking_list(spark, folder):
    listed = results.ranking_list(cut_lineage(_ranking_rows(spark, folder)), "year", "code", "pts_for")
    return listed.select("year", "players", "sex", "category", "pts_for", "place")


@query(f"""WITH {RANKING_SQL}, c AS (SELECT split_part(players, ' / ', 1) AS player, substr(code, 2) AS category,
    CAST(sum(matches) AS BIGINT) AS matches, CAST(sum(wins) AS BIGINT) AS wins, CAST(sum(matches - wins) AS BIGINT) AS losses,
    CAST(sum(pts_for) AS BIGINT) AS pts_for, CAST(sum(pts_agst) AS BIGINT) AS pts_agst FROM l GROUP BY ALL)
  SELECT *, round(wins / matches, 6) AS win_pct, round(pts_for / (pts_for + pts_agst), 6) AS shot_pct FROM c""")
def careers(spark, folder):
    rows = _ranking_rows(spark, folder).withColumn("losses", F.col("matches") - F.col("wins"))
    rows = rows.withColumn("category", F.substr("code", F.lit(2)))
    made = results.careers(rows, "players", "category", "matches", "wins", "losses", "pts_for", "pts_agst")
    return rounded(made, "win_pct", "shot_pct", places=6)


@query("""SELECT event_id, event_type AS shot_outcome, CASE WHEN user_id % 2 = event_id % 2 THEN 'home ' || user_id
  ELSE 'away ' || user_id END AS shooting_team, value FROM events WHERE event_type IN ('click', 'view', 'purchase')""")
def shot_table(spark, folder):
    events = table(spark, folder, "events").withColumn("team_id", F.col("user_id") % 2)
    events = events.withColumn("home_team_id", F.col("event_id") % 2).withColumn("away_team_id", 1 - F.col("home_team_id"))
    user = F.col("user_id").cast("string")
    events = events.withColumn("home_name", F.concat(F.lit("home "), user)).withColumn(
        "away_name", F.concat(F.lit("away "), user))
    return teams.shot_table(events, ["click", "view", "purchase"], "event_type", "team_id", "home_team_id",
                            "away_team_id", "home_name", "away_name", ["event_id", "value"])


@query("""SELECT event_id, user_id % 4 || '-' || event_id % 3 AS count, event_type AS pitch_type FROM events
  WHERE event_type <> 'view' AND user_id % 3 <> 0""")
def pitch_table(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.when(F.col("user_id") % 3 == 0, "S").otherwise("R").alias("game_type"),
        F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("pitch_type"),
        (F.col("user_id") % 4).alias("balls"), (F.col("event_id") % 3).alias("strikes"))
    return teams.pitch_table(events, "game_type", "S", "pitch_type", "balls", "strikes")


DIVES = [f"(l_orderkey * {i} + l_partkey) % 21 / 2.0" for i in range(1, 8)]


@query(f"""WITH d AS (SELECT l_suppkey AS diver, list_sort([{', '.join(DIVES)}]) AS j, 1.5 + l_linenumber / 4.0 AS dd FROM lineitem)
  SELECT diver, count(*) AS dives, round(sum((j[3] + j[4] + j[5]) * dd), 4) AS total_points FROM d GROUP BY diver""")
def dive_totals(spark, folder):
    """Seven judges; two highest and two lowest dropped; times difficulty."""
    line = table(spark, folder, "lineitem")
    judges = [((F.col("l_orderkey") * i + F.col("l_partkey")) % 21 / 2.0).alias(f"judge{i}") for i in range(1, 8)]
    dives = line.select(F.col("l_suppkey").alias("diver"), (1.5 + F.col("l_linenumber") / 4.0).alias("difficulty"), *judges)
    scored = judging.dive_points(dives, [f"judge{i}" for i in range(1, 8)], "difficulty")
    return rounded(judging.dive_totals(scored, ["diver"]), "total_points")


def _fights(spark, folder):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    scores = []
    for i in range(1, 4):
        scores += [(27 + (key * i + cust) % 4).cast("int").alias(f"a{i}"), (27 + (key + cust * i) % 4).cast("int").alias(f"b{i}")]
    fights = table(spark, folder, "orders").select("o_orderkey", *scores)
    return judging.fight_decisions(fights, [(f"a{i}", f"b{i}") for i in range(1, 4)])


FIGHTS_SQL = """f AS (SELECT o_orderkey, """ + ", ".join(
    f"CAST(27 + (o_orderkey * {i} + o_custkey) % 4 AS INTEGER) AS a{i}, CAST(27 + (o_orderkey + o_custkey * {i}) % 4 AS INTEGER) AS b{i}"
    for i in range(1, 4)) + """ FROM orders), m AS (SELECT *, a1 - b1 AS m1, a2 - b2 AS m2, a3 - b3 AS m3 FROM f),
  o AS (SELECT *, """ + ", ".join(
    f"CASE WHEN m{i} > 0 THEN 'fighter1' WHEN m{i} < 0 THEN 'fighter2' ELSE 'draw' END AS o{i}" for i in range(1, 4)) + " FROM m)"


@query(f"""WITH {FIGHTS_SQL} SELECT o_orderkey, """ + ", ".join(
    f"""CAST(m{i} AS INTEGER) AS judge{i}_margin, round(100.0 * m{i} / b{i}, 4) AS judge{i}_perc, o{i} AS judge{i}_out,
    round(m{i} - ({' + '.join(f'm{j}' for j in range(1, 4) if j != i)}) / 2.0, 4) AS judge{i}_dev""" for i in range(1, 4))
    + """, CASE WHEN o1 = o2 AND o2 = o3 THEN 'Agree' WHEN o1 = o2 THEN 'judge3' WHEN o1 = o3 THEN 'judge2'
    WHEN o2 = o3 THEN 'judge1' ELSE 'Disagree' END AS agreement FROM o""")
def fight_decisions(spark, folder):
    made = _fights(spark, folder).drop(*[f"{s}{i}" for s in "ab" for i in range(1, 4)])
    return rounded(made, *[f"judge{i}_{c}" for i in range(1, 4) for c in ("perc", "dev")])


@query(f"""WITH {FIGHTS_SQL}, j AS (SELECT 1 AS judge, m1 AS m, m1 - (m2 + m3) / 2.0 AS d FROM o
    UNION ALL SELECT 2, m2, m2 - (m1 + m3) / 2.0 FROM o UNION ALL SELECT 3, m3, m3 - (m1 + m2) / 2.0 FROM o)
  SELECT judge, count(*) AS fights, round(avg(m), 6) AS mean_margin, round(stddev_samp(m), 6) AS sd_margin,
    round(avg(abs(d)), 6) AS mean_abs_dev FROM j GROUP BY judge""")
def judge_variability(spark, folder):
    rows = judging.judge_rows(_fights(spark, folder), "o_orderkey")
    return rounded(judging.judge_variability(rows), "mean_margin", "sd_margin", "mean_abs_dev", places=6)


@query(f"""WITH {FIGHTS_SQL}, c AS (SELECT o_orderkey, unnest([o1, o2, o3]) AS v FROM o),
  k AS (SELECT o_orderkey, v, count(*) AS n FROM c GROUP BY ALL),
  s AS (SELECT o_orderkey, sum(n * (n - 1)) / 6.0 AS p FROM k GROUP BY o_orderkey),
  e AS (SELECT sum(pj * pj) AS chance FROM (SELECT sum(n) / (SELECT sum(n) FROM k) AS pj FROM k GROUP BY v))
  SELECT count(*) AS subjects, round(avg(p), 6) AS observed, round(min(chance), 6) AS chance,
    round((avg(p) - min(chance)) / (1 - min(chance)), 6) AS kappa FROM s, e""")
def judge_agreement(spark, folder):
    rows = judging.judge_rows(_fights(spark, folder), "o_orderkey")
    return rounded(judging.fleiss_kappa(rows, "o_orderkey", "outcome"), "observed", "chance", "kappa", places=6)


@query("""WITH b AS (SELECT quality AS a, toxic AS b FROM labels), n AS (SELECT count(*) AS n FROM b),
  t AS (SELECT n, (SELECT count(*) FROM b WHERE a = b) / n AS observed,
    (SELECT sum(x.c * y.c) FROM (SELECT a AS v, count(*) AS c FROM b GROUP BY a) x
      JOIN (SELECT b AS v, count(*) AS c FROM b GROUP BY b) y USING (v)) / (n * n) AS chance FROM n)
  SELECT n, round(observed, 6) AS observed, round(chance, 6) AS chance,
    round((observed - chance) / (1 - chance), 6) AS kappa FROM t""")
def two_rater_agreement(spark, folder):
    made = judging.cohen_kappa(table(spark, folder, "labels"), "quality", "toxic")
    return rounded(made, "observed", "chance", "kappa", places=6)


@query("""WITH c AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL),
  a AS (SELECT p_type FROM c GROUP BY p_type ORDER BY sum(n) DESC, p_type LIMIT 3),
  b AS (SELECT p_brand FROM c GROUP BY p_brand ORDER BY sum(n) DESC, p_brand LIMIT 5)
  SELECT CASE WHEN p_type IN (FROM a) THEN p_type ELSE 'Other' END AS p_type,
    CASE WHEN p_brand IN (FROM b) THEN p_brand ELSE 'Other' END AS p_brand, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL""")
def popular_pairs(spark, folder):
    """Most popular levels per axis, the rest as Other."""
    cells = contingency.cell_counts(table(spark, folder, "part"), "p_type", "p_brand")
    return contingency.lump(contingency.lump(cells, "p_type", "n", 3), "p_brand", "n", 5)


@query("""WITH c AS (SELECT least(n, 3) AS n FROM (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1))
  SELECT CASE WHEN n = 3 THEN '3+' ELSE CAST(n AS VARCHAR) END AS goals, count(*) AS games FROM c GROUP BY ALL""")
def lumped_scores(spark, folder):
    line = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    goals = line.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return goals.groupBy(contingency.lump_counts("n", 3).alias("goals")).agg(F.count(F.lit(1)).alias("games"))


@query("""WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand)
  SELECT p_brand, n, round(n / sum(n) OVER (), 6) AS share,
    round(sum(n) OVER (ORDER BY n DESC, p_brand ROWS UNBOUNDED PRECEDING) / sum(n) OVER (), 6) AS running_share FROM c""")
def cumulative_shares(spark, folder):
    counts = table(spark, folder, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return rounded(contingency.cumulative_share(counts, "p_brand", "n"), "share", "running_share", places=6)


@query("""SELECT o_custkey, round(48 * sum(o_totalprice) / sum(o_orderkey % 60 + 1), 5) AS per_48,
  round(100.0 * count(*) / sum(o_orderkey % 60 + 1), 9) AS per_100 FROM orders GROUP BY o_custkey""")
def rates_per_unit(spark, folder):
    sums = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("points"), F.count(F.lit(1)).alias("shots"), F.sum(F.col("o_orderkey") % 60 + 1).alias("minutes"))
    made = season.rate(season.rate(sums, {"per_48": "points"}, "minutes", 48), {"per_100": "shots"}, "minutes", 100)
    return rounded(rounded(made.select("o_custkey", "per_48", "per_100"), "per_48", places=5), "per_100", places=9)


@query("""SELECT o_orderkey, o_custkey AS player, o_orderkey % 97 AS opponent_player, o_totalprice AS points,
    o_totalprice / 2 AS opponent_points, TRUE AS won FROM orders
  UNION ALL SELECT o_orderkey, o_orderkey % 97, o_custkey, o_totalprice / 2, o_totalprice, FALSE FROM orders""")
def athlete_matches(spark, folder):
    orders = table(spark, folder, "orders").withColumn("loser", F.col("o_orderkey") % 97)
    orders = orders.withColumn("loser_points", F.col("o_totalprice") / 2)
    return results.athlete_matches(orders, ["o_orderkey"], {"player": "o_custkey", "points": "o_totalprice"},
                                   {"player": "loser", "points": "loser_points"})


@query("""SELECT rank_diff_cat, higher_rank_won, same_hand, count(*) AS n, CAST(sum(d) AS BIGINT) AS rank_diff FROM (
  SELECT d, CASE WHEN d <= 30 THEN 'Low' WHEN d <= 75 THEN 'Medium' ELSE 'High' END AS rank_diff_cat,
    CASE WHEN w < l THEN 'Yes' ELSE 'No' END AS higher_rank_won, CASE WHEN wh IS NULL THEN NULL WHEN wh = lh THEN 'Yes' ELSE 'No' END AS same_hand
  FROM (SELECT o_custkey % 150 AS w, o_orderkey % 140 AS l, abs(o_custkey % 150 - o_orderkey % 140) AS d,
    nullif(o_orderstatus, 'P') AS wh, CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE 'O' END AS lh FROM orders)) GROUP BY ALL""")
def favourites(spark, folder):
    """Rank difference bands, did the better rank win, same hand."""
    matches = table(spark, folder, "orders").select(
        (F.col("o_custkey") % 150).alias("w"), (F.col("o_orderkey") % 140).alias("l"),
        F.nullif("o_orderstatus", F.lit("P")).alias("wh"), F.when(F.col("o_orderkey") % 3 == 0, "F").otherwise("O").alias("lh"))
    made = results.favourites(matches, "w", "l", "wh", "lh")
    return made.groupBy("rank_diff_cat", "higher_rank_won", "same_hand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rank_diff").alias("rank_diff"))


@query("""WITH r AS (SELECT o_custkey % 40 AS team, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderpriority AS name FROM orders)
  SELECT team, arg_max(name, (season, name)) AS current_name, count(DISTINCT name) AS names_used, max(season) AS last_season
  FROM r GROUP BY team""")
def latest_team_names(spark, folder):
    rows = table(spark, folder, "orders").select(
        (F.col("o_custkey") % 40).alias("team"), F.year("o_orderdate").alias("season"), F.col("o_orderpriority").alias("name"))
    return season.latest_names(rows, "team", "name", "season")


@query("""WITH r AS (SELECT o_custkey % 40 AS team, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderstatus || split_part(o_orderpriority, '-', 1) AS name FROM orders),
  l AS (SELECT team, arg_max(name, (season, name)) AS current_name FROM r GROUP BY team)
  SELECT season, current_name, count(*) AS n FROM r JOIN l USING (team) GROUP BY ALL""")
def crosswalked_names(spark, folder):
    rows = table(spark, folder, "orders").select(
        (F.col("o_custkey") % 40).alias("team"), F.year("o_orderdate").alias("season"),
        F.concat(F.col("o_orderstatus"), piece("o_orderpriority", "-", 0)).alias("name"))
    named = season.with_latest_names(rows, "team", "name", "season")
    return named.groupBy("season", "current_name").agg(F.count(F.lit(1)).alias("n"))
