from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from touchline.plans import contingency, games, judging, results, stints
from touchline.queries.flows import play_log, tolerant_groups
from touchline.session import HOT_ROWS_KEY
from touchline.streaming.standings import run_to_table, streaming_totals

LOG = "event_no int, is_sub boolean, home_text string, away_text string, home_score int, away_score int, game_id int, neutral_text string, minute double"


def log_of(spark, plays):
    rows = []
    for i, p in enumerate(plays):
        rows.append((i, p.get("sub", False), p.get("h"), p.get("a"), p.get("hs"), p.get("as"), 1, p.get("n"), float(i)))
    return spark.createDataFrame(rows, LOG)


def stint_of(spark, plays):
    made = stints.with_stints(log_of(spark, plays))
    return {r["event_no"]: r["stint_id"] for r in made.collect()}


def test_a_run_of_substitutions_opens_one_stint(spark):
    plays = [{}, {"sub": True}, {"sub": True}, {}, {"sub": True}, {}]
    assert stint_of(spark, plays) == {0: 1, 2: 2, 3: 2, 4: 3, 5: 3}


def test_substitution_before_the_final_free_throw_opens_after_it(spark):
    plays = [{}, {"sub": True}, {"h": "X Free Throw 2 of 2 (3 PTS)"}, {}, {}]
    assert stint_of(spark, plays) == {0: 1, 2: 1, 3: 2, 4: 2}


def test_an_early_free_throw_does_not_delay_the_stint(spark):
    plays = [{}, {"sub": True}, {"h": "X Free Throw 1 of 2 (3 PTS)"}, {}]
    assert stint_of(spark, plays) == {0: 1, 1: 2, 2: 2, 3: 2}


def test_a_last_row_substitution_opens_nothing(spark):
    assert stint_of(spark, [{}, {}, {"sub": True}]) == {0: 1, 1: 1}
    assert stint_of(spark, [{"sub": True}, {}, {}]) == {1: 1, 2: 1}


def test_scores_start_at_zero_and_carry_on(spark):
    plays = [{"hs": 9}, {"hs": 2}, {}, {"as": 3}]
    made = {r["event_no"]: (r["home_score"], r["away_score"]) for r in stints.with_stints(log_of(spark, plays)).collect()}
    assert made == {0: (0, 0), 1: (2, 0), 2: (2, 0), 3: (2, 3)}


@pytest.mark.parametrize("before, play, ends", [
    ({}, {"h": "A Layup (2 PTS)"}, 1), ({}, {"h": "A Free Throw 1 of 2 (1 PTS)"}, 0), ({}, {"h": "A Free Throw 2 of 3 (1 PTS)"}, 0),
    ({}, {"a": "A Free Throw 1 of 3 (1 PTS)"}, 1), ({"h": "MISS A shot"}, {"a": "B Rebound"}, 1), ({"h": "MISS A shot"}, {"h": "A REBOUND"}, 0),
    ({"a": "MISS B shot"}, {"h": "A REBOUND"}, 1), ({}, {"a": "B bad pass Turnover"}, 1), ({}, {"n": "End of 1st"}, 1), ({}, {"n": "end"}, 0),
    ({}, {}, 0)])
def test_possession_rules(spark, before, play, ends):
    rows = stints.with_stints(log_of(spark, [before, play])).withColumn("e", stints.possession_ends())
    assert rows.where("event_no = 1").first()["e"] == ends


def test_stint_summary_drops_stints_without_possession(spark):
    plays = [{"hs": 0}, {"h": "A Layup (2 PTS)", "hs": 2}, {"a": "B turnover"}, {"sub": True}, {}]
    made = stints.stint_summary(stints.with_stints(log_of(spark, plays))).collect()
    assert [tuple(r) for r in made] == [(1, 1, 2, 2, 0, 2.0, 100.0)]


def test_split_games_give_the_same_stints(spark):
    log = play_log(spark, "/root/testdata/sf0.001").withColumn("game_id", (F.col("game_id") > 1).cast("int"))
    whole = sorted(map(str, stints.stint_summary(stints.with_stints(log)).collect()))
    spark.conf.set(HOT_ROWS_KEY, "30")
    cut = sorted(map(str, stints.stint_summary(stints.with_stints(log)).collect()))
    spark.conf.unset(HOT_ROWS_KEY)
    assert whole == cut and len(whole) > 50


def test_signed_lineups_cancel(spark):
    df = spark.createDataFrame([(1, "a_b", "b_c"), (2, "a", "a")], "s int, h string, w string")
    made = sorted(map(tuple, stints.signed_lineups(df, ["s"], "h", "w").collect()))
    assert made == [(1, "a", 1), (1, "c", -1)]


GAMES = [(1, "A", "B", 3, 1), (1, "B", "A", 2, 2), (1, "C", "A", 0, 1), (2, "A", "C", 5, 4), (1, "B", "C", None, None)]


def games_df(spark):
    return spark.createDataFrame(GAMES, "season int, home string, away string, hs int, vs int")


def test_standings(spark):
    made = {(r["season"], r["team"]): tuple(r)[2:] for r in
            games.standings(games_df(spark), "season", "home", "away", "hs", "vs").collect()}
    assert made[1, "A"] == (3, 2, 0, 1, 6, 3, 3, 1)
    assert made[1, "B"] == (2, 0, 1, 1, 3, 5, -2, 3)
    assert made[1, "C"] == (1, 0, 1, 0, 0, 1, -1, 2)
    assert made[2, "C"] == (1, 0, 1, 0, 4, 5, -1, 2)


def test_streamed_standings_equal_batch(spark, tmp_path):
    source = str(tmp_path / "games")
    games_df(spark).repartition(3).write.parquet(source)
    stream = spark.readStream.schema(games_df(spark).schema).option("maxFilesPerTrigger", 1).parquet(source)
    run_to_table(streaming_totals(stream, "season", "home", "away", "hs", "vs"), "stream_test", str(tmp_path / "c"))
    batch = games.standings(games_df(spark), "season", "home", "away", "hs", "vs").drop("place", "differential")
    assert sorted(map(tuple, spark.table("stream_test").collect())) == sorted(map(tuple, batch.collect()))


def test_medals_count_a_crew_once(spark):
    rows = [(2000, "Eight", "Gold", "GBR")] * 8 + [(2000, "Eight", "Silver", "USA"), (2004, "Eight", "Gold", "GBR"), (2004, "Four", None, "USA")]
    made = results.medal_table(spark.createDataFrame(rows, "y int, e string, m string, n string"), ["y", "e"], "m", "n")
    assert sorted(map(tuple, made.collect())) == [("GBR", 2, 6, 2, 0, 0), ("USA", 1, 2, 0, 1, 0)]


def test_latest_record_order_matters(spark):
    rows = [("a", 1, True), ("a", 2, False), ("b", 1, True)]
    df = spark.createDataFrame(rows, "name string, day int, ok boolean").withColumn("g", F.lit(1))
    use = (["day"], F.col("ok"), ["day"], ["g"], ["name"], 5, 1)
    assert {r["name"] for r in results.lifter_table(df, "name", *use).collect()} == {"b"}
    assert {r["name"] for r in results.lifter_table(df, "name", *use, latest_first=False).collect()} == {"a", "b"}


def test_gaps_are_added_to_the_leader(spark):
    df = spark.createDataFrame([(1, 1, "1:05.50"), (1, 2, "+0.40"), (1, 3, None)], "race int, place int, t string")
    made = {r["place"]: r["s"] for r in results.gaps_to_times(df, ["race"], ["place"], {"s": "t"}).collect()}
    assert made == {1: 65.5, 2: pytest.approx(65.9), 3: None}


def test_traded_players_get_a_total(spark):
    df = spark.createDataFrame([("p", "X", 3), ("p", "Y", 4), ("q", "X", 1)], "player string, tm string, g int")
    made = results.season_totals(df, "player", "tm", ["g"])
    assert sorted(map(tuple, made.collect())) == [("p", "TOT", 7), ("p", "X", 3), ("p", "Y", 4), ("q", "X", 1)]


def test_fight_agreement(spark):
    rows = [(1, 30, 27, 30, 27, 29, 28), (2, 30, 27, 27, 30, 30, 27), (3, 30, 27, 27, 30, 28, 28)]
    df = spark.createDataFrame(rows, "f int, a1 int, b1 int, a2 int, b2 int, a3 int, b3 int")
    made = {r["f"]: r for r in judging.fight_decisions(df, [("a1", "b1"), ("a2", "b2"), ("a3", "b3")]).collect()}
    assert [made[i]["agreement"] for i in (1, 2, 3)] == ["Agree", "judge2", "Disagree"]
    assert made[1]["judge1_perc"] == pytest.approx(100 * 3 / 27) and made[1]["judge3_dev"] == -2.0
    assert made[3]["judge3_out"] == "draw"


def test_fleiss_kappa_known_table(spark):
    # textbook table: 10 subjects, 14 raters, 5 categories, kappa 0.210
    counts = [[0, 0, 0, 0, 14], [0, 2, 6, 4, 2], [0, 0, 3, 5, 6], [0, 3, 9, 2, 0], [2, 2, 8, 1, 1],
              [7, 7, 0, 0, 0], [3, 2, 6, 3, 0], [2, 5, 3, 2, 2], [6, 5, 2, 1, 0], [0, 2, 2, 3, 7]]
    rows = [(i, c) for i, row in enumerate(counts) for c, n in enumerate(row) for _ in range(n)]
    made = judging.fleiss_kappa(spark.createDataFrame(rows, "s int, c int"), "s", "c").first()
    assert made["kappa"] == pytest.approx(0.210, abs=5e-4) and made["observed"] == pytest.approx(0.378, abs=5e-4)


def test_cohen_kappa(spark):
    rows = [("y", "y")] * 20 + [("y", "n")] * 5 + [("n", "y")] * 10 + [("n", "n")] * 15 + [(None, "y")]
    made = judging.cohen_kappa(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    assert (made["n"], made["kappa"]) == (50, pytest.approx(0.4))


def test_lumping_keeps_the_total(spark):
    rows = [("a", "x", 9), ("a", "y", 1), ("b", "x", 5), ("c", "y", 5), ("d", "y", 1)]
    made = contingency.lump(spark.createDataFrame(rows, "p string, q string, n long"), "p", "n", 2)
    assert sorted(map(tuple, made.collect())) == [("Other", "y", 6), ("a", "x", 9), ("a", "y", 1), ("b", "x", 5)]


def test_tolerant_apply_separates_failures(spark):
    df = spark.createDataFrame([(1, "4"), (2, "x")], "i int, t string")
    made = {r["i"]: (r["n"], r["error"]) for r in stints.tolerant(df, "i", lambda row: {"n": int(row["t"])}, "n double").collect()}
    assert made == {1: (4.0, None), 2: (None, "ValueError")}


def test_qualification_uses_half_of_the_games(spark, sizes):
    rows = [(1, t, i, int((i < 20) == (t < 3))) for t in range(6) for i in range(40)]
    made = games.qualification(spark.createDataFrame(rows, "season int, team int, g int, win int"), "season", "team", ["g"], "win", 3)
    got = pd.DataFrame(map(tuple, made.collect()), columns=made.columns).set_index("team")
    assert list(got.loc[[0, 3], "mid_pct"]) == [1.0, 0.0] and list(got["final_pct"].unique()) == [0.5]
    assert list(got.loc[[0, 3], "mid_in"]) == [True, False] and got["final_in"].all()


def test_tolerant_groups_gets_whole_orders(spark, tmp_path):
    lines = [(k, float(v)) for k, vs in ((1, [5, 9]), (2, [3]), (3, [4, 1, 8, 8])) for v in vs]
    spark.createDataFrame(lines, "l_orderkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r["l_orderkey"]: (r["lines"], r["width"], r["error"]) for r in tolerant_groups(spark, str(tmp_path)).collect()}
    assert got == {1: (2, 4, None), 2: (None, None, "ValueError"), 3: (4, 7, None)}
