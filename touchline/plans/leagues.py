"""Raw league tables, as published, to clean tables.

Column names are those of the published tables; input is text unless said otherwise.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.numeric import if_else
from touchline.functions.text import (
    date_of, digits_only, feet_inches, first_number, piece, recode, replace_all, split_into, to_number,
)
from touchline.operators.joins import natural_full, stack
from touchline.operators.reshape import runs_to_rows, drop_leading, promote_header
from touchline.operators.verbs import drop_null_columns, filled
from touchline.plans.results import gaps_to_times
from touchline.session import cut_lineage
from touchline.sources.markup import selected_texts

# Spellings of school names, and the schools of the Ivy League.
SCHOOL_SPELLINGS = {"Pennsylvania": "UPenn", "Columbia/Barnard": "Barnard"}
IVY_SCHOOLS = ("Barnard", "Brown", "Columbia", "Cornell", "Harvard", "Princeton", "UPenn", "Yale")


def fencing_table(cells: DataFrame, gender: str | Column, weapon: str | Column) -> DataFrame:
    """Result tables (``X1 .. X9``) with header rows dropped and types set.

    ``gender`` and ``weapon`` are constants of one event, or columns over the cells'
    page when all events are read in one go.
    """
    tags = {name: F.lit(tag) if isinstance(tag, str) else tag for name, tag in (("Gender", gender), ("Weapon", weapon))}
    names = ["Place", "Tied", "Name", "School", "V/B", "Pct", "TS", "TR", "Ind"]
    table = cells.select(*[F.col(f"X{i}").alias(n) for i, n in enumerate(names, 1)],
                         *[tag.alias(name) for name, tag in tags.items()]).where(F.col("Place") != "Place")
    table = split_into(table, "V/B", ["Victories", "Bouts"], "/")
    table = table.withColumn("Tied", if_else(F.col("Tied") == "T", F.lit(True), F.lit(False)))
    table = table.withColumns({c: to_number(c, "int") for c in ("Place", "Victories", "Bouts", "TS", "TR", "Ind")})
    return table.withColumn("Pct", to_number("Pct"))


def fencing_season(tables: Sequence[DataFrame]) -> DataFrame:
    """All events stacked (they share no row), school names settled, Ivy League marked."""
    rows = stack(*tables)
    for old, new in SCHOOL_SPELLINGS.items():
        rows = rows.withColumn("School", replace_all("School", old, new))
    ivy = F.when(F.col("School").isin(*IVY_SCHOOLS), "Ivy").otherwise("Non-Ivy")
    return rows.withColumn("Ivy", ivy)


def rider_table(raw: DataFrame) -> DataFrame:
    """Bull riders: packed counts split, money, gaps and percentages as numbers."""
    named = raw.withColumnsRenamed({"Name": "Rider", "% Ridden": "prop_Ridden"})
    counts = ["Outs", "Rides", "Buckoffs"]
    split = split_into(named, "Outs / Rides / Buckoffs", counts, " / ")
    split = split.withColumns({c: to_number(c) for c in counts})
    return split.withColumns({c: digits_only(f"`{c}`") for c in ("Earnings", "Points Back", "prop_Ridden")})


def bull_table(raw: DataFrame) -> DataFrame:
    counts = ["Outs", "Rides", "Buckoffs"]
    split = split_into(raw.withColumnRenamed("Name", "Bull"), "Outs / Ridden / Buckoffs", counts, " / ")
    return split.withColumns({c: to_number(c) for c in counts})


def fighter_table(raw: DataFrame) -> DataFrame:
    """Fighters: numbers out of texts, height in inches, birth year; broken rows dropped."""
    numbers = ("Str_Acc", "Weight", "Str_Def", "TD_Acc", "TD_Def")
    made = raw.withColumns({c: first_number(c) for c in numbers})
    made = made.where((F.col("Str_Acc") != 0) & filled("Reach")).withColumn("Reach", first_number("Reach"))
    made = made.where(F.col("Reach").isNotNull())
    made = made.withColumn("Birthyear", F.year(date_of("DOB", "MMM d, yyyy"))).withColumn("Height", feet_inches("Height"))
    return made.select("fighter_name", "Height", "Weight", "Reach", "Stance", "Birthyear", "SLpM", "Str_Acc", "SApM",
                       "Str_Def", "TD_Avg", "TD_Acc", "TD_Def", "Sub_Avg")


def swim_table(raw: DataFrame, distance: float = 100.0) -> DataFrame:
    """Olympic finals at one distance; results that are no numbers are dropped."""
    named = raw.withColumnRenamed("Distance..in.meters.", "dist_m")
    made = named.withColumn("Results", to_number("Results")).where(F.col("Results").isNotNull())
    made = made.withColumn("dist_m", to_number(replace_all("dist_m", "m", "")))
    period = F.when((F.col("Year") >= 1924) & (F.col("Year") < 1976), "early").when(
        (F.col("Year") >= 1976) & (F.col("Year") <= 2020), "recent")
    relay = [c for c in made.columns if c.startswith("Relay")]
    return made.drop(*[F.col(f"`{c}`") for c in relay]).where(F.col("dist_m") == distance).withColumn("time_period", period)


def skater_table(sheets: Sequence[DataFrame], row: str = "row_no") -> DataFrame:
    """Sheets with a header in the first row: stacked, header promoted, holed columns dropped."""
    whole = cut_lineage(reduce(natural_full, sheets))  # looked at twice before the result
    headed = drop_null_columns(promote_header(whole, row)).drop(row)
    per_game = {"+/-": "Plus_Minus", "G/GP": "G_Per_GP", "A/GP": "A_Per_GP", "P/GP": "P_Per_GP"}
    named = headed.withColumnsRenamed(per_game)
    numbers = ("Rk", "Age", "GP", "G", "A", "P", "PIM", "Plus_Minus", "PPG", "SHG", "GWG", "G_Per_GP", "A_Per_GP", "P_Per_GP")
    return named.withColumns({c: to_number(c) for c in numbers if c in named.columns})


# Columns of the two published disc golf tables.
THROW_STATS = ("player", "birdie_avg", "bogey_avg", "PKD", "C1R", "C2R", "FWY", "SCR", "OB/18", "C1X", "C2P", "tot_SG:TG",
               "tot_SG:P", "throws/SG:TG", "putts/SG:P", "events", "rounds")
SEASON_STATS = ("player", "starts", "wins", "podiums", "top_10s", "top_20s", "avg_place", "DNFs", "win%", "podium%",
                "top_10%", "top_20%", "total_earnings", "avg_earnings", "earnings_as_winner", "total_strokes")
WHOLE = ("events", "rounds", "wins", "podiums", "top_10s", "top_20s")
WITH_SIGNS = ("total_earnings", "total_strokes")
LEFT_OUT = ("starts", "throws/SG:TG", "putts/SG:P", "DNFs", "win%", "podium%", "earnings_as_winner", "avg_earnings")


def disc_golf_table(throws: DataFrame, season: DataFrame, row: str = "row_no") -> DataFrame:
    """Two tables ``X1 ..`` with two header rows each, named, typed and joined by player."""

    def named(table: DataFrame, names: Sequence[str]) -> DataFrame:
        body = drop_leading(table, row, 2)
        columns = []
        for i, name in enumerate(names, 1):
            if name in LEFT_OUT:
                continue
            text = F.col(f"X{i}")
            if name in WITH_SIGNS:
                text = first_number(text)
            elif name != "player":
                text = to_number(text, "int" if name in WHOLE else "double")
            columns.append(text.alias(name))
        return body.select(*columns)

    return named(throws, THROW_STATS).join(named(season, SEASON_STATS), "player", "inner")


def alpine_results(pages: DataFrame, page_id: str, html: str, selector: str = ".sortable") -> DataFrame:
    """Race pages to results: cells in runs of nine, leader times plus gaps, ranks in brackets."""
    texts = selected_texts(pages, page_id, html, [selector], whole=True)
    one = texts.sparkSession.createDataFrame(texts.head(1), texts.schema)
    header, cells = (runs_to_rows(t, ["page_id"], "texts", 9) for t in (one, texts))
    rows = promote_header(cells, "row_no", keep=["page_id"], first=0, header=header)
    parts = {}
    for run in ("Run 1", "Run 2"):
        out = run.replace(" ", "")
        parts[f"{out}_Rank"] = first_number(piece(f"`{run}`", r"\(", 1)).cast("int")
        parts[f"__{out}"] = F.trim(piece(f"`{run}`", r"\(", 0))
    clocks = {"Run1_Time": "__Run1", "Run2_Time": "__Run2", "Total_Time": "Total"}
    timed = gaps_to_times(rows.withColumns(parts), ["page_id"], ["row_no"], clocks, small_races=True)
    return timed.select(
        "page_id", "Name", "Nat", to_number("Bib", "int").alias("Run1_Order"), "Run1_Time", "Run1_Rank",
        to_number("`N°`", "int").alias("Run2_Order"), "Run2_Time", "Run2_Rank", "Total_Time",
        to_number("Rank", "int").alias("Final_Rank"), first_number("Pr").cast("int").alias("Rank_Diff"),
    )


# Columns of the yearly match files that are not published.
MATCH_COLUMNS_LEFT_OUT = ("tourney_id", "tourney_level", "best_of", "draw_size", "match_num", "winner_id", "winner_entry",
                          "loser_id", "loser_entry", "winner_rank_points", "loser_rank_points")


def grand_slam_matches(matches: DataFrame) -> DataFrame:
    """Grand slam matches of all years, tournament names in capitals."""
    slams = matches.where(F.col("tourney_level") == "G").drop(*MATCH_COLUMNS_LEFT_OUT)
    return slams.withColumn("tourney_name", F.upper("tourney_name"))


# Teams that moved, with their present names.
MOVED_TEAMS = {"3": "Dallas Wings", "17": "Las Vegas Aces"}
TEAM_GAME_COLUMNS = ("game_id", "season", "season_type", "game_date", "team_id", "team_display_name", "team_winner",
                     "opponent_team_id", "team_home_away")


def team_box_scores(box: DataFrame, first: int, last: int, largest_team_id: int = 20) -> DataFrame:
    """Season range of league teams (exhibition teams have larger ids) with present names."""
    kept = box.where(F.col("season").between(first, last) & (F.col("team_id") <= largest_team_id))
    present = recode(F.col("team_id").cast("string"), MOVED_TEAMS)
    moved = F.when(F.col("team_id").cast("string").isin(*MOVED_TEAMS), present).otherwise(F.col("team_display_name"))
    return kept.select(*TEAM_GAME_COLUMNS, moved.alias("team_name"))


def team_season_goals(stats: DataFrame, teams: DataFrame, skipped_seasons: Sequence[int], skipped: Sequence[tuple]) -> DataFrame:
    """Seasons in which each team played, with its name and goal differential.

    ``skipped`` are single (team, season) pairs to leave out.
    """
    years = teams.select("team_id", "team_name", F.explode(F.sequence("first_season", "last_season")).alias("season"))
    years = years.where(~F.col("season").isin(*skipped_seasons))
    for team, season in skipped:
        years = years.where(~((F.col("team_name") == team) & (F.col("season") == season)))
    joined = stats.join(years, ["team_id", "season"], "inner")
    return joined.withColumn("goal_differential", F.col("goals") - F.col("goals_conceded"))

