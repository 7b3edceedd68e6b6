"""Season results: outcomes, standings, running records, team name crosswalk."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.numeric import outcome, winner
from touchline.operators.ordered import attach, ranks, running_record
from touchline.operators.reshape import two_sided
from touchline.session import cut_lineage


def game_outcomes(games: DataFrame, home: str, away: str, home_score: str, away_score: str) -> DataFrame:
    """Add score difference, winner and home outcome (1 win, 0.5 tie, else 0).

    A game without a score has outcome 0 and no difference; filter such games first
    where they should not count.
    """
    return (
        games.withColumn("score_diff", F.col(home_score) - F.col(away_score))
        .withColumn("winner", winner(home, away, home_score, away_score))
        .withColumn("outcome", outcome(home_score, away_score, unplayed=0.0))
    )


def team_games(
    games: DataFrame, keep: Sequence[str], home: str, away: str, home_score: str, away_score: str
) -> DataFrame:
    """One row per team and game, from a single scan of the games."""
    return two_sided(
        games,
        keep,
        {"team": home, "opponent": away, "at_home": F.lit(True),
         "points_for": home_score, "points_against": away_score},
        {"team": away, "opponent": home, "at_home": F.lit(False),
         "points_for": away_score, "points_against": home_score},
    )


def standings(
    games: DataFrame, season: str, home: str, away: str, home_score: str, away_score: str
) -> DataFrame:
    """Wins, losses, ties and points per season and team, with the place in the season.

    Games without both scores count for nothing. ``place`` orders by wins, then by
    point differential; equal teams share a place.
    """
    sides = team_games(games, [season], home, away, home_score, away_score)
    own, other = F.col("points_for"), F.col("points_against")
    played = own.isNotNull() & other.isNotNull()
    table = sides.groupBy(season, "team").agg(
        F.count_if(played).alias("games"),
        F.count_if(own > other).alias("wins"),
        F.count_if(own < other).alias("losses"),
        F.count_if(own == other).alias("ties"),
        F.coalesce(F.sum(F.when(played, own)), F.lit(0)).cast("long").alias("points_for"),
        F.coalesce(F.sum(F.when(played, other)), F.lit(0)).cast("long").alias("points_against"),
    )
    table = table.withColumn("differential", F.col("points_for") - F.col("points_against"))
    return ranks(cut_lineage(table), [season], ["-wins", "-differential"], low="place")


def qualification(
    rows: DataFrame, season: str, team: str, order: Sequence[str], win: str, places: int
) -> DataFrame:
    """Would a team qualify on its record at mid-season, and does it at the end?

    Mid-season is half of the team's games, rounded down (at least one).
    """
    keys = [season, team]
    record = running_record(rows, keys, order, win)
    middle = F.greatest(F.floor(F.col("games") / 2), F.lit(1))
    halfway = F.max(F.when(F.col("game_no") == middle, F.col("wins_so_far") / F.col("game_no")))
    final = F.max(F.when(F.col("game_no") == F.col("games"), F.col("wins_so_far") / F.col("games")))
    table = record.groupBy(*keys).agg(
        F.max("games").alias("games"), halfway.alias("mid_pct"), final.alias("final_pct")
    )
    ranked = ranks(cut_lineage(table), [season], "-mid_pct", low="mid_place")
    ranked = ranks(ranked, [season], "-final_pct", low="final_place")
    return ranked.withColumn("mid_in", F.col("mid_place") <= places).withColumn(
        "final_in", F.col("final_place") <= places
    )


def latest_names(rows: DataFrame, team_id: str, name: str, season: str) -> DataFrame:
    """Each team's current name: the one of its latest season (last in order on ties)."""
    newest = F.max_by(name, F.struct(season, name)).alias("current_name")
    return rows.groupBy(team_id).agg(
        newest, F.count_distinct(name).alias("names_used"), F.max(season).alias("last_season")
    )


def with_latest_names(rows: DataFrame, team_id: str, name: str, season: str) -> DataFrame:
    current = latest_names(rows, team_id, name, season).select(team_id, "current_name")
    return attach(rows, current, [team_id], measure=True)


def home_advantage(outcomes: DataFrame, season: str) -> DataFrame:
    """Mean home margin and outcome per season."""
    return outcomes.where(F.col("score_diff").isNotNull()).groupBy(season).agg(
        F.count("score_diff").alias("games"),
        F.avg("score_diff").alias("home_margin"),
        F.avg("outcome").alias("home_outcome"),
    )


def advantage_trend(by_season: DataFrame, season: str) -> DataFrame:
    """Least-squares slope of the home margin over seasons."""
    return by_season.agg(
        F.count(F.lit(1)).alias("seasons"),
        F.regr_slope("home_margin", season).alias("slope"),
        F.regr_intercept("home_margin", season).alias("intercept"),
        F.regr_r2("home_margin", season).alias("r2"),
    )


def rate(df: DataFrame, measures: dict[str, str], exposure: str, unit: float) -> DataFrame:
    """Measures per ``unit`` of exposure (48 minutes, 100 possessions, one set)."""
    for out, measure in measures.items():
        df = df.withColumn(out, F.try_divide(F.col(measure) * F.lit(float(unit)), F.col(exposure)))
    return df
