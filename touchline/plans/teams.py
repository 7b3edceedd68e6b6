"""Play-by-play to team-season summaries, and shot and pitch tables."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.numeric import if_else, share_true, total
from touchline.functions.text import unite
from touchline.operators.reshape import two_sided

# Measures that only make sense for passing plays.
PASS_ONLY = ("completion_percentage", "total_air_yards", "ave_air_yards", "total_yac", "ave_yac",
             "n_interceptions")
MEASURES = ("completion_percentage", "total_yards_gained", "ave_yards_gained", "total_air_yards",
            "ave_air_yards", "total_yac", "ave_yac", "n_plays", "n_interceptions", "n_fumbles_lost",
            "total_epa", "ave_epa", "total_wpa", "ave_wpa", "success_rate")


def play_measures() -> dict:
    """The 15 measures over plays with the columns named below."""
    sums = {"yards_gained": "yards_gained", "air_yards": "air_yards", "yac": "yards_after_catch",
            "epa": "epa", "wpa": "wpa"}
    made = {f"total_{name}": total(source) for name, source in sums.items()}
    made |= {f"ave_{name}": F.avg(source) for name, source in sums.items()}
    made["completion_percentage"] = F.avg("complete_pass")
    made["n_plays"] = F.count(F.lit(1))
    made["n_interceptions"] = total("interception")
    made["n_fumbles_lost"] = total("fumble_lost")
    made["success_rate"] = share_true(F.col("epa") > 0)
    return {name: made[name] for name in MEASURES}


def team_seasons(
    plays: DataFrame, season: str, offense: str, defense: str, play_type: str,
    passing: str = "pass", running: str = "run",
) -> DataFrame:
    """One row per season and team: measures by side and play type.

    Each play becomes an offence and a defence row, so one scan and one aggregate serve
    both sides and no join is needed. Teams seen on one side only are left out.
    """
    columns = ["yards_gained", "air_yards", "yards_after_catch", "epa", "wpa", "complete_pass",
               "interception", "fumble_lost"]
    kept = plays.where(F.col(play_type).isin(passing, running) & F.col("epa").isNotNull())
    sides = two_sided(
        kept, [season, play_type, *columns],
        {"team": offense, "side": F.lit("offense")}, {"team": defense, "side": F.lit("defense")},
    ).where(F.col("team").isNotNull() & (F.col("team") != ""))
    kind = F.when(F.col(play_type) == passing, "pass").otherwise("run")
    slots = [f"{side}_{p}" for side in ("offense", "defense") for p in ("pass", "run")]
    wide = (
        sides.withColumn("slot", F.concat_ws("_", "side", kind))
        .groupBy(season, "team").pivot("slot", slots)
        .agg(*[column.alias(name) for name, column in play_measures().items()])
    )
    both = [F.coalesce(f"{side}_pass_n_plays", f"{side}_run_n_plays").isNotNull()
            for side in ("offense", "defense")]
    out = [F.col(season), F.col("team")]
    for side in ("offense", "defense"):
        for name in MEASURES:
            if name in PASS_ONLY:
                out.append(F.col(f"{side}_pass_{name}").alias(f"{side}_{name}"))
            else:
                out += [F.col(f"{side}_{p}_{name}").alias(f"{side}_{name}_{p}") for p in ("pass", "run")]
    return wide.where(both[0] & both[1]).select(*out)


def with_results(summary: DataFrame, results: DataFrame, season: str) -> DataFrame:
    """Team-season summary with its results and score differential."""
    joined = summary.join(results, [season, "team"], "inner")
    return joined.withColumn("score_differential", F.col("points_for") - F.col("points_against"))


def shot_table(
    log: DataFrame, shot_types: Sequence[str], kind: str, team: str, home: str, away: str,
    home_name: str, away_name: str, keep: Sequence[str],
) -> DataFrame:
    """Shot events with the name of the shooting team."""
    shots = log.where(F.col(kind).isin(*shot_types))
    name = if_else(F.col(team) == F.col(home), F.col(home_name), F.col(away_name))
    return shots.select(*keep, F.col(kind).alias("shot_outcome"), name.alias("shooting_team"))


def pitch_table(
    pitches: DataFrame, game_type: str, skip_type: str, pitch: str, balls: str, strikes: str
) -> DataFrame:
    """Regular pitches with a known type and their ball-strike count."""
    kept = pitches.where((F.col(game_type) != skip_type) & (F.col(pitch) != ""))
    return unite(kept, "count", [balls, strikes], "-").drop(game_type)
