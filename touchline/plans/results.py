"""Result tables: medals, umpires, lifters, race clocks, careers, match perspectives."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.numeric import (
    MEDAL_POINTS, RANK_DIFFERENCE_BANDS, ROWING_AGE_BANDS, bands, if_else, percent_change, ratio,
    umpire_rating, weighted,
)
from touchline.functions.text import blank_to, clock_minutes, clock_seconds, first_number, missing_to, piece
from touchline.functions.text import split_at
from touchline.operators.ordered import blocks, latest_per_key, ranks, scan, whole_keys
from touchline.operators.reshape import longer, two_sided
from touchline.operators.sampling import sample_per_group
from touchline.session import cut_lineage


def medal_table(
    athletes: DataFrame, event: Sequence[str], medal: str, nation: str,
    points: Mapping[str, float] = MEDAL_POINTS,
) -> DataFrame:
    """Medals and points per nation; a crew counts once per event and medal."""
    crews = athletes.where(F.col(medal).isNotNull()).select(*event, medal, nation).distinct()
    counts = [F.count_if(F.col(medal) == m).alias(f"total_{m.lower()}") for m in points]
    return crews.groupBy(nation).agg(
        F.count(F.lit(1)).alias("total_medals"), F.sum(weighted(medal, points)).alias("total_points"), *counts
    )


def umpire_boosts(
    raw: DataFrame, umpire: str, games: str, percents: Sequence[str], boosts: Mapping[str, str]
) -> DataFrame:
    """One row per umpire and statistic with percent change and favoured side.

    ``percents`` end in ``%``, ``boosts`` (``{column: statistic}``) in ``x``.
    """
    cells = [F.col(umpire), F.col(games).try_cast("double").alias("games")]
    cells += [split_at(p, -1)[0].try_cast("double").alias(p) for p in percents]
    cells += [split_at(c, -1)[0].try_cast("double").alias(s) for c, s in boosts.items()]
    clean = raw.where(F.col(umpire) != umpire).select(*cells).where(F.col("games") > 1)
    long = longer(clean, list(boosts.values()), "boost_stat", "boost_pct")
    long = long.withColumn("boost_pct", percent_change("boost_pct"))
    long = long.withColumn("boost_stat", F.upper("boost_stat"))
    return long.withColumn("rating", umpire_rating("boost_stat", "boost_pct"))


def lifter_table(
    meets: DataFrame, name: str, order: Sequence[str], qualifies: Column, complete: Sequence[str],
    groups: Sequence[str], ids: Sequence[str], cap: int, seed: int, latest_first: bool = True,
) -> DataFrame:
    """Latest record per athlete, qualifying rows, complete cases, capped random groups.

    ``latest_first`` picks the latest record before testing it, so an athlete whose
    latest record does not qualify is left out; otherwise the latest qualifying one.
    """
    if latest_first:
        picked = latest_per_key(meets, [name], order).where(qualifies)
    else:
        picked = latest_per_key(meets.where(qualifies), [name], order)
    return sample_per_group(cut_lineage(picked.dropna(subset=list(complete))), groups, ids, cap, seed)


def split_times(
    rows: DataFrame, race: Sequence[str], order: Sequence[str], racer: Sequence[str], rank: str, clock: str,
    gap: str, distances: Sequence[float], drop_last: int,
) -> DataFrame:
    """Stacked checkpoint blocks to one row per racer; times in minutes.

    A racer must appear at the first checkpoint, the others are looked up.
    """
    k = len(distances)
    placed = blocks(rows, race, order, k, drop_last)
    placed = placed.withColumn("__minutes", F.round(clock_seconds(clock) / 60, 3))
    picks = []
    for i, distance in enumerate(distances, 1):
        at = F.col("block") == i
        picks += [
            F.max(F.when(at, F.col(rank).try_cast("int"))).alias(f"rank{i}"),
            F.max(F.when(at, F.col("__minutes"))).alias(f"time{i}"),
            F.max(F.when(at, F.col(gap).try_cast("double"))).alias(f"diff{i}"),
            F.max(F.when(at, F.lit(float(distance)))).alias(f"dist{i}"),
        ]
    wide = placed.groupBy(*race, *racer).agg(F.count_if(F.col("block") == 1).alias("__started"), *picks)
    return wide.where(F.col("__started") > 0).drop("__started")


def gaps_to_times(
    df: DataFrame, race: Sequence[str], order: Sequence[str], clocks: Mapping[str, str], small_races: bool = False
) -> DataFrame:
    """First row's clock in seconds; the others are the leader plus their gap.

    ``clocks`` are ``{new: source}``; all are done in one ordered pass. ``small_races``
    says that a race is bounded by its nature (one page), so sizes need no look.
    """
    leads = {f"__lead_{out}": clock for out, clock in clocks.items()}
    split = whole_keys(df, race, order) if small_races else None
    led = scan(df, race, order, first=leads, number="__place", split=split)
    for out, clock in clocks.items():
        lead = clock_seconds(f"__lead_{out}")
        led = led.withColumn(out, F.when(F.col("__place") == 1, lead).otherwise(lead + first_number(clock)))
    return led.drop("__place", *leads)


def pace_table(df: DataFrame, clock: str, distance: str, place: str) -> DataFrame:
    """``"39:56 AU20R"`` to minutes, record, speed, 500 m split and podium flag."""
    minutes = clock_minutes(piece(clock, " ", 0))
    timed = df.withColumn("record", missing_to(piece(clock, " ", 1), "NONE")).withColumn("minutes", minutes)
    timed = timed.withColumn("speed", ratio(distance, "minutes"))
    timed = timed.withColumn("split_500", ratio("minutes", distance, 500))
    timed = timed.withColumn("has_record", F.col("record") != "NONE")
    return timed.withColumn("podium", F.col(place) <= 3)


def rowing_labels(df: DataFrame, age: str, blanks: Sequence[str], verified: str) -> DataFrame:
    """Age band, ``None Listed`` for blanks, ``Race`` counted as verified."""
    for column in blanks:
        df = df.withColumn(column, blank_to(column, "None Listed"))
    checked = if_else(F.col(verified) == "Race", F.lit("Yes"), F.col(verified))
    return df.withColumn(verified, checked).withColumn("age_group", bands(age, ROWING_AGE_BANDS))


# Discipline codes.
DISCIPLINES = {"S": "Singles", "D": "Doubles"}


def ranking_list(df: DataFrame, year: str, code: str, points: str) -> DataFrame:
    """Split a code like ``WS`` and rank by points within year and discipline.

    Ties share the average rank, cut to a whole number.
    """
    sex, kind = split_at(code, 1)
    listed = df.withColumn("sex", sex).withColumn("category", kind)
    for short, full in DISCIPLINES.items():
        listed = listed.withColumn(
            "category", F.when(F.col("category") == short, full).otherwise(F.col("category"))
        )
    ranked = ranks(listed, [year, code], f"-{points}", average="__rank")
    return ranked.withColumn("place", F.floor("__rank").cast("int")).drop("__rank")


def careers(
    df: DataFrame, players: str, category: str, matches: str, wins: str, losses: str, gained: str, given: str
) -> DataFrame:
    """Totals per first-named player and category over all lists, with ratios of sums."""
    first = df.withColumn("player", piece(players, " / ", 0))
    table = first.groupBy("player", category).agg(
        *[F.sum(c).alias(c) for c in (matches, wins, losses, gained, given)]
    )
    return table.withColumn("win_pct", ratio(wins, matches)).withColumn(
        "shot_pct", ratio(gained, F.col(gained) + F.col(given))
    )


def athlete_matches(
    matches: DataFrame, keep: Sequence[str], won: Mapping[str, str], lost: Mapping[str, str]
) -> DataFrame:
    """Winner/loser columns to one row per athlete: own and opponent columns, won flag.

    ``won``/``lost`` give the source column of each attribute.
    """

    def view(own: Mapping[str, str], other: Mapping[str, str], flag: bool) -> dict:
        columns: dict = {name: source for name, source in own.items()}
        columns |= {f"opponent_{name}": source for name, source in other.items()}
        return {**columns, "won": F.lit(flag)}

    return two_sided(matches, keep, view(won, lost, True), view(lost, won, False))


def favourites(df: DataFrame, winner_rank: str, loser_rank: str, winner_hand: str, loser_hand: str) -> DataFrame:
    """Rank difference and its band, whether the better rank won, whether hands agree."""
    difference = F.abs(F.col(winner_rank) - F.col(loser_rank))
    yes_no = lambda test: if_else(test, F.lit("Yes"), F.lit("No"))
    return (
        df.withColumn("rank_diff", difference)
        .withColumn("rank_diff_cat", bands("rank_diff", RANK_DIFFERENCE_BANDS))
        .withColumn("higher_rank_won", yes_no(F.col(winner_rank) < F.col(loser_rank)))
        .withColumn("same_hand", yes_no(F.col(winner_hand) == F.col(loser_hand)))
    )


def season_totals(df: DataFrame, player: str, team: str, measures: Sequence[str]) -> DataFrame:
    """Team rows plus one total row (``TOT``) for each player with several teams."""
    sums = [F.sum(m).alias(m) for m in measures]
    per_team = df.groupBy(player, team).agg(*sums)
    whole = per_team.groupBy(player).agg(F.count(F.lit(1)).alias("__teams"), *sums)
    traded = whole.where(F.col("__teams") > 1).drop("__teams").withColumn(team, F.lit("TOT"))
    return per_team.unionByName(traded.select(per_team.columns))
