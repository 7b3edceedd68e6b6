"""Ratings carried forward game by game in a stream."""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def row_state(spark: SparkSession) -> Iterator[None]:
    """The state store that such streams need, for streams started inside; the session's own setting comes back."""
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER_KEY) if before is None else spark.conf.set(PROVIDER_KEY, before)


def elo_gain(home: float, away: float, outcome: float, k: float, home_edge: float, scale: float) -> float:
    """What the home team gains by a game."""
    return k * (outcome - 1 / (1 + 10 ** ((away - home - home_edge) / scale)))


class Ratings(StatefulProcessor):
    """One league: a rating and a number of games for each team, and the order value of its last game."""

    def __init__(self, league: str, start: float, k: float, home_edge: float, scale: float):
        self.league, self.start, self.k, self.home_edge, self.scale = league, start, k, home_edge, scale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.teams = handle.getMapState("teams", "team string", "rating double, games long")
        self.last = handle.getValueState("last", "played long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        games = pd.concat(list(rows)).sort_values(["played", "home", "away"], kind="stable")
        newest = self.last.get()[0] if self.last.exists() else None
        known: dict[str, tuple[float, int, bool]] = {}

        def of(team: str) -> tuple[float, int, bool]:
            if team not in known:
                held = self.teams.getValue((team,)) if self.teams.containsKey((team,)) else (self.start, 0)
                known[team] = float(held[0]), int(held[1]), False
            return known[team]

        for played, home, away, outcome in zip(games["played"], games["home"], games["away"], games["outcome"]):
            late = newest is not None and played < newest
            h, a = of(home), of(away)
            gain = elo_gain(h[0], a[0], outcome, self.k, self.home_edge, self.scale)
            known[home] = h[0] + gain, h[1] + 1, h[2] or late
            known[away] = a[0] - gain, a[1] + 1, a[2] or late
        if len(games):
            self.last.update((int(max(games["played"].max(), newest if newest is not None else games["played"].min())),))
        for team, (rating, count, _) in known.items():
            self.teams.updateValue((team,), (rating, count))
        yield pd.DataFrame([(key[0], t, r, n, late) for t, (r, n, late) in known.items()], columns=[self.league, "team", "rating", "games", "late"])

    def close(self) -> None:
        pass


def streaming_elo(
    games: DataFrame, league: str, played: str, home: str, away: str, outcome: str,
    start: float = 1500.0, k: float = 20.0, home_edge: float = 0.0, scale: float = 400.0,
) -> DataFrame:
    """(league, team, rating, games, late) of every team that a trigger changed, for a stream of games.

    State is one row per team, in the state store. The games of a league in one trigger are applied in order of ``played`` (a
    whole number; then home, away). A game that comes after later ones of its league have been applied is applied when it
    comes, and its teams are marked ``late``; games without teams, outcome or order are left out. A league's games are
    handled one after the other, as each rating depends on the one before: a league is the unit of work.
    """
    spark = games.sparkSession
    if spark.conf.get(PROVIDER_KEY, "") != PROVIDER:
        raise ValueError(f"stateful processors need {PROVIDER_KEY} = {PROVIDER}")
    rows = games.selectExpr(
        f"`{league}`", f"cast(`{played}` AS long) AS played", f"cast(`{home}` AS string) AS home", f"cast(`{away}` AS string) AS away",
        f"cast(`{outcome}` AS double) AS outcome").dropna(subset=["played", "home", "away", "outcome"])
    kind = games.schema[league].dataType.simpleString()
    return rows.groupBy(league).transformWithStateInPandas(
        statefulProcessor=Ratings(league, start, k, home_edge, scale),
        outputStructType=f"`{league}` {kind}, team string, rating double, games long, late boolean", outputMode="Update", timeMode="None")
