"""Play-by-play logs to stints, possessions and a signed lineup design matrix."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.numeric import if_else, ratio
from touchline.functions.text import mentions
from touchline.operators.ordered import RANGE, attach, hot_split, scan

# Texts that mark plays.
LAST_FREE_THROWS = ("Free Throw 1 of 1", "Free Throw 2 of 2", "Free Throw 3 of 3")
EARLY_FREE_THROWS = ("Free Throw 1 of 2", "Free Throw 2 of 3")


def with_stints(log: DataFrame, game: str = "game_id", order: str = "event_no") -> DataFrame:
    """Number the stints (spells without a lineup change) of each game.

    Needs ``is_sub`` (boolean), ``home_text``, ``away_text``, ``home_score``,
    ``away_score``. A run of substitutions opens a stint at its last one. When a final
    free throw follows, the stint opens after that throw instead. Substitutions that
    open nothing are dropped. Scores start at 0 and are carried forward.
    All passes share one partitioning of the log.
    """
    keys, by = [game], [order]
    split = hot_split(log, keys, by)
    tagged = split.tag(log) if split.active else log

    rows = scan(tagged, keys, by, number="__no", lag={"__sub_before": "is_sub"},
                lead={"__sub_after": "is_sub"}, split=split)
    last_throw = mentions("home_text", *LAST_FREE_THROWS), mentions("away_text", *LAST_FREE_THROWS)
    rows = rows.withColumn(
        "__throw", F.when((last_throw[0] | last_throw[1]) & F.col("__sub_before"), True).otherwise(False)
    )
    for score in ("home_score", "away_score"):
        rows = rows.withColumn(score, F.when(F.col("__no") == 1, F.lit(0)).otherwise(F.col(score)))

    rows = scan(rows, keys, by, lag={"__throw_before": "__throw"}, lead={"__throw_after": "__throw"},
                fill={"__home": "home_score", "__away": "away_score"}, split=split)
    opens = F.col("is_sub") & ~F.col("__sub_after")
    opens = if_else(F.col("is_sub") & F.col("__throw_after"), F.lit(False), opens)
    opens = if_else(F.col("__throw_before"), F.lit(True), opens)
    rows = (
        rows.withColumn("home_score", F.col("__home"))
        .withColumn("away_score", F.col("__away"))
        .withColumn("__opens", F.coalesce(opens, F.lit(False)).cast("int"))
        .where(~(F.col("is_sub") & (F.col("__opens") == 0)))
    )
    rows = scan(rows, keys, by, running={"__starts": "__opens"},
                lag={"home_before": "home_text", "away_before": "away_text"}, split=split)
    rows = rows.withColumn("stint_id", (F.col("__starts") + 1).cast("int"))
    gone = [c for c in rows.columns if c.startswith("__") and c not in log.columns]
    return rows.drop(*gone, RANGE)


def possession_ends() -> Column:
    """1 when a play ends a possession, over rows from :func:`with_stints`."""
    home, away = F.col("home_text"), F.col("away_text")
    scored = [t.contains(" PTS") & ~mentions(t, *EARLY_FREE_THROWS) for t in (home, away)]
    rebound = [
        mentions(own, "rebound", fold_case=True) & mentions(f"{other}_before", "miss ", fold_case=True)
        for own, other in ((away, "home"), (home, "away"))
    ]
    lost = [mentions(t, " turnover", fold_case=True) for t in (home, away)]
    rules = [*scored, *rebound, *lost, mentions("neutral_text", "End")]
    chain = F.when(rules[0], 1)
    for rule in rules[1:]:
        chain = chain.when(rule, 1)
    return chain.otherwise(0)


def stint_summary(
    rows: DataFrame, game: str = "game_id", order: str = "event_no", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Points, minutes, possessions and margin per 100 possessions of each stint.

    Ordered first and last values come from one hash aggregate. ``keep`` are columns
    constant in a stint (lineups). Stints without a possession are dropped first.
    """
    ends = rows.withColumn("__ends", possession_ends())
    first = [F.min_by(c, order).alias(f"__first_{c}") for c in ("home_score", "away_score", "minute")]
    last = [F.max_by(c, order).alias(f"__last_{c}") for c in ("home_score", "away_score", "minute")]
    table = ends.groupBy(game, "stint_id").agg(
        *[F.min_by(c, order).alias(c) for c in keep], F.sum("__ends").alias("n_pos"), *first, *last
    )
    table = table.where(F.col("n_pos") != 0)

    def change(column: str) -> Column:
        return F.col(f"__last_{column}") - F.col(f"__first_{column}")

    return table.select(
        game, "stint_id", *keep, "n_pos",
        change("home_score").alias("home_points"),
        change("away_score").alias("away_points"),
        change("minute").alias("minutes"),
        ratio(change("home_score") - change("away_score"), "n_pos", 100).alias("margin"),
    )


def signed_lineups(stints: DataFrame, keys: list[str], home: str, away: str, sep: str | None = "_") -> DataFrame:
    """Long design matrix (keys, player, value): +1 home, -1 away, summed, zeros dropped.

    Each row explodes into its own lineups only.
    """

    def players(column: str) -> Column:
        return F.split(column, sep) if sep else F.col(column)

    def signed(column: str, sign: int) -> Column:
        return F.transform(players(column), lambda p: F.struct(p.alias("player"), F.lit(sign).alias("sign")))

    both = F.explode(F.concat(signed(home, 1), signed(away, -1))).alias("__p")
    long = stints.select(*keys, both).select(*keys, "__p.player", "__p.sign")
    return long.groupBy(*keys, "player").agg(F.sum("sign").alias("value")).where(F.col("value") != 0)


def design_with_context(stints: DataFrame, matrix: DataFrame, keys: list[str]) -> DataFrame:
    """Design entries next to the stint's measures."""
    return attach(stints, matrix, keys)


def tolerant(
    df: DataFrame, key: str, function: Callable[[dict], dict], schema: str, error: str = "error"
) -> DataFrame:
    """Apply a row function; a failing row gives its key and the error name.

    Split the result on ``error``: good rows go on, failures form a side table.
    """
    from pyspark.sql import types as T

    fields = T.StructType.fromDDL(schema).names
    kind = df.schema[key].dataType.simpleString()

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for record in batch.to_dict("records"):
                try:
                    made = function(record)
                    rows.append((record[key], *[made[f] for f in fields], None))
                except Exception as problem:  # a bad row must not stop the job
                    rows.append((record[key], *[None] * len(fields), type(problem).__name__))
            yield pd.DataFrame(rows, columns=[key, *fields, error])

    return df.mapInPandas(apply, f"{key} {kind}, {schema}, {error} string")


def tolerant_groups(
    df: DataFrame, keys: list[str], function: Callable, schema: str, error: str = "error", arrays: bool = False
) -> DataFrame:
    """Apply a table function to each group; a failing group gives one row with its keys and the error name.

    The function gets its group as a DataFrame and returns one; with ``arrays`` it gets and returns ``{column: values}`` (gets numpy
    arrays, missing numbers as NaN), which saves making two DataFrames: at millions of small groups they cost far more than the function.
    It needs its whole group (a game, an order) in one task: use it for groups that
    are small by their nature. Rows are dealt and sorted by the keys, and a task hands out the groups of a whole batch one
    by one, so a million small groups cost no exchange with the worker each.
    """
    from pyspark.sql import types as T

    names = T.StructType.fromDDL(schema).names
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    whole = [isinstance(df.schema[k].dataType, T.IntegralType) for k in keys]
    columns = df.columns

    def plain(values: pd.Series, is_whole: bool) -> list:
        return [None if gone else int(v) if is_whole else v for v, gone in zip(values, values.isna())]

    def results(rows: pd.DataFrame, starts: np.ndarray) -> Iterator[list[tuple] | str]:
        """The result rows of each group, or an error's name; groups lie between the starts."""
        held = {c: rows[c].to_numpy() for c in columns} if arrays else {}
        ends = [*starts[1:].tolist(), len(rows)]
        for a, b in zip(starts.tolist(), ends):
            try:
                if arrays:
                    made = function({c: values[a:b] for c, values in held.items()})
                    yield list(zip(*[made[n] for n in names], strict=True))
                else:
                    yield list(function(rows.iloc[a:b].reset_index(drop=True))[names].itertuples(index=False, name=None))
            except Exception as problem:  # a bad group must not stop the job
                yield type(problem).__name__

    def done(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        missing = (None,) * len(names)
        out = []
        for key, made in zip(zip(*[plain(rows[k].iloc[starts], w) for k, w in zip(keys, whole)]), results(rows, starts)):
            out += [(*key, *missing, made)] if isinstance(made, str) else [(*key, *row, None) for row in made]
        return pd.DataFrame(out, columns=[*keys, *names, error], dtype=object)

    def opened(rows: pd.DataFrame) -> np.ndarray:
        """Where groups start: the rows are sorted by the keys, and missing keys are equal."""
        new = np.zeros(len(rows), bool)
        for k in keys:
            values = rows[k]
            gone = values.isna().to_numpy()
            own = values.to_numpy()
            new[1:] |= (gone[1:] != gone[:-1]) | (~gone[1:] & ~gone[:-1] & (own[1:] != own[:-1]))
        new[:1] = True
        return np.flatnonzero(new)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the last group so far: it may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            starts = opened(batch)
            if held and len(opened(pd.concat([held[-1][keys].tail(1), batch[keys].head(1)], ignore_index=True))) == 1:
                end = int(starts[1]) if len(starts) > 1 else len(batch)
                held.append(batch.iloc[:end])
                batch, starts = batch.iloc[end:], starts[1:] - end
                if not len(batch):
                    continue
            ready = pd.concat([*held, batch.iloc[:starts[-1]]], ignore_index=True)
            if len(ready):
                yield done(ready, opened(ready))
            held = [batch.iloc[starts[-1]:]]
        if held:
            yield done(pd.concat(held, ignore_index=True), np.zeros(1, int))

    dealt = df.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(apply, f"{kinds}, {schema}, {error} string")
