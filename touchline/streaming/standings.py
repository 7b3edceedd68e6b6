"""Standings kept up to date from a stream of finished games."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from touchline.plans.games import team_games


def streaming_totals(
    games: DataFrame, season: str, home: str, away: str, home_score: str, away_score: str
) -> DataFrame:
    """Running totals per season and team; the same measures as batch standings.

    State is one row per season and team, in update mode.
    """
    sides = team_games(games, [season], home, away, home_score, away_score)
    own, other = F.col("points_for"), F.col("points_against")
    played = own.isNotNull() & other.isNotNull()
    return sides.groupBy(season, "team").agg(
        F.count_if(played).alias("games"),
        F.count_if(own > other).alias("wins"),
        F.count_if(own < other).alias("losses"),
        F.count_if(own == other).alias("ties"),
        F.sum(F.when(played, own)).cast("long").alias("points_for"),
        F.sum(F.when(played, other)).cast("long").alias("points_against"),
    )


def run_to_table(totals: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and keep the full result in a memory table."""
    query = (
        totals.writeStream.outputMode("complete").format("memory").queryName(name)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def run_to_folder(totals: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Process what is there and keep the newest row of each key in a written table.

    Each trigger writes the keys it changed, with its number, by the executors; the table read back
    takes the newest of each key. A trigger that is repeated after a failure overwrites its own folder.
    """
    spark = totals.sparkSession

    def store(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        totals.writeStream.outputMode("update").foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.schema(StructType([*totals.schema.fields, StructField("batch", LongType())])).parquet(path)
    values = F.struct(*[c for c in totals.columns if c not in keys])
    return rows.groupBy(*keys).agg(F.max_by(values, "batch").alias("__new")).select(*keys, "__new.*").select(*totals.columns)
