"""Table scans: by name, by season range, by key and date range, by key fan-out."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.joins import without


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_seasons(df: DataFrame, path: str, season: str) -> None:
    """Parquet with one folder per season. Rows of a season stay in many files."""
    df.write.mode("errorifexists").partitionBy(season).parquet(path)


def season_scan(spark: SparkSession, path: str, season: str, first: int, last: int) -> DataFrame:
    """Seasons of a partitioned table; the others are never listed or read."""
    return spark.read.parquet(path).where(F.col(season).between(first, last))


def keyed_range_scan(df: DataFrame, key: str, value, date: str, first: str, last: str) -> DataFrame:
    """One key between two dates (inclusive); both conditions reach the file scan."""
    low, high = F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")
    return df.where((F.col(key) == value) & F.col(date).between(low, high))


def in_years(date: str, first: int, last: int) -> Column:
    """Dates from the first to the last year, as a range that reaches the file scan."""
    low, high = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (first, last + 1))
    return (F.col(date) >= low) & (F.col(date) < high)


def key_years(keys: DataFrame, key: str, first: str, last: str, excluded: Sequence[int] = ()) -> DataFrame:
    """Every (key, year) from first to last year, minus the excluded years."""
    years = keys.select(key, F.explode(F.sequence(F.col(first), F.col(last))).alias("year"))
    return years.where(~F.col("year").isin(*excluded)) if excluded else years


def fan_out_scan(facts: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Fact rows of the wanted keys in one semi join instead of a load per key."""
    return facts.join(wanted.select(*on), list(on), "left_semi")


def missing_keys(facts: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Wanted keys without any fact row."""
    return without(wanted, facts, on)
