"""Wide to long, long to wide, two-sided stacking."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def longer(df: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot([c for c in df.columns if c not in columns], list(columns), name, value)


def wider(
    df: DataFrame, keys: Sequence[str], names_from: str, levels: Sequence, measures: Mapping[str, Column]
) -> DataFrame:
    """Aggregate and spread over given levels, columns named ``measure_level``."""
    spread = df.groupBy(*keys).pivot(names_from, list(levels))
    spread = spread.agg(*[column.alias(name) for name, column in measures.items()])
    if len(measures) == 1:
        only = next(iter(measures))
        renames = {str(level): f"{only}_{level}" for level in levels}
    else:
        renames = {f"{level}_{name}": f"{name}_{level}" for level in levels for name in measures}
    ordered = [f"{name}_{level}" for name in measures for level in levels]
    return spread.withColumnsRenamed(renames).select(*keys, *[F.col(f"`{c}`") for c in ordered])


def indicator(
    df: DataFrame, keys: Sequence[str], names_from: str, levels: Sequence, value: Column
) -> DataFrame:
    """One column per level, 0 where absent. For small level sets at the edge only."""
    spread = df.groupBy(*keys).pivot(names_from, list(levels)).agg(F.sum(value))
    return spread.fillna(0)


def two_sided(
    df: DataFrame, keep: Sequence[str], first: Mapping[str, str | Column], second: Mapping[str, str | Column]
) -> DataFrame:
    """Two rows per game, one per side, from a single scan."""

    def side(columns: Mapping[str, str | Column]) -> Column:
        return F.struct(
            *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
        )

    exploded = df.select(*keep, F.explode(F.array(side(first), side(second))).alias("__side"))
    return exploded.select(*keep, "__side.*")


def cells_to_rows(
    df: DataFrame, keys: Sequence[str], position: str, value: str, width: int
) -> DataFrame:
    """A flat run of cells to rows of ``width`` columns ``X1 .. Xwidth``."""
    placed = df.withColumn("row_no", F.floor(F.col(position) / width).cast("int")).withColumn(
        "__at", (F.col(position) % width + 1).cast("int")
    )
    columns = [F.max(F.when(F.col("__at") == i, F.col(value))).alias(f"X{i}") for i in range(1, width + 1)]
    return placed.groupBy(*keys, "row_no").agg(*columns)


def runs_to_rows(df: DataFrame, keys: Sequence[str], cells: str, width: int) -> DataFrame:
    """``cells_to_rows`` of cells kept in order in an array column: arrays are dealt by key once, not cell by cell.

    Arrays of equal keys are laid over each other; of the cells in one place the largest stands, as in ``cells_to_rows``.
    """
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(cells) - 1) / width).cast("int")), lambda i: F.struct(
        i.alias("row_no"), *[F.get(F.col(cells), i * width + c).alias(f"X{c + 1}") for c in range(width)]))
    rows = df.where(F.size(cells) > 0).select(*keys, cells).repartition(*keys).select(*keys, F.inline(runs))
    return rows.groupBy(*keys, "row_no").agg(*[F.max(f"X{c}").alias(f"X{c}") for c in range(1, width + 1)])


def promote_header(df: DataFrame, row: str, keep: Sequence[str] = (), first: int | None = None, header: DataFrame | None = None) -> DataFrame:
    """The first row's values become the column names; repeats of it are dropped.

    ``keep`` are columns outside the table proper (page ids). With the header's row
    number given as ``first`` only as many partitions are read as it takes to see one. Where ``df`` comes
    out of a shuffle that is all of them: then give a small table with such a row as ``header``.
    """
    data = [c for c in df.columns if c != row and c not in keep]
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in data])
    if first is None:
        names = df.agg(F.min_by(cells, F.col(row))).first()[0]
    else:
        names = (df if header is None else header).where(F.col(row) == first).select(cells).first()[0]
    repeated = F.lit(True)
    for c, n in zip(data, names):
        repeated = repeated & F.col(f"`{c}`").cast("string").eqNullSafe(F.lit(n))
    kept = df.where(~repeated)
    return kept.select(*keep, row, *[F.col(f"`{c}`").alias(n) for c, n in zip(data, names)])


def drop_leading(df: DataFrame, row: str, n: int) -> DataFrame:
    return df.where(F.col(row) > n)
