"""Column selection, renaming and row filters by name or position."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import cut_lineage


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def by_position(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Columns in the order of their 1-based positions."""
    return df.select(*[_q(df.columns[p - 1]) for p in positions])


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in table order."""
    return df.columns[df.columns.index(first): df.columns.index(last) + 1]


def move(df: DataFrame, names: Sequence[str], before: str | None = None) -> DataFrame:
    """Move columns to the front, or before another one."""
    rest = [c for c in df.columns if c not in names]
    at = rest.index(before) if before else 0
    return df.select(*[_q(c) for c in [*rest[:at], *names, *rest[at:]]])


def rename_positions(df: DataFrame, names: Mapping[int, str]) -> DataFrame:
    """Rename by 1-based position."""
    return df.toDF(*[names.get(i, c) for i, c in enumerate(df.columns, 1)])


def prefix_all(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Prefix every column except the keys."""
    return df.toDF(*[c if c in keys else prefix + c for c in df.columns])


def sanitize_names(df: DataFrame) -> DataFrame:
    """Names of letters, digits and underscores; ``%`` reads ``pct``, ``+/-`` ``plus_minus``."""
    import re

    def clean(name: str) -> str:
        name = name.strip().replace("+/-", "plus_minus").replace("%", "pct").replace("/", "_per_")
        name = re.sub(r"\W+", "_", name).strip("_") or "column"
        return f"x{name}" if name[0].isdigit() else name

    names: list[str] = []
    for column in df.columns:
        name, n = clean(column), 1
        while name in names:
            n += 1
            name = f"{clean(column)}_{n}"
        names.append(name)
    return df.toDF(*names)


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop every column with a missing value; one aggregate decides."""
    holes = df.agg(*[F.count_if(_q(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    counts = holes.first()
    return df.select(*[_q(c) for i, c in enumerate(df.columns) if not counts[i]])


def encode_levels(df: DataFrame, column: str, out: str) -> DataFrame:
    """1-based code of a categorical column in sorted level order.

    Levels are ranked on the distinct values and joined back, so the code table may
    be of any size.
    """
    from touchline.operators.ordered import attach, scan

    levels = cut_lineage(df.select(column).where(F.col(column).isNotNull()).distinct())
    return attach(df, scan(levels, [], [column], number=out), [column], measure=True)


def not_in(column: str, values: Sequence) -> Column:
    """Not one of the values; a missing value is kept."""
    return F.coalesce(~F.col(column).isin(*values), F.lit(True))


def filled(column: str) -> Column:
    """Neither missing nor blank."""
    return F.col(column).isNotNull() & (F.col(column) != "")


def key_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, as a table."""
    return df.select(column).distinct()
