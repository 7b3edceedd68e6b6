"""Running results of any associative combination, in order and within keys.

Rows are numbered, cut into ranges of at most ``length`` rows, and combined by doubling: after k rounds a
row holds the combination of the last 2^k rows, each round one shift inside the same sorted range. The last
rows of the ranges are scanned in the same way, and what comes before a range is combined with its rows.
A key may have any number of rows; nothing is gathered.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.ordered import attach, scan
from touchline.session import cut_lineage

LENGTH = 256


def associative_scan(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], element: str, combine: Callable[[Column, Column], Column],
    out: str, length: int = LENGTH,
) -> DataFrame:
    """Adds ``out``: the elements (structs) of all rows of the key up to this one, combined in order.

    ``combine(earlier, later)`` gives a struct of the same fields and must be associative. Rows are read several times:
    the numbered table is checkpointed.
    """
    keys, number, part, own = list(keys), "__number", "__part", "__own"
    numbered = scan(df, keys, order, number=number)
    numbered = cut_lineage(numbered.withColumn(part, F.floor((F.col(number) - 1) / length)).withColumn(own, F.col(element)))
    most = numbered.agg(F.max(number)).first()[0]
    if most is None:
        return numbered.withColumn(out, F.col(element)).drop(number, part, own)
    window = Window.partitionBy(*keys, part).orderBy(number)
    made, reach = numbered, 1
    while reach < min(length, most):
        before = f"__before_{reach}"
        made = made.withColumn(before, F.lag(own, reach).over(window))
        made = made.withColumn(own, F.when(F.col(before).isNull(), F.col(own)).otherwise(combine(F.col(before), F.col(own)))).drop(before)
        reach *= 2
    if most > length:
        ends = made.groupBy(*keys, F.col(part).alias("__range_no")).agg(F.max_by(own, number).alias("__end"))
        carried = associative_scan(ends, keys, ["__range_no"], "__end", combine, "__sum", length)
        carried = carried.select(*keys, (F.col("__range_no") + 1).alias(part), "__sum")
        made = attach(made, carried, [*keys, part])
        made = made.withColumn(own, F.when(F.col("__sum").isNull(), F.col(own)).otherwise(combine(F.col("__sum"), F.col(own))))
        made = made.drop("__sum")
    return made.withColumn(out, F.col(own)).drop(number, part, own)


