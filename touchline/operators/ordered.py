"""Order-aware operators (shift, running sum, fill, numbering, ranks).

A plain window sends every row of one key to one task. Each operator here first
looks for hot keys. Without any, it is one ordinary window. With some, the rows of
a hot key are cut into consecutive ranges at rows of their own: the cut points are whole
order values (all order columns, in their direction, missing values last), so ties in
the first column, missing values and texts of any shape are cut as evenly as numbers.
The window runs per range, and one small table carries last/first rows and totals across the cuts.

A key is hot above ``max(hot_group_rows, total / HOT_SHARES)`` rows, so there are
at most ``HOT_SHARES`` hot keys and ``3 * HOT_SHARES`` ranges: the carried table has
a fixed size bound and is the only thing broadcast. Cut points are chosen from a sample of
``SAMPLED`` rows for each range; they only decide which task a row goes to.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import hot_group_rows

HOT_SHARES = 32_768
SAMPLED = 64
RANGE = "__range"


def order_columns(order: Sequence[str]) -> list[Column]:
    """``"x"`` ascending, ``"-x"`` descending; missing values last both ways."""
    return [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in order
    ]


def _from(bound: Column, order: Sequence[str]) -> Column:
    """Whether a row stands at or behind ``bound`` (a struct of order values), as the sort order has it."""
    reached = F.lit(True)
    for i, name in reversed(list(enumerate(order))):
        own, cut = F.col(name.lstrip("-")), bound[f"o{i}"]
        passed = cut > own if name.startswith("-") else cut < own
        missing_after = cut.isNotNull() & own.isNull()
        reached = missing_after | F.coalesce(passed, F.lit(False)) | (cut.eqNullSafe(own) & reached)
    return reached


def _place(bounds: Column, order: Sequence[str]) -> Column:
    """How many of the ordered bounds a row has reached, by halving."""
    state = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.floor((low + high) / 2).cast("int")
        reached = _from(F.get(bounds, middle), order)
        more = F.struct(
            F.when(reached, middle + 1).otherwise(low).alias("low"), F.when(reached, high).otherwise(middle).alias("high"))
        return F.when(low < high, more).otherwise(state)

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(bounds) + 1)).cast("int"))
    return F.aggregate(rounds, state, halve, lambda s: s["low"])


@dataclass(frozen=True)
class Split:
    """Which keys are hot and the order values that cut them."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: DataFrame | None = None
    large: bool = False  # some key has more rows than the hot-group size, split or not

    @property
    def active(self) -> bool:
        return self.hot is not None

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the range number: 0, 1, .. inside hot keys, -1 elsewhere."""
        if self.keys:
            matched = [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in self.keys]
            cut = df.join(F.broadcast(self.hot), matched, "left").drop(*[f"__hot_{k}" for k in self.keys])
        else:
            cut = attach(df, self.hot, [])
        bounds = F.col("__bounds")
        place = F.when(bounds.isNull(), F.lit(-1)).otherwise(_place(bounds, self.order))
        return cut.withColumn(RANGE, place.cast("int")).drop("__bounds")


def hot_split(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int | None = None
) -> Split:
    """Count the keys in one pre-aggregated pass; only if some are hot, a second
    pass over a sample of their rows picks the order values to cut at.
    """
    spark = df.sparkSession
    floor = hot_group_rows(spark) if hot_rows is None else hot_rows
    keys, order = list(keys), list(order)
    plain = Split(tuple(keys), tuple(order))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    found = sizes.where(F.col("__rows") > floor).orderBy(F.col("__rows").desc()).limit(HOT_SHARES + 1).collect()
    if not found:
        return plain
    total = df.count() if keys else found[0]["__rows"]
    limit = max(floor, -(-total // HOT_SHARES))
    pieces = [(*(r[k] for k in keys), int(-(-2 * r["__rows"] // limit))) for r in found if r["__rows"] > limit]
    if not pieces:
        return replace(plain, large=True)
    key_fields = [T.StructField(f"__hot_{k}", df.schema[k].dataType) for k in keys]
    counted = spark.createDataFrame(pieces, T.StructType([*key_fields, T.StructField("__pieces", T.IntegerType())]))
    columns = list(dict.fromkeys([*keys, *(name.lstrip("-") for name in order)]))
    rows = df.select(*columns)
    if keys:
        rows = rows.join(F.broadcast(counted), [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys]).drop(
            *[f"__hot_{k}" for k in keys])
    else:
        rows = rows.withColumn("__pieces", F.lit(pieces[0][-1]))
    hot_total = sum(r["__rows"] for r in found if r["__rows"] > limit)
    share = SAMPLED * sum(p[-1] for p in pieces) / hot_total
    if share < 1:
        rows = rows.where(F.rand(11) < share)
    within = Window.partitionBy(*keys)
    numbered = rows.withColumn("__no", F.row_number().over(within.orderBy(*order_columns(order)))).withColumn(
        "__n", F.count(F.lit(1)).over(within))
    step = lambda no: F.floor(no * F.col("__pieces") / F.col("__n"))
    opening = (F.col("__no") > 1) & (step(F.col("__no") - 1) > step(F.col("__no") - 2))
    value = F.struct(*[F.col(name.lstrip("-")).alias(f"o{i}") for i, name in enumerate(order)])
    cuts = numbered.where(opening).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("__no", value.alias("__value")))).alias("__all"))
    made = cuts.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], F.col("__all.__value").alias("__bounds"))
    bounds = made.collect()
    if not bounds:
        return replace(plain, large=True)
    return replace(plain, hot=spark.createDataFrame(bounds, made.schema), large=True)


def whole_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Split:
    """No splitting, for keys that are small by their nature; saves the profile pass."""
    return Split(tuple(keys), tuple(order))


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    running: Mapping[str, str] | None = None,
    fill: Mapping[str, str] | None = None,
    first: Mapping[str, str] | None = None,
    number: str | None = None,
    size: str | None = None,
    split: Split | None = None,
) -> DataFrame:
    """Add order-aware columns, ``{new: source}`` each, within ``keys`` by ``order``.

    ``lag``/``lead`` shift by one row, ``running`` is the inclusive running sum,
    ``fill`` the latest non-missing value so far, ``first`` the value in the key's first
    row, ``number`` counts from 1, ``size`` is the number of rows of the key.
    """
    lag, lead = dict(lag or {}), dict(lead or {})
    running, fill, first = dict(running or {}), dict(fill or {}), dict(first or {})
    keys = list(keys)
    if split is None:
        split = hot_split(df, keys, order)
    by = order_columns(order)
    carry_range = RANGE in df.columns
    if not split.active:
        window = Window.partitionBy(*keys).orderBy(*by)
        so_far = window.rowsBetween(Window.unboundedPreceding, 0)
        new = {out: F.lag(src).over(window) for out, src in lag.items()}
        new |= {out: F.lead(src).over(window) for out, src in lead.items()}
        new |= {out: F.sum(src).over(so_far) for out, src in running.items()}
        new |= {out: F.last(src, ignorenulls=True).over(so_far) for out, src in fill.items()}
        new |= {out: F.first(src).over(so_far) for out, src in first.items()}
        if number:
            new[number] = F.row_number().over(window)
        if size:
            new[size] = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        return df.select("*", *[column.alias(out) for out, column in new.items()])

    tagged = df if carry_range else split.tag(df)
    local = Window.partitionBy(*keys, RANGE).orderBy(*by)
    so_far = local.rowsBetween(Window.unboundedPreceding, 0)

    # edge rows by their place in the very order that the windows use
    sources = dict.fromkeys([*keys, *(o.lstrip("-") for o in order), *lag.values(), *lead.values(),
                             *running.values(), *fill.values(), *first.values()])
    placed = tagged.where(F.col(RANGE) >= 0).select(*sources, RANGE).withColumn("__place", F.row_number().over(local))
    place = F.col("__place")
    edge = [F.count(F.lit(1)).alias("__n")]
    edge += [F.max_by(src, place).alias(f"__lag_{out}") for out, src in lag.items()]
    edge += [F.min_by(src, place).alias(f"__lead_{out}") for out, src in lead.items()]
    edge += [F.sum(src).alias(f"__sum_{out}") for out, src in running.items()]
    edge += [
        F.max_by(src, F.when(F.col(src).isNotNull(), place)).alias(f"__fill_{out}")
        for out, src in fill.items()
    ]
    edge += [F.min_by(src, place).alias(f"__first_{out}") for out, src in first.items()]
    edges = placed.groupBy(*keys, RANGE).agg(*edge)
    across = Window.partitionBy(*keys).orderBy(RANGE)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum("__n").over(earlier).alias("__n"), F.sum("__n").over(Window.partitionBy(*keys)).alias("__all")]
    carried += [F.lag(f"__lag_{out}").over(across).alias(f"__lag_{out}") for out in lag]
    carried += [F.lead(f"__lead_{out}").over(across).alias(f"__lead_{out}") for out in lead]
    carried += [F.sum(f"__sum_{out}").over(earlier).alias(f"__sum_{out}") for out in running]
    carried += [
        F.last(f"__fill_{out}", ignorenulls=True).over(earlier).alias(f"__fill_{out}")
        for out in fill
    ]
    carried += [
        F.first(f"__first_{out}").over(across.rowsBetween(Window.unboundedPreceding, 0)).alias(f"__first_{out}")
        for out in first
    ]
    carry = edges.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys], F.col(RANGE).alias("__key_range"), *carried
    )
    new = {}
    for out, src in lag.items():
        opening = F.row_number().over(local) == 1
        new[out] = F.when(opening, F.col(f"__lag_{out}")).otherwise(F.lag(src).over(local))
    for out, src in lead.items():
        final = F.lead(F.lit(1)).over(local).isNull()
        new[out] = F.when(final, F.col(f"__lead_{out}")).otherwise(F.lead(src).over(local))
    for out, src in running.items():
        here, before = F.sum(src).over(so_far), F.col(f"__sum_{out}")
        new[out] = F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)
    for out, src in fill.items():
        new[out] = F.coalesce(F.last(src, ignorenulls=True).over(so_far), F.col(f"__fill_{out}"))
    for out, src in first.items():
        in_hot_key = F.col("__all").isNotNull()
        new[out] = F.when(in_hot_key, F.col(f"__first_{out}")).otherwise(F.first(src).over(so_far))
    if number:
        before = F.coalesce(F.col("__n"), F.lit(0))
        new[number] = (F.row_number().over(local) + before).cast("int")
    if size:
        new[size] = F.coalesce(F.col("__all"), F.count(F.lit(1)).over(Window.partitionBy(*keys, RANGE)))
    matched = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    matched.append(F.col(RANGE) == F.col("__key_range"))
    kept = df.columns if carry_range else [c for c in tagged.columns if c != RANGE]
    return tagged.join(F.broadcast(carry), matched, "left").select(
        *[F.col(f"`{c}`") for c in kept], *[column.alias(out) for out, column in new.items()]
    )


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    by: str | Sequence[str],
    *,
    low: str | None = None,
    average: str | None = None,
    dense: str | None = None,
    share: str | None = None,
    cumulative: str | None = None,
    split: Split | None = None,
) -> DataFrame:
    """Rank rows within ``keys``: lowest, average-on-ties, dense, percent, cumulative.

    Hot keys are ranked on their distinct values (counted first), so heavy ties cost
    one row each and the remaining values are split by range.
    """
    keys = list(keys)
    order = [by] if isinstance(by, str) else list(by)
    values = [name.lstrip("-") for name in order]
    if split is None:
        split = hot_split(df, keys, order)
    if not split.active:
        window = Window.partitionBy(*keys).orderBy(*order_columns(order))
        tied = F.count(F.lit(1)).over(Window.partitionBy(*keys, *values))
        new = {}
        if low:
            new[low] = F.rank().over(window)
        if average:
            new[average] = F.rank().over(window) + (tied - 1) / 2.0
        if dense:
            new[dense] = F.dense_rank().over(window)
        if share:
            new[share] = F.percent_rank().over(window)
        if cumulative:
            new[cumulative] = F.cume_dist().over(window)
        return df.select("*", *[column.alias(out) for out, column in new.items()])

    on = list(dict.fromkeys([*keys, *values]))
    tied = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__tied"))
    ranked = scan(tied, keys, order, running={"__upto": "__tied"}, number="__dense", split=split)
    first = F.col("__upto") - F.col("__tied") + 1
    new = {}
    if low:
        new[low] = first.cast("int")
    if average:
        new[average] = first + (F.col("__tied") - 1) / 2.0
    if dense:
        new[dense] = F.col("__dense")
    if share:
        new[share] = F.coalesce(F.try_divide(first - 1, F.col("__size") - 1), F.lit(0.0))
    if cumulative:
        new[cumulative] = F.col("__upto") / F.col("__size")
    joined = attach(df, ranked.select(*on, "__upto", "__tied", "__dense"), on)
    if share or cumulative:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
        joined = attach(joined, sizes, keys, measure=True)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(o) for o, c in new.items()])


FEW_ROWS = 10_000


def attach(
    df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", measure: bool = False
) -> DataFrame:
    """Join one row per key back to the rows, missing keys matching each other.

    Without keys the table is a single row, read as a scalar subquery, not a cross join.
    ``measure`` counts the table's keys first (only key columns are read for that) and
    broadcasts up to ``FEW_ROWS`` of them, which saves shuffling all rows; a larger
    table is joined by shuffle, where Spark splits skewed keys.
    """
    keys = list(keys)
    extra = [c for c in table.columns if c not in keys]
    if not keys:
        joined = df.withColumn("__row", table.select(F.struct(*extra).alias("row")).scalar())
        return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                             *[F.col("__row").getField(c).alias(c) for c in extra])
    renamed = table.select(*[F.col(k).alias(f"__at_{k}") for k in keys], *extra)
    if measure and table.select(*keys).limit(FEW_ROWS + 1).count() <= FEW_ROWS:
        renamed = F.broadcast(renamed)
    matched = [F.col(k).eqNullSafe(F.col(f"__at_{k}")) for k in keys]
    return df.join(renamed, matched, how).drop(*[f"__at_{k}" for k in keys])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``; a map-side combined aggregate, no sort.

    Every order column must be non-decreasing in time; the last one breaks ties.
    """
    rest = [c for c in df.columns if c not in keys]
    present = [F.struct(F.col(c).isNotNull(), F.col(c)) for c in order]
    row = F.max_by(F.struct(*rest), F.struct(*present))
    picked = df.groupBy(*keys).agg(row.alias("__row"))
    return picked.select(*keys, *[F.col("__row").getField(c).alias(c) for c in rest]).select(*df.columns)


def blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int, drop_last: int = 0
) -> DataFrame:
    """Cut the ordered rows of each key into ``count`` equal blocks, numbered from 1.

    ``block`` and ``position`` are added; the last ``drop_last`` rows of each block go.
    """
    numbered = scan(df, keys, order, number="__number", size="__size")
    numbered = numbered.withColumn("__length", F.floor(F.col("__size") / count))
    zero_based = F.col("__number") - 1
    length = F.greatest(F.col("__length"), F.lit(1))
    placed = (
        numbered.withColumn("block", (F.floor(zero_based / length) + 1).cast("int"))
        .withColumn("position", (zero_based % length + 1).cast("int"))
        .where(F.col("block") <= count)
        .where(F.col("position") <= F.col("__length") - drop_last)
    )
    return placed.drop("__number", "__size", "__length")


TOP_PARTS = 64


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows per key. Spark limits each task's rows before the shuffle.

    With a large key, each of ``TOP_PARTS`` hashed parts of a key is cut to its first
    ``n`` rows beforehand, so the last step sees at most ``n * TOP_PARTS`` rows of a key.
    """

    def first(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order_columns(order))
        return rows.withColumn("__n", F.row_number().over(window)).where(F.col("__n") <= n).drop("__n")

    floor = hot_group_rows(df.sparkSession)
    if not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c")).where(F.col("__c") > floor).isEmpty():
        part = F.pmod(F.xxhash64(*[F.col(name.lstrip("-")) for name in order]), F.lit(TOP_PARTS))
        df = first(df.withColumn("__part", part), [*keys, "__part"]).drop("__part")
    return first(df, keys)


def running_record(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], win: str
) -> DataFrame:
    """Game number, wins so far and games in total, per row."""
    return scan(df, keys, order, running={"wins_so_far": win}, number="game_no", size="games")
