"""Mixing sources to target weights by systematic sampling.

Sources share a total of words by weight; a source's target stops at a multiple of its words and the
excess goes to the others by weight. Within a source every document expects the same number of
copies. These expectations are summed up in order of size, one random offset is added, and a
document is emitted once for each integer boundary that its stretch of the sum crosses.

The order by size bounds the error: the words taken of a source differ from its target by at most
its largest document (and a rounding of 2^-24 of its words), and no document is taken more than
``most`` times. Sums are integers (copies x 2^24), so they do not depend on how the rows are dealt.

Rows are dealt by ranges of (source, size, id), whatever a source holds of all rows; their sums are
carried from range to range through one row for each range and source. Nothing is joined on the
source alone. What a rerun takes depends on the rows and the seed only.

Defined results: a missing text has size 0; a missing source is a source of its own, the last one;
missing ids come last and repeated ids are rows of their own, in the order of the kept columns;
documents of size 0 are drawn like others and take 0 words, and a source of such documents alone
has target 0 and no copies; extra columns are ignored unless kept, and a kept column that has the name
of a result is left out; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
ONE = 1 << 24
PART_ROWS = 1_000_000


def ranged(rows: DataFrame, keys: Sequence[str], part_rows: int = PART_ROWS) -> DataFrame:
    """The rows dealt by ranges of their order (missing values last), with the number of the range."""
    order = [F.col(k).asc_nulls_last() for k in keys]
    parts = max(1, -(-rows.count() // part_rows))
    return cut_lineage(rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()))


def numbered_sources(held: DataFrame, weights: Sequence[float]) -> DataFrame:
    """(source, n, words, weight) from (range, source, n, words): sources in code-point order take the weights in turn.

    Ranges follow the sources, so a source is numbered among those that begin in its range, behind all
    that begin in ranges before.
    """
    sources = held.groupBy("source").agg(F.min("range").alias("range"), F.sum("n").alias("n"), F.sum("words").alias("words"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    begun = sources.groupBy("range").agg(F.count("*").alias("begun")).select(
        "range", F.coalesce(F.sum("begun").over(before), F.lit(0)).alias("begun"))
    own = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.pmod(F.col("begun") + F.col("own"), F.lit(len(weights))).cast("int")
    return sources.withColumn("own", own).join(begun, "range").select(
        "source", "n", "words", F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).alias("weight"))


def with_targets(sources: DataFrame, share: tuple[int, int], most: int) -> DataFrame:
    """Adds ``target``: sources below their limit get words in proportion to weight, the others their limit.

    Every round fixes the sources that would pass their limit; the rest is shared anew, until none passes.
    """
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    cap = F.lit(most * share[1]) * exact("words")
    whole = sources.agg(F.coalesce(F.sum(exact("words")), F.lit(0)).alias("w"), F.coalesce(F.sum("weight"), F.lit(0)).alias("v")).first()
    total, weight = int(whole["w"]) * share[0], int(whole["v"])
    rest, open_weight = total, weight
    while open_weight:
        # the limit of a source against its share, in whole numbers
        full = cap * F.lit(open_weight) <= exact("weight") * F.lit(rest)
        fixed = sources.where(full).agg(F.coalesce(F.sum(cap), F.lit(0)).alias("w"), F.coalesce(F.sum("weight"), F.lit(0)).alias("v")).first()
        if weight - int(fixed["v"]) == open_weight:
            break
        rest, open_weight = total - int(fixed["w"]), weight - int(fixed["v"])
    limit = (F.col("words") * most).cast("double")
    part = F.lit(rest / share[1]) * F.col("weight") / F.lit(float(open_weight)) if open_weight else limit
    return sources.withColumn("target", F.least(limit, part))


def offset(source: Column, seed: int) -> Column:
    """A random part of one copy for each source."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(source.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 6), 16, 10).cast("long")


def mixed(
    docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text", weights: Sequence[int] = (5, 2, 1),
    share: tuple[int, int] = (3, 2), most: int = 2, seed: int = 42, keep: Sequence[str] = (), part_rows: int = PART_ROWS,
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) of every document, and the columns ``keep``.

    The mix has ``share`` (a fraction) of all words. ``weights`` are whole numbers, given to the sources in turn.
    """
    results = (id_column, "source", "size", "source_size", "target", "copies", "taken")
    size = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    kept = [F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(0)
    rows = docs.select(
        F.col(f"`{source}`").alias("source"), size.alias("size"), F.col(f"`{id_column}`").alias("id"), tie.alias("tie"), *kept)
    order = ["size", "id", "tie"]
    rows = ranged(rows, ["source", *order], part_rows)
    held = cut_lineage(rows.groupBy("range", "source").agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    sources = with_targets(cut_lineage(numbered_sources(held, weights)), share, most)
    step = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words") * ONE)).otherwise(0).cast("long")
    steps = sources.select(
        F.col("source").alias("of"), F.col("words").alias("source_size"), "target", step.alias("step"), offset(F.col("source"), seed).alias("offset"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(steps, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("range").alias("at"), "of", "source_size", "target", "step", (F.col("offset") + F.col("before") * F.col("step")).alias("begin"))
    joined = rows.join(carried, (F.col("range") == F.col("at")) & F.col("source").eqNullSafe(F.col("of")))
    inside = Window.partitionBy("range", "source").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    end = F.col("begin") + F.sum("step").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    crossed = joined.withColumn("end", end).withColumn("copies", F.shiftright("end", 24) - F.shiftright(F.col("end") - F.col("step"), 24))
    return crossed.select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep) if c not in results])


def emitted(mix: DataFrame) -> DataFrame:
    """The rows of the mix themselves: each document as often as it is taken, with ``copy`` 1, 2, .."""
    return mix.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")
