"""Packing into optimal length buckets, and batches of a token budget inside each bucket.

Texts longer than ``longest`` tokens are cut into pieces of that length and a rest. The global histogram of piece
lengths therefore has at most ``longest`` rows, whatever the data; dynamic programming over it
finds the bucket boundaries with the least padding. Inside a bucket pieces are numbered over
salted parts (offsets from counted parts), so no bucket is sorted in one task, and every ``budget //
boundary`` pieces form a batch.

Defined results: a missing length counts as 0, and a text of 0 tokens has no piece; ids may be
missing or repeat, each row is packed on its own; extra columns are ignored; an empty table gives
no rows.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import cut_lineage

LONGEST, BUCKETS, BUDGET = 2048, 8, 65_536
PART_ROWS = 100_000


def cut_into_pieces(df: DataFrame, id_column: str, length: str, longest: int = LONGEST) -> DataFrame:
    """(id, piece, start, length) of pieces of at most ``longest`` tokens."""
    n = F.coalesce(F.col(length), F.lit(0)).cast("long")
    pieces = df.select(F.col(f"`{id_column}`").alias("packed"), n.alias("total")).where("total > 0")
    each = pieces.select("packed", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / longest))).alias("piece"))
    start = F.col("piece") * longest
    return each.select(
        F.col("packed").alias(id_column), F.col("piece").cast("int").alias("piece"), start.alias("start"),
        F.least(F.col("total") - start, F.lit(longest)).cast("int").alias("length"))


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most ``buckets`` upper boundaries (the last is the largest length) with the least total padding."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    n = len(lengths)
    if not n:
        return []
    pieces = np.append(0, np.cumsum(counts))
    tokens = np.append(0, np.cumsum(counts * lengths))
    # least[j]: padding of the first j lengths in the buckets so far; one more bucket takes lengths i..j-1
    least = np.append(0, lengths * pieces[1:] - tokens[1:])
    choice = [np.zeros(n + 1, np.int64)]
    for _ in range(1, min(buckets, n)):
        new, came = least.copy(), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            cost = least[:j] + lengths[j - 1] * (pieces[j] - pieces[:j]) - (tokens[j] - tokens[:j])
            came[j] = int(cost.argmin())
            new[j] = cost[came[j]]
        least = new
        choice.append(came)
    ends, j, k = [], n, len(choice) - 1
    while j > 0:
        ends.append(int(lengths[j - 1]))
        j, k = int(choice[k][j]), k - 1
    return ends[::-1]


def boundaries(pieces: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> list[int]:
    """Bucket boundaries for all pieces, from their histogram of at most ``longest`` rows."""
    rows = pieces.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").limit(longest + 1).collect()
    if len(rows) > longest:
        raise ValueError(f"pieces have more than {longest} lengths")
    return best_boundaries([r["length"] for r in rows], [r["n"] for r in rows], buckets)


def packed(
    df: DataFrame, id_column: str, length: str, longest: int = LONGEST, buckets: int = BUCKETS, budget: int = BUDGET, part_rows: int = PART_ROWS
) -> DataFrame:
    """(id, piece, start, length, bucket, bucket_length, batch, place) of every piece; a batch is numbered inside its bucket."""
    pieces = cut_lineage(cut_into_pieces(df, id_column, length, longest).withColumn("row", F.monotonically_increasing_id()))
    ends = boundaries(pieces, buckets, longest) or [longest]
    table = F.array(*[F.lit(e) for e in ends])
    bucket = F.size(F.filter(table, lambda e: e < F.col("length")))
    parts = max(1, -(-pieces.count() // part_rows))
    dealt = pieces.withColumn("bucket", bucket).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    counted = dealt.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("row"))
    numbered = dealt.withColumn("own", own).join(offsets, ["bucket", "part"]).withColumn("no", F.col("own") - 1 + F.col("offset"))
    end = F.element_at(table, F.col("bucket") + 1)
    size = F.greatest(F.lit(1), F.floor(F.lit(budget) / end))
    return numbered.select(
        id_column, "piece", "start", "length", "bucket", end.alias("bucket_length"), F.floor(F.col("no") / size).alias("batch"),
        F.pmod(F.col("no"), size).cast("int").alias("place"))
