"""Reproducible sampling and bootstrap, ordered or weighted by hashes."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.ordered import top_per_key


def draw_key(seed: int, *ids: str) -> Column:
    """A hash text that fixes the draw order of a row."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def sample_per_group(
    df: DataFrame, keys: Sequence[str], ids: Sequence[str], n: int, seed: int
) -> DataFrame:
    """``n`` rows per group; groups of at most ``n`` rows stay whole."""
    drawn = df.withColumn("__draw", draw_key(seed, *ids))
    return top_per_key(drawn, keys, ["__draw", *ids], n).drop("__draw")


# Cumulative Poisson(1) probabilities.
POISSON_STEPS = (
    0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
    0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253,
    0.9999988747974149, 0.9999998885745217,
)


COPIES_PER_HASH = 8  # a hash has 128 bits, a weight takes 16 of them
FIELD = 1 << 16


def poisson_weight(seed: int, copy: Column, *ids: str) -> Column:
    """How often a row occurs in one bootstrap copy (Poisson with mean 1)."""
    block = F.floor((copy - 1) / COPIES_PER_HASH)
    place = (copy - 1) % COPIES_PER_HASH
    return _weight(F.conv(F.substr(_block_hash(seed, block, ids), (place * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("long"))


def _block_hash(seed: int, block: Column, ids: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids], block.cast("string")))


def _weight(field: Column) -> Column:
    """The number of steps that a 16-bit draw reaches; most draws are decided by the first comparisons."""
    weight = F
    for count, step in enumerate(POISSON_STEPS):
        weight = weight.when(field < math.ceil(step * FIELD), count)
    return weight.otherwise(len(POISSON_STEPS))


def _words(text: Column) -> list[Column]:
    """The hash as three whole numbers of 48, 48 and 32 bits: each is read once for up to three weights."""
    return [F.conv(F.substr(text, F.lit(1 + at), F.lit(size)), 16, 10).cast("long") for at, size in ((0, 12), (12, 12), (24, 8))]


def _field(i: int) -> Column:
    """The ``i``-th 16 bits of the words __h0, __h1 and __h2."""
    word, place = divmod(i, 3)
    size = 3 if word < 2 else 2
    return F.shiftright(F.col(f"__h{word}"), 16 * (size - 1 - place)).bitwiseAND(F.lit(FIELD - 1))


def bootstrap_means(
    df: DataFrame, keys: Sequence[str], value: str, ids: Sequence[str], copies: int, seed: int
) -> DataFrame:
    """Mean of each bootstrap copy per group: ``copies`` rows per group.

    A row is hashed once for every eight copies and never leaves its task in copies: each
    task adds up the weights of all copies and only those partial sums are shuffled.
    """
    blocks = -(-copies // COPIES_PER_HASH)
    drawn = (
        df.where(F.col(value).isNotNull())
        .select(*keys, value, *[c for c in ids if c not in keys and c != value],
                F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__block"))
        .withColumn("__hash", _block_hash(seed, F.col("__block"), ids))
    )
    drawn = drawn.withColumns({f"__h{i}": word for i, word in enumerate(_words(F.col("__hash")))})
    drawn = drawn.withColumns({f"__w{i}": _weight(_field(i)) for i in range(COPIES_PER_HASH)})
    each = [F.struct(F.sum(f"__w{i}").alias("n"), F.sum(F.col(f"__w{i}") * F.col(value)).alias("__s")) for i in range(COPIES_PER_HASH)]
    sums = drawn.groupBy(*keys, "__block").agg(F.array(*each).alias("__sums"))
    sums = sums.select(*keys, "__block", F.posexplode("__sums").alias("__i", "__sum"))
    sums = sums.select(*keys, (F.col("__block") * COPIES_PER_HASH + F.col("__i") + 1).cast("int").alias("copy"), "__sum.*")
    return sums.where((F.col("n") > 0) & (F.col("copy") <= copies)).select(*keys, "copy", "n", (F.col("__s") / F.col("n")).alias("mean"))
