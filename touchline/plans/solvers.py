"""Large sparse linear systems and orders, solved by joins and aggregates on long tables."""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.ordered import FEW_ROWS
from touchline.session import cut_lineage

MOST_ROUNDS = 2000


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has few rows (they were counted), else as it is."""
    return F.broadcast(df) if rows <= FEW_ROWS else df


def settled(df: DataFrame, rows: int) -> DataFrame:
    """The table as it is now: few rows (they were counted) are held as a local table, more are checkpointed."""
    if rows > FEW_ROWS:
        return cut_lineage(df)
    return df.sparkSession.createDataFrame(df.toPandas(), df.schema)


def conjugate_gradients(
    system: DataFrame, key: str, product: Callable[[DataFrame], DataFrame], shift: float = 0.0, tolerance: float = 1e-12, most: int = MOST_ROUNDS
) -> DataFrame:
    """(key, x, ..) with (B - m m' + shift I) x = right, symmetric and positive (semi)definite, where B is given by its products.

    ``system`` has one row per unknown: key, ``right``, ``mean`` (m) and ``diagonal`` (of the whole matrix). ``product`` gets
    a table (key, p) and returns (key, q) with q = B p, where missing keys stand for 0. Stops when the residual has shrunk to
    ``tolerance`` of the right side. Up to FEW_ROWS unknowns (they are counted) the vectors are held on the
    driver, and a round is one product; beyond that they are checkpointed tables.
    """
    system = cut_lineage(system)
    count = system.limit(FEW_ROWS + 1).count()
    solve = _near if count <= FEW_ROWS else _far
    return solve(system, key, product, shift, tolerance, most)


def _near(system: DataFrame, key: str, product, shift: float, tolerance: float, most: int) -> DataFrame:
    spark, held = system.sparkSession, system.toPandas()
    right, mean, diagonal = (held[c].to_numpy(float) for c in ("right", "mean", "diagonal"))
    usable = diagonal > 0
    scale = np.where(usable, 1 / np.where(usable, diagonal, 1.0), 0.0)
    kinds = f"`{key}` {system.schema[key].dataType.simpleString()}, p double"
    place = {k: i for i, k in enumerate(held[key])}

    def times(p: np.ndarray) -> np.ndarray:
        q = shift * p - mean * float(mean @ p)
        vector = held[[key]].assign(p=p)
        for row in product(F.broadcast(spark.createDataFrame(vector, kinds))).collect():
            q[place[row[0]]] += row[1]
        return q

    x, r = np.zeros(len(held)), right.copy()
    p = scale * r
    size = start = float(r @ p)
    for _ in range(most):
        if size <= start * tolerance * tolerance:
            break
        q = times(p)
        curve = float(p @ q)
        if curve <= 0:  # the direction changes nothing: what remains is rounding
            break
        x, r = x + size / curve * p, r - size / curve * q
        before, size = size, float(r @ (scale * r))
        p = scale * r + size / before * p
    else:
        raise ArithmeticError(f"conjugate gradients did not converge in {most} rounds")
    solution = held.assign(x=x)
    return spark.createDataFrame(solution, system.schema.add("x", "double")) if len(solution) else system.withColumn("x", F.lit(0.0))


def _far(system: DataFrame, key: str, product, shift: float, tolerance: float, most: int) -> DataFrame:
    state = system.withColumns({"x": F.lit(0.0), "r": F.col("right"), "p": F.coalesce(F.try_divide("right", "diagonal"), F.lit(0.0))})
    size = F.coalesce(F.sum(F.try_divide(F.col("r") * F.col("r"), F.col("diagonal"))), F.lit(0.0))
    held = start = state.agg(size).first()[0]
    for _ in range(most):
        if held <= start * tolerance * tolerance:
            return state.drop("r", "p")
        middle = state.agg(F.sum(F.col("mean") * F.col("p"))).first()[0]
        q = product(state.select(key, "p")).withColumnRenamed("q", "__q")
        whole = F.coalesce("__q", F.lit(0.0)) + F.lit(shift) * F.col("p") - F.col("mean") * F.lit(middle)
        moved = cut_lineage(state.join(q, key, "left").withColumn("q", whole).drop("__q"))
        curve = moved.agg(F.sum(F.col("p") * F.col("q"))).first()[0]
        if curve <= 0:
            return state.drop("r", "p")
        step = F.lit(held / curve)
        moved = moved.withColumns({"x": F.col("x") + step * F.col("p"), "r": F.col("r") - step * F.col("q")}).drop("q")
        before, held = held, moved.agg(size).first()[0]
        onward = F.coalesce(F.try_divide("r", "diagonal"), F.lit(0.0)) + F.lit(held / before) * F.col("p")
        state = moved.withColumn("p", onward)
    raise ArithmeticError(f"conjugate gradients did not converge in {most} rounds")


def connected(edges: DataFrame, first: str, second: str) -> DataFrame:
    """(node, label) of an undirected graph: the smallest node each is connected with. A round takes the
    smallest label among neighbours and then that of the node it names, so long paths shorten quickly."""
    pairs = edges.select(F.col(first).alias("a"), F.col(second).alias("b")).where(F.col("a") != F.col("b"))
    both = cut_lineage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        drawn = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jumped = drawn.join(drawn.select(F.col("node").alias("new"), F.col("new").alias("further")), "new", "left")
        moved = cut_lineage(jumped.select("node", "label", F.least("new", F.coalesce("further", "new")).alias("new")))
        changed = moved.where(F.col("new") != F.col("label")).limit(1).count()
        labels = moved.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def reaches_all(edges: DataFrame, source: str, target: str) -> bool:
    """Whether every node of a directed graph is reached from one of them, and reaches it."""
    links = cut_lineage(edges.select(F.col(source).alias("a"), F.col(target).alias("b")).distinct())
    nodes = links.select(F.explode(F.array("a", "b")).alias("n")).distinct()
    total, start = nodes.count(), nodes.agg(F.min("n")).first()[0]
    for here, there in (("a", "b"), ("b", "a")):
        seen, count = nodes.where(F.col("n") == start), 1
        while count < total:
            next_ = links.join(seen.select(F.col("n").alias(here)), here).select(F.col(there).alias("n"))
            seen = cut_lineage(seen.select("n").unionByName(next_).distinct())
            before, count = count, seen.count()
            if count == before:
                return False
    return True
