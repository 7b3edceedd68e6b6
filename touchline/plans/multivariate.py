"""Principal components and clusters."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.ordered import attach
from touchline.plans.regression import moments
from touchline.session import cut_lineage


class Components:
    """Principal components of standardised columns, from one pass of cross moments."""

    def __init__(self, df: DataFrame, columns: Sequence[str]):
        self.columns = list(columns)
        m = moments(df, columns)
        self.mean = m.mean
        self.sd = np.sqrt(np.diag(m.cross) / (m.n - 1))
        scale = np.sqrt(np.diag(m.cross))
        values, vectors = np.linalg.eigh(m.cross / np.outer(scale, scale))
        order = np.argsort(values)[::-1]
        self.variance = np.clip(values[order], 0, None)
        vectors = vectors[:, order]
        # sign: the first loading of a component that is not about 0 is positive
        lead = (np.abs(vectors) > 1e-9).argmax(axis=0)
        self.loadings = vectors * np.sign(vectors[lead, range(len(columns))])

    def shares(self, spark) -> DataFrame:
        share = self.variance / self.variance.sum()
        rows = [(i, float(np.sqrt(v)), float(s), float(c))
                for i, (v, s, c) in enumerate(zip(self.variance, share, share.cumsum()), 1)]
        return spark.createDataFrame(rows, "component int, sd double, share double, cumulative double")

    def loading_table(self, spark) -> DataFrame:
        rows = [(c, k + 1, float(self.loadings[i, k]))
                for i, c in enumerate(self.columns) for k in range(len(self.columns))]
        return spark.createDataFrame(rows, "variable string, component int, loading double")

    def scores(self, df: DataFrame, count: int) -> DataFrame:
        """Component scores as generated-code column sums."""
        for k in range(count):
            value = F.lit(0.0)
            for i, c in enumerate(self.columns):
                value = value + F.lit(float(self.loadings[i, k] / self.sd[i])) * (F.col(c) - F.lit(float(self.mean[i])))
            df = df.withColumn(f"pc{k + 1}", value)
        return df


def clusters(df: DataFrame, columns: Sequence[str], k: int, seed: int, kind: str = "kmeans", scale: bool = True, keep_features: bool = False):
    """Cluster numeric columns (or one array column) with Spark ML; returns labelled rows and model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import array_to_vector

    if len(columns) == 1 and df.schema[columns[0]].dataType.typeName() == "array":
        ready = df.withColumn("__raw", array_to_vector(F.col(columns[0])))
    else:
        ready = VectorAssembler(inputCols=list(columns), outputCol="__raw").transform(df.dropna(subset=list(columns)))
    maker = {"kmeans": KMeans, "bisecting": BisectingKMeans, "mixture": GaussianMixture}[kind]
    stages = [StandardScaler(inputCol="__raw", outputCol="features", withMean=True)] if scale else []
    stages.append(maker(k=k, seed=seed, featuresCol="features" if scale else "__raw", predictionCol="cluster"))
    model = Pipeline(stages=stages).fit(ready)
    kept = [*df.columns, "cluster"]
    kept += [F.col("features" if scale else "__raw").alias("__features")] if keep_features else []
    return model.transform(ready).select(*kept), model


def agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """How far two partitions of the rows agree: adjusted Rand index, purity of the second by the first,
    and mutual information over the mean of both entropies. One row, from the counted table of both; rows
    that miss a value are left out. Indices without a meaning (one group on both sides) are 1.
    """
    cells = cut_lineage(df.dropna(subset=[first, second]).groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(
        F.count(F.lit(1)).cast("double").alias("n")))
    pairs = lambda n: n * (n - 1) / 2
    sums = {c: cells.groupBy(c).agg(F.sum("n").alias("n"), F.max("n").alias("top")) for c in "ab"}
    n = F.col("n")
    log_sum = lambda c: F.sum(c * F.log(c))
    row = cells.agg(F.sum(n).alias("rows"), F.sum(pairs(n)).alias("pairs"), log_sum(n).alias("logs"))
    for c, table in sums.items():
        own = table.agg(F.sum(pairs(n)).alias(f"pairs_{c}"), log_sum(n).alias(f"logs_{c}"), F.sum("top").alias(f"top_{c}"), F.count(F.lit(1)).alias(f"groups_{c}"))
        row = attach(row, own, [])
    rows, base = F.col("rows"), F.log("rows")
    expected = F.col("pairs_a") * F.col("pairs_b") / F.nullif(pairs(rows), F.lit(0.0))
    most = (F.col("pairs_a") + F.col("pairs_b")) / 2
    rand = F.coalesce(F.try_divide(F.col("pairs") - expected, most - expected), F.lit(1.0))
    entropy = {c: base - F.col(f"logs_{c}") / rows for c in "ab"}
    shared = base + (F.col("logs") - F.col("logs_a") - F.col("logs_b")) / rows
    information = F.coalesce(F.try_divide(shared, (entropy["a"] + entropy["b"]) / 2), F.lit(1.0))
    return row.where("rows > 0").select(
        rows.cast("long").alias("rows"), "groups_a", "groups_b", rand.alias("adjusted_rand"), (F.col("top_b") / rows).alias("purity"),
        information.alias("shared_information"))


def silhouettes(df: DataFrame, columns: Sequence[str], counts: Sequence[int], seed: int, scale: bool = True) -> DataFrame:
    """(k, silhouette) of k-means with each number of clusters: how much nearer a row is to its own centre
    than to the next one, on average. Distances to all centres are one expression, so a fit is read once more."""
    from pyspark.ml.functions import vector_to_array

    rows = []
    for k in counts:
        if k < 2:
            raise ValueError("a silhouette compares two clusters or more")
        labelled, model = clusters(df, columns, k, seed, "kmeans", scale, keep_features=True)
        centres = [list(map(float, c)) for c in model.stages[-1].clusterCenters()]
        x = vector_to_array("__features")
        away = F.array_sort(F.array(*[
            F.sqrt(F.aggregate(F.zip_with(x, F.array(*[F.lit(v) for v in c]), lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d))
            for c in centres]))
        near = labelled.select(away.alias("d")).select(F.get("d", F.lit(0)).alias("own"), F.get("d", F.lit(1)).alias("next"))
        value = near.agg(F.avg(F.coalesce(F.try_divide(F.col("next") - F.col("own"), F.col("next")), F.lit(0.0)))).first()[0]
        rows.append((int(k), value))
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")
