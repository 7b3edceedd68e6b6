from __future__ import annotations

import numpy as np
import pytest

from touchline.operators.quantiles import quantiles, quantiles_long
from touchline.plans import describe


def data(spark, rows=900):
    random = np.random.default_rng(4)
    made = [(int(k), float(v)) for k, v in zip(np.minimum(random.integers(0, 40, rows), 3), random.normal(size=rows).round(1))]
    return made, spark.createDataFrame([*made, (1, None)], "k int, v double")


def test_quantiles_match_numpy(spark, sizes):
    rows, df = data(spark)
    cuts = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.731, "e": 1.0}
    for r in quantiles(df, ["k"], "v", cuts).collect():
        values = [v for k, v in rows if k == r["k"]]
        for name, p in cuts.items():
            assert r[name] == pytest.approx(np.quantile(values, p), abs=1e-12)
    whole = quantiles(df, [], "v", cuts).first()
    assert whole["d"] == pytest.approx(np.quantile([v for _, v in rows], 0.731), abs=1e-12)


def test_summary_and_boxplot(spark, sizes):
    rows, df = data(spark)
    values = np.array([v for k, v in rows if k == 3])
    got = {r["k"]: r for r in describe.summary(df, ["k"], ["v"]).collect()}[3]
    assert (got["n"], got["lowest"], got["highest"]) == (len(values), values.min(), values.max())
    assert got["iqr"] == pytest.approx(np.quantile(values, 0.75) - np.quantile(values, 0.25))
    box = {r["k"]: r for r in describe.boxplot(df, ["k"], "v").collect()}[3]
    q1, q3 = np.quantile(values, [0.25, 0.75])
    inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
    assert (box["low_whisker"], box["high_whisker"], box["n_outliers"]) == (
        inside.min(), inside.max(), len(values) - len(inside))
    found = describe.outliers(df, ["k"], "v").where("k = 3").count()
    assert found == len(values) - len(inside)


def test_several_columns(spark, sizes):
    _, df = data(spark)
    both = df.withColumn("w", df.v * 2)
    rows = {(r["k"], r["measure"]): r["m"] for r in quantiles_long(both, ["k"], ["v", "w"], {"m": 0.5}).collect()}
    assert all(rows[(k, "w")] == pytest.approx(2 * rows[(k, "v")]) for k in range(4))


def test_normal_quantiles_and_histogram(spark, sizes):
    rows, df = data(spark)
    values = np.array([v for _, v in rows])
    for r in describe.normal_quantiles(df, "v", 9).collect():
        assert r["sample"] == pytest.approx(np.quantile(values, (r["point"] - 0.5) / 9), abs=1e-9)
    got = [r["n"] for r in describe.histogram(df, "v", 7).orderBy("bin").collect()]
    low, high = values.min(), values.max()
    bins = np.minimum(np.floor((values - low) / (high - low) * 7), 6).astype(int)
    assert got == [int((bins == i).sum()) for i in range(7)]


def test_large_groups_below_the_split_size_are_counted(spark, hot, monkeypatch):
    from touchline.operators import ordered

    monkeypatch.setattr(ordered, "HOT_SHARES", 1)
    rows, df = data(spark)
    split = ordered.hot_split(df, ["k"], ["v"])
    assert split.large and not split.active
    for r in quantiles(df, ["k"], "v", {"m": 0.5}).collect():
        assert r["m"] == pytest.approx(np.quantile([v for k, v in rows if k == r["k"]], 0.5), abs=1e-12)
    plan = quantiles(df, ["k"], "v", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan
