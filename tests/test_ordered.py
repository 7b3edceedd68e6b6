"""Windows against pandas, with plain keys and with split hot keys."""
from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.operators import ordered


def log(rows=600, seed=1, ties=False):
    """One key holds most rows, a missing key and missing values occur."""
    random = np.random.default_rng(seed)
    key = np.where(random.random(rows) < 0.5, 1, random.integers(2, 30, rows)).astype(float)
    key[random.random(rows) < 0.1] = np.nan
    frame = pd.DataFrame({
        "k": pd.array(key, dtype="Int64"), "id": random.permutation(rows) * 3,
        "x": pd.array(random.integers(0, 12 if ties else 500, rows), dtype="Int64"),
        "s": random.choice(["a", "b", None], rows),
    })
    frame.loc[random.random(rows) < 0.2, "x"] = pd.NA
    return frame


def frame_of(spark, data):
    rows = [tuple(None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r)
            for r in data.itertuples(index=False)]
    return spark.createDataFrame(rows, "k long, id long, x long, s string")


def plain(value):
    return None if value is None or pd.isna(value) else value


def expected_scan(data, descending=False):
    out = {}
    for _, group in data.groupby("k", dropna=False):
        group = group.sort_values("id", ascending=not descending)
        total, seen, before, kept = None, 0, None, None
        ids = list(group["id"])
        for i, row in enumerate(group.itertuples()):
            seen += 1
            if not pd.isna(row.x):
                total = (total or 0) + row.x
            if row.s is not None:
                kept = row.s
            after = plain(group.iloc[i + 1]["x"]) if i + 1 < len(ids) else None
            out[row.id] = (before, after, total, kept, seen)
            before = plain(row.x)
    return out


@pytest.mark.parametrize("descending", [False, True])
def test_scan_matches_pandas(spark, sizes, descending):
    data = log()
    df = frame_of(spark, data)
    order = ["-id"] if descending else ["id"]
    split = ordered.hot_split(df, ["k"], order)
    assert split.active == (sizes == "hot")
    made = ordered.scan(df, ["k"], order, lag={"before": "x"}, lead={"after": "x"}, running={"total": "x"},
                        fill={"kept": "s"}, first={"head": "x"}, number="no", size="rows", split=split)
    assert made.columns == ["k", "id", "x", "s", "before", "after", "total", "kept", "head", "no", "rows"]
    heads = {k: g.sort_values("id", ascending=not descending).iloc[0]["x"] for k, g in data.dropna(subset=["k"]).groupby("k")}
    counts = data.groupby("k", dropna=False)["id"].size()
    for r in made.where("k is not null").collect():
        assert r["head"] == plain(heads[r["k"]]) and r["rows"] == counts[r["k"]]
    got = {r["id"]: (r["before"], r["after"], r["total"], r["kept"], r["no"]) for r in made.collect()}
    assert got == expected_scan(data, descending)


def test_scan_without_keys(spark, sizes):
    data = log().assign(k=1)
    data["k"] = data["k"].astype("Int64")
    made = ordered.scan(frame_of(spark, data), [], ["id"], lag={"before": "x"}, lead={"after": "x"},
                        running={"total": "x"}, fill={"kept": "s"}, number="no")
    got = {r["id"]: (r["before"], r["after"], r["total"], r["kept"], r["no"]) for r in made.collect()}
    assert got == expected_scan(data)


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz", "date", "double"])
def test_scan_orders_by_other_types(spark, sizes, kind):
    rows = [(1, f"{i:05d}" if kind == "string" else i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, raw string" if kind == "string" else "k int, raw int")
    if kind == "timestamp_ntz":
        df = df.withColumn("o", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, raw)"))
    elif kind == "date":
        df = df.withColumn("o", F.date_add(F.lit("2024-01-01").cast("date"), F.col("raw")))
    else:
        df = df.withColumn("o", F.col("raw").cast(kind))
    made = ordered.scan(df, ["k"], ["o"], number="no").collect()
    assert all(r["no"] == int(r["raw"]) + 1 for r in made)


def test_hot_keys_are_bounded_and_balanced(spark, hot):
    df = frame_of(spark, log(rows=2000))
    split = ordered.hot_split(df, ["k"], ["id"])
    tagged = split.tag(df)
    assert tagged.count() == 2000
    largest = tagged.groupBy("k", ordered.RANGE).count().agg(F.max("count")).first()[0]
    assert largest <= 60
    assert split.hot.count() <= ordered.HOT_SHARES


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_match_pandas(spark, sizes, descending):
    data = log(ties=True)
    data["x"] = data["x"].fillna(-1 if descending else 99)
    df = frame_of(spark, data)
    made = ordered.ranks(df, ["k"], "-x" if descending else "x", low="low", average="average", dense="dense",
                         share="share", cumulative="upto")
    by = data.assign(x=data["x"].astype(float)).groupby("k", dropna=False)["x"]
    way = {"ascending": not descending}
    want = pd.DataFrame({"id": data["id"], "low": by.rank("min", **way), "average": by.rank("average", **way),
                         "dense": by.rank("dense", **way), "size": by.transform("size"), "top": by.rank("max", **way)})
    want = {r.id: r for r in want.itertuples()}
    for r in made.collect():
        w = want[r["id"]]
        assert (r["low"], r["average"], r["dense"]) == (w.low, w.average, w.dense)
        assert r["share"] == pytest.approx((w.low - 1) / (w.size - 1) if w.size > 1 else 0.0)
        assert r["upto"] == pytest.approx(w.top / w.size)


def test_ranks_by_two_columns(spark, sizes):
    rows = [(i, i % 4, i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    made = {r["id"]: r["low"] for r in ordered.ranks(df, [], ["-a", "b"], low="low").collect()}
    for i, a, b in rows:
        assert made[i] == 1 + sum((-x, y) < (-a, b) for _, x, y in rows)


def test_blocks_drop_the_tail_of_each_block(spark, sizes):
    rows = [(1, i) for i in range(83)] + [(2, i) for i in range(9)]
    made = ordered.blocks(spark.createDataFrame(rows, "k int, i int"), ["k"], ["i"], 4, drop_last=1).collect()
    got = sorted((r["k"], r["i"], r["block"], r["position"]) for r in made)
    want = [(1, i, i // 20 + 1, i % 20 + 1) for i in range(80) if i % 20 < 19]
    want += [(2, i, i // 2 + 1, i % 2 + 1) for i in range(8) if i % 2 < 1]
    assert got == sorted(want)


def test_latest_and_first_per_key(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), (None, 2, "q"), ("b", None, "w")]
    df = spark.createDataFrame(rows, "k string, d int, v string")
    assert sorted(ordered.latest_per_key(df, ["k"], ["d"]).collect(), key=str) == sorted(
        [("a", 3, "y"), (None, 2, "q"), ("b", None, "w")], key=str)
    led = ordered.scan(df, ["k"], ["d"], first={"first": "v"})
    assert {(r["k"], r["first"]) for r in led.collect()} == {("a", "x"), (None, "q"), ("b", "w")}


def test_top_per_key_limits_before_the_shuffle(spark, sizes):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    made = ordered.top_per_key(df, ["k"], ["-id"], 2)
    assert sorted(map(tuple, made.collect())) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=80, unique_by=lambda r: (r[0], r[1])))
def test_split_windows_equal_plain_windows(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, x int")
    use = dict(lag={"before": "x"}, lead={"after": "x"}, running={"total": "x"}, fill={"kept": "x"}, first={"head": "x"}, number="no", size="rows")
    whole = ordered.scan(df, ["k"], ["o"], split=ordered.hot_split(df, ["k"], ["o"], 10**9), **use)
    cut = ordered.scan(df, ["k"], ["o"], split=ordered.hot_split(df, ["k"], ["o"], 4), **use)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_uneven_values_are_cut_evenly(spark, hot):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.exp(F.col("id") / 200.0).alias("x"))
    tagged = ordered.hot_split(df, ["k"], ["x"]).tag(df)
    sizes = [r["count"] for r in tagged.groupBy(ordered.RANGE).count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == 4000
    text = df.select("k", F.format_string("Customer#%09d", F.col("x").cast("long")).alias("s")).distinct()
    sizes = [r["count"] for r in ordered.hot_split(text, [], ["s"]).tag(text).groupBy(ordered.RANGE).count().collect()]
    assert max(sizes) < sum(sizes) / 4


KINDS = {
    "long": "1152921504606846976L + raw", "string": "CASE WHEN raw = 3 THEN 'odd one' ELSE format_string('Customer#%09d', raw) END",
    "date": "date_add(DATE'2024-01-01', raw)", "timestamp": "timestamp_micros(1700000000000000 + raw * 100000)",
    "timestamp_ntz": "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, raw / 10.0)", "decimal": "CAST(raw AS DECIMAL(38, 2)) / 100",
}
USE = dict(lag={"before": "x"}, lead={"after": "x"}, running={"total": "x"}, fill={"kept": "x"}, first={"head": "x"}, number="no", size="rows")


@pytest.mark.parametrize("kind", list(KINDS))
@pytest.mark.parametrize("order", [["o", "id"], ["-o", "-id"], ["-o", "id"], ["tie", "-o", "id"]])
def test_split_windows_equal_plain_ones_in_any_order(spark, kind, order):
    df = spark.range(240).select(
        F.expr("CASE WHEN id % 9 = 0 THEN 2 ELSE 1 END").alias("k"), "id", F.lit(7).alias("tie"),
        F.expr(f"CASE WHEN id % 5 = 0 THEN NULL ELSE {KINDS[kind].replace('raw', 'CAST(id * 7919 % 240 AS INT)')} END").alias("o"),
        F.expr("CASE WHEN id % 4 = 0 THEN NULL ELSE id END").alias("x"))
    whole = ordered.scan(df, ["k"], order, split=ordered.hot_split(df, ["k"], order, 10**9), **USE)
    split = ordered.hot_split(df, ["k"], order, 4)
    assert split.active
    cut = ordered.scan(df, ["k"], order, split=split, **USE)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_ties_and_missing_values_are_cut(spark):
    rows = [(1, 5, i) for i in range(2000)] + [(2, None, i) for i in range(1900)]
    df = spark.createDataFrame(rows, "k int, o int, seq int")
    sizes = ordered.hot_split(df, ["k"], ["o", "seq"], 100).tag(df).groupBy("k", ordered.RANGE).count().collect()
    assert max(r["count"] for r in sizes) <= 200 and min(r[ordered.RANGE] for r in sizes) >= 0
    names = spark.range(2000).select(F.when(F.col("id") == 7, "odd").otherwise(F.format_string("Customer#%09d", "id")).alias("s"))
    sizes = ordered.hot_split(names, [], ["s"], 100).tag(names).groupBy(ordered.RANGE).count().collect()
    assert max(r["count"] for r in sizes) <= 200
