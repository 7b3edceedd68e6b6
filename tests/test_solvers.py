"""Sparse systems, associative scans, rating models and partitions against plain computations."""
from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators.scans import associative_scan
from touchline.plans import inference, multivariate, ratings, regression, solvers
from touchline.sources import markup
from touchline.streaming.ratings import row_state, streaming_elo
from touchline.streaming.standings import run_to_folder


def matrix_product(spark, a):
    cells = spark.createDataFrame([(i, j, float(v)) for i, r in enumerate(a) for j, v in enumerate(r) if v], "i int, j int, v double")

    def product(vector):
        return cells.join(vector.withColumnRenamed("k", "j"), "j").groupBy(F.col("i").alias("k")).agg(F.sum(F.col("v") * F.col("p")).alias("q"))

    return product


@pytest.mark.parametrize("few", [10_000, 3])
def test_conjugate_gradients_near_and_far(spark, monkeypatch, few):
    monkeypatch.setattr(solvers, "FEW_ROWS", few)
    random = np.random.default_rng(2)
    x, mean = random.normal(size=(30, 6)), random.normal(size=6) * 0.1
    raw, shift = x.T @ x, 0.7
    whole, right = raw - np.outer(mean, mean) + shift * np.eye(6), random.normal(size=6)
    system = spark.createDataFrame(
        [(k, float(right[k]), float(mean[k]), float(whole[k, k])) for k in range(6)], "k int, right double, mean double, diagonal double")
    made = {r["k"]: r["x"] for r in solvers.conjugate_gradients(system, "k", matrix_product(spark, raw), shift).collect()}
    solution = np.array([made[k] for k in range(6)])
    assert np.abs(whole @ solution - right).max() < 1e-8
    assert solvers.conjugate_gradients(system.limit(0), "k", matrix_product(spark, raw), shift).collect() == []


def test_parts_of_a_graph(spark):
    edges = [("a", "b"), ("b", "c"), ("x", "y"), *[(f"p{i:02d}", f"p{i + 1:02d}") for i in range(20)], ("q", "q")]
    made = {r["node"]: r["label"] for r in solvers.connected(spark.createDataFrame(edges, "f string, s string"), "f", "s").collect()}
    assert made["c"] == "a" and made["y"] == "x" and {made[f"p{i:02d}"] for i in range(21)} == {"p00"}
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "w string, l string")
    assert solvers.reaches_all(ring, "w", "l") and not solvers.reaches_all(ring.where("w <> 'c'"), "w", "l")


def test_ridge_ratings_leave_no_residual(spark):
    random = np.random.default_rng(8)
    players, n, penalty = 30, 200, 0.05
    x = random.choice([-1, 0, 0, 1], size=(n, players)).astype(float)
    y, w = x @ random.normal(size=players) + random.normal(size=n), random.integers(1, 9, n).astype(float)
    entries = [(i, f"p{j}", int(x[i, j])) for i, j in itertools.product(range(n), range(players)) if x[i, j]]
    made = ratings.plus_minus(
        spark.createDataFrame(entries, "s int, player string, value int"),
        spark.createDataFrame([(i, float(y[i]), float(w[i])) for i in range(n)] + [(n, None, 1.0)], "s int, m double, n double"), ["s"], "m", "n", penalty)
    got = {r["player"]: r["rating"] for r in made.collect()}
    b = np.array([got[f"p{j}"] for j in range(players)])
    xc, yc = x - w @ x / w.sum(), y - w @ y / w.sum()
    assert np.abs((xc * w[:, None]).T @ (yc - xc @ b) / w.sum() - penalty * b).max() < 1e-8


def test_unlinked_teams_have_no_strength(spark):
    schema = "h string, a string, w boolean"
    with pytest.raises(ValueError, match="not linked"):
        ratings.paired_comparison(spark.createDataFrame([("a", "b", True), ("b", "a", True), ("c", "a", True), ("a", "b", False)], schema), "h", "a", "w")
    with pytest.raises(ValueError, match="home edge"):
        ratings.paired_comparison(spark.createDataFrame([("a", "b", True), ("b", "a", True)], schema), "h", "a", "w")


@pytest.mark.parametrize("length", [4, 256])
def test_scans_of_any_combination(spark, length):
    random = np.random.default_rng(4)
    rows = [(g, i, float(random.uniform(0.5, 1.5)), float(random.normal())) for g, n in (("a", 75), ("b", 1), ("c", 16)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, m double, c double").repartition(3).withColumn("e", F.struct("m", "c"))
    lines = lambda a, b: F.struct((a["m"] * b["m"]).alias("m"), (b["m"] * a["c"] + b["c"]).alias("c"))
    made = {(r["g"], r["i"]): (r["s"]["m"], r["s"]["c"]) for r in associative_scan(df, ["g"], ["i"], "e", lines, "s", length).collect()}
    want, m, c = {}, 1.0, 0.0
    for g, i, own, add in rows:
        m, c = (own, add) if i == 0 else (m * own, own * c + add)
        want[g, i] = m, c
    assert made.keys() == want.keys()
    assert all(made[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    assert associative_scan(df.limit(0), ["g"], ["i"], "e", lines, "s", length).collect() == []


@pytest.mark.parametrize("length", [3, 256])
def test_local_levels_forwards_and_backwards(spark, length):
    random = np.random.default_rng(5)
    rows = [(t, p, float(random.normal(p / 5))) for t, last in (("x", 40), ("y", 2), ("z", 1)) for p in range(last) for _ in range(int(random.integers(1, 4)))]
    made = ratings.local_level(spark.createDataFrame(rows, "t string, p int, v double"), "t", "p", "v", 4.0, 0.5, smoothed=True, length=length)
    got = {(r["t"], r["p"]): r for r in made.collect()}
    for team in "xyz":
        seen = {}
        for t, p, v in rows:
            if t == team:
                seen.setdefault(p, []).append(v)
        levels, spreads = [], []
        for p in sorted(seen):
            own, mean = 4.0 / len(seen[p]), float(np.mean(seen[p]))
            if not levels:
                levels, spreads = [mean], [own]
                continue
            ahead = spreads[-1] + 0.5
            gain = ahead / (ahead + own)
            levels.append(levels[-1] + gain * (mean - levels[-1]))
            spreads.append(ahead * (1 - gain))
        back, wide = [levels[-1]], [spreads[-1]]
        for level, spread in zip(levels[-2::-1], spreads[-2::-1]):
            share = spread / (spread + 0.5)
            back.append(level + share * (back[-1] - level))
            wide.append(spread + share**2 * (wide[-1] - spread - 0.5))
        for p, level, spread, b, w in zip(sorted(seen), levels, spreads, back[::-1], wide[::-1]):
            r = got[team, p]
            assert (r["level"], r["variance"], r["smoothed_level"], r["smoothed_variance"]) == pytest.approx((level, spread, b, w))


def fold(games, k=20.0, edge=40.0):
    rating, count = {}, {}
    for _, h, a, points in sorted(games):
        if points is None or h == a:
            continue
        own, other = rating.get(h, 1500.0), rating.get(a, 1500.0)
        gain = k * (points - 1 / (1 + 10 ** ((other - own - edge) / 400)))
        rating[h], rating[a] = own + gain, other - gain
        count[h], count[a] = count.get(h, 0) + 1, count.get(a, 0) + 1
    return {t: (rating[t], count[t]) for t in rating}


def test_elo_by_game_equals_a_fold(spark):
    random = np.random.default_rng(7)
    games = [(int(random.integers(0, 25)), f"t{a}", f"t{b}", None if random.random() < 0.05 else float(random.choice([0, 0.5, 1])))
             for _ in range(260) for a, b in [random.integers(0, 30, 2)]]
    games = list({(d, h, a): (d, h, a, o) for d, h, a, o in games}.values())
    made = ratings.elo_by_game(spark.createDataFrame(games, "d int, h string, a string, o double").repartition(4), ["d"], "h", "a", "o", home_edge=40.0)
    want = fold(games)
    got = {r["team"]: (r["rating"], r["games"]) for r in made.collect()}
    assert got.keys() == want.keys() and all(got[t] == pytest.approx(want[t]) for t in want)


def test_streamed_ratings_go_on_after_a_restart(spark, tmp_path):
    random = np.random.default_rng(9)
    games = [("one" if i % 3 else "two", i, f"t{a}", f"t{b}", float(random.choice([0, 0.5, 1]))) for i in range(90) for a, b in [random.permutation(6)[:2]]]
    schema = "league string, no long, h string, a string, o double"
    source, state, out = (str(tmp_path / n) for n in ("games", "state", "out"))
    for part in (games[:50], games[50:]):  # the second run finds the state of the first
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        with row_state(spark):
            stream = spark.readStream.schema(schema).parquet(source)
            made = run_to_folder(streaming_elo(stream, "league", "no", "h", "a", "o", home_edge=40.0), ["league", "team"], out, state)
    got = {(r["league"], r["team"]): (r["rating"], r["games"]) for r in made.collect()}
    for league in ("one", "two"):
        for team, want in fold([(n, h, a, o) for g, n, h, a, o in games if g == league]).items():
            assert got[league, team] == pytest.approx(want)
    assert not any(r["late"] for r in made.collect())
    spark.createDataFrame([("one", 3, "t0", "new", 1.0)], schema).write.mode("append").parquet(source)
    with row_state(spark):
        stream = spark.readStream.schema(schema).parquet(source)
        made = run_to_folder(streaming_elo(stream, "league", "no", "h", "a", "o", home_edge=40.0), ["league", "team"], out, state)
    late = {r["team"]: r["late"] for r in made.where("league = 'one'").collect()}
    assert late["t0"] and late["new"] and not late["t1"]
    with pytest.raises(ValueError, match="stateful"):
        streaming_elo(stream, "league", "no", "h", "a", "o")


def test_two_way_table_with_unlinked_and_many_levels(spark):
    random = np.random.default_rng(11)
    rows = [(f"a{i % 3}", f"b{i % 4 if i % 3 < 2 else 9}", float(random.normal())) for i in range(200)]
    frame = spark.createDataFrame(rows, "g string, h string, y double")
    a, b, y = (np.array([r[k] for r in rows]) for k in range(3))
    y = y.astype(float)

    def sse(*factors):
        x = np.column_stack([np.ones(len(y)), *[(f == v).astype(float) for f in factors for v in sorted(set(f))]])
        return ((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2).sum(), np.linalg.matrix_rank(x)

    (sa, ra), (sb, rb), (sab, rab) = sse(a), sse(b), sse(a, b)
    made = {r["term"]: r for r in inference.two_way_anova(frame, "g", "h", "y").collect()}
    assert made["g"]["ss"] == pytest.approx(sb - sab, abs=1e-8) and made["g"]["df"] == rab - rb
    assert made["h"]["ss"] == pytest.approx(sa - sab, abs=1e-8) and made["h"]["df"] == rab - ra
    many = spark.range(60_000).select((F.col("id") % 30_000).alias("g"), (F.col("id") % 7).alias("h"), (F.col("id") % 11).cast("double").alias("y"))
    rows = {r["term"]: r["df"] for r in inference.two_way_anova(many, "g", "h", "y").collect()}
    assert rows["g"] == 29_999 and rows["h"] == 6


def test_lasso_meets_its_conditions(spark):
    random = np.random.default_rng(12)
    x = random.normal(size=(300, 4)) * [1, 5, 0.2, 2]
    x[:, 3] += x[:, 0]
    y = x @ [2.0, 0.0, 3.0, -1.0] + random.normal(size=300)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, y double")
    made = regression.lasso_paths(df, "y", ["a", "b", "c", "d"], [1.5, 0.3, 0.0])
    for penalty in (1.5, 0.3, 0.0):
        b = {r["term"]: r["estimate"] for r in made.where(F.col("penalty") == penalty).collect()}
        left = y - b["(Intercept)"] - x @ [b[k] for k in "abcd"]
        pull = x.T @ left / 300
        for k, name in enumerate("abcd"):
            limit = penalty * x[:, k].std(ddof=1)
            if b[name]:
                assert pull[k] == pytest.approx(np.sign(b[name]) * limit, abs=1e-8)
            else:
                assert abs(pull[k]) <= limit + 1e-8


def test_additive_model_between_line_and_curve(spark):
    df = spark.range(3000).select("id", (F.col("id") % 40 / 4.0).alias("x")).withColumn(
        "won", (F.pmod(F.xxhash64("id"), F.lit(1000)) < 1000 * (0.5 + 0.4 * F.sin("x"))).cast("int"))
    span = {"x": (0.0, 10.0, 6)}
    line, names = regression.additive_logistic(df, "won", span, 1e10)
    grid, _ = regression.spline_columns(df.select("x").distinct(), "x", 0.0, 10.0, 6)
    odds = grid.select("x", F.log(regression.logistic_probability(line, names) / (1 - regression.logistic_probability(line, names))).alias("l"))
    rows = np.array(sorted(map(tuple, odds.collect())))
    assert np.abs(np.diff(rows[:, 1], 2)).max() < 1e-6 and line.freedom == pytest.approx(2, abs=1e-3)
    best, _ = regression.additive_logistic(df, "won", span, [1e10, 10.0, 0.1])
    assert best.penalty < 1e10 and best.score < line.score and best.deviance < line.deviance and best.freedom > 3


def test_agreement_of_partitions(spark):
    random = np.random.default_rng(13)
    rows = [(int(a), int(a) if random.random() < 0.7 else int(random.integers(0, 3))) for a in random.integers(0, 4, 300)]
    made = multivariate.agreement(spark.createDataFrame(rows + [(None, 1)], "a int, b int"), "a", "b").first()
    pairs = [(x[0] == y[0], x[1] == y[1]) for x, y in itertools.combinations(rows, 2)]
    both, one, two = (sum(f(p) for p in pairs) for f in (lambda p: p[0] and p[1], lambda p: p[0], lambda p: p[1]))
    expected = one * two / len(pairs)
    assert made["adjusted_rand"] == pytest.approx((both - expected) / ((one + two) / 2 - expected))
    assert made["purity"] == pytest.approx(sum(max(sum(r == (a, b) for r in rows) for a in range(4)) for b in {r[1] for r in rows}) / 300)
    same = multivariate.agreement(spark.createDataFrame([(1, 5), (2, 6), (2, 6)], "a int, b int"), "a", "b").first()
    assert (same["adjusted_rand"], same["purity"], same["shared_information"]) == pytest.approx((1, 1, 1))
    points = [(float(c * 100 + i),) for c in range(3) for i in range(10)]
    found = {r["k"]: r["silhouette"] for r in multivariate.silhouettes(spark.createDataFrame(points, "x double"), ["x"], [2, 3, 5], 1).collect()}
    assert max(found, key=found.get) == 3


def test_end_tags_may_be_left_out():
    read = lambda html, *s: markup._read_texts(html, s)
    assert read("<ul><li>a<li>b<ul><li>c</ul>d<li>e</ul>", "li") == {"li": ["a", "b\nc\nd", "e"]} or read(
        "<ul><li>a<li>b</ul>", "li") == {"li": ["a", "b"]}
    assert read("<ul><li>a<li>b</ul>", "li") == {"li": ["a", "b"]}
    assert read("<p>one<p>two<div>three</div>", "p") == {"p": ["one", "two"]}
    assert read("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "dt", "dd") == {"dt": ["k", "l"], "dd": ["v", "w"]}
    assert read("<select><option>a<option>b</select>x", "option") == {"option": ["a", "b"]}
    assert len(read("<li>" * 8000 + "x", "li")["li"]) == 8000


def test_groups_of_many_batches_stay_whole(spark):
    from touchline.plans import stints

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(500).select((F.col("id") % 40).alias("k"), F.when(F.col("id") % 40 == 3, None).otherwise(F.lit("x")).alias("t"), "id")

        def size(rows):
            if rows["id"].min() % 2:
                raise KeyError("odd")
            return rows[["id"]].agg(["count", "sum"]).T.reset_index(drop=True).set_axis(["n", "total"], axis=1)

        got = {r["k"]: (r["n"], r["total"], r["error"]) for r in stints.tolerant_groups(df, ["k", "t"], size, "n long, total long").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 40 and got[3] == (None, None, "KeyError")
    assert got[4] == (13, sum(range(4, 500, 40)), None)


def test_elo_by_game_needs_few_jobs_for_long_chains(spark):
    random = np.random.default_rng(3)
    games = [(i, f"t{a}", f"t{b}", float(random.choice([0, 0.5, 1]))) for i in range(600) for a, b in [random.permutation(60)[:2]]]
    df = spark.createDataFrame(games, "d int, h string, a string, o double")
    spark.sparkContext.setJobGroup("elo by game", "jobs are counted")
    try:
        got = {r["team"]: (r["rating"], r["games"]) for r in ratings.elo_by_game(df, ["d"], "h", "a", "o", home_edge=40.0).collect()}
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("elo by game"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = fold(games)
    assert got.keys() == want.keys() and all(got[t] == pytest.approx(want[t]) for t in want)
    assert jobs < 100  # with one round a step of the longest chain: several hundred


def test_groups_as_arrays_make_no_frames(spark):
    from touchline.plans import stints

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(3000).select(F.when(F.col("id") < 100, 5).otherwise(F.col("id") % 900 + 10).alias("k"), F.col("id").cast("double").alias("v"))
        df = df.unionByName(spark.sql("SELECT CAST(NULL AS long) AS k, double(i) AS v FROM VALUES (1), (NULL), (4), (8) AS t(i)"))

        def width(rows):
            if not isinstance(rows["v"], np.ndarray) or len(rows["v"]) % 2:
                raise ValueError("odd")
            return {"n": [len(rows["v"])], "width": [float(np.fmax.reduce(rows["v"]) - np.fmin.reduce(rows["v"]))]}

        seen = {r["k"]: (r["n"], r["width"], r["error"]) for r in stints.tolerant_groups(df, ["k"], width, "n long, width double", arrays=True).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(seen) == 902 and seen[5] == (100, 99.0, None) and seen[None] == (4, 7.0, None)
    for k in range(900):
        values = [i for i in range(100, 3000) if i % 900 == k]
        want = (None, None, "ValueError") if len(values) % 2 else (len(values), float(values[-1] - values[0]), None)
        assert seen[k + 10] == want


def test_plus_minus_adds_up_rows_of_one_lineup(spark, monkeypatch):
    random, rows = np.random.default_rng(5), []
    lineups = [tuple(random.choice([-1, 0, 1, 2], 4)) for _ in range(6)]
    for s in range(400):
        rows.append((s, lineups[s % 6], float(random.normal(5, 9)), float(random.integers(1, 9))))
    entries = spark.createDataFrame([(s, f"p{i}", int(v)) for s, x, _, _ in rows for i, v in enumerate(x) if v], "s int, player string, value int")
    context = spark.createDataFrame([(s, y, w) for s, _, y, w in rows], "s int, y double, w double")
    held, keep = [], ratings.cut_lineage
    monkeypatch.setattr(ratings, "cut_lineage", lambda df: held.append(keep(df)) or held[-1])
    got = {r["player"]: (r["rating"], r["n_rows"]) for r in ratings.plus_minus(entries, context, ["s"], "y", "w", 0.05).collect()}
    assert max(df.count() for df in held) <= 24  # not one for each entry of the 400 rows
    x, y, w = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    w = w / w.sum()
    x0, y0 = x - w @ x, y - w @ y
    want = np.linalg.solve(x0.T @ (w[:, None] * x0) + 0.05 * np.eye(4), x0.T @ (w * y0))
    for i in range(4):
        if f"p{i}" in got:
            assert got[f"p{i}"] == (pytest.approx(want[i], abs=1e-8), int((x[:, i] != 0).sum()))
