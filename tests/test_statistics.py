"""Statistics and models against numpy and closed forms."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.plans import contingency, describe, inference, multivariate, ratings, regression, solvers


def table_of(spark, **columns):
    names = list(columns)
    rows = [tuple(v.item() if hasattr(v, "item") else v for v in r) for r in zip(*columns.values())]
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def sample(spark):
    random = np.random.default_rng(8)
    n = 400
    a, b, c = random.normal(size=n), random.normal(size=n) * 3 + 5, random.integers(0, 3, n).astype(float)
    a = a + 0.6 * b
    y = 2 + 1.5 * a - 0.7 * b + 0.4 * c + random.normal(size=n)
    g = np.array(list("pqr"))[random.integers(0, 3, n)]
    h = np.array(list("uvwx"))[np.minimum(random.integers(0, 5, n), 3)]
    won = (random.random(n) < 1 / (1 + np.exp(-(0.3 * a - 0.2 * b)))).astype(int)
    w = random.integers(1, 5, n)
    frame = dict(a=a, b=b, c=c, y=y, g=g, h=h, won=won, w=w, i=np.arange(n))
    return frame, table_of(spark, **frame).cache()


def design(frame, names):
    return np.column_stack([np.ones(len(frame["y"])), *[frame[n] for n in names]])


def test_ols_matches_numpy(spark, sample):
    frame, df = sample
    x = design(frame, ["a", "b", "c"])
    beta, *_ = np.linalg.lstsq(x, frame["y"], rcond=None)
    residual = frame["y"] - x @ beta
    sigma2 = residual @ residual / (len(x) - 4)
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * sigma2)
    fit = regression.ols(df, "y", ["a", "b", "c"])
    rows = {r["term"]: r for r in fit.coefficients(spark).collect()}
    for i, term in enumerate(["(Intercept)", "a", "b", "c"]):
        assert rows[term]["estimate"] == pytest.approx(beta[i]) and rows[term]["std_error"] == pytest.approx(se[i])
    quality = fit.quality(spark).first()
    assert quality["r2"] == pytest.approx(1 - residual @ residual / ((frame["y"] - frame["y"].mean()) ** 2).sum())
    hat = np.diag(x @ np.linalg.inv(x.T @ x) @ x.T)
    z = residual / np.sqrt(sigma2 * (1 - hat))
    for r in regression.influence(df, fit).collect():
        assert r["leverage"] == pytest.approx(hat[r["i"]], abs=1e-9)
        assert r["cooks_d"] == pytest.approx(z[r["i"]] ** 2 * hat[r["i"]] / (1 - hat[r["i"]]) / 4, abs=1e-9)


def test_weighted_ols(sample):
    frame, df = sample
    x, root = design(frame, ["a", "b"]), np.sqrt(frame["w"])
    beta, *_ = np.linalg.lstsq(x * root[:, None], frame["y"] * root, rcond=None)
    assert regression.ols(df, "y", ["a", "b"], weight="w").beta == pytest.approx(beta)


def test_vif_subsets_forward(spark, sample):
    frame, df = sample
    vif = {r["predictor"]: r["vif"] for r in regression.variance_inflation(df, ["a", "b", "c"]).collect()}
    inverse = np.linalg.inv(np.corrcoef([frame["a"], frame["b"], frame["c"]]))
    assert [vif[k] for k in "abc"] == pytest.approx(list(np.diag(inverse)))
    table = {r["model"]: r for r in regression.subsets(df, "y", ["a", "b", "c"]).collect()}
    assert len(table) == 7
    assert table["a + b"]["r2"] == pytest.approx(regression.ols(df, "y", ["a", "b"]).r2)
    steps = [r["added"] for r in regression.forward(df, "y", ["a", "b", "c"]).orderBy("step").collect()]
    assert steps[0] == "a" and set(steps) == {"a", "b", "c"}


def test_ridge_and_its_cross_validation(sample):
    frame, df = sample
    names, penalty = ["a", "b", "c"], 0.3
    x = np.column_stack([frame[n] for n in names])
    z = (x - x.mean(0)) / x.std(0)
    n = len(x)
    slopes = np.linalg.solve(z.T @ z / n + penalty * np.eye(3), z.T @ (frame["y"] - frame["y"].mean()) / n) / x.std(0)
    got = regression.ridge(regression.moments(df, [*names, "y"]), "y", names, penalty)
    assert got[1:] == pytest.approx(slopes)
    error = 0.0
    for k in range(4):
        out = frame["i"] % 4 == k
        xt, yt = x[~out], frame["y"][~out]
        zt = (xt - xt.mean(0)) / xt.std(0)
        b = np.linalg.solve(zt.T @ zt / len(zt) + penalty * np.eye(3), zt.T @ (yt - yt.mean()) / len(zt)) / xt.std(0)
        error += ((frame["y"][out] - yt.mean() - (x[out] - xt.mean(0)) @ b) ** 2).sum()
    made = regression.ridge_path(df, "y", names, [penalty], F.pmod("i", F.lit(4)), 4).first()
    assert made["cv_mse"] == pytest.approx(error / n)


def test_lasso_drops_noise(sample):
    _, df = sample
    noisy = df.withColumn("noise", F.sin(F.col("i") * 12.9898))
    made = {r["term"]: r["estimate"] for r in regression.lasso(noisy, "y", ["a", "b", "c", "noise"], 0.15).collect()}
    assert made["noise"] == 0 and made["a"] > 0.5


def test_polynomial_vertex_and_interaction(spark):
    df = spark.range(50).select((F.col("id") / 10).alias("x")).withColumn("y", 3 - (F.col("x") - 2) * (F.col("x") - 2))
    assert regression.vertex(regression.polynomial(df, "y", "x", 2)) == pytest.approx(2.0)
    both = df.withColumn("g", F.when(F.col("x") * 10 % 2 < 1, "A").otherwise("B")).withColumn(
        "y", F.when(F.col("g") == "A", 1 + 2 * F.col("x")).otherwise(4 - F.col("x")))
    made, terms = regression.with_dummies(both, "g", ["A", "B"], interact="x")
    full = regression.ols(made, "y", ["x", *terms])
    assert full.beta == pytest.approx([1, 2, 3, -3], abs=1e-8)
    f, extra, _, p = regression.nested_test(regression.ols(made, "y", ["x", "g_1"]), regression.ols(made, "y", ["x"]))
    assert extra == 1 and f > 0 and 0 <= p <= 1


def logistic_by_newton(x, y, steps=30, penalty=0.0):
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        beta = beta + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (y - p))
    p = 1 / (1 + np.exp(-x @ beta))
    return beta, np.linalg.inv((x * (p * (1 - p))[:, None]).T @ x), p


def test_logistic_matches_newton(spark, sample):
    frame, df = sample
    x = design(frame, ["a", "b"])
    beta, covariance, p = logistic_by_newton(x, frame["won"])
    model = regression.logistic(df, "won", ["a", "b"])
    rows = regression.logistic_table(spark, model, ["a", "b"]).collect()
    assert [r["estimate"] for r in rows] == pytest.approx(beta, abs=1e-6)
    assert [r["std_error"] for r in rows] == pytest.approx(np.sqrt(np.diag(covariance)), rel=1e-4)
    got = df.select("i", regression.logistic_probability(model, ["a", "b"]).alias("p")).orderBy("i").collect()
    assert [r["p"] for r in got] == pytest.approx(p, abs=1e-6)
    drop = regression.deviance_test(spark, model, ["a", "b"]).first()
    rate = frame["won"].mean()
    null = np.log(np.where(frame["won"] == 1, rate, 1 - rate)).sum()
    full = np.log(np.where(frame["won"] == 1, p, 1 - p)).sum()
    assert drop["deviance_drop"] == pytest.approx(2 * (full - null))


def test_naive_bayes(sample):
    frame, df = sample
    classes = regression.bayes_model(df, "g", ["a", "y"])
    scored = {r["i"]: r["predicted"] for r in regression.bayes_classes(df, classes, "g", ["a", "y"]).collect()}
    for i in range(0, 400, 7):
        score = {}
        for k in "pqr":
            m = frame["g"] == k
            score[k] = np.log(m.sum())
            for v in ("a", "y"):
                s2 = frame[v][m].var(ddof=1)
                score[k] -= 0.5 * np.log(s2) + (frame[v][i] - frame[v][m].mean()) ** 2 / (2 * s2)
        assert scored[i] == max(score, key=score.get)


def test_additive_logistic_follows_a_curve(spark):
    df = spark.range(4000).select("id", (F.col("id") % 40 / 4.0).alias("x")).withColumn(
        "won", (F.pmod(F.xxhash64("id"), F.lit(1000)) < 1000 * (0.5 + 0.4 * F.sin("x"))).cast("int"))
    model, names = regression.additive_logistic(df, "won", {"x": (0.0, 10.0, 6)}, 1e-6)
    curve, _ = regression.spline_columns(df, "x", 0.0, 10.0, 6)
    off = curve.groupBy("x").agg(F.avg(F.abs(regression.logistic_probability(model, names) - (0.5 + 0.4 * F.sin("x")))).alias("d"))
    assert off.agg(F.max("d")).first()[0] < 0.12


def test_components(spark, sample):
    frame, df = sample
    x = np.column_stack([frame[k] for k in ("a", "b", "c", "y")])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    singular = np.linalg.svd(z, compute_uv=False)
    parts = multivariate.Components(df, ["a", "b", "c", "y"])
    rows = parts.shares(spark).orderBy("component").collect()
    assert [r["sd"] for r in rows] == pytest.approx(singular / np.sqrt(len(z) - 1))
    assert rows[-1]["cumulative"] == pytest.approx(1)
    scores = parts.scores(df, 2).agg(F.variance("pc1"), F.variance("pc2"), F.corr("pc1", "pc2")).first()
    assert list(scores) == pytest.approx([*(singular[:2] ** 2 / (len(z) - 1)), 0], abs=1e-9)


def test_clusters_find_separate_groups(spark):
    df = spark.range(300).select("id", (F.col("id") % 3 * 100 + F.col("id") % 7).cast("double").alias("x"))
    rows, _ = multivariate.clusters(df, ["x"], 3, seed=1)
    assert rows.groupBy((F.col("id") % 3).alias("t"), "cluster").count().count() == 3
    for kind in ("bisecting", "mixture"):
        rows, _ = multivariate.clusters(df, ["x"], 3, seed=1, kind=kind)
        assert rows.count() == 300 and rows.select("cluster").distinct().count() <= 3


def test_anova_and_pairwise(sample):
    frame, df = sample
    groups = [frame["y"][frame["h"] == k] for k in "uvwx"]
    grand = frame["y"].mean()
    between = sum(len(g) * (g.mean() - grand) ** 2 for g in groups)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups)
    made = inference.anova(df, "h", "y").first()
    assert made["between_ss"] == pytest.approx(between) and made["within_ss"] == pytest.approx(within)
    assert made["f"] == pytest.approx(between / 3 / (within / (400 - 4)))
    pairs = inference.pairwise(df, "h", "y").collect()
    assert len(pairs) == 6
    for r in pairs:
        assert r["difference"] == pytest.approx(groups["uvwx".index(r["first"])].mean() - groups["uvwx".index(r["second"])].mean())
        assert r["hsd_p"] >= r["lsd_p"] - 1e-6


def test_two_way_anova(sample):
    frame, df = sample

    def dummies(values):
        return np.column_stack([values == k for k in np.unique(values)[1:]]).astype(float)

    def sse(*blocks):
        x = np.column_stack([np.ones(400), *blocks])
        beta, *_ = np.linalg.lstsq(x, frame["y"], rcond=None)
        return ((frame["y"] - x @ beta) ** 2).sum()

    g, h = dummies(frame["g"]), dummies(frame["h"])
    cross = np.column_stack([g[:, [i]] * h[:, [j]] for i in range(2) for j in range(3)])
    made = {r["term"]: r for r in inference.two_way_anova(df, "g", "h", "y").collect()}
    assert made["g"]["ss_in_order"] == pytest.approx(sse() - sse(g)) and made["h"]["ss_in_order"] == pytest.approx(made["h"]["ss"])
    assert made["g"]["ss"] == pytest.approx(sse(h) - sse(g, h)) and made["g"]["df"] == 2
    assert made["h"]["ss"] == pytest.approx(sse(g) - sse(g, h)) and made["h"]["df"] == 3
    assert made["g:h"]["ss"] == pytest.approx(sse(g, h) - sse(g, h, cross)) and made["g:h"]["df"] == 6
    assert made["residual"]["ss"] == pytest.approx(sse(g, h, cross)) and made["residual"]["df"] == 388


def test_t_tests(sample):
    frame, df = sample
    p, q = frame["y"][frame["g"] == "p"], frame["y"][frame["g"] == "q"]
    rows = {r["method"]: r for r in inference.two_samples(df, "y", "g", "p", "q").collect()}
    se = np.sqrt(p.var(ddof=1) / len(p) + q.var(ddof=1) / len(q))
    assert rows["welch"]["t"] == pytest.approx((p.mean() - q.mean()) / se)
    assert rows["pooled"]["df"] == len(p) + len(q) - 2
    assert rows["welch"]["low"] < rows["welch"]["difference"] < rows["welch"]["high"]
    pair = inference.paired(df, "a", "b").first()
    d = frame["a"] - frame["b"]
    assert pair["t"] == pytest.approx(d.mean() / (d.std(ddof=1) / np.sqrt(400)))


def test_chi_square_with_an_empty_cell(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 5 + [("b", "y")] * 9 + [("b", None)]
    df = spark.createDataFrame(rows, "r string, c string")
    seen = np.array([[10, 5], [0, 9]])
    expected = seen.sum(1, keepdims=True) * seen.sum(0) / seen.sum()
    made = contingency.chi_square(df, "r", "c").first()
    assert made["chi_square"] == pytest.approx(((seen - expected) ** 2 / expected).sum()) and made["df"] == 1
    cells = {(r["r"], r["c"]): r for r in contingency.expected_counts(df, "r", "c").collect()}
    assert len(cells) == 4 and cells["b", "x"]["n"] == 0 and cells["b", "x"]["expected"] == pytest.approx(expected[1, 0])


def test_random_tables_agree_with_the_exact_test(spark):
    rows = [("a", "x")] * 8 + [("a", "y")] * 2 + [("b", "x")] * 3 + [("b", "y")] * 7
    df = spark.createDataFrame(rows, "r string, c string")
    exact = contingency.fisher_2x2(df, "r", "c", (("a", "b"), ("x", "y"))).first()["p_value"]
    random = contingency.fisher_monte_carlo(df, "r", "c", 3000, 2).first()["p_value"]
    assert random == pytest.approx(exact, abs=0.025)


def test_density_integrates_to_one(spark, sample):
    _, df = sample
    made = describe.density(df, "b", -15, 25, 200, 0.8)
    assert made.agg(F.sum("density")).first()[0] * 40 / 199 == pytest.approx(1, abs=1e-3)
    surface = describe.density_2d(df, "a", "b", (-10, 20), (-15, 25), 60, 0.8, 0.8)
    assert surface.agg(F.sum("density")).first()[0] * (30 / 59) * (40 / 59) == pytest.approx(1, abs=1e-2)


def test_shrinkage_pulls_small_groups_most(spark):
    rows = [("big", float(i % 5)) for i in range(100)] + [("small", 9.0), ("small", 8.0)] + [("mid", float(i % 3) + 3) for i in range(30)]
    made = {r["g"]: r for r in ratings.shrunken_means(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    assert made["small"]["weight"] < made["mid"]["weight"] < made["big"]["weight"] < 1
    assert made["small"]["shrunken_mean"] < made["small"]["mean"]


def test_plus_minus_is_weighted_ridge(spark):
    random = np.random.default_rng(3)
    players, n, penalty = 8, 120, 0.2
    rows, entries, x = [], [], np.zeros((n, players))
    for i in range(n):
        five = random.permutation(players)[:4]
        x[i, five[:2]], x[i, five[2:]] = 1, -1
        entries += [(i, f"p{k}", int(x[i, k])) for k in five]
        rows.append((i, float(x[i] @ np.arange(players) + random.normal()), float(random.integers(1, 9))))
    y, w = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    xm, ym = w @ x / w.sum(), w @ y / w.sum()
    xc, yc = x - xm, y - ym
    want = np.linalg.solve((xc * w[:, None]).T @ xc / w.sum() + penalty * np.eye(players), (xc * w[:, None]).T @ yc / w.sum())
    made = ratings.plus_minus(spark.createDataFrame(entries, "s int, player string, value int"),
                              spark.createDataFrame(rows, "s int, margin double, n double"), ["s"], "margin", "n", penalty)
    got = {r["player"]: r["rating"] for r in made.collect()}
    assert [got[f"p{k}"] for k in range(players)] == pytest.approx(want, abs=1e-5)


def test_elo_equals_a_fold_when_each_period_is_one_game(spark):
    random = np.random.default_rng(5)
    games = [(p, f"t{a}", f"t{b}", float(random.choice([0, 0.5, 1]))) for p in range(12)
             for a, b in [random.permutation(4)[:2]]]
    rating = {f"t{i}": 1500.0 for i in range(4)}
    for _, a, b, points in games:
        gain = 20 * (points - 1 / (1 + 10 ** ((rating[b] - rating[a] - 40) / 400)))
        rating[a] += gain
        rating[b] -= gain
    made = ratings.elo(spark.createDataFrame(games, "p int, h string, a string, o double"), "p", "h", "a", "o", home_edge=40.0)
    got = {r["team"]: r["rating"] for r in made.collect()}
    assert got == pytest.approx({t: r for t, r in rating.items() if t in got})


def test_bradley_terry_matches_newton(spark):
    random = np.random.default_rng(6)
    strength, edge, rows, x, y = np.array([0.0, 0.5, 1.0, -0.4]), 0.3, [], [], []
    for _ in range(600):
        a, b = random.permutation(4)[:2]
        won = random.random() < 1 / (1 + np.exp(-(strength[a] - strength[b] + edge)))
        rows.append((f"t{a}", f"t{b}", bool(won)))
        line = np.zeros(4)
        line[0] = 1
        for k, sign in ((a, 1), (b, -1)):
            if k:
                line[k] += sign
        x.append(line)
        y.append(float(won))
    beta, _, _ = logistic_by_newton(np.array(x), np.array(y))
    table, got = ratings.paired_comparison(spark.createDataFrame(rows, "h string, a string, w boolean"), "h", "a", "w")
    strengths = {r["team"]: r["strength"] for r in table.collect()}
    assert got == pytest.approx(beta[0], abs=1e-4)
    assert [strengths[f"t{k}"] for k in range(4)] == pytest.approx([0, *beta[1:]], abs=1e-4)


def test_schedule_scores_match_a_power_iteration(spark, monkeypatch):
    rows = [("a", "b")] * 3 + [("b", "c")] * 2 + [("a", "c"), ("c", "a"), ("d", "c")]
    names = "abcd"
    flow = np.zeros((4, 4))
    for w, l in rows:
        flow[names.index(w), names.index(l)] += 1
    beaten = flow.sum(0) > 0
    flow[:, beaten] /= flow[:, beaten].sum(0)
    score = np.full(4, 0.25)
    for _ in range(400):
        score = 0.15 / 4 + 0.85 * (flow @ score + score[~beaten].sum() / 4)
    made = {r["player"]: r["score"] for r in ratings.schedule_scores(spark.createDataFrame(rows, "w string, l string"), "w", "l", tolerance=1e-6).collect()}
    assert [made[k] for k in names] == pytest.approx(score, abs=1e-5)
    monkeypatch.setattr(solvers, "FEW_ROWS", 2)  # the scores as a checkpointed table
    made = {r["player"]: r["score"] for r in ratings.schedule_scores(spark.createDataFrame(rows, "w string, l string"), "w", "l").collect()}
    assert [made[k] for k in names] == pytest.approx(score, abs=1e-12)
    assert ratings.schedule_scores(spark.createDataFrame([("a", "a")], "w string, l string"), "w", "l").count() == 0


def test_local_level_with_one_team(spark):
    rows = [("t", p, v) for p, v in ((1, 3.0), (1, 5.0), (2, 1.0), (3, 2.0))]
    made = ratings.local_level(spark.createDataFrame(rows, "team string, p int, v double"), "team", "p", "v", 4.0, 1.0)
    levels = [r["level"] for r in made.orderBy("p").collect()]
    second = 4 + 3 / (3 + 4) * (1 - 4)
    assert levels[:2] == pytest.approx([4.0, second])


def test_exact_tests_on_very_large_counts(spark):
    """Counted cells of 10^10 rows: the exact tests agree with the normal limit."""
    from touchline.functions import tails

    cells = [("a", "x", 2_500_050_000), ("a", "y", 2_499_950_000), ("b", "x", 2_499_950_000), ("b", "y", 2_500_050_000)]
    df = spark.createDataFrame(cells, "r string, c string, n long")
    want = tails.normal_two_sided((4 * 50_000) / 1e5)
    exact = contingency.fisher_2x2(df, "r", "c", (("a", "b"), ("x", "y")), weight="n").first()
    assert exact["a"] == 2_500_050_000 and exact["p_value"] == pytest.approx(want, rel=1e-3)
    drawn = contingency.fisher_monte_carlo(df, "r", "c", 2000, 3, weight="n").first()["p_value"]
    assert drawn == pytest.approx(want, abs=0.02)


def test_models_say_when_they_do_not_converge(spark):
    rows = [(float(i), float(i > 20)) for i in range(40)]
    with pytest.raises(Exception):
        regression.logistic(spark.createDataFrame(rows, "x double, y double"), "y", ["x"])


def test_random_tables_bound_cells_and_score_unseen_ones(spark, monkeypatch):
    rows = [("a", "x", 9), ("b", "y", 8), ("c", "z", 7), ("a", "z", 2)]
    df = spark.createDataFrame(rows, "r string, c string, n long")
    assert contingency.fisher_monte_carlo(df, "r", "c", 300, 5, weight="n").first()["p_value"] == pytest.approx(1 / 301)
    even = spark.createDataFrame([(a, b, 5) for a in "abc" for b in "xyz"], "r string, c string, n long")
    assert contingency.fisher_monte_carlo(even, "r", "c", 300, 5, weight="n").first()["p_value"] == 1
    monkeypatch.setattr(contingency, "MAX_CELLS", 8, raising=False)
    with pytest.raises(ValueError, match="cells"):
        contingency.fisher_monte_carlo(even, "r", "c", 300, 5, weight="n")
