from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from touchline.functions import numeric, tails, text


def one(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize("value, seconds", [
    ("39:56", 2396.0), ("1:20:31", 4831.0), ("1:02.5", 62.5), (" 5:00 ", 300.0), ("12.25", 12.25), ("DNF", None),
    ("1:xx", None), ("", None), (None, None)])
def test_clock(spark, value, seconds):
    assert one(spark, [value], text.clock_seconds("x")) == [seconds]


@pytest.mark.parametrize("value, number", [
    ("$1,234.50", 1234.5), ("155 lbs.", 155.0), ("-3.5%", -3.5), ("45%", 45.0), ("n/a", None), ("--", None), (None, None),
    ("1.5 of 7", 1.5), ("+0.40", 0.4)])
def test_first_number(spark, value, number):
    assert one(spark, [value], text.first_number("x")) == [number]


def test_pieces_beyond_the_end_are_missing(spark):
    df = spark.createDataFrame([("a / b / c / d",), ("a",), (None,)], "p string").withColumn("z", F.lit(1))
    made = text.split_into(df, "p", ["one", "two", "three"], " / ")
    assert made.columns == ["one", "two", "three", "z"]
    assert [tuple(r) for r in made.collect()] == [("a", "b", "c", 1), ("a", None, None, 1), (None, None, None, 1)]
    assert text.split_into(df, "p", ["one"], " / ", keep=True).columns == ["p", "one", "z"]


def test_split_at_both_ends(spark):
    assert one(spark, ["WS", "M", ""], text.split_at("x", 1)[0]) == ["W", "M", ""]
    assert one(spark, ["12.5%", "x", ""], text.split_at("x", -1)[0]) == ["12.5", "", ""]
    assert one(spark, ["12.5%", "x", ""], text.split_at("x", -1)[1]) == ["%", "x", ""]


def test_heights_names_codes(spark):
    assert one(spark, ["5' 11\"", "6' 0\"", "--"], text.feet_inches("x")) == [71, 72, None]
    assert one(spark, ["Ana de Souza", "Ana"], text.first_last_name("x")[1]) == ["de Souza", None]
    assert one(spark, ["OAK", "NYG", None], text.recode("x", {"OAK": "LV"})) == ["LV", "NYG", None]
    assert one(spark, ["Jul 14, 1988", "soon"], F.year(text.date_of("x", "MMM d, yyyy"))) == [1988, None]


def test_canonical_list_sorts_numbers_as_numbers(spark):
    df = spark.createDataFrame([(10, 9, None), (2, 10, 1)], "a int, b int, c int")
    assert [r[0] for r in df.select(text.canonical_list(["a", "b", "c"])).collect()] == ["9_10", "1_2_10"]


def test_unite_shows_missing(spark):
    df = spark.createDataFrame([(1, 2, None), (3, None, 4)], "k int, a int, b int")
    made = text.unite(df, "count", ["a", "b"], "-")
    assert made.columns == ["k", "count"] and [r["count"] for r in made.collect()] == ["2-NA", "NA-4"]


def test_missing_tests(spark):
    assert one(spark, ["made", "missed", None], text.mentions("x", "made")) == [True, False, None]
    test = F.col("x") > 1
    assert one(spark, [0, 2, None], numeric.if_else(test, F.lit("y"), F.lit("n")), "int") == ["n", "y", None]


@pytest.mark.parametrize("difference, label", [(0, "Low"), (30, "Low"), (31, "Medium"), (75, "Medium"), (76, "High"), (999, "High")])
def test_rank_bands(spark, difference, label):
    assert one(spark, [difference], numeric.bands("x", numeric.RANK_DIFFERENCE_BANDS), "int") == [label]


def test_ratings_and_trimmed_scores(spark):
    rows = [("K", 1.0), ("K", -1.0), ("BB", 1.0), ("SLG", -2.0), ("R", 0.0)]
    df = spark.createDataFrame(rows, "s string, p double")
    assert [r[0] for r in df.select(numeric.umpire_rating("s", "p")).collect()] == [
        "Defensive", "Offensive", "Offensive", "Defensive", "Neither"]
    judges = spark.createDataFrame([(8.0, 7.0, 7.5, 9.0, 6.0, 7.0, 7.5)], ", ".join(f"j{i} double" for i in range(7)))
    assert judges.select(numeric.trimmed_sum([f"j{i}" for i in range(7)], 2)).first()[0] == 22.0


def test_ratio_by_zero_is_missing(spark):
    assert one(spark, [0.0, 4.0], numeric.ratio(F.lit(8.0), "x", 100), "double") == [None, 200.0]


@pytest.mark.parametrize("kind, arguments, value", [
    ("t", (2.0, 10.0), 0.07338803477074037), ("t", (0.0, 3.0), 1.0), ("t", (12.706204736, 1.0), 0.05),
    ("f", (4.0, 2.0, 10.0), 1.8**-5), ("chi2", (3.841458820694124, 1.0), 0.05), ("chi2", (18.307038053, 10.0), 0.05),
    ("normal", (1.959963984540054,), 0.05), ("normal_cdf", (0.0,), 0.5), ("normal_quantile", (0.975,), 1.959963984540054),
    ("t_quantile", (0.975, 10.0), 2.2281388519649385), ("t_quantile", (0.025, 10.0), -2.2281388519649385),
    ("range", (3.877, 3.0, 10.0), 0.05), ("range", (3.949, 3.0, 9.0), 0.05), ("range", (4.232, 5.0, 20.0), 0.05), ("fisher", (3, 1, 1, 3), 0.48571428571)])
def test_tail_areas(spark, kind, arguments, value):
    got = spark.range(1).select(tails.area(kind, *arguments)).first()[0]
    assert got == pytest.approx(value, abs=2e-3 if kind == "range" else 1e-7)


def test_tail_areas_of_missing(spark):
    assert spark.range(1).select(tails.area("t", F.lit(None).cast("double"), 3.0)).first()[0] is None


def test_beta_and_gamma_closed_forms():
    assert tails.beta_area(0.3, 1, 1) == pytest.approx(0.3)
    assert tails.beta_area(0.3, 2, 1) == pytest.approx(0.09)
    assert tails.gamma_tail(2.0, 1) == pytest.approx(math.exp(-2))
    assert tails.chi2_upper(5.0, 2) == pytest.approx(math.exp(-2.5))


@pytest.mark.parametrize("n", [1e5, 1e9, 1e10, 1e11, 1e12, 1e13])
def test_areas_at_very_large_degrees_of_freedom(n):
    assert tails.f_upper(1.0, n, n) == pytest.approx(0.5, abs=1e-9)
    assert tails.t_two_sided(1.96, n) == pytest.approx(tails.normal_two_sided(1.96), rel=1e-4 if n < 1e6 else 1e-8)
    assert tails.t_quantile(0.975, n) == pytest.approx(1.959963984540054, rel=2e-5 if n < 1e6 else 1e-8)
    assert tails.chi2_upper(n + 1.96 * (2 * n) ** 0.5, n) == pytest.approx(0.0249979, rel=0.02 if n < 1e6 else 1e-3)
    assert tails.f_upper(3.841458820694124, 1, n) == pytest.approx(0.05, rel=1e-3 if n < 1e6 else 1e-7)


def test_integrals_meet_the_fractions(monkeypatch):
    cases = [(0.49, 9000.0, 9100.0), (0.9999, 9500.0, 0.5), (0.3, 3.0, 9.0), (0.02, 0.5, 40.0), (0.999, 9000.0, 2.0)]
    below = [tails.beta_area(*c) for c in cases] + [tails.gamma_tail(9100.0, 9000.0), tails.gamma_tail(8800.0, 9000.0)]
    monkeypatch.setattr(tails, "LARGE", 0.0)
    above = [tails.beta_area(*c) for c in cases] + [tails.gamma_tail(9100.0, 9000.0), tails.gamma_tail(8800.0, 9000.0)]
    assert above == pytest.approx(below, rel=1e-7)


def test_exact_2x2_against_whole_numbers():
    from fractions import Fraction
    from math import comb

    for a, b, c, d in [(3, 1, 1, 3), (0, 5, 7, 2), (12, 40, 33, 8), (0, 0, 4, 6), (10, 10, 10, 10), (60, 2, 1, 55)]:
        row, col, n = a + b, a + c, a + b + c + d
        ways = [comb(col, x) * comb(n - col, row - x) for x in range(max(0, row + col - n), min(row, col) + 1)]
        seen = comb(col, a) * comb(n - col, row - a)
        want = float(Fraction(sum(w for w in ways if w <= seen * (1 + Fraction(1, 10**7))), comb(n, row)))
        assert tails.fisher_two_sided(a, b, c, d) == pytest.approx(want, rel=1e-9)
