"""Joins, reshaping, sources, sampling."""
from __future__ import annotations

import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline import session
from touchline.operators import joins, reshape, sampling, verbs
from touchline.sources import catalog, files, markup, tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_natural_joins_match_missing_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([("x", 10), (None, 20), ("z", 30)], "k string, b int")
    assert rows(joins.natural_left(a, b)) == sorted([("x", 1, 10), (None, 2, 20), ("y", 3, None)], key=str)
    assert rows(joins.natural_full(a, b)) == sorted(
        [("x", 1, 10), (None, 2, 20), ("y", 3, None), ("z", None, 30)], key=str)


def test_natural_full_of_equal_schemas_is_a_union(spark):
    a = spark.createDataFrame([(1, "p"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(2, None), (3, "q")], "i int, s string")
    assert rows(joins.natural_full(a, b)) == [(1, "p"), (2, None), (3, "q")]
    with pytest.raises(ValueError):
        joins.natural_left(a, b.toDF("u", "v"))


def test_match_classes_and_join_sizes(spark):
    a = spark.createDataFrame([("p",), ("p",), ("q",), ("r",)], "k string")
    b = spark.createDataFrame([("p",), ("p",), ("p",), ("s",)], "k string")
    made = {r["k"]: (r["left_rows"], r["right_rows"], r["match"]) for r in joins.match_classes(a, b, ["k"]).collect()}
    assert made == {"p": (2, 3, "both"), "q": (1, 0, "left only"), "r": (1, 0, "left only"), "s": (0, 1, "right only")}
    sizes = {r["join_type"]: r["result_rows"] for r in joins.join_sizes(a, b, ["k"]).collect()}
    for kind, name in (("inner", "inner"), ("left", "left"), ("right", "right"), ("full", "full"), ("semi", "left_semi"),
                       ("anti", "left_anti")):
        assert sizes[kind] == a.join(b, "k", name).count(), kind


def test_names_and_positions(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["+/-", "10%", "a/b", "a.b"])
    assert verbs.sanitize_names(df).columns == ["plus_minus", "x10pct", "a_per_b", "a_b"]
    plain = df.toDF("a", "b", "c", "d")
    assert verbs.column_range(plain, "b", "d") == ["b", "c", "d"]
    assert verbs.move(plain, ["d"], before="b").columns == ["a", "d", "b", "c"]
    assert verbs.by_position(plain, [4, 1]).columns == ["d", "a"]
    assert verbs.rename_positions(plain, {2: "z"}).columns == ["a", "z", "c", "d"]


def test_null_columns_and_levels(spark, sizes):
    df = spark.createDataFrame([(1, None, "b"), (2, 5, "a"), (3, 6, None)], "i int, h int, f string")
    assert verbs.drop_null_columns(df).columns == ["i"]
    assert {r["i"]: r["code"] for r in verbs.encode_levels(df, "f", "code").collect()} == {1: 2, 2: 1, 3: None}


def test_wider_names_and_indicator(spark):
    df = spark.createDataFrame([("t", "pass", 1), ("t", "run", 4), ("u", "run", 2)], "k string, p string, v int")
    made = reshape.wider(df, ["k"], "p", ["pass", "run"], {"n": F.count(F.lit(1)), "v": F.sum("v")})
    assert made.columns == ["k", "n_pass", "n_run", "v_pass", "v_run"]
    assert rows(made) == [("t", 1, 1, 1, 4), ("u", None, 1, None, 2)]
    assert rows(reshape.indicator(df, ["k"], "p", ["pass", "run"], F.lit(1))) == [("t", 1, 1), ("u", 0, 1)]


def test_promote_header_and_cells(spark):
    cells = spark.createDataFrame([(1, i, v) for i, v in enumerate(["N", "T", "a", "1", "N", "T", "b", "2"])], "p int, i int, t string")
    table = reshape.cells_to_rows(cells, ["p"], "i", "t", 2)
    made = reshape.promote_header(table, "row_no", keep=["p"])
    assert made.columns == ["p", "row_no", "N", "T"] and rows(made) == [(1, 1, "a", "1"), (1, 3, "b", "2")]


def test_samples_are_fixed_and_whole_when_small(spark):
    df = spark.range(300).select((F.col("id") % 7 == 0).alias("g"), "id")
    one = sampling.sample_per_group(df, ["g"], ["id"], 50, 3)
    assert rows(one) == rows(sampling.sample_per_group(df.repartition(5), ["g"], ["id"], 50, 3))
    assert {r["g"]: r["count"] for r in one.groupBy("g").count().collect()} == {True: 43, False: 50}
    assert rows(one) != rows(sampling.sample_per_group(df, ["g"], ["id"], 50, 4))


def test_bootstrap_weights_are_poisson(spark):
    df = spark.range(20000).select(F.col("id"), sampling.poisson_weight(5, F.lit(1), "id").alias("w"))
    mean, variance, none = df.agg(F.avg("w"), F.var_samp("w"), F.avg((F.col("w") == 0).cast("int"))).first()
    assert abs(mean - 1) < 0.03 and abs(variance - 1) < 0.05 and abs(none - np.exp(-1)) < 0.01


def test_bootstrap_spread_is_the_standard_error(spark):
    df = spark.range(4000).select("id", (F.col("id") % 10).cast("double").alias("x"), F.lit("a").alias("g"))
    means = sampling.bootstrap_means(df, ["g"], "x", ["id"], 200, 1)
    spread = means.agg(F.stddev("mean")).first()[0]
    assert spread == pytest.approx(np.std(np.arange(10)) / np.sqrt(4000), rel=0.2)


def test_zip_of_csv(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("note.txt", "x,y\n9,9\n")
        archive.writestr("in/data.csv", "x,y\r\n1,NA\r\n2,é\r\n")
    made = files.zip_csv(files.zip_archives(spark, str(tmp_path / "a.zip")), "x INT, y STRING")
    assert rows(made) == [(1, None), (2, "é")]


def test_csv_with_counter_newlines_and_crlf(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('"","a b","n%"\r\n1,"two\nlines",NA\r\n2,é,3.5\r\n'.encode())
    made = files.read_csv(spark, str(path), "`a b` STRING, `n%` DOUBLE", multi_line=True)
    assert rows(made) == [("two\nlines", None), ("é", 3.5)]


def test_files_are_matched_by_name(spark, tmp_path):
    (tmp_path / "2018.csv").write_text("a,b\n1,x\n")
    (tmp_path / "2019.csv").write_text("b,a,more\ny,2,q\n")
    (tmp_path / "2020.csv").write_text("a\n3\n")
    made = files.read_years(spark, str(tmp_path), "a INT, b STRING")
    assert sorted(map(tuple, made.collect())) == [(1, "x", 2018), (2, "y", 2019), (3, None, 2020)]
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path), "a INT, c STRING")


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"{i}.csv").write_bytes(('\ufeff"a","b ""x""\nc"\r\n' if i % 2 else '"b ""x""\nc",a,a2\n').encode() + (b"1,2\n" if i % 3 else b"") * 500)
    (tmp_path / "empty.csv").write_text("")
    wide = ",".join(["a", "", "A", "z"])
    (tmp_path / "odd.csv").write_text(f"\n{wide}\n1,2,3,4\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    found = files._headers(spark, str(tmp_path))
    jobs = tracker.getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {k: len(v) for k, v in found.items()} == {("a", 'b "x"\nc'): 30, ('b "x"\nc', "a", "a2"): 30, ("a0", "_c1", "A2", "z"): 1}
    assert len(jobs) <= 2 and spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_zip_members_are_unpacked_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "CHUNK", 1000)
    texts = {f"m{i}.csv": "".join(f"{j},line {j * i}é\n" for j in range(0 if i == 5 else 500)) for i in range(8)}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        for i, (name, text) in enumerate(texts.items()):
            archive.writestr(name, "n,t\n" + text, zipfile.ZIP_DEFLATED if i % 2 else zipfile.ZIP_STORED)
        archive.writestr("none.csv", "")
    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("big.csv", "n,t\n" + "7,same\n" * 300_000)
    archives = files.zip_archives(spark, str(tmp_path / "a.zip"))
    lines = files.zip_lines(archives)
    got = {}
    for row in lines.orderBy("member", "line_no").collect():
        got.setdefault(row["member"], []).append(row["line"])
    assert got == {name: ["n,t", *text.splitlines()] for name, text in texts.items()}
    tasks = lines.select(F.spark_partition_id().alias("task"), "member").distinct().groupBy("member").agg(F.count(F.lit(1)).alias("n"))
    assert {r["n"] for r in tasks.collect()} == {1} and lines.select(F.spark_partition_id()).distinct().count() > 1
    both = archives.unionByName(archives).unionByName(files.zip_archives(spark, str(tmp_path / "b.zip"))).drop("path")
    read = files.zip_csv(both, "t STRING, n INT")
    assert read.count() == 2 * 7 * 500 + 300_000 and read.where("t = 'same'").agg(F.sum("n")).first()[0] == 2_100_000


def test_file_names_with_marks(spark, tmp_path):
    names = ["a b.csv", "c%20d.csv", "é[1].csv", "x{y}*?.csv"]
    for i, name in enumerate(names):
        (tmp_path / name).write_text(f"a,b\n{i},x\n")
    for ranges in (False, True):
        made = files.read_csv(spark, str(tmp_path), "a INT, b STRING", in_ranges=ranges)
        assert rows(made) == [(i, "x") for i in range(4)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_byte_ranges_give_what_one_task_gives(spark, tmp_path, end):
    draw = random.Random(3)
    for name in ("x", "y", "z"):
        made = [f"n,s{end}" if name != "y" else f"{end}\ufeffs,more,n{end}"]
        for i in range(0 if name == "z" else 600):
            inner = "".join(draw.choice(["a", "é", '""', ",", "\n", "\n\n", "NA", " "]) for _ in range(draw.choice([0, 2, 9, 400 if i % 50 == 0 else 3])))
            cell = draw.choice(["NA", "", "plain", f'"{inner}"', f'"{inner}"', f'"{inner}x"'])
            made.append(f"{i},{cell}{end}" if name == "x" else f"{cell},{i}.5,{i}{end}")
            made += [end] if draw.random() < 0.05 else []
        (tmp_path / f"{name}.csv").write_bytes("".join(made).encode())
    (tmp_path / "empty.csv").write_text("")
    wanted = sorted(map(repr, rows(files.read_csv(spark, str(tmp_path), "n LONG, s STRING", path_column="f"))))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("1000", "250", "100000000"):  # shorter than some records, and whole files
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = sorted(map(repr, rows(files.read_csv(spark, str(tmp_path), "n LONG, s STRING", path_column="f", in_ranges=True))))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert len(got) == 1200 and got == wanted


def test_missing_mark_can_be_chosen(spark, tmp_path):
    df = spark.createDataFrame([(1, "NA"), (2, None), (3, ' "x"\ny, ')], "i int, s string")
    files.write_csv(df, str(tmp_path / "t"), missing="-")
    assert rows(files.read_csv(spark, str(tmp_path / "t"), "s STRING, i INT", missing="-")) == [(' "x"\ny, ', 3), ("NA", 1), (None, 2)]


def test_season_scan_reads_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "s")
    tables.write_seasons(spark.range(40).select("id", (1990 + F.col("id") % 8).alias("season")), path, "season")
    made = tables.season_scan(spark, path, "season", 1992, 1994)
    assert made.count() == 15
    assert "PartitionFilters: [isnotnull(season" in made._jdf.queryExecution().executedPlan().toString()


def test_keyed_scan_is_pushed_down(spark):
    line = tables.table(spark, "/root/testdata/sf0.001", "lineitem")
    plan = tables.keyed_range_scan(line, "l_suppkey", 3, "l_shipdate", "1996-01-01", "1996-12-31").select("l_tax")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_suppkey,3)" in text and "GreaterThanOrEqual(l_shipdate" in text


def test_column_json(spark):
    df = spark.range(10).select("id", (F.col("id") * 2).alias("v"), F.when(F.col("id") % 2 == 0, "e").alias("s"))
    chunks = files.column_chunks(df, "id", 4)
    assert chunks.count() == 3
    assert rows(files.from_column_chunks(chunks, df.schema)) == rows(df)


PAGE = """<html><head><style>td{a:"<td>"}</style></head><body><!-- <table><tr><td>no</td></tr></table> -->
<TABLE class=x><thead><tr><th rowspan="2">Name</th><th colspan=2>Score &amp; rank</th></tr>
<tr><th>S</th><th>R</th></tr></thead><tr><td>A<b>n</b>a<br>B</td><td> 1 <td>2</tr>
<tr><td>Q<table><tr><td>inner</td></tr></table></td><td title="a>b">7</td></tr></table>
<p class="time big">1:02<br>3</p><p>other</p><script>var x = "<p class='time'>no</p>";</script><div class="time">x&nbsp;y</div>"""


def test_html_tables_and_texts(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>no table")], "id int, html string")
    got = {(r["table_no"], r["row_no"]): list(r["cells"]) for r in markup.table_rows(pages, "id", "html").collect()}
    assert got == {(1, 1): ["Name", "Score & rank", "Score & rank"], (1, 2): ["Name", "S", "R"], (1, 3): ["Ana B", "1", "2"],
                   (1, 4): ["Q", "7"], (2, 1): ["inner"]}
    texts = markup.selected_texts(pages, "id", "html", [".time", "p", "p.big"])
    found = {(r["page_id"], r["selector"], r["pos"]): r["text"] for r in texts.collect()}
    assert found[1, ".time", 0] == "1:02\n3" and found[1, ".time", 1] == "x y" and found[1, "p.big", 0] == "1:02\n3"
    assert found[1, "p", 1] == "other" and found[3, "p", 0] == "no table" and len(found) == 6


def test_topics_and_contracts(spark):
    pages = spark.createDataFrame([
        ("a", '---\ntitle: "x"\ncategories:\n  - Histogram\n  - "Two words"\n---\ntext\n- not a topic'),
        ("b", "---\ncategories:\n  - histogram\nother: 1\n---\n"), ("c", "no front matter\ncategories:\n  - z")], "p string, t string")
    made = {r["topic"]: r["pages"] for r in catalog.topic_index(catalog.page_topics(pages, "p", "t"), "p").collect()}
    assert made == {"histogram": 2, "two words": 1}
    df = spark.createDataFrame([(1, None), (1, "y")], "k int, v string")
    check = catalog.check_contracts({"t": df}, {"t": catalog.Contract(("k", "w"), ("k",), 2)}).first()
    assert (check["n_rows"], check["n_keys"], check["missing_cells"], check["absent_columns"], check["undeclared_columns"],
            check["key_is_unique"], check["rows_as_declared"]) == (2, 1, 1, 1, 1, False, True)


def test_checkpoint_folder_comes_from_the_session(spark, tmp_path):
    folder = session.checkpoint_dir(spark)
    assert session.checkpoint_dir(spark) == folder
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")
    assert session.cut_lineage(spark.range(5)).count() == 5


def test_task_helpers_need_no_installed_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from touchline.functions import tails

    held = tmp_path / "helpers"
    held.write_bytes(cloudpickle.dumps((markup._read_tables, tails.t_two_sided)))
    code = ("import pickle; tables, area = pickle.load(open('helpers', 'rb'));"
            "print(tables('<table><tr><td>a<td>b</table>'), round(area(2.0, 10.0), 6))")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "[[['a', 'b']]] 0.073388", done.stderr


def test_a_row_that_only_begins_like_the_header_stays(spark):
    df = spark.createDataFrame([(0, "Name", "Pos"), (1, "Name", "x"), (2, "Name", "Pos"), (3, None, "y")], "n int, X1 string, X2 string")
    made = reshape.promote_header(df, "n")
    assert made.columns == ["n", "Name", "Pos"] and rows(made) == [(1, "Name", "x"), (3, None, "y")]


def test_python_work_is_dealt_in_small_tasks(spark, tmp_path, monkeypatch):
    from touchline.queries import common, sources

    spark.range(5000).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).repartition(9).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(common, "ROWS_A_TASK", 250)
    pages = sources._result_pages(spark, str(tmp_path))
    sizes = [r["count"] for r in pages.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and sum(sizes) == 5000 and max(sizes) <= 300


def test_tags_are_told_apart():
    texts = lambda html, *s: markup._read_texts(html, s)
    html = """<div class='a "b"'>x<script>if (1<2) "<p>"</script>y</div><!-- <div class="a"> --><P CLASS=a title="1>0">z &amp;  w</P><style>p{}</STYLE >"""
    assert texts(html, ".a", "p", "div") == {".a": ["xy", "z & w"], "p": ["z & w"], "div": ["xy"]}
    assert markup._read_tables("<table><tr><td colspan='2'>a<td rowspan=2>b</tr><tr><td>c<td>d</table>") == [[["a", "a", "b"], ["c", "d", "b"]]]


def test_runs_of_cells_equal_single_cells(spark):
    random.seed(4)
    pages = [(random.choice([None, *range(12)]), [random.choice([None, "a", "b", "é", ""]) for _ in range(random.randint(0, 11))]) for _ in range(60)]
    whole = spark.createDataFrame(pages, "p int, texts array<string>")
    single = whole.select("p", F.posexplode("texts").alias("i", "t"))
    made, want = reshape.runs_to_rows(whole, ["p"], "texts", 3), reshape.cells_to_rows(single, ["p"], "i", "t", 3)
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert made.schema.simpleString() == want.schema.simpleString() and order(made) == order(want)


def test_alpine_pages_are_dealt_once(spark):
    from touchline.plans import leagues

    heads = ["Rank", "Pr", "Bib", "Name", "Nat", "Total", "N°", "Run 1", "Run 2"]
    cells = [*heads, "1", "0", "4", "A", "N", "2:05.50", "7", "1:02.25 (1)", "1:03.25 (2)", "2", "-1", "5", "B", "N", "+1.50", "6", "+0.50 (2)", "+1.00 (1)"]
    html = "".join(f'<div class="sortable">{c}</div>' for c in cells)
    pages = spark.createDataFrame([(i, html if i else None) for i in range(5)], "page_id int, html string")
    made = leagues.alpine_results(pages, "page_id", "html")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # no shuffle of single cells, none for the window
    got = sorted((r["page_id"], r["Name"], r["Total_Time"], r["Run2_Time"]) for r in made.collect())
    assert got == [(i, n, t, r) for i in range(1, 5) for n, t, r in (("A", 125.5, 63.25), ("B", 127.0, 64.25))]
