"""Queries over sources and sinks. Files are written below the shared checkpoint folder."""
from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from touchline.operators.reshape import cells_to_rows, drop_leading, promote_header
from touchline.queries.common import query, spread
from touchline.session import scratch_dir
from touchline.sources import catalog, files, markup, tables

ORDER_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                "o_orderdate DATE, o_orderpriority STRING")


def _orders(spark, folder):
    orders = tables.table(spark, folder, "orders")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _holed(orders):
    return orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))


ORDERS_SQL = """SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""


@query(ORDERS_SQL)
def csv_round_trip(spark, folder):
    path = scratch_dir(spark, "orders-csv")
    files.write_csv(_holed(_orders(spark, folder)), path)
    return files.read_csv(spark, path, ORDER_SCHEMA)


@query(ORDERS_SQL)
def gzip_csv_round_trip(spark, folder):
    path = scratch_dir(spark, "orders-gz")
    files.write_csv(_holed(_orders(spark, folder)), path, compression="gzip")
    return files.read_csv(spark, path, ORDER_SCHEMA, spread_over=spark.sparkContext.defaultParallelism)


@query(ORDERS_SQL)
def numbered_csv_round_trip(spark, folder):
    """A file with an unnamed leading row counter; the counter is dropped on reading."""
    path = scratch_dir(spark, "orders-numbered")
    orders = _holed(_orders(spark, folder))
    files.write_csv(orders.select(F.col("o_orderkey").alias("_row"), "*"), path)
    return files.read_csv(spark, path, ORDER_SCHEMA)


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  CASE WHEN year(o_orderdate) % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'Q' || o_custkey END AS seed,
  count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL""")
def yearly_files(spark, folder):
    """Years whose seed is a number and years whose seed is text, read with one wide type."""
    path = scratch_dir(spark, "orders-years")
    year = F.year("o_orderdate")
    seed = F.when(year % 2 == 0, F.col("o_custkey").cast("string")).otherwise(F.concat(F.lit("Q"), F.col("o_custkey")))
    out = _orders(spark, folder).select(year.alias("year"), seed.alias("seed"), "o_totalprice")
    out.write.partitionBy("year").option("header", True).csv(path)
    stacked = files.read_years(spark, f"{path}/year=*", "seed STRING, o_totalprice DOUBLE", r"year=(\d{4})")
    return stacked.groupBy("year", "seed").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_custkey,
  CASE WHEN year(o_orderdate) % 2 = 0 THEN o_orderstatus END AS o_orderstatus FROM orders""")
def yearly_files_by_name(spark, folder):
    """Years with the columns in another order, and years that lack one."""
    path = scratch_dir(spark, "orders-mixed")
    orders = _orders(spark, folder).withColumn("year", F.year("o_orderdate"))
    even, odd = orders.where("year % 2 = 0"), orders.where("year % 2 = 1")
    for rows, columns in ((even, ["o_custkey", "o_orderstatus", "o_orderkey"]), (odd, ["o_orderkey", "o_totalprice", "o_custkey"])):
        rows.select("year", *columns).write.mode("append").partitionBy("year").option("header", True).csv(path)
    stacked = files.read_years(spark, f"{path}/year=*", "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING", r"year=(\d{4})")
    return stacked.select("year", "o_orderkey", "o_custkey", "o_orderstatus")


BROKEN_SQL = "SELECT o_orderkey, o_orderstatus || chr(10) || '\"' || o_orderpriority || '\", NA' || chr(10) AS note FROM orders"


def _broken(spark, folder):
    note = F.concat("o_orderstatus", F.lit('\n"'), "o_orderpriority", F.lit('", NA\n'))
    return _orders(spark, folder).select("o_orderkey", note.alias("note"))


@query(BROKEN_SQL)
def csv_with_line_breaks(spark, folder):
    """Texts with line breaks and quotes survive writing and reading, plain and gzipped."""
    plain, packed = scratch_dir(spark, "orders-breaks"), scratch_dir(spark, "orders-breaks-gz")
    rows = _broken(spark, folder)
    files.write_csv(rows.where("o_orderkey % 2 = 0"), plain)
    files.write_csv(rows.where("o_orderkey % 2 = 1"), packed, compression="gzip")
    return files.read_csv(spark, [plain, packed], "o_orderkey BIGINT, note STRING")


@query(BROKEN_SQL)
def csv_in_ranges(spark, folder):
    """Records over several lines, read in byte ranges by many tasks."""
    path = scratch_dir(spark, "orders-ranges")
    files.write_csv(_broken(spark, folder), path)
    return files.read_csv(spark, path, "o_orderkey BIGINT, note STRING", in_ranges=True)


@query(BROKEN_SQL)
def zip_with_line_breaks(spark, folder):
    """Zip members whose records span lines, half of them with the columns in another order."""

    def pack(batches):
        for batch in batches:
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                half = len(batch) // 2
                archive.writestr("a.csv", batch[:half].to_csv(index=False))
                archive.writestr("b.csv", batch[half:][["note", "o_orderkey"]].to_csv())
            yield pd.DataFrame({"content": [held.getvalue()]})

    return files.zip_csv(_broken(spark, folder).mapInPandas(pack, "content binary"), "o_orderkey BIGINT, note STRING")


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_orderstatus, count(*) AS n
  FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY ALL""")
def season_scan(spark, folder):
    path = scratch_dir(spark, "orders-seasons")
    orders = _orders(spark, folder).withColumn("season", F.year("o_orderdate"))
    tables.write_seasons(orders, path, "season")
    seasons = tables.season_scan(spark, path, "season", 1996, 1998)
    return seasons.groupBy("season", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem
  WHERE l_suppkey = 7 AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'""")
def keyed_date_range(spark, folder):
    line = tables.table(spark, folder, "lineitem")
    kept = tables.keyed_range_scan(line, "l_suppkey", 7, "l_shipdate", "1996-01-01", "1997-12-31")
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("l_shipdate"))


@query("""WITH wanted AS (SELECT s_suppkey, CAST(y AS INTEGER) AS year FROM supplier,
    range(1995, 2002) AS r(y) WHERE y BETWEEN 1995 + s_suppkey % 3 AND 1998 + s_suppkey % 4 AND y <> 1997)
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity
  FROM lineitem JOIN wanted ON l_suppkey = s_suppkey AND year(l_shipdate) = wanted.year GROUP BY ALL""")
def key_fan_out(spark, folder):
    supplier = tables.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), (1995 + F.col("s_suppkey") % 3).cast("int").alias("first"),
        (1998 + F.col("s_suppkey") % 4).cast("int").alias("last"),
    )
    wanted = tables.key_years(supplier, "l_suppkey", "first", "last", excluded=[1997])
    facts = tables.table(spark, folder, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("year"), "l_quantity"
    )
    return tables.fan_out_scan(facts, wanted, ["l_suppkey", "year"]).groupBy("l_suppkey", "year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity")
    )


@query("""SELECT s_suppkey AS l_suppkey, CAST(y AS INTEGER) AS year FROM supplier, range(1993, 1997) AS r(y)
  WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND year(l_shipdate) = y)""")
def keys_without_rows(spark, folder):
    supplier = tables.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.lit(1993).alias("first"), F.lit(1996).alias("last")
    )
    facts = tables.table(spark, folder, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("year"))
    return tables.missing_keys(facts, tables.key_years(supplier, "l_suppkey", "first", "last"), ["l_suppkey", "year"])


@query("""SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice FROM orders""")
def zip_members(spark, folder):
    """Orders packed into zip archives (one per batch) and read back from the inner CSV."""
    orders = _holed(_orders(spark, folder)).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")

    def pack(batches):
        for batch in batches:
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.txt", "not data\n")
                archive.writestr("orders.csv", batch.to_csv(index=False, na_rep="NA"))
            yield pd.DataFrame({"path": [f"{batch['o_orderkey'].iloc[0]}.zip"], "content": [held.getvalue()]})

    archives = orders.mapInPandas(pack, "path string, content binary")
    return files.zip_csv(archives, "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def column_json(spark, folder):
    orders = _orders(spark, folder).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return files.from_column_chunks(files.column_chunks(orders, "o_orderkey", 500), orders.schema)


@query("""SELECT user_id, event_type, nullif(value, 0.01) AS value, event_id FROM events""")
def json_round_trip(spark, folder):
    path = scratch_dir(spark, "events-json")
    events = tables.table(spark, folder, "events")
    out = events.select("user_id", "event_type", F.nullif("value", F.lit(0.01)).alias("value"), "event_id")
    files.write_json(out, path)
    return spark.read.schema(out.schema).json(path)


def _result_pages(spark, folder):
    """One HTML page per order: a small menu table, then a table with header rows."""
    cells = ["o_orderkey", "o_custkey", "o_orderpriority"]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), F.col(c).cast("string"), F.lit("</td>")) for c in cells],
                   F.lit("</tr>"))
    head = F.lit("<tr><th>Key</th><th>Customer</th><th>Priority</th></tr>")
    html = F.concat(
        F.lit("<html><body><table><tr><td>menu</td></tr></table><table class='results'>"), head, row, head,
        F.lit("<tr><td colspan='2'>price &amp; status</td><td>"), F.col("o_orderstatus"),
        F.lit("</td></tr></table></body></html>"),
    )
    orders = tables.table(spark, folder, "orders").select(*cells, "o_orderstatus")
    return spread(orders).select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


@query("""SELECT o_orderkey AS page_id, CAST(o_orderkey AS VARCHAR) AS "Key", CAST(o_custkey AS VARCHAR) AS "Customer",
    o_orderpriority AS "Priority", 2 AS row_no FROM orders
  UNION ALL SELECT o_orderkey, 'price & status', 'price & status', o_orderstatus, 4 FROM orders""")
def html_tables(spark, folder):
    """Second table of each page: header row promoted, repeated header rows dropped."""
    rows = markup.table_rows(_result_pages(spark, folder), "page_id", "html")
    cells = markup.table_columns(rows, 2, 3)
    return promote_header(cells, "row_no", keep=["page_id"], first=1)


@query("""SELECT o_orderkey AS page_id, 4 AS row_no, 'price & status' AS "X1", 'price & status' AS "X2",
  o_orderstatus AS "X3" FROM orders""")
def leading_rows_dropped(spark, folder):
    rows = markup.table_rows(_result_pages(spark, folder), "page_id", "html")
    return drop_leading(markup.table_columns(rows, 2, 3), "row_no", 3)


CLEAN_SQL = """regexp_replace(regexp_replace(replace(replace(replace({0}, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g'),
  '\\s+', ' ', 'g')"""


@query(f"""SELECT page_id, 'h1' AS selector, 0 AS pos,
  trim({CLEAN_SQL.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}) AS text FROM pages
  UNION ALL SELECT page_id, '.ad', 0,
  trim({CLEAN_SQL.format("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")}) FROM pages""")
def page_texts(spark, folder):
    pages = tables.table(spark, folder, "pages")
    return markup.selected_texts(pages, "page_id", "html", ["h1", ".ad"])


MENU_SQL = """menu AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">(.*?)</a></li>', 1)) AS item,
  unnest(range(len(regexp_extract_all(html, '<li><a href="[^"]*">(.*?)</a></li>', 1)))) AS pos FROM pages)"""


@query(f"""WITH {MENU_SQL} SELECT page_id, CAST(pos AS INTEGER) AS pos, item, item AS link FROM menu""")
def parallel_vectors(spark, folder):
    """Two selectors of equal length put side by side."""
    texts = markup.selected_texts(tables.table(spark, folder, "pages"), "page_id", "html", ["li", "a"])
    return markup.parallel_vectors(texts, {"li": "item", "a": "link"})


@query(f"""WITH {MENU_SQL} SELECT page_id, CAST(pos // 3 AS INTEGER) AS row_no,
  max(item) FILTER (pos % 3 = 0) AS "X1", max(item) FILTER (pos % 3 = 1) AS "X2", max(item) FILTER (pos % 3 = 2) AS "X3"
  FROM menu GROUP BY ALL""")
def flat_cells_to_rows(spark, folder):
    texts = markup.selected_texts(tables.table(spark, folder, "pages"), "page_id", "html", ["li"])
    return cells_to_rows(texts, ["page_id"], "pos", "text", 3)


@query("""SELECT topic, count(*) AS pages, min(doc_id) AS first_page, max(doc_id) AS last_page FROM (
    SELECT doc_id, 'language ' || lang AS topic FROM documents UNION SELECT doc_id, lower(source) FROM documents)
  GROUP BY topic""")
def topic_catalog(spark, folder):
    """Topics from the front matter of pages made from the documents' own text."""
    front = F.concat(
        F.lit("---\ntitle: page\ncategories:\n  - Language "), F.upper("lang"), F.lit("\n  - \""),
        F.upper("source"), F.lit("\"\n  - language "), F.col("lang"), F.lit("\nfreeze: auto\n---\n"), F.col("text"),
    )
    pages = tables.table(spark, folder, "documents").select("doc_id", front.alias("page"))
    return catalog.topic_index(catalog.page_topics(pages, "doc_id", "page"), "doc_id")


CONTRACTS = {
    "nation": catalog.Contract(("n_nationkey", "n_name", "n_regionkey"), ("n_nationkey",), 25),
    "orders": catalog.Contract(
        ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_shippriority"), ("o_orderkey",)),
    "lineitem": catalog.Contract(("l_orderkey", "l_linenumber"), ("l_orderkey", "l_linenumber")),
    "events": catalog.Contract(("event_id", "ts", "user_id", "event_type", "value", "props"), ("event_id",), 1000),
}


def _contract_sql(name, contract, columns):
    declared = f"count(*) = {contract.rows}" if contract.rows is not None else "CAST(NULL AS BOOLEAN)"
    key = ", ".join(contract.key)
    absent = len([c for c in contract.columns if c not in columns])
    extra = len([c for c in columns if c not in contract.columns])
    holes = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)
    return f"""SELECT '{name}' AS table_name, count(*) AS n_rows, {len(columns)} AS n_columns, {absent} AS absent_columns,
      {extra} AS undeclared_columns, count(DISTINCT ({key})) AS n_keys, {holes} AS missing_cells,
      count(DISTINCT ({key})) = count(*) AS key_is_unique, {declared} AS rows_as_declared FROM {name}"""


ACTUAL = {
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


@query(" UNION ALL ".join(_contract_sql(n, c, ACTUAL[n]) for n, c in CONTRACTS.items()))
def contract_check(spark, folder):
    return catalog.check_contracts({n: tables.table(spark, folder, n) for n in CONTRACTS}, CONTRACTS)
