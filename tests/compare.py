"""Run registered queries next to their SQL oracle and compare whole results.

SF_DIR chooses the tables, HOT_ROWS a small size from which keys are split.
"""
from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return "NULL" if value is None else str(value)


def database(folder: str):
    import duckdb

    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def spark_rows(df):
    names = sorted(df.columns)
    rows = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return names, rows, [kinds[n] for n in names]


def oracle_rows(db, sql):
    cursor = db.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = dict(zip(columns, [str(d[1]) for d in cursor.description]))
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    names = [columns[i] for i in order]
    return names, rows, [kinds[n] for n in names]


SAME = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def difference(df, db, sql) -> str | None:
    names, rows, kinds = spark_rows(df)
    o_names, o_rows, o_kinds = oracle_rows(db, sql)
    if names != o_names:
        return f"columns {names} != {o_names}"
    if len(rows) != len(o_rows):
        return f"{len(rows)} rows != {len(o_rows)}"
    for a, b in zip(rows, o_rows):
        if a != b:
            only = sorted(set(rows) - set(o_rows))[:2], sorted(set(o_rows) - set(rows))[:2]
            return f"{names}: {len(set(rows) - set(o_rows))} rows differ, {only[0]} != {only[1]}"
    wrong = [(n, a, b) for n, a, b in zip(names, kinds, o_kinds) if SAME.get(a, a) != b]
    return f"types {wrong}" if wrong else None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.touchline.hotGroupRows", os.environ.get("HOT_ROWS", "1000000")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db = database(folder)
    wanted = sys.argv[1:]
    sqls, failed = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and not any(w == name for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in sqls:
                problem = difference(df, db, sqls[name])
            else:
                rows = df.collect()
                problem = None if rows else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        mark = "FAIL" if problem else ("ok" if name in sqls else "rows")
        print(f"{mark:5}{time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
