"""Compare every registered query with its SQL on DuckDB.

    python tests/check_queries.py [folder] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    """A value both engines can be compared by."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str([plain(row[i]) for i in order]) for row in rows)


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def compare(spark, connection, folder, key):
    """(agrees or None without SQL, rows, seconds Spark, seconds SQL, note)"""
    start = time.time()
    frame = entry_points.queries()[key](spark, folder)
    got = [tuple(r) for r in frame.collect()]
    spent = time.time() - start
    sql = entry_points.oracle_sql().get(key)
    if sql is None:
        return None, len(got), spent, 0.0, "no SQL"
    start = time.time()
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    wanted = cursor.fetchall()
    sql_spent = time.time() - start
    if sorted(names) != sorted(frame.columns):
        return False, len(got), spent, sql_spent, f"columns {frame.columns} / {names}"
    a, b = rows_of(frame.columns, got), rows_of(names, wanted)
    note = f"{dict(frame.dtypes)} / {kinds}" if os.environ.get("TYPES") else ""
    if a == b:
        return True, len(got), spent, sql_spent, note
    first = next(((x, y) for x, y in zip(a, b) if x != y), (len(a), len(b)))
    return False, len(got), spent, sql_spent, f"{len(a)} / {len(b)} rows; first difference: {str(first)[:1500]}"


def main():
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    keys = sys.argv[2:] or list(entry_points.queries())
    bad = 0
    for key in keys:
        try:
            agrees, n, spent, sql_spent, note = compare(spark, connection, folder, key)
        except Exception as error:  # noqa: BLE001
            agrees, n, spent, sql_spent, note = False, 0, 0.0, 0.0, f"{type(error).__name__}: {str(error)[:1200]}"
        bad += agrees is False
        print({True: "ok  ", False: "BAD ", None: "rows"}[agrees], f"{key:28s} {n:8d} rows {spent:6.1f}s sql {sql_spent:5.1f}s {note}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
