"""Runs registered queries next to their SQL forms and compares the rows.

``python -m tests.oracle [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value + 0.0:.9g}")
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_cell(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, con, run, sql: str, sf_dir: str) -> str:
    """Empty text when both results are equal, else what differs."""
    df = run(spark, sf_dir)
    mine = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(mine, df.columns), _rows(theirs, names)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{sorted(names)}\n   spark {str(x)[:600]}\n   sql   {str(y)[:600]}"
    return "" if a else "no rows"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = args[1:] or list(queries)
    bad = []
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, queries[name], oracle[name], sf_dir)
            else:
                problem = "" if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        kind = "sql " if name in oracle else "rows"
        print(f"{'ok  ' if not problem else 'FAIL'} {kind} {name} {time.time() - start:.1f}s {problem}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} equal; failed: {bad}")


if __name__ == "__main__":
    main()
