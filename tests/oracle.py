"""Run a registered query and its SQL and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v).__name__), str(v)) for v in row)


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(_plain(r[n]) for n in names) for r in df.select(*names).collect()]
    return names, sorted(rows, key=_key)


def sql_rows(con, sql):
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in rel.fetchall()]
    return [rel.columns[i] for i in order], sorted(rows, key=_key)


def differences(df, con, sql):
    names, ours = spark_rows(df)
    other, theirs = sql_rows(con, sql)
    if names != other:
        return f"columns {names} != {other}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        cells = [(n, x, y) for n, x, y in zip(names, *bad[0]) if x != y]
        return f"{len(bad)} of {len(ours)} rows differ, first: {cells}"
    types = [(n, type(x).__name__, type(y).__name__) for r, s in zip(ours, theirs)
             for n, x, y in zip(names, r, s) if type(x) is not type(y)]
    return f"types {types[0]}" if types else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    import __spark_entry__ as e

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = e.oracle_sql()
    for name, fn in e.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sql:
                found = differences(df, con, sql[name])
                note = found or "ok"
            else:
                note = f"rows only: {df.count()}"
        except Exception as exc:  # report and go on
            note = "ERROR " + str(exc)[:1500]
        print(f"{name:32s} {time.time() - start:6.2f}s {note}", flush=True)
