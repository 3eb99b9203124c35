"""Runs registered queries beside their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both give the same columns and the same rows, else what differs."""
    relation = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} against {sorted(relation.columns)}"
    ours = Counter(tuple(row) for row in df.select(*(f"`{n}`" for n in names)).collect())
    picked = ", ".join(f'"{n}"' for n in names)
    theirs = Counter(relation.project(picked).fetchall())
    if ours == theirs:
        return None
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{ours.total()} rows against {theirs.total()}; only ours {list(extra)[:2]}; only theirs {list(missing)[:2]}"
    )[:2000]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    scale, *wanted = sys.argv[1:] or ["0.01"]
    spark = (
        SparkSession.builder.master(os.environ.get("ORACLE_MASTER", "local[8]"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    directory = f"{TESTDATA}/sf{scale}"
    database = connect(directory)
    for key, run in queries().items():
        if wanted and key not in wanted:
            continue
        start = time.time()
        sql = oracle_sql().get(key)
        try:
            result = run(spark, directory)
            verdict = differences(result, database, sql) or "same" if sql else f"{result.count()} rows, no SQL"
        except Exception as error:
            verdict = f"{type(error).__name__}: {error}"[:300]
        print(f"{key:34s} {time.time() - start:6.2f}s  {verdict}", flush=True)
