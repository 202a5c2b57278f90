"""Run queries and their SQL side by side: `python -m checks.compare <sf_dir> [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool | str):
        return value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return round(float(value), 9)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None if equal, else what differs."""
    got = QUERIES[name](spark, sf_dir)
    got_rows = rows_of(got.columns, got.collect())
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    want_rows = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(got.columns):
        return f"columns {got.columns} against {columns}"
    if got_rows != want_rows:
        extra, missing = got_rows - want_rows, want_rows - got_rows
        return (
            f"{extra.total()} extra, {missing.total()} missing of {want_rows.total()}; "
            f"extra {str(extra.most_common(2))[:400]} missing {str(missing.most_common(2))[:400]}"
        )
    return None


def main() -> None:
    sf_dir, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    for name in names or QUERIES:
        start = time.time()
        if name not in ORACLE:
            print("## no oracle", name, flush=True)
            continue
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:
            problem = f"error {str(error)[:600]}"
        print(f"## {'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main()
