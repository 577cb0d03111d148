"""Run every registered query beside its DuckDB counterpart and compare whole results.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in entry.TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    return repr(value)


def normalised(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, db, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    frame = entry.queries()[name](spark, folder)
    mine = normalised(frame.columns, frame.collect())
    seconds = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(mine[1])} rows, no oracle, {seconds:.2f}s"
    cursor = db.execute(sql)
    theirs = normalised([c[0] for c in cursor.description], cursor.fetchall())
    if mine == theirs:
        return True, f"{len(mine[1])} rows, {seconds:.2f}s"
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} and {theirs[0]}"
    first = next((p for p in zip(mine[1], theirs[1]) if p[0] != p[1]), None)
    return False, f"{len(mine[1])} and {len(theirs[1])} rows, first difference {str(first)[:1500]}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(folder), 0
    for name in names:
        try:
            same, note = compare(spark, db, folder, name)
        except Exception as error:
            same, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not same
        print("ok  " if same else "FAIL", name, note, flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
