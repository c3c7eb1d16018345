"""Runs registered queries next to their SQL in DuckDB and compares whole results."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, db, name: str, query, folder: str) -> str | None:
    """None when both results are equal, else what differs."""
    df = query.run(spark, folder)
    got_columns, got = df.columns, df.collect()
    result = db.execute(query.sql)
    want_columns = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    left, right = rows_of(got_columns, map(tuple, got)), rows_of(want_columns, want)
    if left != right:
        return f"{len(got)} vs {len(want)} rows; only Spark {list((left - right).items())[:3]}; only SQL {list((right - left).items())[:3]}"
    return None


def main() -> None:
    from cratelight.plans.registry import load
    from cratelight.session import local_session

    folder = sys.argv[1]
    chosen = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name, query in load().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if query.sql is None:
                problem = None
                print(f"{name:28s} rows {query.run(spark, folder).count()} {time.time() - start:.1f}s (no SQL)")
                continue
            problem = difference(spark, db, name, query, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {'ok' if problem is None else problem} {time.time() - start:.1f}s", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
