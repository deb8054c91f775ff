"""Run a registered query beside its SQL and compare the rows, order aside.

``python -m tests.oracle [sf_dir] [name prefix ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """Row count and a description of the first difference, None when equal."""
    expected = con.execute(sql)
    columns = [d[0] for d in expected.description]
    want = rows_of(columns, expected.fetchall())
    if sorted(df.columns) != sorted(columns):
        return 0, f"columns {sorted(df.columns)} expected {sorted(columns)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        return len(got), f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return len(got), f"\n  got      {a}\n  expected {b}"
    return len(got), None


def main() -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        begin = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                count, problem = compare(df, con, sqls[name])
            else:
                count, problem = df.count(), None
        except Exception as error:  # a broken query must not hide the others
            count, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:34s} {count:7d} rows {time.time() - begin:6.2f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
