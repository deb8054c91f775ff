"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

A query is planned, run and written to Spark's no-op sink.  The first run of each warms the JVM,
the better of the next two counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

import registry  # noqa: E402
from lakeload.operators import scd1_merge, scd2_merge  # noqa: E402
from lakeload.schemas import ARCHIVED  # noqa: E402
from lakeload.session import configure  # noqa: E402
from registry import extracts as x  # noqa: E402

HEADLINE = {
    "scd1_merge": ["orders", "customer"],
    "scd1_fold": ["orders", "customer"],
    "scd1_duplicates_last": ["lineitem"],
    "scd1_partition_pruned": ["orders", "lineitem"],
    "scd2_merge": ["orders", "customer"],
    "scd2_from_snapshots": ["orders", "customer"],
    "fact_dim_as_of": ["orders", "customer"],
    "fact_merge": ["orders", "lineitem"],
    "fact_load_filtered": ["orders", "lineitem"],
    "fact_two_part_key": ["lineitem"],
    "fact_fold": ["orders", "customer"],
    "fact_fold_sliced": ["orders", "customer"],
    "scd2_fold_sliced": ["orders", "customer"],
    "scd1_fold_update_filter": ["orders", "customer"],
    "purge_candidates": ["events"],
    "purge_summary": ["events"],
    "purge_candidates_years": ["orders"],
    "pending_files": ["orders"],
    "export_changed": ["events"],
    "row_hash_safe": ["documents", "labels"],
}


def one_by_one(merge):
    """The yearly extracts merged one after another: what the folds replace."""

    def run(spark, sf_dir):
        years, table = x.customer_years(spark, sf_dir), None
        for year in range(1996, 2003):
            taken = x.stamp(f"{year}-01-01 00:00:00")
            table = merge(table, years.where(years[ARCHIVED] == taken), taken)
        return table

    return run


SEQUENTIAL = {
    "scd1_one_by_one": one_by_one(
        lambda t, s, _: scd1_merge(t, s, ["custkey"], on_duplicates="assume_unique")
    ),
    "scd2_one_by_one": one_by_one(
        lambda t, s, ts: scd2_merge(t, s, ["custkey"], ts, delete="full", on_duplicates="assume_unique")
    ),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lakeload-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    registry.load_all()
    plans = {name: registry.QUERIES[name] for name in HEADLINE} | SEQUENTIAL
    counts: dict[str, int] = {}
    times, rates = {}, {}
    for name, plan in plans.items():
        best = None
        for attempt in range(runs + 1):
            begin = time.perf_counter()
            plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begin
            if attempt or runs == 0:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        tables = HEADLINE.get(name, ["orders", "customer"])
        for table in tables:
            if table not in counts:
                counts[table] = x.table(spark, sf_dir, table).count()
        rates[name] = round(sum(counts[t] for t in tables) / best)
    total = round(sum(times.values()), 3)
    result = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "rows_per_sec": rates,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
