"""Every registered query with SQL, compared with DuckDB on the smallest tables."""

import inspect

import pytest

import __spark_entry__ as entry
import registry
from registry import files, streams
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
JOBS = {n for n, fn in registry.QUERIES.items() if inspect.getmodule(fn) in (files, streams)}
# The jobs have tests of their own; a few stand for their kind here.
CHOSEN = sorted((set(registry.SQL) - JOBS) | {"csv_scan", "json_scan", "parquet_scan_drifting", "load_scd2"})


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_agrees_with_sql(spark, duck, name):
    _, problem = compare(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name])
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(registry.QUERIES) <= set(entry.queries())


def test_folds_and_merges_have_no_nested_loops(spark):
    for name in ("scd1_merge", "scd1_fold", "scd2_merge", "scd2_from_snapshots", "fact_load_filtered", "purge_candidates"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEval" not in plan, name


def test_scans_are_pruned_and_filtered(spark):
    plan = entry.queries()["export_lookback"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts)" in plan
    plan = entry.queries()["row_hash_concat"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" not in plan.split("ReadSchema")[1]
