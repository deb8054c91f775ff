import pytest
from pyspark.sql import functions as F

from lakeload.functions import row_hash
from lakeload.operators import (
    fact_merge,
    fact_soft_delete,
    keep_last,
    members,
    scd1_merge,
    scd1_merge_partitions,
    touched_partitions,
    union_drifting,
)
from lakeload.operators import matching
from lakeload.schemas import ARCHIVED, DELETED, MODIFIED
from tests.conftest import day, ntz, rows

SHOW = ["k", "a", "__ArchiveFilePath"]
BASE = [(1, "same", "x"), (2, "old", "x"), (3, "gone", "y")]
DELTA = [(1, "same", "x"), (2, "new", "x"), (4, "fresh", "z")]


@pytest.mark.parametrize("strategy", ["full", "broadcast"])
def test_scd1_changed_unchanged_new_vanished(extract_of, strategy):
    got = scd1_merge(extract_of(0, BASE), extract_of(1, DELTA), ["k"], strategy=strategy)
    assert rows(got, *SHOW) == [
        (1, "same", "file0"), (2, "new", "file1"), (3, "gone", "file0"), (4, "fresh", "file1"),
    ]


def test_first_load_is_the_source(extract_of):
    assert rows(scd1_merge(None, extract_of(0, BASE), ["k"]), "k") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("strategy", ["full", "broadcast"])
@pytest.mark.parametrize(("null_safe", "count"), [(True, 1), (False, 3)])
def test_null_keys(extract_of, null_safe, count, strategy):
    target = extract_of(0, [(None, "a", "x"), (7, "a", "x")])
    source = extract_of(1, [(None, "b", "x"), (7, "b", "x")])
    if not null_safe:
        source = source.union(extract_of(2, [(None, "c", "x")]))
    got = scd1_merge(target, source, ["k"], null_safe=null_safe, strategy=strategy)
    assert got.where("k is null").count() == count
    assert rows(got.where("k = 7"), "a") == [("b",)]


def test_null_shift_is_a_change_under_the_safe_hash_only(extract_of):
    schema = "k int, a string, b string"
    for mode, seen in (("safe", "file1"), ("concat", "file0")):
        target = extract_of(0, [(1, None, "v")], mode, schema)
        source = extract_of(1, [(1, "v", None)], mode, schema)
        assert rows(scd1_merge(target, source, ["k"]), "__ArchiveFilePath") == [(seen,)]


def test_schema_grows_and_widens_and_nothing_is_dropped(spark, extract_of):
    target = extract_of(0, [(1, "a", "x"), (2, "b", "y")])
    source = extract_of(1, [(1, "a2", "n1"), (3, "c", "n3")], schema="k long, a string, e string")
    got = scd1_merge(target, source, ["k"])
    assert dict(got.dtypes)["k"] == "bigint"
    assert rows(got, "k", "a", "d", "e") == [(1, "a2", "x", "n1"), (2, "b", "y", None), (3, "c", None, "n3")]
    with pytest.raises(TypeError):
        scd1_merge(target, extract_of(1, [("1", "a", "x")], schema="k string, a string, d string"), ["k"])


def test_update_filter_sees_both_sides(extract_of):
    got = scd1_merge(
        extract_of(0, BASE), extract_of(1, DELTA + [(3, "back", "q")]), ["k"], update_filter="s.d = t.d"
    )
    assert rows(got, "k", "a") == [(1, "same"), (2, "new"), (3, "gone"), (4, "fresh")]


def test_duplicate_keys_fail_or_reduce(extract_of):
    source = extract_of(1, [(1, "a", "1"), (1, "b", "2"), (2, "c", "1")])
    with pytest.raises(Exception, match="several source rows"):
        scd1_merge(extract_of(0, BASE), source, ["k"]).collect()
    got = scd1_merge(extract_of(0, BASE), source, ["k"], on_duplicates="last", order_by=["d"])
    assert rows(got, "k", "a") == [(1, "b"), (2, "c"), (3, "gone")]
    with pytest.raises(ValueError):
        scd1_merge(None, source, ["k"], on_duplicates="last")
    with pytest.raises(ValueError):
        scd1_merge(None, source, ["k"], on_duplicates="first")


def test_moved_key_leaves_its_old_partition(extract_of):
    target = extract_of(0, [(1, "a", "p1"), (2, "b", "p1"), (3, "c", "p2"), (4, "d", "p3")])
    source = extract_of(1, [(1, "a", "p2")])
    assert rows(touched_partitions(target, source, ["k"], ["d"])) == [("p1",), ("p2",)]
    got = scd1_merge_partitions(target, source, ["k"], ["d"])
    assert rows(got, "k", "d") == [(1, "p2"), (2, "p1"), (3, "p2")]
    stable = scd1_merge_partitions(target, source, ["k"], ["d"], partition_stable=True)
    assert rows(stable, "k", "d") == [(1, "p2"), (3, "p2")]


def fact_base(extract_of):
    return extract_of(0, BASE).withColumn(DELETED, F.lit(None).cast("timestamp_ntz"))


FACT = ["k", "a", "__ArchiveFilePath", MODIFIED, DELETED]


def test_fact_full_extract(extract_of):
    got = fact_merge(fact_base(extract_of), extract_of(1, DELTA), ["k"], ntz(day(9)), delete="full")
    assert rows(got, *FACT) == [
        (1, "same", "file0", 0, None),
        (2, "new", "file1", 1, None),
        (3, "gone", "file0", 9, 9),
        (4, "fresh", "file1", 1, None),
    ]


@pytest.mark.parametrize(("back", "a"), [("gone", "gone"), ("other", "other")])
def test_fact_resurrect_with_same_and_other_content(extract_of, back, a):
    gone = fact_merge(fact_base(extract_of), extract_of(1, DELTA), ["k"], ntz(day(1)), delete="full")
    got = fact_merge(gone, extract_of(2, [(3, back, "y")]), ["k"], ntz(day(2)))
    assert rows(got.where("k = 3"), *FACT) == [(3, a, "file2", 2, None)]


def test_fact_delete_twice_keeps_the_first_time(extract_of):
    once = fact_soft_delete(fact_base(extract_of), extract_of(1, DELTA), ["k"], ntz(day(1)))
    twice = fact_soft_delete(once, extract_of(2, DELTA), ["k"], ntz(day(2)))
    assert rows(once) == rows(twice)


def test_fact_delete_acts_only_in_the_slices_of_the_file(extract_of):
    target = extract_of(0, [(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2"), (4, "d", None), (5, "e", None)])
    target = target.withColumn(DELETED, F.lit(None).cast("timestamp_ntz"))
    source = extract_of(1, [(1, "a", "d1"), (4, "d", None)])
    got = fact_soft_delete(target, source, ["k"], ntz(day(1)), ["d"])
    assert rows(got.where(F.col(DELETED).isNotNull()), "k") == [(2,), (5,)]


def test_empty_file_deletes_all_or_none(extract_of):
    empty = extract_of(1, [])
    assert fact_soft_delete(fact_base(extract_of), empty, ["k"], ntz(day(1))).where(F.col(DELETED).isNotNull()).count() == 3
    sliced = fact_soft_delete(fact_base(extract_of), empty, ["k"], ntz(day(1)), ["d"])
    assert sliced.where(F.col(DELETED).isNotNull()).count() == 0


def test_fact_keeps_a_text_delete_time(extract_of):
    target = fact_base(extract_of).withColumn(DELETED, F.lit(None).cast("string"))
    got = fact_merge(target, extract_of(1, DELTA), ["k"], ntz(day(1)), delete="full")
    assert dict(got.dtypes)[DELETED] == "string"
    assert rows(got.where("k = 3"), DELETED) == [("2023-01-02 00:00:00",)]


def test_fact_update_filter_leaves_hash_mismatch_untouched(extract_of):
    got = fact_merge(fact_base(extract_of), extract_of(1, DELTA), ["k"], ntz(day(1)), update_filter="t.a <> 'old'")
    assert rows(got.where("k = 2"), *FACT) == [(2, "old", "file0", 0, None)]


def test_same_last_file_twice_changes_nothing(extract_of):
    once = fact_merge(fact_base(extract_of), extract_of(1, DELTA), ["k"], ntz(day(1)), delete="full")
    twice = fact_merge(once, extract_of(1, DELTA), ["k"], ntz(day(5)), delete="full")
    assert rows(once) == rows(twice)


def test_salted_membership_on_a_hot_value(spark, monkeypatch):
    """A lookup that is not broadcast: a value with most of the rows, NULL among the keys."""
    monkeypatch.setattr(matching, "fits_broadcast", lambda df: False)
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("g"))
    lookup = spark.createDataFrame([("hot", 1), (None, 2), ("6", 3)], "g string, v int")
    assert members(big, lookup, ["g"]).count() == 2000 + 500 + 1
    assert members(big, lookup, ["g"], "left_anti").count() == 499
    found = members(big, lookup, ["g"], "left_outer")
    assert found.count() == 3000 and found.columns == ["id", "g", "v"]
    assert found.agg(F.sum("v")).first()[0] == 2000 + 2 * 500 + 3


def test_keep_last_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    last = keep_last(df, ["k"], ["id"])
    assert rows(last) == [(0, 999), (1, 997), (2, 998)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_union_of_drifting_files(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 1.5)], "k long, b double")
    got = union_drifting([a, b])
    assert got.dtypes == [("k", "bigint"), ("a", "string"), ("b", "double")]
    assert rows(got) == [(1, "x", None), (2, None, 1.5)]


def test_merge_plan_shuffles_each_side_once(extract_of, spark):
    plan = (
        scd1_merge(extract_of(0, BASE), extract_of(1, DELTA), ["k"], on_duplicates="assume_unique", strategy="full")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_archive_time_column_survives(extract_of):
    got = scd1_merge(extract_of(0, BASE), extract_of(1, DELTA), ["k"])
    assert rows(got, "k", ARCHIVED) == [(1, 0), (2, 1), (3, 0), (4, 1)]
    assert row_hash(got.select("k", "a", "d")).count() == 4


def test_a_small_source_does_not_shuffle_a_large_target(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    target = row_hash(keep_last(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"]))
    region = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    source = row_hash(region.selectExpr("cast(r_regionkey as bigint) as l_orderkey", "1 as l_linenumber"))
    stored = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumn("__HashDiff", F.lit("x"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    try:
        merged = scd1_merge(stored, source, ["l_orderkey", "l_linenumber"], on_duplicates="assume_unique")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        large = plan.split("Union")[1].split("SortMergeJoin")[0]
        assert "BroadcastHashJoin" in large and "LeftOuter" in large and "Exchange hashpartitioning" not in large
        full = scd1_merge(target, target, ["l_orderkey", "l_linenumber"], on_duplicates="assume_unique")
        assert "FullOuter" in full._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
