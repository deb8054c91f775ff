"""Folds of many files against a plain dictionary that applies them one by one."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lakeload.functions import row_hash
from lakeload.operators import (
    fact_fold,
    number_in_order,
    scd1_fold,
    scd1_merge,
    scd2_from_snapshots,
    scd2_merge,
)
from lakeload.schemas import ARCHIVE_FILE, ARCHIVED, DELETED, MODIFIED
from tests.conftest import day, ntz, rows

FILES = 9


def random_files(seed):
    """Per file: key -> value; keys come, go and change."""
    rng = random.Random(seed)
    return [
        {k: rng.choice("pq") for k in [None, *range(6)] if rng.random() < 0.7} if n != 4 else {}
        for n in range(FILES)
    ]


def batch_of(spark, files, offset=0):
    data = [(k, v, n + offset) for n, file in enumerate(files) for k, v in file.items()]
    df = spark.createDataFrame(data, "k int, a string, n int")
    df = row_hash(df, ["k", "a"])
    at = F.timestamp_add("DAY", F.col("n"), F.lit("2023-01-01").cast("timestamp_ntz"))
    return df.withColumns(
        {
            MODIFIED: ntz(day(50)),
            ARCHIVED: at,
            ARCHIVE_FILE: F.concat(F.lit("file"), F.col("n")),
            "__OriginalStagingFileName": F.concat(F.lit("name"), F.col("n")),
        }
    ).drop("n")


def list_of(spark, files, offset=0):
    stamped = spark.range(len(files)).select(
        F.concat(F.lit("file"), F.col("id") + offset).alias(ARCHIVE_FILE),
        F.timestamp_add("DAY", (F.col("id") + offset).cast("int"), F.lit("2023-01-01").cast("timestamp_ntz")).alias(ARCHIVED),
    )
    return stamped


def scd1_by_hand(files, table=None, offset=0):
    table = dict(table or {})
    for n, file in enumerate(files):
        for k, v in file.items():
            if k not in table or table[k][0] != v:
                table[k] = (v, f"file{n + offset}")
    return table


def scd2_by_hand(files):
    history, current = [], {}
    for n, file in enumerate(files):
        for k in list(current):
            if file.get(k) != current[k][0]:
                history.append((k, *current.pop(k), n, False))
        for k, v in file.items():
            current.setdefault(k, (v, n))
    return history + [(k, *c, "open", True) for k, c in current.items()]


def fact_by_hand(files):
    table = {}
    for n, file in enumerate(files):
        for k, v in file.items():
            if k not in table or table[k][0] != v or table[k][2] is not None:
                table[k] = (v, f"file{n}", None)
        for k, (v, f, gone) in table.items():
            if k not in file and gone is None:
                table[k] = (v, f, 99)
    return table


def ordered(values):
    return sorted(values, key=repr)


@pytest.mark.parametrize(("seed", "chunk"), [(1, None), (2, 2), (3, 3), (4, 256)])
def test_scd1_fold(spark, seed, chunk):
    files = random_files(seed)
    order = number_in_order(list_of(spark, files), ARCHIVED, [ARCHIVE_FILE])
    got = scd1_fold(None, batch_of(spark, files), ["k"], order, chunk_files=chunk)
    assert rows(got, "k", "a", ARCHIVE_FILE) == ordered((k, *v) for k, v in scd1_by_hand(files).items())

    # The same in two steps.
    early, late = files[:5], files[5:]
    table = scd1_fold(None, batch_of(spark, early), ["k"], order, chunk_files=chunk)
    got = scd1_fold(table, batch_of(spark, late, 5), ["k"], order, chunk_files=chunk)
    assert rows(got, "k", "a", ARCHIVE_FILE) == ordered((k, *v) for k, v in scd1_by_hand(files).items())


def test_scd1_fold_keeps_columns_the_batch_lacks(spark, extract_of):
    target = extract_of(0, [(1, "p", "x"), (2, "p", "y")]).withColumn("extra", F.lit("kept"))
    files = [{1: "q", 3: "p"}, {1: "p"}]
    order = number_in_order(list_of(spark, files, 1), ARCHIVED, [ARCHIVE_FILE])
    got = scd1_fold(target, batch_of(spark, files, 1), ["k"], order)
    assert rows(got, "k", "a", "d", "extra", ARCHIVE_FILE) == [
        (1, "p", "x", "kept", "file2"), (2, "p", "y", "kept", "file0"), (3, "p", None, None, "file1"),
    ]


@pytest.mark.parametrize(("seed", "chunk"), [(1, None), (2, 2), (3, 3), (4, 256)])
def test_scd2_from_snapshots(spark, seed, chunk):
    files = random_files(seed)
    show = ["k", "a", "__StartDatetimeUTC", "__EndDatetimeUTC", "__Current"]
    whole = scd2_from_snapshots(batch_of(spark, files), ["k"], snapshots=list_of(spark, files), chunk_files=chunk)
    assert rows(whole, *show) == ordered(scd2_by_hand(files))

    table = scd2_from_snapshots(batch_of(spark, files[:3]), ["k"], snapshots=list_of(spark, files[:3]))
    got = scd2_from_snapshots(
        batch_of(spark, files[3:], 3), ["k"], target=table, snapshots=list_of(spark, files[3:], 3), chunk_files=chunk
    )
    assert rows(got, *show) == ordered(scd2_by_hand(files))


def test_snapshots_agree_with_single_merges(spark):
    files = random_files(5)[:4]
    show = ["k", "a", "__StartDatetimeUTC", "__EndDatetimeUTC", "__Current", ARCHIVE_FILE]
    table = None
    for n, file in enumerate(files):
        table = scd2_merge(table, batch_of(spark, [file], n), ["k"], ntz(day(n)), delete="full")
    folded = scd2_from_snapshots(batch_of(spark, files), ["k"], snapshots=list_of(spark, files))
    assert rows(folded, *show) == rows(table, *show)
    current = scd1_merge(None, table.where("__Current"), ["k"])
    fact = fact_fold(None, batch_of(spark, files), ["k"], ntz(day(99)), snapshots=list_of(spark, files))
    assert rows(current, "k", "a") == rows(fact.where(F.col(DELETED).isNull()), "k", "a")


@pytest.mark.parametrize(("seed", "chunk"), [(1, None), (2, 2), (3, 3)])
def test_fact_fold(spark, seed, chunk):
    files = random_files(seed)
    show = ["k", "a", ARCHIVE_FILE, DELETED]
    want = ordered((k, *v) for k, v in fact_by_hand(files).items())
    whole = fact_fold(
        None, batch_of(spark, files), ["k"], ntz(day(99)), snapshots=list_of(spark, files), chunk_files=chunk
    )
    assert rows(whole, *show) == want
    table = fact_fold(None, batch_of(spark, files[:6]), ["k"], ntz(day(99)), snapshots=list_of(spark, files[:6]))
    got = fact_fold(
        table, batch_of(spark, files[6:], 6), ["k"], ntz(day(99)), snapshots=list_of(spark, files[6:], 6), chunk_files=chunk
    )
    assert rows(got, *show) == want


def test_a_key_twice_in_one_file(spark):
    batch = batch_of(spark, [{1: "p"}]).unionByName(batch_of(spark, [{1: "q"}]))
    order = number_in_order(list_of(spark, [{}]), ARCHIVED, [ARCHIVE_FILE])
    with pytest.raises(Exception, match="several source rows"):
        scd1_fold(None, batch, ["k"], order).collect()
    assert rows(scd1_fold(None, batch, ["k"], order, on_duplicates="last", order_by=["a"]), "a") == [("q",)]


def test_groups_of_a_hot_key_stay_small(spark):
    """One key in every one of 600 files: windows are cut by chunk."""
    files = [{1: "pq"[n // 50 % 2]} for n in range(600)]
    got = scd2_from_snapshots(batch_of(spark, files), ["k"], chunk_files=25, on_duplicates="assume_unique")
    assert got.count() == 12
    plan = got._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\(k#\d+, (\w+)#", plan)
    assert sorted(shuffles) == ["__chunk", "__chunk_of"]


def test_numbers_follow_time_and_ties(spark):
    data = [("a", "2023-01-01 05:59:59"), ("c", "2023-01-01 06:00:00"), ("b", "2023-01-01 06:00:00"), ("d", "2023-03-01 00:00:00")]
    df = spark.createDataFrame(data, "p string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {r["p"]: (r["__seq"], str(r["__next"])) for r in number_in_order(df, "t", ["p"]).collect()}
    assert got == {
        "a": (0, "2023-01-01 06:00:00"), "b": (1, "2023-01-01 06:00:00"),
        "c": (2, "2023-03-01 00:00:00"), "d": (3, "None"),
    }
