"""Sliced and filtered folds against single merges; late files in their place against files in order."""

import random

import pytest
from pyspark.sql import functions as F

from lakeload.functions import row_hash
from lakeload.operators import (
    fact_fold,
    fact_merge,
    fact_splice,
    number_in_order,
    scd1_fold,
    scd1_fold_filtered,
    scd1_merge,
    scd2_from_snapshots,
    scd2_merge,
    scd2_splice,
    unseen_since,
)
from lakeload.schemas import ABSENT, ARCHIVE_FILE, ARCHIVED, DELETED, MODIFIED, SEEN, STAGING_NAME
from tests.conftest import day, ntz, rows
from tests.test_fold import batch_of, list_of, random_files

HISTORY = ["k", "a", "__StartDatetimeUTC", "__EndDatetimeUTC", "__Current", ARCHIVED, ARCHIVE_FILE]


def sliced_files(seed, n=8):
    """Per file: key -> (value, slice); keys move between slices, files name one slice or more."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        named = rng.sample(["x", "y", None], rng.randint(1, 2))
        out.append({k: (rng.choice("pq"), rng.choice(named)) for k in range(7) if rng.random() < 0.5})
    return out


def sliced_batch(spark, files, offset=0):
    data = [(k, a, s, n + offset) for n, f in enumerate(files) for k, (a, s) in f.items()]
    df = row_hash(spark.createDataFrame(data, "k int, a string, s string, n int"), ["k", "a", "s"], "json")
    at = F.timestamp_add("DAY", F.col("n"), F.lit("2023-01-01").cast("timestamp_ntz"))
    lineage = {MODIFIED: ntz(day(50)), ARCHIVED: at, ARCHIVE_FILE: F.concat(F.lit("file"), F.col("n"))}
    return df.withColumns({**lineage, STAGING_NAME: F.concat(F.lit("name"), F.col("n"))}).drop("n")


@pytest.mark.parametrize(("seed", "chunk"), [(1, None), (2, 2), (3, 3), (4, 1), (5, None)])
def test_sliced_folds_agree_with_single_merges(spark, seed, chunk):
    files = sliced_files(seed)
    facts = history = None
    for n, file in enumerate(files):
        batch = sliced_batch(spark, [file], n)
        slices = {"delete": "filtered", "filter_cols": ["s"]}
        facts = fact_merge(facts, batch, ["k"], ntz(day(99)), **slices)
        history = scd2_merge(history, batch, ["k"], ntz(day(n)), **slices)
        # Plans of eight nested merges take long to analyse.
        facts, history = (spark.createDataFrame(df.collect(), df.schema) for df in (facts, history))
    show = ["k", "a", "s", ARCHIVE_FILE, DELETED]
    for split in (0, 3):
        table = old = None
        if split:
            early, stamps = sliced_batch(spark, files[:split]), list_of(spark, files[:split])
            table = fact_fold(None, early, ["k"], ntz(day(99)), snapshots=stamps, filter_cols=["s"])
            old = scd2_from_snapshots(early, ["k"], snapshots=stamps, filter_cols=["s"])
        batch, stamps = sliced_batch(spark, files[split:], split), list_of(spark, files[split:], split)
        options = {"snapshots": stamps, "filter_cols": ["s"], "chunk_files": chunk}
        assert rows(fact_fold(table, batch, ["k"], ntz(day(99)), **options), *show) == rows(facts, *show)
        got = scd2_from_snapshots(batch, ["k"], target=old, **options)
        assert rows(got, "s", *HISTORY) == rows(history, "s", *HISTORY)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_filtered_fold_agrees_with_single_merges(spark, seed):
    files = random_files(seed)
    update = "s.a < t.a OR t.a = 'o'"
    table = None
    for n, file in enumerate(files):
        batch = batch_of(spark, [file], n).withColumn(SEEN, F.col(ARCHIVED))
        table = scd1_merge(table, batch, ["k"], update_filter=update)
        table = spark.createDataFrame(table.collect(), table.schema)
    order = number_in_order(list_of(spark, files), ARCHIVED, [ARCHIVE_FILE])
    got = None
    for split in ((0, 9), (0, 4), (4, 9)):
        batch = batch_of(spark, files[split[0] : split[1]], split[0]).withColumn(SEEN, F.col(ARCHIVED))
        if split == (0, 4):
            got = None
        got = scd1_fold_filtered(got, batch, ["k"], order, update)
        if split[1] == 9:
            assert rows(got, "k", "a", ARCHIVE_FILE, SEEN) == rows(table, "k", "a", ARCHIVE_FILE, SEEN)


def test_filtered_fold_keeps_columns_the_batch_lacks(spark, extract_of):
    target = extract_of(0, [(1, "p", "x"), (2, "p", "y")]).withColumn("extra", F.lit("kept"))
    files = [{1: "q", 3: "p"}, {1: "p", 3: "q"}]
    order = number_in_order(list_of(spark, files, 1), ARCHIVED, [ARCHIVE_FILE])
    got = scd1_fold_filtered(target, batch_of(spark, files, 1), ["k"], order, "s.a = 'q'")
    assert rows(got, "k", "a", "d", "extra", ARCHIVE_FILE) == [
        (1, "q", None, "kept", "file1"), (2, "p", "y", "kept", "file0"), (3, "q", None, None, "file2"),
    ] or rows(got, "k", "a", "extra", ARCHIVE_FILE) == [
        (1, "q", "kept", "file1"), (2, "p", "kept", "file0"), (3, "q", None, "file2"),
    ]


def parts_of(spark, files, late):
    """Batches and file lists of the files in time and of the late ones."""
    batch, stamps = batch_of(spark, files), list_of(spark, files)
    stamps = stamps.withColumn(STAGING_NAME, F.replace(F.col(ARCHIVE_FILE), F.lit("file"), F.lit("name")))
    is_late = F.col(ARCHIVE_FILE).isin([f"file{n}" for n in late])
    return batch.where(~is_late), stamps.where(~is_late), batch.where(is_late), stamps.where(is_late)


CASES = [(1, [3]), (2, [0]), (3, [4]), (4, [5, 6]), (5, [1, 3, 6]), (6, [0, 1, 2]), (7, [7])]


@pytest.mark.parametrize(("seed", "late"), CASES)
def test_late_extracts_in_a_history(spark, seed, late):
    files = random_files(seed)
    timely, stamps, more, late_files = parts_of(spark, files, late)
    want = scd2_from_snapshots(batch_of(spark, files), ["k"], snapshots=list_of(spark, files))
    table = scd2_from_snapshots(timely, ["k"], snapshots=stamps)
    got = scd2_splice(table, more, ["k"], stamps, late_files, ntz(day(50)))
    assert rows(got, *HISTORY) == rows(want, *HISTORY)
    assert got.columns == table.columns


@pytest.mark.parametrize(("seed", "late"), CASES)
def test_late_extracts_in_facts(spark, seed, late):
    files = random_files(seed)
    timely, stamps, more, late_files = parts_of(spark, files, late)
    absent = F.lit(None).cast("timestamp_ntz")
    show = ["k", "a", ARCHIVED, ARCHIVE_FILE, DELETED, ABSENT]
    whole = batch_of(spark, files).withColumn(ABSENT, absent)
    want = fact_fold(None, whole, ["k"], ntz(day(99)), snapshots=list_of(spark, files))
    table = fact_fold(None, timely.withColumn(ABSENT, absent), ["k"], ntz(day(99)), snapshots=stamps)
    more = more.withColumns({ABSENT: absent, DELETED: absent})
    got = fact_splice(table, more, ["k"], stamps, late_files, ntz(day(99)))
    assert rows(got, *show) == rows(want, *show)
    assert set(got.columns) == set(table.columns)


@pytest.mark.parametrize(("seed", "late"), CASES)
def test_late_extracts_in_a_current_image(spark, seed, late):
    files = random_files(seed)
    timely, stamps, more, late_files = parts_of(spark, files, late)
    seen = F.col(ARCHIVED)
    order = number_in_order(list_of(spark, files), ARCHIVED, [ARCHIVE_FILE])
    want = scd1_fold(None, batch_of(spark, files).withColumn(SEEN, seen), ["k"], order)
    table = scd1_fold(None, timely.withColumn(SEEN, seen), ["k"], order)
    needed = unseen_since(table, more.withColumn(SEEN, seen), ["k"])
    got = scd1_fold(table, needed, ["k"], order)
    assert rows(got, "k", "a", SEEN) == rows(want, "k", "a", SEEN)


def test_the_second_half_of_an_extract(spark):
    """Two files of one stamp are one extract: the later half takes nothing away, and repeats pass."""
    files = [{1: "p", 2: "p"}, {1: "p", 2: "q"}, {1: "p", 2: "p"}]
    batch, stamps = batch_of(spark, files), list_of(spark, files).withColumn(STAGING_NAME, F.lit("n"))
    half = (F.col("k") == 2) & (F.col(ARCHIVE_FILE) == "file1")
    table = scd2_from_snapshots(batch.where(~half), ["k"], snapshots=stamps)
    late = stamps.where(F.col(ARCHIVE_FILE) == "file1")
    got = scd2_splice(table, batch.where(half), ["k"], stamps, late, ntz(day(50)))
    want = scd2_from_snapshots(batch, ["k"], snapshots=stamps)
    assert rows(got, *HISTORY) == rows(want, *HISTORY)
    again = scd2_splice(want, batch.where(half), ["k"], stamps, late, ntz(day(50)))
    assert rows(again, *HISTORY) == rows(want, *HISTORY)
    other = batch.where((F.col("k") == 1) & (F.col(ARCHIVE_FILE) == "file1")).withColumn("__HashDiff", F.lit("other"))
    with pytest.raises(Exception, match="disagree"):
        scd2_splice(want, other, ["k"], stamps, late, ntz(day(50))).collect()


def test_rows_without_their_marks_stop_the_job(spark):
    files = [{1: "p"}, {}, {2: "q"}]
    timely, stamps, more, late_files = parts_of(spark, files, [1])
    order = number_in_order(list_of(spark, files), ARCHIVED, [ARCHIVE_FILE])
    table = scd1_fold(None, timely, ["k"], order).withColumn(SEEN, F.lit(None).cast("timestamp_ntz"))
    late = batch_of(spark, [{1: "q", 2: "p"}], 1).withColumn(SEEN, F.col(ARCHIVED))
    assert rows(unseen_since(table, late.where("k = 2"), ["k"]), "k") == []
    with pytest.raises(Exception, match=SEEN):
        unseen_since(table, late, ["k"]).collect()
    facts = fact_fold(None, timely, ["k"], ntz(day(99)), snapshots=stamps).withColumn(ABSENT, F.lit(None).cast("timestamp_ntz"))
    with pytest.raises(Exception, match=ABSENT):
        fact_splice(facts, more, ["k"], stamps, late_files, ntz(day(99))).collect()
