import pytest
from pyspark.sql import functions as F

from lakeload.operators import (
    dimension_as_of,
    open_versions,
    scd2_as_of,
    scd2_close_deleted,
    scd2_current,
    scd2_merge,
)
from tests.conftest import day, ntz, rows

SHOW = ["k", "a", "__StartDatetimeUTC", "__EndDatetimeUTC", "__Current"]


def first(extract_of, data):
    return open_versions(extract_of(0, data), ntz(day(0)))


@pytest.mark.parametrize("strategy", ["full", "broadcast"])
def test_close_open_and_vanish_in_one_pass(extract_of, strategy):
    table = first(extract_of, [(1, "same", "x"), (2, "old", "x"), (3, "gone", "x")])
    got = scd2_merge(
        table, extract_of(1, [(1, "same", "x"), (2, "new", "x"), (4, "fresh", "x")]), ["k"], ntz(day(1)),
        delete="full", strategy=strategy,
    )
    assert rows(got, *SHOW) == [
        (1, "same", 0, "open", True),
        (2, "new", 1, "open", True),
        (2, "old", 0, 1, False),
        (3, "gone", 0, 1, False),
        (4, "fresh", 1, "open", True),
    ]


def test_closed_versions_keep_their_end(extract_of):
    """A key that changes twice: the first version's end is written once."""
    table = first(extract_of, [(1, "a", "x")])
    table = scd2_merge(table, extract_of(1, [(1, "b", "x")]), ["k"], ntz(day(1)))
    table = scd2_merge(table, extract_of(2, [(1, "c", "x")]), ["k"], ntz(day(2)))
    assert rows(table, *SHOW) == [(1, "a", 0, 1, False), (1, "b", 1, 2, False), (1, "c", 2, "open", True)]


def test_returning_key_opens_a_new_version_after_a_gap(extract_of):
    table = first(extract_of, [(1, "a", "x"), (2, "b", "x")])
    table = scd2_merge(table, extract_of(1, [(2, "b", "x")]), ["k"], ntz(day(1)), delete="full")
    table = scd2_merge(table, extract_of(2, [(1, "a", "x"), (2, "b", "x")]), ["k"], ntz(day(2)), delete="full")
    assert rows(table.where("k = 1"), *SHOW) == [(1, "a", 0, 1, False), (1, "a", 2, "open", True)]


def test_filtered_delete_looks_at_current_versions_only(extract_of):
    """Key 1 was in slice d1 once and is in d2 now: a file about d1 does not close it."""
    table = first(extract_of, [(1, "a", "d1"), (2, "b", "d1")])
    table = scd2_merge(table, extract_of(1, [(1, "a", "d2")]), ["k"], ntz(day(1)))
    got = scd2_close_deleted(table, extract_of(2, [(9, "z", "d1")]), ["k"], ntz(day(2)), ["d"])
    assert rows(scd2_current(got), "k", "d") == [(1, "d2")]
    assert rows(got.where("k = 2"), "__EndDatetimeUTC") == [(2,)]


def test_same_file_again_changes_nothing(extract_of):
    delta = extract_of(1, [(1, "b", "x")])
    once = scd2_merge(first(extract_of, [(1, "a", "x"), (2, "c", "x")]), delta, ["k"], ntz(day(1)), delete="full")
    assert rows(scd2_merge(once, delta, ["k"], ntz(day(1)), delete="full")) == rows(once)


def test_new_and_missing_columns(extract_of):
    table = first(extract_of, [(1, "a", "x"), (2, "b", "y")])
    got = scd2_merge(table, extract_of(1, [(1, "a", "n")], schema="k long, a string, e string"), ["k"], ntz(day(1)))
    assert rows(got, "k", "d", "e", "__Current") == [(1, "x", None, False), (1, None, "n", True), (2, "y", None, True)]


def test_reading_at_a_time(extract_of):
    table = scd2_merge(first(extract_of, [(1, "a", "x")]), extract_of(2, [(1, "b", "x")]), ["k"], ntz(day(2)))
    assert rows(scd2_as_of(table, ntz(day(1))), "a") == [("a",)]
    assert rows(scd2_as_of(table, ntz(day(2))), "a") == [("b",)]
    facts = table.sparkSession.range(4).select(
        F.lit(1).alias("fk"), F.expr("timestamp_ntz'2023-01-01' + make_dt_interval(cast(id as int) - 1)").alias("at")
    )
    found = dimension_as_of(facts, table.select("k", "a", "__StartDatetimeUTC", "__EndDatetimeUTC"), ["fk"], ["k"], "at")
    assert rows(found, "at", "a") == [(-1, None), (0, "a"), (1, "a"), (2, "b")]
