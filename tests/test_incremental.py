import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeload.operators import (
    changed_since,
    export_watermark,
    initial_watermark,
    mark_ignorable,
    next_watermark,
    pending_files,
    purge_candidates,
    purge_summary,
    purge_totals,
    repair_log_types,
)
from lakeload.schemas import ARCHIVE_LOG, PROCESS_LOG


def log_row(path, ts, purged=False, ignorable=False, modified=None, size=10):
    t = dt.datetime.fromisoformat(ts)
    return (t, t.year, t.month, t.day, t.year * 10000 + t.month * 100 + t.day, path, path, size,
            modified and dt.datetime.fromisoformat(modified), path, path, purged, None, ignorable, None)


def log_of(spark, *items):
    return spark.createDataFrame([log_row(*i) if isinstance(i, tuple) else log_row(**i) for i in items], ARCHIVE_LOG)


def done_of(spark, *pairs):
    data = [(None, dt.datetime.fromisoformat(t), None, None, None, p, None) for p, t in pairs]
    return spark.createDataFrame(data, PROCESS_LOG)


def paths(df):
    return [r["ArchiveFilePath"] for r in df.collect()]


@pytest.fixture
def log(spark):
    return log_of(
        spark,
        ("a", "2023-01-01T10:00:00"),
        ("c", "2023-01-03T00:00:00", False, False, "2023-01-02T09:00:00"),
        ("b", "2023-01-03T00:00:00", False, False, "2023-01-02T08:00:00"),
        ("purged", "2023-01-04T00:00:00", True),
        ("ignored", "2023-01-04T00:00:00", False, True),
        ("d", "2023-01-05T00:00:00"),
    )


def test_pending_after_the_watermark_in_load_order(spark, log):
    done = done_of(spark, (None, "2022-12-01T00:00:00"), ("a", "2023-01-01T10:00:00"))
    assert paths(pending_files(log, done)) == ["b", "c", "d"]
    assert paths(pending_files(log, done, inclusive=True)) == ["a", "b", "c", "d"]
    assert paths(pending_files(log, None, initial="2023-01-04 12:00:00")) == ["d"]


def test_a_file_logged_late_is_found_by_absence_only(spark, log):
    done = done_of(spark, (None, "2022-12-01T00:00:00"), ("a", "2023-01-01T10:00:00"), ("c", "2023-01-03T00:00:00"))
    assert paths(pending_files(log, done)) == ["d"]
    start = "2022-12-01 00:00:00"
    assert paths(pending_files(log, done, initial=start, by="absence")) == ["b", "d"]
    assert paths(pending_files(log, done, initial=start, by="absence", inclusive=True)) == ["b", "c", "d"]


def test_watermark_prunes_log_partitions(spark, log, lake):
    log.write.partitionBy("ArchiveyyyyMMddUTC").parquet(f"{lake}/log")
    stored = spark.read.schema(ARCHIVE_LOG).parquet(f"{lake}/log")
    plan = pending_files(stored, None, initial="2023-01-04 12:00:00")._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "ArchiveyyyyMMddUTC" in partition_filters
    assert paths(pending_files(stored, None, initial="2023-01-04 12:00:00")) == ["d"]


def test_initial_watermark_is_midnight_five_days_ago(spark):
    at = F.lit("2023-03-08 17:45:00").cast("timestamp")
    got = spark.range(1).select(initial_watermark(at).cast("string")).first()[0]
    assert got == "2023-03-03 00:00:00"


def test_ignorable_mark_and_old_log(spark, log):
    marked = mark_ignorable(log, "ArchiveFilePath = 'b'", "broken")
    assert [tuple(r) for r in marked.where("IsIgnorable").orderBy("ArchiveFilePath").select("ArchiveFilePath", "Notes").collect()] == [
        ("b", "broken"), ("ignored", None),
    ]
    old = log.drop("OriginalModificationTime").withColumn("OriginalStagingFileSize", F.lit(7))
    fixed = dict(repair_log_types(old).dtypes)
    assert fixed["OriginalStagingFileSize"] == "bigint" and fixed["OriginalModificationTime"] == "timestamp"


def test_export_window(spark):
    rows = spark.createDataFrame([(i, dt.datetime(2023, 1, i)) for i in range(1, 8)], "i int, t timestamp")
    wm = dt.datetime(2023, 1, 3)
    assert changed_since(rows, "t", wm).count() == 4
    assert changed_since(rows, "t", wm, inclusive=True).count() == 5
    assert next_watermark(rows, "t", wm, dt.datetime(2023, 1, 5, 12)).first()[0] == dt.datetime(2023, 1, 5)
    assert next_watermark(rows, "t", dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1)).first()[0] is None
    log = rows.select(F.col("t").alias("ProcessDatetime"))
    back = spark.range(1).select(export_watermark(log, 2).cast("string"), export_watermark(None, 2).cast("string")).first()
    assert tuple(back) == ("2023-01-05 00:00:00", "1900-01-01 00:00:00")


def flags(df):
    return {r["ArchiveFilePath"]: r["IsToBePurged"] for r in df.collect()}


def test_iso_week_of_new_year_shares_the_calendar_year(spark):
    """1 January 2021 is in ISO week 53, as are the last days of December 2020 of another year."""
    log = log_of(
        spark,
        ("jan1", "2021-01-01T08:00:00"),
        ("dec31", "2021-12-31T08:00:00"),
        ("jan2", "2021-01-02T08:00:00"),
        ("dec2020", "2020-12-30T08:00:00"),
    )
    got = flags(purge_candidates(log, "2022-06-01 00:00:00", keep_year=False, keep_month=False, keep_day=False))
    assert got == {"jan1": True, "jan2": False, "dec31": False, "dec2020": False}


def test_rows_after_the_cutoff_do_not_compete(spark):
    log = log_of(spark, ("early", "2023-01-01T08:00:00"), ("late", "2023-01-01T20:00:00"))
    assert flags(purge_candidates(log, "2023-01-01 12:00:00")) == {"early": False}


def test_purged_rows_keep_their_rank_unless_told_otherwise(spark):
    log = log_of(spark, ("newest", "2023-01-01T20:00:00", True), ("older", "2023-01-01T08:00:00"))
    assert flags(purge_candidates(log, "2023-02-01 00:00:00")) == {"newest": False, "older": True}
    assert flags(purge_candidates(log, "2023-02-01 00:00:00", rank_purged=False)) == {"newest": True, "older": False}


def test_equal_stamps_are_ordered_by_path_and_ignorable_plays_no_part(spark):
    log = log_of(spark, ("a", "2023-01-01T08:00:00"), ("b", "2023-01-01T08:00:00", False, True))
    assert flags(purge_candidates(log, "2023-02-01 00:00:00")) == {"a": True, "b": False}


def test_all_rules_off(spark, log):
    got = purge_candidates(log, "2024-01-01 00:00:00", False, False, False, False)
    assert set(flags(got).values()) == {True}


def test_summary_and_totals(spark):
    log = log_of(
        spark,
        {"path": "a", "ts": "2023-01-01T08:00:00", "size": 1024},
        {"path": "b", "ts": "2023-01-01T09:00:00", "size": 10},
        {"path": "c", "ts": "2023-01-01T07:00:00", "size": 5, "purged": True},
    )
    cands = purge_candidates(log, "2023-02-01 00:00:00")
    row = purge_summary(cands).first().asDict()
    assert row == {
        "ArchiveTable": "archive", "BytesToPurge": 1024, "BytesToRetain": 10, "BytesPurged": 5,
        "BytesToPurgeText": "1.0 KB", "BytesToRetainText": "10.0 B", "BytesPurgedText": "5.0 B",
    }
    assert purge_totals(cands).first()["BytesToPurge"] == 1024
    none = purge_totals(cands.limit(0)).first()
    assert (none["BytesPurged"], none["BytesPurgedText"]) == (0, "0B")
