"""Incremental selection over archive and process logs: one archived file per order date."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.functions import archive_calendar, epoch_millis, file_extension, file_name, name_prefix
from lakeload.operators import (
    load_watermark,
    mark_ignorable,
    number_in_order,
    pending_files,
    process_log_rows,
    repair_log_types,
)
from registry import extracts as x
from registry import query

_LOG = [
    "ArchiveDatetimeUTC", "ArchiveYearUTC", "ArchiveMonthUTC", "ArchiveDayUTC", "ArchiveyyyyMMddUTC",
    "OriginalStagingFilePath", "OriginalStagingFileName", "OriginalStagingFileSize", "OriginalModificationTime",
    "ArchiveFilePath", "ArchiveFileName", "IsPurged", "IsIgnorable", "Notes",
]


def day_log(spark, sf):
    days = x.table(spark, sf, "orders").groupBy("o_orderdate").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("o_totalprice") * 100).cast("decimal(18,0)")).cast("long").alias("size"),
        F.max("o_orderkey").alias("top"),
        F.min("o_orderstatus").alias("least"),
    )
    ts = F.col("o_orderdate")
    day = F.date_format(ts, "yyyyMMdd")
    staged = F.concat(F.lit("ingest/orders/"), day, F.lit(".csv"))
    archived = F.concat(F.lit("archive/orders/"), day, F.lit(".csv"))
    return days.select(
        ts.alias("ArchiveDatetimeUTC"),
        *[v.alias(k) for k, v in archive_calendar(ts).items()],
        staged.alias("OriginalStagingFilePath"),
        file_name(staged).alias("OriginalStagingFileName"),
        F.col("size").alias("OriginalStagingFileSize"),
        (ts - F.make_dt_interval(F.lit(0), F.lit(0), F.col("top").cast("int"))).alias("OriginalModificationTime"),
        archived.alias("ArchiveFilePath"),
        file_name(archived).alias("ArchiveFileName"),
        (F.col("least") == "P").alias("IsPurged"),
        (F.col("n") <= 3).alias("IsIgnorable"),
        F.lit(None).cast("string").alias("Notes"),
    )


DAY_LOG_SQL = """
  SELECT o_orderdate AS ArchiveDatetimeUTC, CAST(year(o_orderdate) AS INTEGER) AS ArchiveYearUTC,
         CAST(month(o_orderdate) AS INTEGER) AS ArchiveMonthUTC, CAST(day(o_orderdate) AS INTEGER) AS ArchiveDayUTC,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS ArchiveyyyyMMddUTC,
         'ingest/orders/' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS OriginalStagingFilePath,
         strftime(o_orderdate, '%Y%m%d') || '.csv' AS OriginalStagingFileName,
         CAST(sum(CAST(o_totalprice * 100 AS DECIMAL(18,0))) AS BIGINT) AS OriginalStagingFileSize,
         o_orderdate - to_minutes(max(o_orderkey)) AS OriginalModificationTime,
         'archive/orders/' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS ArchiveFilePath,
         strftime(o_orderdate, '%Y%m%d') || '.csv' AS ArchiveFileName,
         min(o_orderstatus) = 'P' AS IsPurged, count(*) <= 3 AS IsIgnorable, CAST(NULL AS VARCHAR) AS Notes
  FROM orders GROUP BY o_orderdate"""


def done_log(spark, sf):
    """Processed: dates with an urgent order, up to the split."""
    urgent = (
        x.table(spark, sf, "orders")
        .where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") <= x.stamp(x.SPLIT)))
        .select(F.col("o_orderdate").alias("ArchiveDatetimeUTC"))
        .distinct()
    )
    files = day_log(spark, sf).join(urgent, "ArchiveDatetimeUTC")
    return process_log_rows(files, x.stamp(x.NOW_BASE))


DONE_SQL = f"""SELECT * FROM ({DAY_LOG_SQL}) WHERE ArchiveDatetimeUTC IN (
  SELECT o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate <= TIMESTAMP '{x.SPLIT}')"""
_PENDING = f"SELECT * FROM ({DAY_LOG_SQL}) WHERE NOT IsPurged AND NOT IsIgnorable"


@query("archive_log_calendar", DAY_LOG_SQL)
def archive_log_calendar(spark, sf):
    return day_log(spark, sf)


@query("load_watermark", f"SELECT max(ArchiveDatetimeUTC) AS ArchiveDatetimeUTC FROM ({DONE_SQL})")
def load_watermark_query(spark, sf):
    return load_watermark(done_log(spark, sf))


@query("pending_files", f"{_PENDING} AND ArchiveDatetimeUTC > (SELECT max(ArchiveDatetimeUTC) FROM ({DONE_SQL}))")
def pending_files_query(spark, sf):
    return pending_files(day_log(spark, sf), done_log(spark, sf))


@query(
    "pending_files_inclusive",
    f"{_PENDING} AND ArchiveDatetimeUTC >= (SELECT max(ArchiveDatetimeUTC) FROM ({DONE_SQL}))",
)
def pending_files_inclusive(spark, sf):
    return pending_files(day_log(spark, sf), done_log(spark, sf), inclusive=True)


@query("pending_files_first_run", f"{_PENDING} AND ArchiveDatetimeUTC > TIMESTAMP '{x.SPLIT}'")
def pending_files_first_run(spark, sf):
    return pending_files(day_log(spark, sf), None, initial=x.stamp(x.SPLIT))


@query(
    "pending_files_late",
    f"""{_PENDING} AND ArchiveDatetimeUTC > TIMESTAMP '1996-01-01 00:00:00'
    AND ArchiveFilePath NOT IN (SELECT ArchiveFilePath FROM ({DONE_SQL}))""",
)
def pending_files_late(spark, sf):
    """Also files stamped before the watermark that no load has taken."""
    return pending_files(
        day_log(spark, sf), done_log(spark, sf), initial=x.stamp("1996-01-01 00:00:00"), by="absence"
    )


@query(
    "pending_files_old_log",
    f"""SELECT * EXCLUDE (OriginalModificationTime), CAST(NULL AS TIMESTAMP) AS OriginalModificationTime
    FROM ({_PENDING} AND ArchiveDatetimeUTC > TIMESTAMP '{x.SPLIT}')""",
)
def pending_files_old_log(spark, sf):
    """A log from before the modification time was kept."""
    log = day_log(spark, sf).drop("OriginalModificationTime")
    return pending_files(log, None, initial=x.stamp(x.SPLIT))


@query(
    "files_in_load_order",
    f"""SELECT ArchiveFilePath, row_number() OVER w - 1 AS seq, lead(ArchiveDatetimeUTC) OVER w AS following
    FROM ({DAY_LOG_SQL}) WINDOW w AS (ORDER BY ArchiveDatetimeUTC, OriginalModificationTime, ArchiveFilePath)""",
)
def files_in_load_order(spark, sf):
    ordered = number_in_order(
        day_log(spark, sf), "ArchiveDatetimeUTC", ["OriginalModificationTime", "ArchiveFilePath"]
    )
    return ordered.select("ArchiveFilePath", F.col("__seq").alias("seq"), F.col("__next").alias("following"))


@query(
    "mark_ignorable",
    f"""SELECT * REPLACE (IsIgnorable OR ArchiveDayUTC = 29 AS IsIgnorable,
    CASE WHEN ArchiveDayUTC = 29 THEN 'broken extract' END AS Notes) FROM ({DAY_LOG_SQL})""",
)
def mark_ignorable_query(spark, sf):
    return mark_ignorable(day_log(spark, sf), "ArchiveDayUTC = 29", "broken extract")


@query(
    "repair_log_types",
    f"""SELECT * REPLACE (OriginalStagingFileSize // 1000 AS OriginalStagingFileSize,
    CAST(NULL AS TIMESTAMP) AS OriginalModificationTime) FROM ({DAY_LOG_SQL})""",
)
def repair_log_types_query(spark, sf):
    """A log that kept sizes as int, here in thousands of bytes."""
    thousands = F.floor(F.col("OriginalStagingFileSize") / 1000).cast("int")
    old = day_log(spark, sf).withColumn("OriginalStagingFileSize", thousands).drop("OriginalModificationTime")
    return repair_log_types(old)


@query(
    "process_log_rows",
    f"""SELECT TIMESTAMP '{x.NOW_BASE}' AS ProcessDatetime, ArchiveDatetimeUTC, OriginalStagingFilePath,
    OriginalStagingFileName, OriginalStagingFileSize, ArchiveFilePath, ArchiveFileName FROM ({DONE_SQL})""",
)
def process_log_query(spark, sf):
    return done_log(spark, sf)


@query(
    "file_name_parts",
    """SELECT page_id, url, regexp_extract(url, '[^/]*$') AS name,
      regexp_extract(url, '[^/](\\.[^./]*)$', 1) AS extension FROM pages""",
)
def file_name_parts(spark, sf):
    url = F.col("url")
    return x.table(spark, sf, "pages").select(
        "page_id", "url", file_name(url).alias("name"), file_extension(url).alias("extension")
    )


@query(
    "epoch_millis",
    """SELECT event_id, date_trunc('millisecond', ts) AS at,
    CAST(strftime(ts, '%H_%M') AS VARCHAR) AS prefix FROM events""",
)
def epoch_millis_query(spark, sf):
    """Modification times given as milliseconds, back to timestamps."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return x.table(spark, sf, "events").select(
        "event_id", epoch_millis(millis).cast("timestamp_ntz").alias("at"), name_prefix(F.col("ts")).alias("prefix")
    )


@query(
    "pending_files_digest",
    f"""{_PENDING} AND ArchiveDatetimeUTC > TIMESTAMP '1997-06-01 12:00:00'
    AND ArchiveFilePath NOT IN (SELECT ArchiveFilePath FROM ({DONE_SQL}))""",
)
def pending_files_digest(spark, sf):
    """The search is limited to log days whose digests differ between the logs."""
    log, done = day_log(spark, sf), done_log(spark, sf)
    return pending_files(log, done, initial=x.stamp("1997-06-01 12:00:00"), by="digest")
