"""Retention over archive logs derived from orders and events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakeload.functions import archive_calendar, human_bytes
from lakeload.plans import purge_catalog
from lakeload.session import shared_dir
from lakeload.sinks.logs import append_archive_log
from lakeload.sinks.tables import register_table
from lakeload.schemas import ARCHIVE_LOG, LOG_PARTITION
from lakeload.operators import mark_purged, purge_candidates, purge_summary, purge_totals
from registry import extracts as x
from registry import query

CUTOFF = "2024-01-25 12:00:00"


def order_log(spark, sf):
    """Every order as one archived file; tables by status, many equal stamps, dates over seven years."""
    ts = F.col("o_orderdate")
    return x.table(spark, sf, "orders").select(
        F.concat(F.lit("archive_orders_"), F.lower("o_orderstatus")).alias("ArchiveTable"),
        ts.alias("ArchiveDatetimeUTC"),
        *[v.alias(k) for k, v in archive_calendar(ts).items()],
        (F.col("o_totalprice") * 100).cast("decimal(18,0)").cast("long").alias("OriginalStagingFileSize"),
        F.concat(F.lit("archive/orders/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("ArchiveFilePath"),
        (F.col("o_orderpriority") == "5-LOW").alias("IsPurged"),
        F.lit(None).cast("timestamp_ntz").alias("PurgeDatetimeUTC"),
    )


def event_log(spark, sf):
    """Every event as one archived file; tables by type."""
    ts = F.col("ts")
    return x.table(spark, sf, "events").select(
        F.concat(F.lit("archive_"), F.col("event_type")).alias("ArchiveTable"),
        ts.alias("ArchiveDatetimeUTC"),
        *[v.alias(k) for k, v in archive_calendar(ts).items()],
        (F.col("value") * 1000).cast("decimal(18,0)").cast("long").alias("OriginalStagingFileSize"),
        F.concat(F.lit("archive/events/"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("ArchiveFilePath"),
        (F.col("value") < 5).alias("IsPurged"),
        F.lit(None).cast("timestamp_ntz").alias("PurgeDatetimeUTC"),
    )


def _log_sql(table: str, ts: str, source: str, size: str, path: str, key: str, purged: str) -> str:
    return f"""
      SELECT {table} AS ArchiveTable, {ts} AS ArchiveDatetimeUTC,
             CAST(year({ts}) AS INTEGER) AS ArchiveYearUTC, CAST(month({ts}) AS INTEGER) AS ArchiveMonthUTC,
             CAST(day({ts}) AS INTEGER) AS ArchiveDayUTC,
             CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS INTEGER) AS ArchiveyyyyMMddUTC,
             CAST(CAST({size} AS DECIMAL(18,0)) AS BIGINT) AS OriginalStagingFileSize,
             '{path}' || lpad(CAST({key} AS VARCHAR), 12, '0') AS ArchiveFilePath,
             {purged} AS IsPurged, CAST(NULL AS TIMESTAMP) AS PurgeDatetimeUTC
      FROM {source}"""


ORDER_LOG_SQL = _log_sql(
    "'archive_orders_' || lower(o_orderstatus)", "o_orderdate", "orders", "o_totalprice * 100",
    "archive/orders/", "o_orderkey", "o_orderpriority = '5-LOW'",
)
EVENT_LOG_SQL = _log_sql(
    "'archive_' || event_type", "ts", "events", "value * 1000", "archive/events/", "event_id", "value < 5"
)

_COLS = """ArchiveTable, ArchiveDatetimeUTC, ArchiveYearUTC, ArchiveMonthUTC, ArchiveDayUTC, ArchiveyyyyMMddUTC,
           OriginalStagingFileSize, ArchiveFilePath, IsPurged, PurgeDatetimeUTC"""


def candidates_sql(log: str, cutoff: str, year=1, month=1, week=1, day=1, rank_purged=True) -> str:
    """The four rankings written out, one window per period."""

    def rank(part: str) -> str:
        free = "" if rank_purged else "IsPurged,"
        return (
            f"row_number() OVER (PARTITION BY {free} ArchiveTable, ArchiveYearUTC{part} "
            "ORDER BY ArchiveDatetimeUTC DESC, ArchiveFilePath DESC)"
        )

    alive = "" if rank_purged else "AND NOT IsPurged"
    return f"""
      SELECT {_COLS}, NOT ((ry = {year} OR rm = {month} OR rw = {week} OR rd = {day}) {alive}) AS IsToBePurged
      FROM (SELECT *, {rank("")} AS ry, {rank(", ArchiveMonthUTC")} AS rm,
                   {rank(", week(ArchiveDatetimeUTC)")} AS rw,
                   {rank(", ArchiveMonthUTC, ArchiveDayUTC")} AS rd
            FROM ({log}) WHERE ArchiveDatetimeUTC <= TIMESTAMP '{cutoff}')"""


@query("purge_candidates", candidates_sql(EVENT_LOG_SQL, CUTOFF))
def purge_candidates_query(spark, sf):
    return purge_candidates(event_log(spark, sf), x.stamp(CUTOFF))


@query("purge_candidates_years", candidates_sql(ORDER_LOG_SQL, "2001-07-01 00:00:00", day=0))
def purge_candidates_years(spark, sf):
    """Seven years with ISO weeks across new year and many files of one stamp; days are not kept."""
    return purge_candidates(order_log(spark, sf), x.stamp("2001-07-01 00:00:00"), keep_day=False)


@query("purge_keep_year_only", candidates_sql(ORDER_LOG_SQL, "2001-12-31 00:00:00", month=0, week=0, day=0))
def purge_keep_year_only(spark, sf):
    return purge_candidates(
        order_log(spark, sf), x.stamp("2001-12-31 00:00:00"), keep_month=False, keep_week=False, keep_day=False
    )


@query("purge_keep_week_only", candidates_sql(ORDER_LOG_SQL, "2001-12-31 00:00:00", year=0, month=0, day=0))
def purge_keep_week_only(spark, sf):
    return purge_candidates(
        order_log(spark, sf), x.stamp("2001-12-31 00:00:00"), keep_year=False, keep_month=False, keep_day=False
    )


@query("purge_rank_unpurged", candidates_sql(ORDER_LOG_SQL, "2001-12-31 00:00:00", rank_purged=False))
def purge_rank_unpurged(spark, sf):
    return purge_candidates(order_log(spark, sf), x.stamp("2001-12-31 00:00:00"), rank_purged=False)


def bytes_sql(col: str) -> str:
    """Size text by integer comparison, one branch per unit."""
    units = ["B", "KB", "MB", "GB", "TB", "PB", "EB"]
    cases = " ".join(
        f"WHEN {col} >= {1024**p} THEN CAST(round(CAST({col} AS DOUBLE) / {1024**p}, 2) AS VARCHAR) || ' {u}'"
        for p, u in reversed(list(enumerate(units)))
    )
    return f"CASE WHEN {col} IS NULL OR {col} = 0 THEN '0B' {cases} END"


_SIZES = ["BytesToPurge", "BytesToRetain", "BytesPurged"]
_SUMS = """
  CAST(coalesce(sum(OriginalStagingFileSize) FILTER (NOT IsPurged AND IsToBePurged), 0) AS BIGINT) AS BytesToPurge,
  CAST(coalesce(sum(OriginalStagingFileSize) FILTER (NOT IsPurged AND NOT IsToBePurged), 0) AS BIGINT) AS BytesToRetain,
  CAST(coalesce(sum(OriginalStagingFileSize) FILTER (IsPurged), 0) AS BIGINT) AS BytesPurged"""
_TEXTS = ", ".join(f"{bytes_sql(c)} AS {c}Text" for c in _SIZES)


@query(
    "purge_summary",
    f"""SELECT *, {_TEXTS} FROM (
    SELECT ArchiveTable, {_SUMS} FROM ({candidates_sql(EVENT_LOG_SQL, CUTOFF)}) GROUP BY ArchiveTable)""",
)
def purge_summary_query(spark, sf):
    return purge_summary(purge_candidates(event_log(spark, sf), x.stamp(CUTOFF)))


@query(
    "purge_totals",
    f"SELECT *, {_TEXTS} FROM (SELECT {_SUMS} FROM ({candidates_sql(EVENT_LOG_SQL, CUTOFF)}))",
)
def purge_totals_query(spark, sf):
    return purge_totals(purge_candidates(event_log(spark, sf), x.stamp(CUTOFF)))


@query(
    "purge_mark",
    f"""WITH log AS ({EVENT_LOG_SQL}), done AS (
      SELECT * FROM ({candidates_sql(EVENT_LOG_SQL, CUTOFF)}) WHERE IsToBePurged AND NOT IsPurged)
    SELECT log.* REPLACE (log.IsPurged OR d.ArchiveFilePath IS NOT NULL AS IsPurged,
        CASE WHEN d.ArchiveFilePath IS NOT NULL THEN TIMESTAMP '2024-03-01 00:00:00' END AS PurgeDatetimeUTC)
    FROM log LEFT JOIN done d ON d.ArchiveFilePath = log.ArchiveFilePath
                             AND d.ArchiveDatetimeUTC = log.ArchiveDatetimeUTC""",
)
def purge_mark(spark, sf):
    log = event_log(spark, sf)
    due = purge_candidates(log, x.stamp(CUTOFF)).where("IsToBePurged AND NOT IsPurged")
    return mark_purged(log, due, x.stamp("2024-03-01 00:00:00"))


@query(
    "human_bytes",
    f"""SELECT o_orderkey, size, {bytes_sql("size")} AS text FROM (
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL
      ELSE CAST(CAST(o_totalprice AS DECIMAL(18,0)) AS BIGINT) * o_custkey * o_custkey END AS size FROM orders)""",
)
def human_bytes_query(spark, sf):
    size = F.when(
        F.col("o_orderstatus") != "P",
        F.col("o_totalprice").cast("decimal(18,0)").cast("long") * F.col("o_custkey") * F.col("o_custkey"),
    )
    sized = x.table(spark, sf, "orders").select("o_orderkey", size.alias("size"))
    return sized.withColumn("text", human_bytes(F.col("size")))


def _report_sql(candidates: str) -> str:
    """Sums per table and over all, and their texts made from the sums alone."""
    return f"""WITH c AS ({candidates})
      SELECT ArchiveTable, grouping(ArchiveTable) = 1 AS IsTotal,
        CAST(coalesce(sum(OriginalStagingFileSize) FILTER (NOT IsPurged AND IsToBePurged), 0) AS BIGINT) AS BytesToPurge,
        CAST(coalesce(sum(OriginalStagingFileSize) FILTER (NOT IsPurged AND NOT IsToBePurged), 0) AS BIGINT) AS BytesToRetain,
        CAST(coalesce(sum(OriginalStagingFileSize) FILTER (IsPurged), 0) AS BIGINT) AS BytesPurged
      FROM c GROUP BY ROLLUP (ArchiveTable)"""


_CATALOG_LOG_SQL = f"SELECT * FROM ({EVENT_LOG_SQL}) WHERE ArchiveTable NOT LIKE 'archive_view%'"


@query("purge_catalog", _report_sql(candidates_sql(_CATALOG_LOG_SQL, CUTOFF)))
def purge_catalog_query(spark, sf):
    """The logs of a database, one left out by its prefix, in one job with totals."""
    lake, database = shared_dir(spark, "purgecatalog"), "purge_catalog_query"
    log = event_log(spark, sf)
    filled = [F.lit(None).cast(f.dataType).alias(f.name) for f in ARCHIVE_LOG.fields if f.name not in log.columns]
    log = log.select("*", *filled).withColumn("IsIgnorable", F.lit(False)).persist()
    names = [r[0] for r in log.select("ArchiveTable").distinct().collect()]
    for name in names:
        append_archive_log(log.where(F.col("ArchiveTable") == name), f"{lake}/{name}")
        register_table(spark, f"{database}.{name}", f"{lake}/{name}", ARCHIVE_LOG, [LOG_PARTITION])
    log.unpersist()
    days = dt.timedelta(days=31)
    now = dt.datetime.fromisoformat(CUTOFF).replace(tzinfo=dt.timezone.utc) + days
    report = purge_catalog(spark, database, exclude=["archive_view"], now=now, older_than_days=31)
    table = F.regexp_extract("ArchiveTable", "`([^`]*)`$", 1)
    return report.select(
        F.when(F.col("ArchiveTable").isNotNull(), table).alias("ArchiveTable"),
        "IsTotal", "BytesToPurge", "BytesToRetain", "BytesPurged",
    )
