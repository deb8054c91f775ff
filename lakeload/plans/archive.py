"""Landing folder to archive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.scalars import day_number, utc_clock
from lakeload.operators.matching import members
from lakeload.schemas import ARCHIVE_LOG, LOG_PARTITION
from lakeload.sinks.files import archive_files, delete_files
from lakeload.sinks.logs import append_archive_log, compact_archive_log
from lakeload.sinks.tables import register_table
from lakeload.sources.archive import read_archive_log
from lakeload.sources.landing import list_landing

_IDENTITY = ["path", "length", "modificationTime"]


def _logged(spark: SparkSession, log_path: str, listing: DataFrame, now: dt.datetime) -> DataFrame | None:
    """Identities of the listing's files that the log may hold.

    A file is not archived before it was modified, which spares the older days of the
    log; one day and the run's own time are allowed for clocks that differ.
    """
    log = read_archive_log(spark, log_path)
    if log is None:
        return None
    oldest = F.least(F.min("modificationTime") - F.expr("INTERVAL 1 DAY"), F.lit(now))
    oldest = listing.agg(day_number(utc_clock(oldest)).alias("day")).scalar()
    return (
        log.where(F.col(LOG_PARTITION) >= oldest)
        .select(
            F.col("OriginalStagingFilePath").alias("path"),
            F.col("OriginalStagingFileSize").alias("length"),
            F.col("OriginalModificationTime").alias("modificationTime"),
        )
        .distinct()
    )


def archive_batch(
    spark: SparkSession,
    listing: DataFrame,
    archive_path: str,
    log_path: str,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Copy a listing, commit its log rows, then delete the logged landing files.

    A file that a broken earlier run already logged is only deleted.  Files that
    could not be copied stay and are tried again by the next run.  Returns the
    deletion result, one row per logged file.
    """
    now = now or dt.datetime.now(dt.timezone.utc)
    fresh = listing
    logged = _logged(spark, log_path, listing, now)
    if logged is not None:
        fresh = members(listing, logged, _IDENTITY, "left_anti", salts=1)
    copied = archive_files(fresh, archive_path, now).where(F.col("problem").isNull())
    append_archive_log(copied, log_path)
    committed = _logged(spark, log_path, listing, now)
    return delete_files(members(listing, committed, _IDENTITY, "left_semi", salts=1))


def archive_job(
    spark: SparkSession,
    ingest_path: str,
    archive_path: str,
    archive_log_path: str | None = None,
    *,
    now: dt.datetime | None = None,
    table_name: str | None = None,
) -> int:
    """Archive everything complete in the landing folder; the number of files archived."""
    now = now or dt.datetime.now(dt.timezone.utc)
    log_path = archive_log_path or f"{archive_path.rstrip('/')}/log"
    listing = list_landing(spark, ingest_path)
    if listing.isEmpty():
        return 0
    deleted = archive_batch(spark, listing, archive_path, log_path, now).where(F.col("problem").isNull()).count()
    yesterday = now.astimezone(dt.timezone.utc) - dt.timedelta(days=1)
    compact_archive_log(spark, log_path, from_day=int(yesterday.strftime("%Y%m%d")))
    if table_name:
        register_table(spark, table_name, log_path, ARCHIVE_LOG, [LOG_PARTITION])
    return deleted
