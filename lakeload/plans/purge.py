"""Retention over several archives in one job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.operators.retention import PURGE_AGE_DAYS, purge_candidates, purge_report, purge_summary
from lakeload.schemas import ARCHIVE_LOG, LOG_PARTITION
from lakeload.session import shared_dir
from lakeload.sinks.files import delete_files
from lakeload.sinks.logs import commit_purged
from lakeload.sinks.storage import Storage
from lakeload.sinks.tables import finish_replacements
from lakeload.sources.archive import read_archive_log
from lakeload.sources.tables import archive_log_locations


def read_logs(spark: SparkSession, logs: Mapping[str, str]) -> DataFrame:
    """Archive logs by table name, as one frame with ``ArchiveTable``."""
    union = None
    for name, path in logs.items():
        if read_archive_log(spark, path) is None:
            continue
        finish_replacements(spark, path, [LOG_PARTITION], ARCHIVE_LOG)
        log = read_archive_log(spark, path)
        named = log.withColumn("ArchiveTable", F.lit(name))
        union = named if union is None else union.unionByName(named)
    if union is None:
        raise ValueError("no archive logs")
    return union


def purge_job(
    spark: SparkSession,
    logs: Mapping[str, str],
    *,
    older_than_days: int = PURGE_AGE_DAYS,
    now: dt.datetime | None = None,
    dry_run: bool = True,
    summarize: Callable[[DataFrame], DataFrame] = purge_summary,
    **rules,
) -> DataFrame:
    """Byte summary per archive; a real run also deletes the due files and marks them.

    Executors delete; only files that are gone are marked.  The outcome of the
    deletion is written once and read back, so nothing is deleted twice.
    """
    now = now or dt.datetime.now(dt.timezone.utc)
    cutoff = F.lit(now - dt.timedelta(days=older_than_days))
    candidates = purge_candidates(read_logs(spark, logs), cutoff, **rules)
    if dry_run:
        return summarize(candidates)
    work = shared_dir(spark, "purge")
    candidates.write.mode("overwrite").parquet(f"{work}/candidates")
    candidates = spark.read.parquet(f"{work}/candidates")
    due = candidates.where(F.col("IsToBePurged") & ~F.col("IsPurged"))
    due = due.select("ArchiveTable", "ArchiveDatetimeUTC", "ArchiveFilePath")
    delete_files(due, "ArchiveFilePath").write.mode("overwrite").parquet(f"{work}/deleted")
    deleted = spark.read.parquet(f"{work}/deleted").where(F.col("problem").isNull())
    for name, path in logs.items():
        gone = deleted.where(F.col("ArchiveTable") == name)
        if not gone.isEmpty():
            commit_purged(spark, path, gone, now)
    # One row per archive: taken before the work folder goes.
    summary = summarize(candidates)
    rows = summary.collect()
    Storage(spark, work).remove(work)
    return spark.createDataFrame(rows, summary.schema)


def purge_catalog(
    spark: SparkSession,
    database: str,
    include: Sequence[str] = ("archive_",),
    exclude: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Retention over all archive logs registered in a database, chosen by name prefix, in one job.

    The logs are united, so there is one ranking, one deletion and one report with a row for all
    archives (``IsTotal``); ``options`` are those of ``purge_job``.
    """
    logs = archive_log_locations(spark, database, include, exclude)
    return purge_job(spark, logs, summarize=purge_report, **options)
