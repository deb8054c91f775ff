"""Appending to and maintaining the logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.scalars import day_number, utc_clock
from lakeload.operators.incremental import mark_ignorable, repair_log_types
from lakeload.operators.retention import mark_purged
from lakeload.schemas import ARCHIVE_LOG, EXPORT_LOG, LOG_PARTITION, PROCESS_LOG
from lakeload.sinks.tables import (
    compact_partitions,
    finish_replacements,
    replace_partitions,
    restrict_partitions,
    write_balanced,
)
from lakeload.sources.archive import read_archive_log


def _as(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append_archive_log(rows: DataFrame, path: str) -> None:
    write_balanced(_as(rows, ARCHIVE_LOG), path, [LOG_PARTITION])


def append_process_log(rows: DataFrame, path: str) -> None:
    _as(rows, PROCESS_LOG).coalesce(1).write.mode("append").parquet(path)


def append_export_log(rows: DataFrame, path: str) -> None:
    _as(rows, EXPORT_LOG).coalesce(1).write.mode("append").parquet(path)


def compact_archive_log(
    spark: SparkSession, path: str, min_files: int = 8, from_day: int | None = None, to_day: int | None = None
) -> bool:
    """Join the small files of crowded log days, between two days (yyyyMMdd) if given."""
    days = F.lit(True)
    if from_day is not None:
        days = days & (F.col(LOG_PARTITION) >= from_day)
    if to_day is not None:
        days = days & (F.col(LOG_PARTITION) <= to_day)
    finish_replacements(spark, path, [LOG_PARTITION], ARCHIVE_LOG)
    return compact_partitions(spark, path, [LOG_PARTITION], ARCHIVE_LOG, min_files=min_files, where=days)


def repair_archive_log(spark: SparkSession, path: str) -> None:
    """Rewrite a log whose size was int or which lacks the modification time."""
    old = spark.read.option("mergeSchema", True).parquet(path)
    fixed = _as(repair_log_types(old), ARCHIVE_LOG)
    replace_partitions(spark, path, lambda _: fixed, old.select(LOG_PARTITION), [LOG_PARTITION], ARCHIVE_LOG)


def _rewrite(spark: SparkSession, path: str, touched: DataFrame, change) -> None:
    finish_replacements(spark, path, [LOG_PARTITION], ARCHIVE_LOG)
    log = read_archive_log(spark, path)

    def changed(days: DataFrame) -> DataFrame:
        return change(restrict_partitions(log, days, [LOG_PARTITION]))

    replace_partitions(spark, path, changed, touched, [LOG_PARTITION], ARCHIVE_LOG)


def commit_purged(spark: SparkSession, path: str, purged: DataFrame, now) -> None:
    """Set the purge mark on deleted files; only the log days that hold them are rewritten."""
    days = purged.select(day_number(utc_clock(F.col("ArchiveDatetimeUTC"))).alias(LOG_PARTITION)).distinct()
    _rewrite(spark, path, days, lambda log: mark_purged(log, purged, now))


def commit_ignorable(spark: SparkSession, path: str, predicate: str | Column, note: str | None = None) -> None:
    hit = F.expr(predicate) if isinstance(predicate, str) else predicate
    days = read_archive_log(spark, path).where(hit).select(LOG_PARTITION).distinct()
    _rewrite(spark, path, days, lambda log: mark_ignorable(log, hit, note))
