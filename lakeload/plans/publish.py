"""Archive to published folders and to relational staging tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.identifiers import column
from lakeload.operators.alignment import union_drifting
from lakeload.operators.incremental import process_log_rows
from lakeload.operators.projection import extract, underscore_names
from lakeload.plans.load import LoadSpec, pending_batches
from lakeload.schemas import ARCHIVED, STAGING_NAME
from lakeload.sinks.files import copy_files
from lakeload.sinks.jdbc import DISTRIBUTION, MAX_STRING_LENGTH, overwrite_jdbc, overwrite_warehouse
from lakeload.sinks.logs import append_process_log
from lakeload.sinks.storage import Storage
from lakeload.sinks.tables import clear_files
from lakeload.session import shared_dir
from lakeload.sources.archive import PUBLISH_CSV, SPARK_ERRORS, log_frame, read_logged


@dataclass
class PublishResult:
    """Published files; a file that failed is named here, is not logged, and is tried again."""

    files: int = 0
    failed: list[str] = field(default_factory=list)


def _spec(archive_log_path: str, target_log_path: str, fmt: str, options: dict) -> LoadSpec:
    defaults = {"encoding": None, "delimiter": PUBLISH_CSV["sep"], "pending_by": "absence"}
    return LoadSpec(archive_log_path, "", target_log_path, bk="", fmt=fmt, **{**defaults, **options})


def published_rows(spark: SparkSession, spec: LoadSpec, files: Sequence[Row]) -> DataFrame:
    """Selected columns of the files with archive time and original name."""
    names = {"ArchiveDatetimeUTC": ARCHIVED, "OriginalStagingFileName": STAGING_NAME}
    traced = read_logged(spark, files, names, spec.fmt, spec.encoding, spec.delimiter)
    rows = traced.select(
        *[column(c) for c in traced.columns if c not in names.values()],
        F.struct(*names.values()).alias("__carry"),
    )
    picked = extract(rows, spec.extract)
    if "__carry" not in picked.columns:
        wanted = spec.extract + ", __carry" if isinstance(spec.extract, str) else [*spec.extract, "__carry"]
        picked = extract(rows, wanted)
    picked = picked.select(*[column(c) for c in picked.columns if c != "__carry"], "__carry.*")
    return underscore_names(picked) if spec.fmt == "csv" else picked


def _each_or_all(
    spark: SparkSession, files: list[Row], act: Callable[[list[Row]], None]
) -> tuple[list[Row], list[str]]:
    """Act on all files at once; if that fails, on each, and tell which ones failed."""
    try:
        act(files)
        return files, []
    except SPARK_ERRORS:
        if len(files) == 1:
            return [], [files[0]["ArchiveFilePath"]]
    done, failed = [], []
    for file in files:
        try:
            act([file])
            done.append(file)
        except SPARK_ERRORS:
            failed.append(file["ArchiveFilePath"])
    return done, failed


def _log(spark: SparkSession, spec: LoadSpec, files: list[Row], now: dt.datetime) -> None:
    if files:
        append_process_log(process_log_rows(log_frame(spark, files), now), spec.log_path)


def _run(spark, spec, now, act) -> PublishResult:
    result, skip = PublishResult(), set()
    for files in pending_batches(spark, spec, now, skip):
        done, failed = _each_or_all(spark, files, act)
        _log(spark, spec, done, now)
        result.files += len(done)
        result.failed += failed
        skip.update(failed)
    return result


def publish_select(
    spark: SparkSession,
    archive_log_path: str,
    target_log_path: str,
    target_path: str,
    fmt: str = "parquet",
    *,
    clear_target: bool = False,
    now: dt.datetime | None = None,
    **options,
) -> PublishResult:
    """Append the selected columns of all pending files to a Parquet folder."""
    now = now or dt.datetime.now(dt.timezone.utc)
    spec = _spec(archive_log_path, target_log_path, fmt, options)
    if clear_target:
        clear_files(spark, target_path)
    return _run(
        spark,
        spec,
        now,
        lambda files: published_rows(spark, spec, files).write.mode("append").parquet(target_path),
    )


def publish_as_is(
    spark: SparkSession,
    archive_log_path: str,
    target_log_path: str,
    target_path: str,
    extension: str = "",
    *,
    clear_target: bool = False,
    now: dt.datetime | None = None,
    **options,
) -> PublishResult:
    """Copy all pending files unchanged; executors copy, the name gets the extension appended."""
    now = now or dt.datetime.now(dt.timezone.utc)
    spec = _spec(archive_log_path, target_log_path, "parquet", options)
    if clear_target:
        clear_files(spark, target_path)
    result, skip = PublishResult(), set()
    for files in pending_batches(spark, spec, now, skip):
        listed = log_frame(spark, files)
        work = listed.select(
            F.col("ArchiveFilePath").alias("path"),
            F.concat(F.lit(target_path.rstrip("/") + "/"), "ArchiveFileName", F.lit(extension)).alias("target"),
        )
        failed = {r["path"] for r in copy_files(work).where(F.col("problem").isNotNull()).select("path").collect()}
        done = [f for f in files if f["ArchiveFilePath"] not in failed]
        _log(spark, spec, done, now)
        result.files += len(done)
        result.failed += sorted(failed)
        skip.update(failed)
    return result


def _stage(spark, spec, now, write: Callable[[DataFrame], None]) -> PublishResult:
    """All readable pending files united, written as one table; without any, nothing is written.

    The rows are kept aside per batch before the target is replaced, so that one
    unreadable file costs only itself.
    """
    folder = shared_dir(spark, "stage")
    try:
        return _stage_in(spark, spec, now, write, folder)
    finally:
        Storage(spark, folder).remove(folder)


def _stage_in(spark, spec, now, write: Callable[[DataFrame], None], folder: str) -> PublishResult:
    result, skip = PublishResult(), set()
    parts: list[str] = []
    logged: list[Row] = []

    def keep(files: list[Row]) -> None:
        part = f"{folder}/{len(parts)}"
        published_rows(spark, spec, files).write.mode("overwrite").parquet(part)
        parts.append(part)

    for files in pending_batches(spark, spec, now, skip):
        done, failed = _each_or_all(spark, files, keep)
        logged += done
        result.failed += failed
        skip.update(f["ArchiveFilePath"] for f in files)
    if parts:
        write(union_drifting([spark.read.parquet(p) for p in parts]))
        _log(spark, spec, logged, now)
    result.files = len(logged)
    return result


def stage_to(
    spark: SparkSession,
    archive_log_path: str,
    target_log_path: str,
    write: Callable[[DataFrame], None],
    fmt: str = "parquet",
    *,
    now: dt.datetime | None = None,
    **options,
) -> PublishResult:
    """Hand the rows of all pending files, united, to any writer that replaces its target."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return _stage(spark, _spec(archive_log_path, target_log_path, fmt, options), now, write)


def stage_to_jdbc(
    spark: SparkSession,
    archive_log_path: str,
    target_log_path: str,
    url: str,
    table: str,
    fmt: str = "parquet",
    *,
    connections: int | None = None,
    now: dt.datetime | None = None,
    **options,
) -> PublishResult:
    """Replace a relational staging table by the rows of all pending files."""
    return stage_to(
        spark,
        archive_log_path,
        target_log_path,
        lambda df: overwrite_jdbc(df, url, table, connections),
        fmt,
        now=now,
        **options,
    )


def stage_to_warehouse(
    spark: SparkSession,
    archive_log_path: str,
    target_log_path: str,
    url: str,
    table: str,
    fmt: str = "parquet",
    *,
    distribution: str = DISTRIBUTION,
    max_length: int | str = MAX_STRING_LENGTH,
    connections: int | None = None,
    now: dt.datetime | None = None,
    **options,
) -> PublishResult:
    """Replace a warehouse table by the rows of all pending files."""
    now = now or dt.datetime.now(dt.timezone.utc)
    spec = _spec(archive_log_path, target_log_path, fmt, options)
    return _stage(
        spark,
        spec,
        now,
        lambda df: overwrite_warehouse(df, url, table, distribution, max_length, connections),
    )
