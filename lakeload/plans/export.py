"""Incremental export of lake tables and queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.operators.incremental import changed_since, export_watermark, next_watermark
from lakeload.operators.projection import extract
from lakeload.schemas import MODIFIED
from lakeload.sinks.jdbc import DISTRIBUTION, MAX_STRING_LENGTH, overwrite_jdbc, overwrite_warehouse
from lakeload.sinks.logs import append_export_log
from lakeload.sources.archive import read_export_log


@dataclass
class ExportResult:
    since: dt.datetime
    until: dt.datetime | None


def export_frame(
    df: DataFrame,
    target_log_path: str,
    write: Callable[[DataFrame], None],
    *,
    columns: str | Sequence[str] = "*",
    track_col: str = MODIFIED,
    include_previous: bool = False,
    lookback_days: int = 0,
    now: dt.datetime | None = None,
) -> ExportResult:
    """Write the rows changed since the last export and remember how far it came.

    Rows changed after the start of the query may be written now and again by the
    next export: the new watermark does not pass the start.
    """
    spark = df.sparkSession
    now = now or dt.datetime.now(dt.timezone.utc)
    log_path = f"{target_log_path.rstrip('/')}/processDatetime"
    log = read_export_log(spark, log_path)
    if log is None:
        first = spark.range(1).select(export_watermark(None).alias("ProcessDatetime"))
        append_export_log(first, log_path)
        log = first
        lookback_days = 0
    since = spark.range(1).select(export_watermark(log, lookback_days).alias("w")).first()["w"]
    write(extract(changed_since(df, track_col, since, include_previous), columns))
    until = next_watermark(df, track_col, since, now)
    latest = until.first()["ProcessDatetime"]
    if latest is not None:
        append_export_log(spark.range(1).select(F.lit(latest).alias("ProcessDatetime")), log_path)
    return ExportResult(since, latest)


def export_table(spark: SparkSession, name: str, target_log_path: str, write, **options) -> ExportResult:
    """Export a lake table by name; ``write`` is a sink such as :func:`to_jdbc`."""
    return export_frame(spark.table(name), target_log_path, write, **options)


def export_query(spark: SparkSession, sql: str, target_log_path: str, write, **options) -> ExportResult:
    """Export the result of a query over lake tables."""
    return export_frame(spark.sql(sql), target_log_path, write, **options)


def to_jdbc(url: str, table: str, connections: int | None = None, **options) -> Callable[[DataFrame], None]:
    return lambda df: overwrite_jdbc(df, url, table, connections, **options)


def to_warehouse(
    url: str,
    table: str,
    distribution: str = DISTRIBUTION,
    max_length: int | str = MAX_STRING_LENGTH,
    connections: int | None = None,
    **options,
) -> Callable[[DataFrame], None]:
    return lambda df: overwrite_warehouse(df, url, table, distribution, max_length, connections, **options)
