"""Scalar expressions over timestamps, file names and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unit names of the size text, 1024 apart.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")


def human_bytes(size: Column) -> Column:
    """``1536`` -> ``1.5 KB``; NULL and 0 give ``0B``."""
    # The nested when picks the power exactly; a floating logarithm would put
    # 1024**k - 1 and 1024**k on the wrong side of the step.
    step = F.lit(0)
    for power in range(1, 7):
        step = F.when(size >= F.lit(1024**power), power).otherwise(step)
    scaled = F.round(size.cast("double") / F.pow(F.lit(1024.0), step), 2)
    unit = F.element_at(F.array(*[F.lit(u) for u in SIZE_UNITS]), step + 1)
    text = F.concat_ws(" ", scaled.cast("string"), unit)
    return F.when(size.isNull() | (size == 0), F.lit("0B")).otherwise(text)


def file_extension(path: Column) -> Column:
    """Last suffix with its dot, empty when the file name has none."""
    return F.regexp_extract(path, r"[^/](\.[^./]*)$", 1)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def day_number(ts: Column) -> Column:
    """Timestamp -> yyyyMMdd as int."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def utc_clock(ts: Column, dtype: T.DataType | None = None) -> Column:
    """The UTC wall clock of an instant, whatever the session's time zone; zoneless times stay."""
    if dtype is not None and not isinstance(dtype, T.TimestampType):
        return ts
    return F.to_utc_timestamp(ts, F.current_timezone())


def name_prefix(ts: Column) -> Column:
    return F.date_format(ts, "HH_mm")


def epoch_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def archive_calendar(ts: Column) -> dict[str, Column]:
    """The calendar columns of the archive log for an archive time."""
    return {
        "ArchiveYearUTC": F.year(ts),
        "ArchiveMonthUTC": F.month(ts),
        "ArchiveDayUTC": F.dayofmonth(ts),
        "ArchiveyyyyMMddUTC": day_number(ts),
    }


def instant(value, like=None) -> Column:
    """A point in time given as Column, datetime or text, as a Column."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast(like or "timestamp")
