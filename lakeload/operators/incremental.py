"""What is new: watermarks over process and export logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.identifiers import column
from lakeload.functions.scalars import day_number, instant, utc_clock
from lakeload.operators.matching import members
from lakeload.schemas import LOG_PARTITION

INITIAL_LOOKBACK_DAYS = 5
EXPORT_START = "1900-01-01 00:00:00"


def load_watermark(process_log: DataFrame) -> DataFrame:
    """One row: the latest archive time that was processed."""
    return process_log.agg(F.max("ArchiveDatetimeUTC").alias("ArchiveDatetimeUTC"))


def initial_watermark(now: Column | None = None, days: int = INITIAL_LOOKBACK_DAYS) -> Column:
    """Midnight some days ago; archive files before it are not loaded by the first run."""
    return F.date_sub(F.current_date() if now is None else now.cast("date"), days).cast("timestamp")


def visible_files(archive_log: DataFrame) -> DataFrame:
    """Log rows that a load may read: neither purged nor set aside."""
    return archive_log.where(~F.col("IsPurged") & ~F.col("IsIgnorable"))


def since(archive_log: DataFrame, watermark: Column, inclusive: bool) -> DataFrame:
    """Log rows after a watermark; the day partition is restricted along with the time."""
    ts = F.col("ArchiveDatetimeUTC")
    rows = archive_log.where(ts >= watermark if inclusive else ts > watermark)
    if LOG_PARTITION in archive_log.columns:
        clock = utc_clock(watermark, archive_log.schema["ArchiveDatetimeUTC"].dataType)
        rows = rows.where(F.col(LOG_PARTITION) >= day_number(clock))
    return rows


def _with_modification_time(archive_log: DataFrame) -> DataFrame:
    if "OriginalModificationTime" in archive_log.columns:
        return archive_log
    ts_type = archive_log.schema["ArchiveDatetimeUTC"].dataType
    return archive_log.withColumn("OriginalModificationTime", F.lit(None).cast(ts_type))


def load_order(files: DataFrame) -> DataFrame:
    return files.orderBy("ArchiveDatetimeUTC", "OriginalModificationTime", "ArchiveFilePath")


def pending_files(
    archive_log: DataFrame,
    process_log: DataFrame | None,
    inclusive: bool = False,
    initial=None,
    by: str = "watermark",
) -> DataFrame:
    """Archived files still to be loaded, in load order.

    ``watermark``  later than the latest processed archive time (``inclusive``: or equal);
    ``absence``    later than the initial watermark and not in the process log, which
                   also finds files logged late with an earlier stamp;
    ``digest``     the same, searched only in log days where the two logs differ.
    Without ``initial`` a first run takes all files; ``initial_watermark`` gives a start some
    days ago.
    """
    files = _with_modification_time(visible_files(archive_log))
    ts_type = archive_log.schema["ArchiveDatetimeUTC"].dataType
    start = instant(EXPORT_START if initial is None else initial, ts_type)
    if by == "watermark":
        if process_log is not None:
            latest = load_watermark(process_log).select(F.col("ArchiveDatetimeUTC").cast(ts_type))
            start = F.coalesce(latest.scalar(), start)
        return load_order(since(files, start, inclusive))
    if by in ("absence", "digest"):
        files = since(files, start, inclusive)
        if process_log is not None:
            if by == "digest" and not inclusive and LOG_PARTITION in archive_log.columns:
                files, process_log = _differing(files, process_log, ts_type)
            done = process_log.where(F.col("ArchiveFilePath").isNotNull())
            if inclusive:
                # Files of the latest processed time are taken once more.
                done = done.where(F.col("ArchiveDatetimeUTC") < load_watermark(process_log).scalar())
            done = done.select("ArchiveFilePath").distinct()
            files = members(files, done, ["ArchiveFilePath"], "left_anti", salts=1)
        return load_order(files)
    raise ValueError(f"unknown rule: {by}")


def day_digests(log: DataFrame) -> DataFrame:
    """Per log day the number of files and 128 bits made from their paths, whatever their order.

    A few numbers per task and day are shuffled instead of all paths.
    """
    path = F.col("ArchiveFilePath")
    day = day_number(utc_clock(F.col("ArchiveDatetimeUTC"), log.schema["ArchiveDatetimeUTC"].dataType))
    return log.groupBy(day.alias(LOG_PARTITION)).agg(
        F.count(F.lit(1)).alias("files"),
        F.bit_xor(F.xxhash64(path)).alias("one"),
        F.bit_xor(F.xxhash64(F.lit("second"), path)).alias("two"),
    )


def _differing(files: DataFrame, process_log: DataFrame, ts_type, limit: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Both logs without the days on which they agree.

    A file logged twice makes its day differ, which costs a search there and nothing else.  Up to
    ``limit`` days are named, so that only their partitions are read; beyond that all are.
    """
    done = process_log.where(F.col("ArchiveFilePath").isNotNull())
    mine, theirs = day_digests(files).alias("l"), day_digests(done).alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in (LOG_PARTITION, "files", "one", "two")]
    days = [r[0] for r in mine.join(theirs, same, "left_anti").select(LOG_PARTITION).limit(limit + 1).collect()]
    if len(days) > limit:
        return files, process_log
    # A stamp belongs to one day, so a file's log rows of both kinds do.
    stamp = day_number(utc_clock(F.col("ArchiveDatetimeUTC"), ts_type))
    return files.where(F.col(LOG_PARTITION).isin(days)), process_log.where(stamp.isin(days))


def mark_ignorable(archive_log: DataFrame, predicate: str | Column, note: str | None = None) -> DataFrame:
    """Hide the chosen files from every load."""
    hit = F.expr(predicate) if isinstance(predicate, str) else predicate
    hit = F.coalesce(hit, F.lit(False))
    return archive_log.withColumns(
        {
            "IsIgnorable": F.col("IsIgnorable") | hit,
            "Notes": F.when(hit & F.lit(note is not None), F.lit(note)).otherwise(F.col("Notes")),
        }
    )


def process_log_rows(files: DataFrame, process_ts) -> DataFrame:
    """Archive-log rows of processed files as process-log rows."""
    return files.select(
        instant(process_ts).alias("ProcessDatetime"),
        "ArchiveDatetimeUTC",
        "OriginalStagingFilePath",
        "OriginalStagingFileName",
        "OriginalStagingFileSize",
        "ArchiveFilePath",
        "ArchiveFileName",
    )


def repair_log_types(archive_log: DataFrame) -> DataFrame:
    """Older logs kept the file size as int and had no modification time."""
    fixed = archive_log.withColumn("OriginalStagingFileSize", F.col("OriginalStagingFileSize").cast("long"))
    return _with_modification_time(fixed)


def export_watermark(export_log: DataFrame | None, lookback_days: int = 0, initial: str = EXPORT_START) -> Column:
    """Latest exported time less the look-back; without a log a fixed start, without look-back."""
    if export_log is None:
        return instant(initial)
    ts_type = export_log.schema["ProcessDatetime"].dataType
    latest = export_log.agg(F.max("ProcessDatetime").alias("ProcessDatetime")).scalar()
    back = F.make_dt_interval(F.lit(lookback_days))
    return F.coalesce(latest - back, F.lit(initial).cast(ts_type))


def changed_since(df: DataFrame, track_col: str, watermark, inclusive: bool = False) -> DataFrame:
    ts = column(track_col)
    at = instant(watermark, df.schema[track_col].dataType)
    return df.where(ts >= at if inclusive else ts > at)


def next_watermark(df: DataFrame, track_col: str, watermark, upper) -> DataFrame:
    """One row: the latest change between the old watermark and the start of the query, or NULL."""
    ts_type = df.schema[track_col].dataType
    ts = column(track_col)
    inside = (ts >= instant(watermark, ts_type)) & (ts <= instant(upper, ts_type))
    return df.where(inside).agg(F.max(ts).alias("ProcessDatetime"))
