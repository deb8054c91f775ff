"""Calendar-based retention over archive logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.functions.scalars import human_bytes, instant, utc_clock
from lakeload.operators.matching import members

PURGE_AGE_DAYS = 31
_KEY = ("ArchiveTable", "ArchiveDatetimeUTC", "ArchiveFilePath")


def purge_candidates(
    log: DataFrame,
    cutoff,
    keep_year: bool = True,
    keep_month: bool = True,
    keep_week: bool = True,
    keep_day: bool = True,
    rank_purged: bool = True,
) -> DataFrame:
    """Rows up to the cutoff with ``IsToBePurged``.

    A row stays when it is the newest of its day, week, month or year, as far as
    that rule is on.  The newest of a longer period is also the newest of its day,
    so one aggregate per (table, day) replaces four rankings of the whole log: a
    table with most of the rows is reduced before any shuffle.

    The year is the calendar year and the week the ISO week, so the first days of
    January can share week 52 or 53 with the end of the same year's December.
    Equal archive times are ordered by path.  ``rank_purged=False`` lets purged
    rows keep no period alive.
    """
    if "ArchiveTable" not in log.columns:
        log = log.withColumn("ArchiveTable", F.lit("archive"))
    rows = log.where(F.col("ArchiveDatetimeUTC") <= instant(cutoff, log.schema["ArchiveDatetimeUTC"].dataType))
    competing = rows if rank_purged else rows.where(~F.col("IsPurged"))
    newest = F.max(F.struct("ArchiveDatetimeUTC", "ArchiveFilePath")).alias("newest")
    days = competing.groupBy(
        "ArchiveTable",
        "ArchiveYearUTC",
        "ArchiveMonthUTC",
        "ArchiveDayUTC",
        F.weekofyear(utc_clock(F.col("ArchiveDatetimeUTC"), log.schema["ArchiveDatetimeUTC"].dataType)).alias("ArchiveWeekUTC"),
    ).agg(newest)

    rules = {
        "day": (keep_day, ["ArchiveMonthUTC", "ArchiveDayUTC"]),
        "week": (keep_week, ["ArchiveWeekUTC"]),
        "month": (keep_month, ["ArchiveMonthUTC"]),
        "year": (keep_year, []),
    }
    kept = None
    for on, period in rules.values():
        if not on:
            continue
        best = days.groupBy("ArchiveTable", "ArchiveYearUTC", *period).agg(F.max("newest").alias("newest"))
        best = best.select("ArchiveTable", "newest.*")
        kept = best if kept is None else kept.unionByName(best)
    if kept is None:
        return rows.withColumn("IsToBePurged", F.lit(True))
    kept = kept.distinct().withColumn("__kept", F.lit(True))
    flagged = members(rows, kept, _KEY, "left_outer", salts=1)
    return flagged.withColumn("IsToBePurged", F.col("__kept").isNull()).drop("__kept")


def _sizes() -> list:
    size = F.col("OriginalStagingFileSize").cast("long")
    purged, due = F.col("IsPurged"), F.col("IsToBePurged")

    def total(condition, name):
        return F.coalesce(F.sum(F.when(condition, size)), F.lit(0).cast("long")).alias(name)

    return [
        total(~purged & due, "BytesToPurge"),
        total(~purged & ~due, "BytesToRetain"),
        total(purged, "BytesPurged"),
    ]


def _with_texts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"{c}Text": human_bytes(F.col(c)) for c in ("BytesToPurge", "BytesToRetain", "BytesPurged")}
    )


def purge_summary(candidates: DataFrame) -> DataFrame:
    """Bytes to purge, to retain and already purged, per archive table."""
    return _with_texts(candidates.groupBy("ArchiveTable").agg(*_sizes()))


def purge_report(candidates: DataFrame) -> DataFrame:
    """The summary per archive table and, with ``IsTotal``, over all of them, from one aggregate."""
    total = F.grouping("ArchiveTable").cast("boolean").alias("IsTotal")
    return _with_texts(candidates.rollup("ArchiveTable").agg(*_sizes(), total))


def purge_totals(candidates: DataFrame) -> DataFrame:
    """The same over all tables, one row."""
    return _with_texts(candidates.agg(*_sizes()))


def mark_purged(log: DataFrame, purged: DataFrame, now) -> DataFrame:
    """Log with the purge mark on the rows named by (path, archive time)."""
    keys = ["ArchiveFilePath", "ArchiveDatetimeUTC"]
    done = purged.select(*keys).distinct().withColumn("__done", F.lit(True))
    flagged = members(log, done, keys, "left_outer", null_safe=False, salts=1)
    hit = F.col("__done").isNotNull()
    stamp = instant(now, log.schema["PurgeDatetimeUTC"].dataType)
    return flagged.withColumns(
        {
            "IsPurged": F.col("IsPurged") | hit,
            "PurgeDatetimeUTC": F.when(hit, stamp).otherwise(F.col("PurgeDatetimeUTC")),
        }
    ).drop("__done")


def choose_tables(names: list[str], include: tuple[str, ...] = ("archive_",), exclude: tuple[str, ...] = ()) -> list[str]:
    """Tables whose name starts with an included and with no excluded prefix."""
    return [n for n in names if n.startswith(tuple(include)) and not (exclude and n.startswith(tuple(exclude)))]
