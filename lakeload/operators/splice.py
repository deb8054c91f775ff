"""Late extracts put in their place without the files that came after them.

A full extract stamped ``t`` that turns up late governs the time from ``t`` to the next stamp that
was applied.  What a table says about that time is replaced, what it says about other times stays,
and neighbouring stretches of equal hash are joined again: the outcome is that of applying all files
in order, though only the late ones are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.functions.identifiers import column
from lakeload.functions.scalars import instant
from lakeload.operators.alignment import align_schemas, conform
from lakeload.operators.fold import _collapse, _one_row_per_file, number_in_order
from lakeload.operators.history import open_end
from lakeload.operators.matching import match_condition, members
from lakeload.schemas import (
    ABSENT,
    ARCHIVE_FILE,
    ARCHIVED,
    CURRENT,
    DELETED,
    END,
    HASH,
    MODIFIED,
    SEEN,
    STAGING_NAME,
    START,
)

_SEQ, _NEXT = "__seq", "__next"


def _stamps(applied: DataFrame, late: DataFrame) -> DataFrame:
    """All stamps once with ``__next``, whether they are ``__late``, and a file of each."""
    kinds = applied.withColumn("__late", F.lit(False)).unionByName(late.withColumn("__late", F.lit(True)))
    # A late stamp that was applied before is one more part of that extract.
    first = F.min(F.struct(column(ARCHIVE_FILE), column(STAGING_NAME)))
    once = kinds.groupBy(ARCHIVED).agg(first.alias("__file"), F.bool_and("__late").alias("__late"))
    return number_in_order(once, ARCHIVED).drop(_SEQ)


def _pieces(versions: DataFrame, stamps: DataFrame) -> DataFrame:
    """Versions without the time that late extracts govern: none, one or several pieces each.

    ``__resumed`` marks a piece that begins where a late extract's time ends.
    """
    at, end = versions.schema[START].dataType, versions.schema[END].dataType
    stretch = F.struct(column(ARCHIVED).cast(at).alias("lo"), F.coalesce(F.col(_NEXT).cast(at), open_end(at)).alias("hi"))
    # One entry for each late file of the batch.
    governed = stamps.where("__late").agg(F.sort_array(F.collect_list(stretch)).alias("g")).scalar()
    versions = versions.withColumn("__governed", governed)
    start, stop = column(START), column(END).cast(at)
    cuts = F.filter("__governed", lambda g: (g["lo"] < stop) & (g["hi"] > start))
    begins = F.concat(F.array(start), F.transform(cuts, lambda g: g["hi"]))
    ends = F.concat(F.transform(cuts, lambda g: g["lo"]), F.array(stop))
    pieces = F.filter(F.arrays_zip(begins.alias("b"), ends.alias("e")), lambda p: p["b"] < p["e"])
    cut = versions.withColumn("__piece", F.explode(pieces))
    resumed = F.col("__piece.b") != start
    whole = column(END).cast(at) == F.col("__piece.e")
    return cut.withColumns(
        {
            "__resumed": resumed,
            CURRENT: column(CURRENT) & whole,
            START: F.col("__piece.b"),
            END: F.when(whole, column(END)).otherwise(F.col("__piece.e").cast(end)),
        }
    ).drop("__piece", "__governed")


def _late_versions(late: DataFrame, stamps: DataFrame, start_type, end_type) -> DataFrame:
    """Late rows as versions that end at the next stamp."""
    following = stamps.select(ARCHIVED, _NEXT)
    rows = members(late, following, [ARCHIVED], "inner")
    return rows.withColumns(
        {
            START: column(ARCHIVED).cast(start_type),
            END: F.coalesce(F.col(_NEXT).cast(end_type), open_end(end_type)),
            CURRENT: F.col(_NEXT).isNull(),
        }
    ).drop(_NEXT)


def _without_repeats(late: DataFrame, versions: DataFrame, stamps: DataFrame, bk: Sequence[str]) -> DataFrame:
    """Late rows of a stamp that was applied before say nothing new where the table agrees; where
    it differs, one extract has a key twice and the job stops."""
    shared = stamps.where("NOT __late").select(column(ARCHIVED), F.lit(True).alias("__shared"))
    flagged = members(late, shared, [ARCHIVED], "left_outer").alias("l")
    known = versions.select(*[column(c) for c in bk], column(HASH).alias("__known"), START, END).alias("r")
    inside = (column(START, "r") <= column(ARCHIVED, "l")) & (column(ARCHIVED, "l") < column(END, "r"))
    found = flagged.join(known, match_condition(bk) & F.col("l.__shared") & inside, "left_outer")
    failure = F.raise_error(F.lit("two files of one stamp disagree about a key")).cast("boolean")
    same = F.when(F.col("__known").isNull(), True).when(F.col("__known") != column(HASH, "l"), failure).otherwise(False)
    return found.where(same).select(*[column(c, "l") for c in late.columns])


def _spliced(
    versions: DataFrame,
    late: DataFrame,
    bk: Sequence[str],
    stamps: DataFrame,
    carried: Sequence[str],
    now,
    last_only: bool,
) -> DataFrame:
    """Pieces and late versions of each key in order, joined where they meet with equal hash."""
    pieces = _pieces(versions, stamps)
    pieces, rows = align_schemas(pieces, late.withColumn("__resumed", F.lit(False)))
    rows = pieces.unionByName(conform(rows, pieces.schema))
    w = Window.partitionBy(*[column(k) for k in bk]).orderBy(column(START))
    meets = (F.lag(column(END)).over(w) == column(START).cast(pieces.schema[END].dataType)) & F.lag(
        column(HASH)
    ).over(w).eqNullSafe(column(HASH))
    joined = _collapse(rows, w, meets, [END, CURRENT, *carried])
    if last_only:
        joined = joined.withColumn("__final", F.lead(column(START)).over(w).isNull()).where("__final").drop("__final")
    # A piece that begins at a stamp stems from a file of that stamp.
    files = stamps.select(column(ARCHIVED).cast(pieces.schema[START].dataType).alias(START), "__file")
    named = members(joined, files, [START], "left_outer")
    values = {
        MODIFIED: instant(now),
        ARCHIVED: column(START),
        ARCHIVE_FILE: F.col("__file").getField(ARCHIVE_FILE),
        STAGING_NAME: F.col("__file").getField(STAGING_NAME),
    }
    moved = {
        k: F.when(F.col("__resumed"), v.cast(pieces.schema[k].dataType)).otherwise(column(k)) for k, v in values.items()
    }
    return named.withColumns(moved).drop("__resumed", "__file")


def scd2_splice(
    history: DataFrame,
    late: DataFrame,
    bk: Sequence[str],
    applied: DataFrame,
    late_files: DataFrame,
    now,
    *,
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """History with late full extracts in their place.

    ``late`` holds the rows of the late files with their lineage, ``late_files`` lists these files and
    ``applied`` those in the history, both with stamp, path and staging name (only stamps from the first
    late one on matter).  Versions that end before the first late stamp, or begin after the last late
    stamp's successor, take no part.  A version taken up again behind a late extract bears the
    lineage of the first file of the stamp where it begins.
    """
    lineage = [ARCHIVED, ARCHIVE_FILE, STAGING_NAME]
    stamps = _stamps(applied.select(*lineage), late_files.select(*lineage))
    late = _unique(late, bk, on_duplicates, order_by)
    at, end = history.schema[START].dataType, history.schema[END].dataType
    # The time that late files, those of an applied stamp included, can change.
    span = members(stamps, late_files.select(ARCHIVED).distinct(), [ARCHIVED], salts=1)
    bounds = span.agg(
        F.struct(
            F.min(ARCHIVED).cast(at).alias("lo"),
            F.max(F.coalesce(F.col(_NEXT).cast(at), open_end(at))).alias("hi"),
        ).alias("b")
    ).scalar()
    near = (column(END).cast(at) >= bounds["lo"]) & (column(START) <= bounds["hi"])
    touched, rest = history.where(near), history.where(~near)
    late = _without_repeats(late, touched, stamps, bk)
    result = _spliced(touched, _late_versions(late, stamps, at, end), bk, stamps, [], now, False)
    return result.unionByName(conform(rest, result.schema))


def fact_splice(
    target: DataFrame,
    late: DataFrame,
    bk: Sequence[str],
    applied: DataFrame,
    late_files: DataFrame,
    now,
    *,
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Fact table with late full extracts in their place; parameters as for ``scd2_splice``.

    A row is a stretch of time from the file that changed or revived it to the extract that lacked
    it (``__AbsentDatetimeUTC``), open while it exists.  The last stretch of a key is its row.
    """
    lineage = [ARCHIVED, ARCHIVE_FILE, STAGING_NAME]
    stamps = _stamps(applied.select(*lineage), late_files.select(*lineage))
    late = _unique(late, bk, on_duplicates, order_by)
    at = target.schema[ARCHIVED].dataType
    gone = column(DELETED).isNotNull()
    unknown = F.raise_error(F.lit(f"a deleted row has no {ABSENT}")).cast(at)
    absent = F.when(gone, F.coalesce(column(ABSENT).cast(at), unknown)).otherwise(open_end(at))
    versions = target.withColumns({START: column(ARCHIVED), END: absent, CURRENT: ~gone})
    late = _without_repeats(late, versions, stamps, bk)
    rows = _late_versions(late, stamps, at, at)
    stamp = instant(now).cast(target.schema[DELETED].dataType)
    rows = rows.withColumn(DELETED, F.when(~column(CURRENT), stamp))
    # A row that a late extract lacked and that stayed away later keeps its time of deletion.
    last = _spliced(versions, rows, bk, stamps, [DELETED], now, True)
    changed = last.schema[MODIFIED].dataType
    return last.withColumns(
        {
            ABSENT: F.when(column(CURRENT), F.lit(None)).otherwise(column(END)).cast(last.schema[ABSENT].dataType),
            DELETED: F.when(column(CURRENT), F.lit(None)).otherwise(F.coalesce(column(DELETED), stamp)),
            MODIFIED: F.greatest(column(MODIFIED), column(DELETED).cast(changed)),
        }
    ).drop(START, END, CURRENT)


def unseen_since(target: DataFrame, late: DataFrame, bk: Sequence[str]) -> DataFrame:
    """Late rows that a current image still needs: of keys that no later file held.

    Any later file that held a key decided its row, whatever the late one says.
    """
    seen = target.select(*[column(k) for k in bk], column(SEEN).alias("__seen"), column(ARCHIVED).alias("__from"))
    found = late.alias("l").join(seen.alias("r"), match_condition(bk), "left_outer")
    unknown = F.raise_error(F.lit(f"a row has no {SEEN}")).cast("boolean")
    at = column(ARCHIVED, "l")
    newer = (
        F.when(F.col("__from").isNull() | (F.col("__seen") <= at), True)
        .when((F.col("__seen") > at) | (F.col("__from") > at), False)
        .otherwise(unknown)
    )
    return found.where(newer).select(*[column(c, "l") for c in late.columns])


def _unique(late: DataFrame, bk: Sequence[str], on_duplicates: str, order_by) -> DataFrame:
    """Each key at most once per stamp."""
    numbered = late.withColumn(_SEQ, column(ARCHIVED))
    return _one_row_per_file(numbered, bk, on_duplicates, order_by).drop(_SEQ)
