"""Current-image (SCD type 1) and fact merges.

Each operator returns the complete new table state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.identifiers import column, quote
from lakeload.functions.scalars import instant
from lakeload.operators.alignment import align_schemas
from lakeload.operators.matching import SALTS, any_null, members, pair, unique_source
from lakeload.schemas import ABSENT, ARCHIVE_FILE, ARCHIVED, DELETED, HASH, MODIFIED, SEEN, STAGING_NAME


def hash_differs(update_filter: str | Column | None = None) -> Column:
    """Both sides present and the row changed, narrowed by a predicate over ``s.`` and ``t.``."""
    changed = F.col("in_t") & F.col("in_s") & (column(HASH, "s") != column(HASH, "t"))
    if update_filter is not None:
        changed = changed & (F.expr(update_filter) if isinstance(update_filter, str) else update_filter)
    return F.coalesce(changed, F.lit(False))


def _rows(paired: DataFrame, target: DataFrame, source: DataFrame, take: Column, more: dict[str, Column]) -> DataFrame:
    """Target row, or source row where ``take``; columns the source lacks keep the target's value."""
    have = set(source.columns)
    out = []
    for name in target.columns:
        value = column(name, "t")
        if name in have:
            value = F.when(take, column(name, "s")).otherwise(value)
        if name in more:
            value = more[name](value)
        out.append(value.alias(name))
    return paired.select(*out)


def scd1_merge(
    target: DataFrame | None,
    source: DataFrame,
    bk: Sequence[str],
    *,
    null_safe: bool = True,
    update_filter: str | Column | None = None,
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Changed keys take the source row, unchanged keep theirs with its lineage, new ones are added.

    A column ``__SeenDatetimeUTC`` moves on for every key of the source.
    """
    source = unique_source(source, bk, on_duplicates, order_by, null_safe)
    if target is None:
        return source
    target, source = align_schemas(target, source)
    paired = pair(target, source, bk, null_safe, strategy)
    more = {}
    if SEEN in source.columns:
        more[SEEN] = lambda v: F.greatest(v, column(SEEN, "s"))
    return _rows(paired, target, source, hash_differs(update_filter) | ~F.col("in_t"), more)


def touched_partitions(
    target: DataFrame,
    source: DataFrame,
    bk: Sequence[str],
    partition_by: Sequence[str],
    null_safe: bool = True,
) -> DataFrame:
    """Distinct partition values a merge has to rewrite.

    Those named by the source, and those where a source key lives now: a key whose
    partition value changed must leave its old partition.
    """
    parts = [column(c) for c in partition_by]
    keys = source.select(*[column(k) for k in bk]).distinct()
    needed = target.select(*[column(c) for c in dict.fromkeys([*bk, *partition_by])])
    if not null_safe:
        # NULL keys match nothing and may be many.
        keys, needed = keys.where(~any_null(bk)), needed.where(~any_null(bk))
    occupied = members(needed, keys, bk, salts=1).select(*parts)
    return source.select(*parts).union(occupied).distinct()


def scd1_merge_partitions(
    target: DataFrame,
    source: DataFrame,
    bk: Sequence[str],
    partition_by: Sequence[str],
    *,
    partition_stable: bool = False,
    **options,
) -> DataFrame:
    """New state of the touched partitions only, for a dynamic partition overwrite.

    ``partition_stable`` promises that a key never changes partition, which saves
    the search for moved keys.
    """
    target, source = align_schemas(target, source)
    if partition_stable:
        touched = source.select(*[column(c) for c in partition_by]).distinct()
    else:
        touched = touched_partitions(target, source, bk, partition_by, options.get("null_safe", True))
    return scd1_merge(members(target, touched, partition_by), source, bk, **options)


def slice_flag(target: DataFrame, source: DataFrame, filter_cols: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Target with ``__in_slice``: its filter values occur in the source."""
    slices = source.select(*[column(c) for c in filter_cols]).distinct().withColumn("__hit", F.lit(True))
    flagged = members(target, slices, filter_cols, "left_outer", salts=salts)
    return flagged.withColumn("__in_slice", F.col("__hit").isNotNull()).drop("__hit")


def fact_merge(
    target: DataFrame | None,
    source: DataFrame,
    bk: Sequence[str],
    now,
    *,
    upsert: bool = True,
    delete: str | None = None,
    filter_cols: Sequence[str] | None = None,
    null_safe: bool = True,
    update_filter: str | Column | None = None,
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
    strategy: str = "auto",
    absent_at=None,
) -> DataFrame:
    """Fact load in one join.

    1. hash differs (and the update filter holds): all columns from the source,
       which also clears the soft delete;
    2. hash equal but soft-deleted: clear the delete and refresh the lineage;
    3. only in the source: insert;
    4. only in the target and not yet deleted: soft-delete, for ``delete="full"``
       always, for ``delete="filtered"`` inside the slices the source speaks for.

    A column ``__AbsentDatetimeUTC`` takes ``absent_at``, the time of the extract that lacked a row.
    """
    if delete not in (None, "full", "filtered"):
        raise ValueError(f"unknown delete: {delete}")
    if delete == "filtered" and not filter_cols:
        raise ValueError("delete='filtered' needs filter_cols")
    spoken_for = source
    source = unique_source(source, bk, on_duplicates, order_by, null_safe)
    if upsert and DELETED not in source.columns:
        like = (target.schema[DELETED] if target is not None else source.schema[MODIFIED]).dataType
        source = source.withColumn(DELETED, F.lit(None).cast(like))
    if target is None:
        return source
    target, source = align_schemas(target, source)
    columns, sized = target.columns, target
    if delete == "filtered":
        target = slice_flag(target, spoken_for, filter_cols)
    paired = pair(target, source, bk, null_safe, strategy, sized)

    never = F.lit(False)
    deleted = column(DELETED, "t").isNotNull()
    take = (hash_differs(update_filter) | ~F.col("in_t")) if upsert else never
    same = F.coalesce(column(HASH, "s") == column(HASH, "t"), never)
    revive = (F.col("in_t") & F.col("in_s") & same & deleted) if upsert else never
    gone = F.col("in_t") & ~F.col("in_s") & ~deleted if delete else never
    if delete == "filtered":
        gone = gone & column("__in_slice", "t")
    if not upsert:
        paired = paired.where("in_t")

    now = instant(now, target.schema[MODIFIED].dataType)
    stamp = now.cast(target.schema[DELETED].dataType)
    more = {
        DELETED: lambda v: F.when(gone, stamp).when(revive, F.lit(None)).otherwise(v),
        MODIFIED: lambda v: F.when(gone | revive, now).otherwise(v),
    }
    if ABSENT in columns and absent_at is not None:
        at = instant(absent_at).cast(target.schema[ABSENT].dataType)
        more[ABSENT] = lambda v: F.when(gone, at).when(revive, F.lit(None)).otherwise(v)
    for name in (ARCHIVED, ARCHIVE_FILE, STAGING_NAME):
        if name in source.columns:
            more[name] = lambda v, name=name: F.when(revive, column(name, "s")).otherwise(v)
    return _rows(paired, target.select(*[quote(c) for c in columns]), source, take, more)


def fact_soft_delete(
    target: DataFrame,
    source: DataFrame,
    bk: Sequence[str],
    now,
    filter_cols: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Only the delete step: keys absent from the file, inside its slices when given."""
    wanted = dict.fromkeys([*bk, *(filter_cols or [])])
    if HASH in source.columns:
        wanted[HASH] = None
    narrow = source.select(*[column(c) for c in wanted])
    if HASH not in wanted:
        narrow = narrow.withColumn(HASH, F.lit(None).cast("string"))
    return fact_merge(
        target,
        narrow,
        bk,
        now,
        upsert=False,
        delete="filtered" if filter_cols else "full",
        filter_cols=filter_cols,
        on_duplicates=options.pop("on_duplicates", "assume_unique"),
        **options,
    )
