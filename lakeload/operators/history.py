"""Full-history (SCD type 2) tables: merge and read side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.identifiers import column, quote
from lakeload.functions.scalars import instant
from lakeload.operators.alignment import align_schemas, conform
from lakeload.operators.matching import match_condition, pair, unique_source
from lakeload.operators.merge import hash_differs, slice_flag
from lakeload.schemas import CURRENT, END, OPEN_END, START


def open_end(dtype: T.DataType) -> Column:
    """The end of an open version; as an instant it is midnight UTC in every session."""
    zone = "+00:00" if isinstance(dtype, T.TimestampType) else ""
    return F.lit(OPEN_END + zone).cast(dtype)


def open_versions(source: DataFrame, archive_ts) -> DataFrame:
    """Source rows as current versions valid from the archive time."""
    start = instant(archive_ts)
    opened = source.withColumn(START, start)
    return opened.withColumns({END: open_end(opened.schema[START].dataType), CURRENT: F.lit(True)})


def scd2_merge_current(
    current: DataFrame,
    source: DataFrame,
    bk: Sequence[str],
    archive_ts,
    *,
    upsert: bool = True,
    delete: str | None = None,
    filter_cols: Sequence[str] | None = None,
    null_safe: bool = True,
    update_filter: str | Column | None = None,
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Merge into the current versions: kept, closed and opened rows come out of one join.

    Closed history never takes part, so a key with a long history costs no more
    than any other, and its end times stay as they were written.
    """
    if delete not in (None, "full", "filtered"):
        raise ValueError(f"unknown delete: {delete}")
    if delete == "filtered" and not filter_cols:
        raise ValueError("delete='filtered' needs filter_cols")
    spoken_for = source
    source = open_versions(unique_source(source, bk, on_duplicates, order_by, null_safe), archive_ts)
    current, source = align_schemas(current, source)
    columns, sized = current.columns, current
    if delete == "filtered":
        current = slice_flag(current, spoken_for, filter_cols)
    paired = pair(current, source, bk, null_safe, strategy, sized)

    changed = hash_differs(update_filter) if upsert else F.lit(False)
    fresh = F.col("in_s") & ~F.col("in_t") if upsert else F.lit(False)
    gone = F.lit(False)
    if delete:
        gone = F.col("in_t") & ~F.col("in_s")
        if delete == "filtered":
            gone = gone & column("__in_slice", "t")
    closes = changed | gone

    at = instant(archive_ts).cast(current.schema[END].dataType)
    closing = {END: F.when(closes, at), CURRENT: F.when(closes, F.lit(False))}
    have = set(source.columns)
    old = F.struct(
        *[
            F.coalesce(closing[c], column(c, "t")).alias(c) if c in closing else column(c, "t").alias(c)
            for c in columns
        ]
    )
    new = F.struct(
        *[
            (column(c, "s") if c in have else F.lit(None).cast(current.schema[c].dataType)).alias(c)
            for c in columns
        ]
    )
    versions = F.array_compact(F.array(F.when(F.col("in_t"), old), F.when(changed | fresh, new)))
    return paired.select(F.explode(versions).alias("v")).select(*[column(c, "v").alias(c) for c in columns])


def scd2_merge(
    target: DataFrame | None,
    source: DataFrame,
    bk: Sequence[str],
    archive_ts,
    **options,
) -> DataFrame:
    """Complete new history: closed versions as they are, current ones merged."""
    if target is None:
        unique = unique_source(
            source,
            bk,
            options.get("on_duplicates", "error"),
            options.get("order_by"),
            options.get("null_safe", True),
        )
        return open_versions(unique, archive_ts)
    merged = scd2_merge_current(target.where(column(CURRENT)), source, bk, archive_ts, **options)
    closed = conform(target.where(~column(CURRENT)), merged.schema)
    return closed.unionByName(merged)


def scd2_close_deleted(
    target: DataFrame,
    source: DataFrame,
    bk: Sequence[str],
    archive_ts,
    filter_cols: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Only the delete step: current versions whose key the file lacks are closed."""
    options.setdefault("on_duplicates", "assume_unique")
    return scd2_merge(
        target,
        source,
        bk,
        archive_ts,
        upsert=False,
        delete="filtered" if filter_cols else "full",
        filter_cols=filter_cols,
        **options,
    )


def scd2_current(df: DataFrame) -> DataFrame:
    return df.where(column(CURRENT))


def scd2_as_of(df: DataFrame, ts) -> DataFrame:
    """Versions valid at a point in time."""
    at = instant(ts, df.schema[START].dataType)
    return df.where((column(START) <= at) & (at < column(END)))


def scd2_rewind(df: DataFrame, ts) -> DataFrame:
    """The history as it was before any file stamped ``ts`` or later was applied.

    Versions opened since are gone, and versions closed since are open again.
    """
    start = df.schema[START].dataType
    ended = column(END) >= instant(ts, start).cast(df.schema[END].dataType)
    before = df.where(column(START) < instant(ts, start))
    reopened = F.when(ended, open_end(df.schema[END].dataType)).otherwise(column(END))
    return before.withColumns({END: reopened, CURRENT: ended})


def dimension_as_of(
    facts: DataFrame,
    dimension: DataFrame,
    fact_keys: Sequence[str],
    dimension_keys: Sequence[str],
    ts_col: str,
    how: str = "left",
) -> DataFrame:
    """Each fact row with the dimension version valid at its time.

    An equi-join on the key with the interval as extra condition; a hot key's fact
    rows are split by Spark's adaptive skew join, and a key has at most one
    version per load on the other side.
    """
    renamed = dimension.select(
        *[column(d).alias(f"__k{i}") for i, d in enumerate(dimension_keys)],
        *[quote(c) for c in dimension.columns if c not in dimension_keys],
    )
    keyed = facts.select("*", *[column(f).alias(f"__k{i}") for i, f in enumerate(fact_keys)])
    keys = [f"__k{i}" for i in range(len(fact_keys))]
    at = column(ts_col, "l")
    condition = match_condition(keys, null_safe=False) & (column(START, "r") <= at) & (at < column(END, "r"))
    joined = keyed.alias("l").join(renamed.alias("r"), condition, how)
    return joined.select(
        *[column(c, "l") for c in facts.columns],
        *[column(c, "r") for c in renamed.columns if c not in keys],
    )
