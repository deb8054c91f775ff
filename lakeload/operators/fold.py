"""Many files in one job: the end state of applying them one after another.

A key's rows are never gathered whole.  Files are numbered, the numbers cut into
chunks, and change points are found per (key, chunk); only the rows at chunk
borders then meet per key.  With ``n`` files a group holds at most ``chunk_files``
rows in the first step and ``2 * n / chunk_files`` in the second.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from lakeload.functions.identifiers import column
from lakeload.functions.scalars import instant
from lakeload.operators.alignment import align_schemas, conform
from lakeload.operators.history import open_end, open_versions
from lakeload.operators.matching import keep_last, members, pair, require_unique, spread, tasks_for
from lakeload.operators.merge import _rows
from lakeload.schemas import ABSENT, ARCHIVE_FILE, ARCHIVED, CURRENT, DELETED, END, HASH, MODIFIED, SEEN, START

CHUNK_FILES = 256
_SEQ, _NEXT, _DUE = "__seq", "__next", "__due"


def number_in_order(df: DataFrame, ts_col: str, ties: Sequence[str] = ()) -> DataFrame:
    """Dense ``__seq`` from 0 by time, and ``__next``: the time of the following row.

    Rows are ranked within their hour; the hours themselves are few (a century has
    under 900 000) and give each hour its offset and the first time of the next.
    """
    hour = F.date_trunc("hour", column(ts_col))
    keyed = df.withColumn("__hour", hour)
    order = [column(ts_col), *[column(c) for c in ties]]
    inside = Window.partitionBy("__hour").orderBy(*order)
    ranked = keyed.withColumn("__rank", F.row_number().over(inside)).withColumn(
        "__later", F.lead(column(ts_col)).over(inside)
    )
    calendar = Window.orderBy("__hour")
    hours = (
        keyed.groupBy("__hour")
        .agg(F.count(F.lit(1)).alias("__n"), F.min(column(ts_col)).alias("__first"))
        .withColumn("__before", F.sum("__n").over(calendar) - F.col("__n"))
        .withColumn("__following", F.lead("__first").over(calendar))
        .select("__hour", "__before", "__following")
    )
    numbered = members(ranked, hours, ["__hour"], "inner")
    return numbered.select(
        *[column(c) for c in df.columns],
        (F.col("__before") + F.col("__rank") - 1).alias(_SEQ),
        F.coalesce(F.col("__later"), F.col("__following")).alias(_NEXT),
    )


def _collapse(rows: DataFrame, w: WindowSpec, joins: Column, carried: Sequence[str]) -> DataFrame:
    """First row of each run, with ``carried`` columns taken from the run's last row.

    ``joins`` tells whether a row continues the one before it.  Every step uses the
    one window, so the rows are shuffled and sorted once.
    """
    marked = rows.withColumn("__head", ~F.coalesce(joins, F.lit(False)))
    marked = marked.withColumn("__tail", F.coalesce(F.lead("__head").over(w), F.lit(True)))
    ends = marked.where(F.col("__head") | F.col("__tail"))
    # Among heads and tails the row after a head that is no tail is its tail.
    last = {c: F.when(F.col("__tail"), F.col(c)).otherwise(F.lead(c).over(w)) for c in carried}
    return ends.withColumns(last).where("__head").drop("__head", "__tail")


def _runs(
    rows: DataFrame,
    bk: Sequence[str],
    chunk_files: int | None,
    last_only: bool = False,
    start_col: str | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Maximal runs of a key's rows with equal hash.

    ``__due`` of a row is the number of the file that ends the key's presence unless it holds the
    key (NULL: none), ``__next`` that file's time; a row beyond it starts a new run.  A run is its
    first row, with ``__until``, the time when its last row ends: ``__next``, or the start of the
    key's following row where ``start_col`` names it, whichever is earlier.  ``carried`` columns
    come from the last row too.  ``last_only`` keeps the last run of each key.
    """
    keys, n_tasks = [column(k) for k in bk], tasks_for(rows)
    chunk = F.floor(F.col(_SEQ) / chunk_files).cast("long") if chunk_files else F.lit(0).cast("long")
    rows = rows.withColumns({"__chunk": chunk, "__until": F.col(_NEXT)})
    ends = [_DUE, "__until", *carried]

    def continues(w: WindowSpec) -> Column:
        same = F.lag(column(HASH)).over(w).eqNullSafe(column(HASH)) & F.lag(_SEQ).over(w).isNotNull()
        return same & ~F.coalesce(F.lag(_DUE).over(w) < F.col(_SEQ), F.lit(False))

    def bounded(df: DataFrame, w: WindowSpec) -> DataFrame:
        if start_col is None:
            return df
        following = F.lead(column(start_col)).over(w)
        return df.withColumn("__until", F.least(F.col("__until").cast(df.schema[start_col].dataType), following))

    inside = Window.partitionBy(*keys, "__chunk").orderBy(_SEQ)
    rows = spread(rows, [*bk, "__chunk"] if chunk_files else bk, n_tasks).withColumns(
        {
            "__first": F.lag(_SEQ).over(inside).isNull(),
            "__last": F.lead(_SEQ).over(inside).isNull(),
        }
    )
    runs = _collapse(bounded(rows, inside), inside, continues(inside), [*ends, "__last"])

    w = inside
    if chunk_files:
        # Only a chunk's first and last run can go on in a neighbouring chunk; every
        # other run is a group of its own.
        edge = F.col("__first") | F.col("__last")
        if last_only:
            runs = runs.where(edge)
        runs = runs.withColumns(
            {
                "__chunk_of": F.when(~edge, F.col("__chunk")),
                "__run_of": F.when(~edge, F.col(_SEQ)),
            }
        )
        runs = spread(runs, [*bk, "__chunk_of", "__run_of"], n_tasks)
        w = Window.partitionBy(*keys, "__chunk_of", "__run_of").orderBy(_SEQ)
        across = (F.lag("__chunk").over(w) != F.col("__chunk")) & continues(w)
        runs = _collapse(bounded(runs, w), w, across, ends)
    if last_only:
        runs = runs.withColumn("__final", F.lead(_SEQ).over(w).isNull()).where("__final")
    return runs.drop("__chunk", "__first", "__last", "__chunk_of", "__run_of", "__final", _DUE)


def _due(
    numbered: DataFrame,
    named: DataFrame | None,
    old: DataFrame | None,
    first,
    filter_cols: Sequence[str] | None,
    few: bool,
) -> tuple[DataFrame, DataFrame | None]:
    """``__due`` and ``__next`` of the rows of numbered files and of a table before them.

    A full extract speaks for all keys, so each row is due in the next one.  A file that speaks
    for slices (``filter_cols``) ends what it lacks of these only: a row is due where its own slice
    is named next, which an equi-join with the slices of each file (``named``) tells.  A slice's files
    meet in one group of a window, one row each, and rows of a large slice are spread by ``members``.
    """
    if not filter_cols:
        numbered = numbered.withColumn(_DUE, F.col(_SEQ) + 1)
        return numbered, None if old is None else old.withColumns({_DUE: F.lit(0).cast("long"), _NEXT: first})
    slices = [column(c) for c in filter_cols]
    w = Window.partitionBy(*slices).orderBy(_SEQ)
    following = named.select(*slices, _SEQ, F.lead(_SEQ).over(w).alias(_DUE), F.lead("__named").over(w).alias(_NEXT))
    numbered = members(numbered.drop(_NEXT), following, [*filter_cols, _SEQ], "inner", few=few)
    if old is not None:
        earliest = named.groupBy(*slices).agg(F.min(_SEQ).alias(_DUE), F.min_by("__named", _SEQ).alias(_NEXT))
        old = members(old, earliest, filter_cols, "left_outer", few=few)
    return numbered, old


def _one_row_per_file(batch: DataFrame, bk: Sequence[str], on_duplicates: str, order_by) -> DataFrame:
    keys = [*bk, _SEQ]
    if on_duplicates == "error":
        return require_unique(batch, keys)
    if on_duplicates == "last":
        return keep_last(batch, keys, order_by)
    return batch


def scd1_fold(
    target: DataFrame | None,
    batch: DataFrame,
    bk: Sequence[str],
    files: DataFrame,
    file_col: str = ARCHIVE_FILE,
    *,
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
    chunk_files: int | None = CHUNK_FILES,
) -> DataFrame:
    """End state of merging the batch's files in order, in one pass.

    ``files`` has ``file_col`` and ``__seq`` once per file.  A key's row comes from
    the file that last *changed* it: the first row of its last run of equal hashes.  A column
    ``__SeenDatetimeUTC`` comes from the run's last row.
    """
    numbered = members(batch, files.select(column(file_col), column(_SEQ)), [file_col], "inner")
    numbered = _one_row_per_file(numbered, bk, on_duplicates, order_by)
    if target is None:
        return _last_runs(numbered, bk, chunk_files)
    known = [c for c in target.columns]
    target, rows = align_schemas(target, numbered.withColumn(_SEQ, column(_SEQ).cast("long")))
    have = rows.columns
    old = target.withColumn(_SEQ, F.lit(-1).cast("long")).select(*[column(c) for c in have])
    folded = _last_runs(rows.unionByName(old), bk, chunk_files)
    target = target.drop(_SEQ)
    if set(known) <= set(have):
        return folded.select(*[column(c) for c in target.columns])
    # Columns the batch lacks keep the target's value.
    return _rows(pair(target, folded, bk), target, folded, F.col("in_s"), {})


def scd1_fold_filtered(
    target: DataFrame | None,
    batch: DataFrame,
    bk: Sequence[str],
    files: DataFrame,
    update_filter: str,
    file_col: str = ARCHIVE_FILE,
    *,
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """End state of merging the batch's files in order where an update filter decides.

    Whether a row is taken depends on the row before it, so each key's versions in the batch
    are gathered in order, at most one a file, and folded from the table's row on.  The filter
    is SQL text over ``s.`` and ``t.`` columns, as for one merge.
    """
    numbered = members(batch, files.select(column(file_col), column(_SEQ)), [file_col], "inner")
    numbered = _one_row_per_file(numbered, bk, on_duplicates, order_by)
    like = numbered.drop(_SEQ).limit(0) if target is None else target
    target, rows = align_schemas(like, numbered.withColumn(_SEQ, column(_SEQ).cast("long")))
    have = [c for c in rows.columns if c != _SEQ]
    schema = target.drop(_SEQ).schema
    # Rows in the table's columns; what the batch lacks is NULL here and kept below.
    wide = F.struct(
        *[(column(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    versions = F.array_sort(F.collect_list(F.struct(column(_SEQ), wide.alias("s"))))
    source = rows.groupBy(*[column(k) for k in bk]).agg(versions.alias("__versions"))
    paired = pair(target.drop(_SEQ), source, bk)
    takes = f"coalesce(s.`{HASH}` <> t.`{HASH}` AND ({update_filter}), false)"
    kept = [f.name for f in schema.fields if f.name not in have]
    # When a key was seen last does not depend on what is taken.
    plain = [n for n in schema.fieldNames() if n != SEEN]
    merged = ", ".join(f"'{n}', {'t' if n in kept else 's'}.`{n}`" for n in plain)
    initial = F.when(F.col("in_t"), F.struct(*[column(n, "t") for n in plain]))
    types = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema.fields if f.name in plain)
    step = (
        "aggregate(transform(coalesce(s.__versions, array()), v -> v.s), __t, "
        f"(t, s) -> CASE WHEN t IS NULL OR {takes} THEN cast(named_struct({merged}) AS struct<{types}>) ELSE t END)"
    )
    folded = paired.withColumn("__t", initial.cast(f"struct<{types}>")).withColumn("__row", F.expr(step))
    out = [column(n, "__row").alias(n) for n in plain]
    if SEEN in schema.fieldNames():
        latest = F.try_element_at(F.col("s.__versions"), F.lit(-1)).getField("s").getField(SEEN)
        out.append(F.greatest(column(SEEN, "t"), latest).alias(SEEN))
    return folded.select(*out).select(*[column(n) for n in schema.fieldNames()])


def _last_runs(numbered: DataFrame, bk: Sequence[str], chunk_files: int | None) -> DataFrame:
    rows = numbered.withColumns({_NEXT: F.lit(None).cast("timestamp"), _DUE: F.lit(None).cast("long")})
    carried = [SEEN] if SEEN in numbered.columns else []
    last = _runs(rows, bk, chunk_files, last_only=True, carried=carried)
    return last.select(*[column(c) for c in numbered.columns if c != _SEQ])


def _numbered(
    batch: DataFrame,
    bk: Sequence[str],
    target: DataFrame | None,
    snapshot_col: str,
    snapshots: DataFrame | None,
    filter_cols: Sequence[str] | None,
    on_duplicates: str,
    order_by: Sequence[str] | None,
    present: Column,
    slices: DataFrame | None,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the batch and of the table before it, numbered and due.

    A table row that is not ``present`` belongs to no snapshot: it is due before the first file, so
    that a returning key starts a new run.  The list of ``snapshots`` has a row per extract, so the
    batch is not moved to number its rows.
    """
    times = (batch if snapshots is None else snapshots).select(column(snapshot_col)).distinct()
    order = number_in_order(times, snapshot_col)
    numbered = members(batch, order, [snapshot_col], "inner", few=snapshots is not None)
    old = None if target is None else target.withColumn(_SEQ, F.lit(-1).cast("long"))
    first = order.agg(F.min(column(snapshot_col)).alias("first")).scalar()
    named = None
    if filter_cols:
        # The slices of a file are those of all its rows, repeated keys included.
        known = numbered if slices is None else members(slices, order, [snapshot_col], "inner", few=True)
        named = known.select(*[column(c) for c in filter_cols], _SEQ, column(snapshot_col).alias("__named")).distinct()
    rows = _one_row_per_file(numbered, bk, on_duplicates, order_by)
    rows, old = _due(rows, named, old, first, filter_cols, slices is not None)
    if old is not None:
        old = old.withColumn(_DUE, F.when(present, F.col(_DUE)).otherwise(F.lit(-1)).cast("long"))
    return rows, old


def scd2_from_snapshots(
    batch: DataFrame,
    bk: Sequence[str],
    snapshot_col: str = ARCHIVED,
    *,
    target: DataFrame | None = None,
    snapshots: DataFrame | None = None,
    filter_cols: Sequence[str] | None = None,
    slices: DataFrame | None = None,
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
    chunk_files: int | None = CHUNK_FILES,
) -> DataFrame:
    """History of a table from all its extracts at once.

    A version is a run of consecutive snapshots that hold the key with one hash.
    With a ``target`` its current versions count as a snapshot before the first,
    and its closed history passes through.  ``snapshots`` lists the snapshot times
    where some extracts are empty; this list is broadcast.

    Extracts that speak for slices only (``filter_cols``, which the hash covers) leave other
    slices alone: for a row the snapshots that count are those that name its slice.  ``slices`` are
    the distinct slices and snapshot times of the batch where the caller knows that they are few.
    """
    rows, old = _numbered(
        batch, bk, target, snapshot_col, snapshots, filter_cols, on_duplicates, order_by, column(CURRENT), slices
    )
    rows = open_versions(rows, column(snapshot_col))
    closed = None
    if target is not None:
        closed = target.where(~column(CURRENT))
        old, rows = align_schemas(old.where(column(CURRENT)), rows)
        rows = conform(rows, old.schema).unionByName(old)
    runs = _runs(rows, bk, chunk_files, start_col=START)
    fields = [f for f in rows.schema.fields if f.name not in (_SEQ, _NEXT, _DUE)]
    end_type = rows.schema[END].dataType

    def value(name: str) -> Column:
        if name == END:
            return F.coalesce(F.col("__until"), open_end(end_type)).cast(end_type)
        if name == CURRENT:
            return F.col("__until").isNull()
        return column(name)

    history = runs.select(*[value(f.name).alias(f.name) for f in fields])
    return history if closed is None else conform(closed, history.schema).unionByName(history)


def fact_fold(
    target: DataFrame | None,
    batch: DataFrame,
    bk: Sequence[str],
    now,
    snapshot_col: str = ARCHIVED,
    *,
    snapshots: DataFrame | None = None,
    filter_cols: Sequence[str] | None = None,
    slices: DataFrame | None = None,
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
    chunk_files: int | None = CHUNK_FILES,
) -> DataFrame:
    """End state of applying extracts with soft delete one after another.

    The last run of a key is the row: its first file changed or revived the key.
    A run that stops before the last snapshot is a soft-deleted row.  With ``filter_cols``, which
    the hash covers, only snapshots that name the row's slice count (``slices`` as for
    ``scd2_from_snapshots``).  A column ``__AbsentDatetimeUTC`` takes the time of the snapshot that lacked a deleted row.
    """
    rows, old = _numbered(
        batch,
        bk,
        target,
        snapshot_col,
        snapshots,
        filter_cols,
        on_duplicates,
        order_by,
        column(DELETED).isNull(),
        slices,
    )
    deleted_type = rows.schema[MODIFIED].dataType
    if DELETED not in rows.columns:
        rows = rows.withColumn(DELETED, F.lit(None).cast(deleted_type))
    if target is not None:
        missing = sorted(set(target.columns) - set(rows.columns))
        if missing:
            raise ValueError(f"apply the files one by one: the batch lacks the table's columns {missing}")
        old, rows = align_schemas(old, rows)
        rows = conform(rows, old.schema).unionByName(old)
    last = _runs(rows, bk, chunk_files, last_only=True)
    now = instant(now, rows.schema[MODIFIED].dataType)
    gone = F.col("__until").isNotNull() & column(DELETED).isNull()
    out = []
    for field in rows.schema.fields:
        if field.name in (_SEQ, _NEXT, _DUE):
            continue
        value = column(field.name)
        if field.name == DELETED:
            value = F.when(gone, now.cast(field.dataType)).otherwise(value)
        elif field.name == MODIFIED:
            value = F.when(gone, now).otherwise(value)
        elif field.name == ABSENT:
            value = F.when(gone, F.col("__until").cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return last.select(*out)
