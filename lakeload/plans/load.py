"""Archive to lake tables: current image, full history, facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.identifiers import column, parse_columns
from lakeload.functions.scalars import instant, utc_clock
from lakeload.operators.fold import CHUNK_FILES, fact_fold, scd1_fold, scd1_fold_filtered, scd2_from_snapshots
from lakeload.operators.history import scd2_merge, scd2_rewind
from lakeload.operators.incremental import (
    EXPORT_START,
    initial_watermark,
    load_order,
    pending_files,
    process_log_rows,
    since,
    visible_files,
)
from lakeload.operators.matching import members
from lakeload.operators.merge import fact_merge, scd1_merge, touched_partitions
from lakeload.operators.projection import prepare_source
from lakeload.operators.splice import fact_splice, scd2_splice, unseen_since
from lakeload.schemas import (
    ABSENT,
    ARCHIVE_FILE,
    ARCHIVED,
    CURRENT,
    DELETED,
    END,
    MODIFIED,
    PROCESS_LOG,
    SEEN,
    STAGING_NAME,
)
from lakeload.session import shared_dir
from lakeload.sinks.logs import append_process_log
from lakeload.sinks.storage import Storage
from lakeload.sinks.tables import LakeTable, name_partitions, restrict_partitions
from lakeload.sources.archive import (
    LOAD_CSV,
    log_frame,
    read_archive_log,
    read_logged,
    read_process_log,
)
from lakeload.sources.tables import read_jdbc

END_DATE = "__EndDate"
_OPEN_DATE = dt.date(9999, 12, 31)
_FEW_PARTITIONS = 1000


@dataclass
class LoadSpec:
    """Parameters of a load; column lists are text (brackets allowed) or lists."""

    archive_log_path: str
    target_path: str
    target_log_path: str
    bk: str | Sequence[str]
    fmt: str = "parquet"
    extract: str | Sequence[str] = "*"
    exclude: str | Sequence[str] = ""
    partition_exprs: str | Sequence[str] = ""
    partition_by: str | Sequence[str] = ""
    delete_filter: str | Sequence[str] = ""
    include_previous: bool = False
    encoding: str | None = LOAD_CSV["encoding"]
    delimiter: str = LOAD_CSV["sep"]
    complex_as_string: bool = False
    update_filter: str | None = None
    hash_mode: str = "safe"
    hash_cols: Sequence[str] | None = None
    on_duplicates: str = "error"
    order_by: Sequence[str] | None = None
    null_safe: bool = True
    #: Where a first run starts: at a time, or at midnight some days ago; else it takes all files.
    initial: dt.datetime | None = None
    initial_days: int | None = None
    pending_by: str = "absence"
    partition_stable: bool = False
    string_delete_time: bool = False
    table_name: str | None = None
    max_files: int = 10_000
    chunk_files: int | None = CHUNK_FILES
    keep_versions: int = 2

    def __post_init__(self) -> None:
        self.bk = parse_columns(self.bk)
        self.partition_by = parse_columns(self.partition_by)
        self.delete_filter = parse_columns(self.delete_filter)
        if self.fmt == "csv":
            # CSV columns lose their spaces, so names of result columns do too.
            for name in ("bk", "partition_by", "delete_filter"):
                setattr(self, name, [c.replace(" ", "_") for c in getattr(self, name)])

    @property
    def folds(self) -> bool:
        """Whether a batch of files is applied in one pass."""
        return self.update_filter is None and self.null_safe

    @property
    def splices(self) -> bool:
        """Whether a late file can be put in its place without later ones."""
        return self.folds and not self.delete_filter

    @property
    def log_path(self) -> str:
        return f"{self.target_log_path.rstrip('/')}/processDatetime"


@dataclass
class LoadResult:
    """``files`` were loaded, ``again`` read once more behind late ones; ``before_start`` files
    are older than the start of a first run and never loaded."""

    files: int = 0
    again: int = 0
    before_start: int = 0


def _start_log(spark: SparkSession, spec: LoadSpec, now: dt.datetime) -> int:
    """First run: remember the initial watermark as a row of its own; how many files are older."""
    if read_process_log(spark, spec.log_path) is not None:
        return 0
    if spec.initial_days is not None:
        start = initial_watermark(instant(now), spec.initial_days)
    else:
        start = instant(spec.initial or EXPORT_START)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in PROCESS_LOG.fields]
    row = spark.range(1).select(*empty).withColumn("ArchiveDatetimeUTC", start)
    append_process_log(row, spec.log_path)
    archive_log = read_archive_log(spark, spec.archive_log_path)
    if archive_log is None or (spec.initial is None and spec.initial_days is None):
        return 0
    return visible_files(archive_log).where(F.col("ArchiveDatetimeUTC") <= start).count()


def pending_batches(
    spark: SparkSession, spec: LoadSpec, now: dt.datetime, skip: set[str] | None = None
) -> Iterator[list[Row]]:
    """Log rows of the files to load, in load order, at most about ``max_files`` at a time.

    Files of one archive time stay in one batch, so that the watermark left by a
    batch never hides the next.  The caller may add paths to ``skip`` while iterating.
    """
    _start_log(spark, spec, now)
    inclusive = spec.include_previous
    while True:
        archive_log = read_archive_log(spark, spec.archive_log_path)
        if archive_log is None:
            return
        process_log = read_process_log(spark, spec.log_path)
        initial = None
        if spec.pending_by != "watermark":
            first = process_log.agg(F.min("ArchiveDatetimeUTC").alias("first"))
            initial = first.scalar()
        pending = pending_files(archive_log, process_log, inclusive, initial, spec.pending_by)
        if skip:
            skipped = spark.createDataFrame([(p,) for p in sorted(skip)], "ArchiveFilePath string")
            pending = members(pending, skipped, ["ArchiveFilePath"], "left_anti", salts=1)
        batch = load_order(pending).limit(spec.max_files).collect()
        if not batch:
            return
        if len(batch) == spec.max_files:
            last = batch[-1]["ArchiveDatetimeUTC"]
            batch = load_order(pending.where(F.col("ArchiveDatetimeUTC") <= F.lit(last))).collect()
        yield batch
        inclusive = False


@contextmanager
def _source(
    spark: SparkSession, spec: LoadSpec, files: list[Row], now: dt.datetime
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Prepared rows of the files with lineage, and the file list with its order.

    A load reads its source several times (uniqueness, touched partitions, merge).
    Parsed text, and whatever goes into a partitioned table, is therefore written
    once to the shared folder and read back with pruned columns.
    """
    carried = {
        "ArchiveDatetimeUTC": ARCHIVED,
        "ArchiveFilePath": ARCHIVE_FILE,
        "OriginalStagingFileName": STAGING_NAME,
    }
    traced = read_logged(spark, files, carried, spec.fmt, spec.encoding, spec.delimiter)
    rows = prepare_source(
        traced,
        spec.extract,
        spec.exclude,
        spec.partition_exprs,
        not_null_keys=spec.bk if spec.fmt == "csv" else None,
        rename_spaces=spec.fmt == "csv",
        complex_mode="cast" if spec.fmt == "json" and spec.complex_as_string else None,
        hash_mode=spec.hash_mode,
        hash_cols=spec.hash_cols,
        carry=list(carried.values()),
    )
    numbers = [(f["ArchiveFilePath"], f["ArchiveDatetimeUTC"], i) for i, f in enumerate(files)]
    order = spark.createDataFrame(numbers, f"{ARCHIVE_FILE} string, {ARCHIVED} timestamp, __seq long")
    rows = rows.withColumn(MODIFIED, instant(now))
    if spec.fmt == "parquet" and not spec.partition_by:
        yield rows, order
        return
    folder = shared_dir(spark, "source")
    try:
        rows.write.mode("overwrite").parquet(f"{folder}/rows")
        yield spark.read.schema(rows.schema).parquet(f"{folder}/rows"), order
    finally:
        Storage(spark, folder).remove(folder)


def _commit(spark: SparkSession, spec: LoadSpec, files: list[Row], now: dt.datetime) -> None:
    append_process_log(process_log_rows(log_frame(spark, files), now), spec.log_path)


def _options(spec: LoadSpec) -> dict:
    return {"on_duplicates": spec.on_duplicates, "order_by": spec.order_by}


def _merge_options(spec: LoadSpec) -> dict:
    return {**_options(spec), "null_safe": spec.null_safe, "update_filter": spec.update_filter}


def _finish(table: LakeTable, spec: LoadSpec) -> None:
    if spec.table_name and table.exists():
        table.register(spec.table_name)
    table.expire(spec.keep_versions)


def _touched(target: DataFrame, rows: DataFrame, spec: LoadSpec) -> DataFrame:
    """Partitions to rewrite: those of the rows, of keys that moved, and of the deletion slices."""
    if spec.partition_stable:
        touched = rows.select(*[column(c) for c in spec.partition_by]).distinct()
    else:
        touched = touched_partitions(target, rows, spec.bk, spec.partition_by, spec.null_safe)
    if spec.delete_filter:
        slices = rows.select(*[column(c) for c in spec.delete_filter]).distinct()
        needed = target.select(*[column(c) for c in dict.fromkeys([*spec.partition_by, *spec.delete_filter])])
        # A slice column that is a partition column leaves other partitions unread.
        needed = name_partitions(needed, slices, spec.delete_filter)
        inside = members(needed, slices, spec.delete_filter).select(*[column(c) for c in spec.partition_by])
        touched = touched.unionByName(inside).distinct()
    return touched


def _stamp(file: Row) -> str:
    return file["ArchiveDatetimeUTC"].astimezone(dt.timezone.utc).isoformat(timespec="microseconds")


def _order(file: Row) -> tuple:
    """The load order, for files from two lists."""
    modified = file["OriginalModificationTime"]
    return file["ArchiveDatetimeUTC"], modified is not None, modified or dt.datetime.min, file["ArchiveFilePath"]


@dataclass
class _Step:
    """Files to apply together: ``files`` in load order, ``mark`` for the table's notes.

    ``spliced``: late files to put in their place.  ``again_from``: the first of several steps that
    read later files once more; what the table holds from that time on is decided anew.
    """

    files: list[Row]
    mark: dict
    spliced: bool = False
    again_from: dt.datetime | None = None


class LateFileError(RuntimeError):
    """A late file belongs before files that are gone, and the table cannot take it without them."""


def _processed_since(spark: SparkSession, spec: LoadSpec, first: dt.datetime) -> DataFrame:
    """Archive-log rows of processed files from a stamp on, purged ones included."""
    process_log = read_process_log(spark, spec.log_path)
    done = process_log.where(F.col("ArchiveFilePath").isNotNull()).select("ArchiveFilePath").distinct()
    later = since(read_archive_log(spark, spec.archive_log_path), F.lit(first), True)
    return members(later, done, ["ArchiveFilePath"], salts=1)


def _pages(files: DataFrame, size: int) -> Iterator[list[Row]]:
    """Log rows in load order, about ``size`` at a time; one stamp is never divided."""
    rest = files
    while True:
        page = load_order(rest).limit(size).collect()
        if not page:
            return
        last = F.lit(page[-1]["ArchiveDatetimeUTC"])
        if len(page) == size:
            page = load_order(rest.where(F.col("ArchiveDatetimeUTC") <= last)).collect()
        yield page
        if len(page) < size:
            return
        rest = rest.where(F.col("ArchiveDatetimeUTC") > last)


def _plan(
    spark: SparkSession, spec: LoadSpec, table: LakeTable, files: list[Row], exact: bool
) -> Iterator[tuple[_Step, int]]:
    """Steps that apply one batch of pending files, each with the number of files read again.

    A file stamped no later than the table's last one belongs between files that were applied
    already.  Where each file speaks for all keys (``spec.splices``) it is put in its place without
    them.  Otherwise all files from its stamp on are applied again, page by page; one that is gone
    stops the load before anything is written.  A current image (``exact`` off) is read again as
    long as all later files are there, since only they tell every row's lineage.  Files that are in
    the table but were not logged, after a crash, are passed over.
    """
    known = set() if spec.include_previous else table.paths()
    todo = [f for f in files if f["ArchiveFilePath"] not in known]
    applied = table.applied()
    late = [f for f in todo if applied is not None and _stamp(f) <= applied]
    if not late:
        if todo:
            yield _Step(todo, _mark(table, files)), 0
        return
    first = late[0]["ArchiveDatetimeUTC"]
    processed = _processed_since(spark, spec, first)
    gone = processed.where(F.col("IsPurged") | F.col("IsIgnorable"))
    if spec.splices and not spec.include_previous and (exact or not gone.isEmpty()):
        taken = known | {f["ArchiveFilePath"] for f in late}
        yield _Step(late, _mark(table, [f for f in files if f["ArchiveFilePath"] in taken]), spliced=True), 0
        fresh = [f for f in todo if f["ArchiveFilePath"] not in taken]
        if fresh:
            yield _Step(fresh, _mark(table, files)), 0
        return
    lost = gone.select("ArchiveFilePath").first()
    if lost is not None:
        raise LateFileError(f"{late[0]['ArchiveFilePath']} belongs before {lost[0]}, which is gone")
    new = {f["ArchiveFilePath"] for f in todo}
    unlogged = [f for f in files if f["ArchiveFilePath"] in known and _order(f) >= _order(todo[0])]
    pending = log_frame(spark, [*todo, *unlogged])
    again = members(processed, pending.select("ArchiveFilePath"), ["ArchiveFilePath"], "left_anti", salts=1)
    pages = _pages(again.select(*pending.columns).unionByName(pending), spec.max_files)
    page, start = next(pages), first
    while page is not None:
        following = next(pages, None)
        mark = _mark(table, page) if following is None else _mark(table, page, False)
        if following is None:
            mark["paths"] = [f["ArchiveFilePath"] for f in files]
        yield _Step(page, mark, again_from=start), sum(f["ArchiveFilePath"] not in new for f in page)
        page, start = following, None


def _load(
    spark: SparkSession, spec: LoadSpec, now: dt.datetime | None, table: LakeTable, apply, exact: bool = True
) -> LoadResult:
    """Batch after batch: apply what is pending, and what belongs after it, then log it."""
    now = now or dt.datetime.now(dt.timezone.utc)
    result = LoadResult(before_start=_start_log(spark, spec, now))
    for files in pending_batches(spark, spec, now):
        for step, again in _plan(spark, spec, table, files, exact):
            apply(step, now)
            result.files += len(step.files) - again
            result.again += again
        _commit(spark, spec, files, now)
    _finish(table, spec)
    return result


def _mark(table: LakeTable, files: list[Row], last: bool = True) -> dict:
    """What the table remembers: the last stamp in it, and the files of a finished batch."""
    stamp = max(filter(None, [table.applied(), *map(_stamp, files)]))
    return {"applied": stamp, "paths": [f["ArchiveFilePath"] for f in files] if last else []}


def _singly(step: _Step, table: LakeTable) -> Iterator[tuple[list[Row], dict]]:
    """The files of a step one by one, each with what the table remembers then."""
    for i, file in enumerate(step.files, 1):
        yield [file], step.mark if i == len(step.files) else _mark(table, [file], False)


def _applied_stamps(spark: SparkSession, spec: LoadSpec, step: _Step, table: LakeTable) -> tuple[DataFrame, DataFrame]:
    """Stamp, path and staging name of the files in the table from the step's first stamp on, and of
    the step's files.  The process log knows them, also those purged since."""
    names = {"ArchiveDatetimeUTC": ARCHIVED, "ArchiveFilePath": ARCHIVE_FILE, "OriginalStagingFileName": STAGING_NAME}
    columns = [F.col(k).alias(v) for k, v in names.items()]
    own = log_frame(spark, step.files).select(*columns)
    log = read_process_log(spark, spec.log_path).where(F.col("ArchiveFilePath").isNotNull())
    done = log.where(F.col("ArchiveDatetimeUTC") >= F.lit(step.files[0]["ArchiveDatetimeUTC"])).select(*columns)
    unlogged = sorted(table.paths() - {f["ArchiveFilePath"] for f in step.files})
    if unlogged:
        paths = spark.createDataFrame([(p,) for p in unlogged], "ArchiveFilePath string")
        archive_log = read_archive_log(spark, spec.archive_log_path)
        done = done.unionByName(members(archive_log, paths, ["ArchiveFilePath"], salts=1).select(*columns))
    return done.distinct(), own


def load_scd1(spark: SparkSession, spec: LoadSpec, now: dt.datetime | None = None) -> LoadResult:
    """Bring a current-image table up to date with all pending files.

    A batch of files is folded in one pass, with an update filter too.  Under plain key equality
    files are merged one after another.  Behind a file that turns up late, rows of later files are
    taken from those files again; where one of these is gone, the late file only decides keys that
    no later file held (``__SeenDatetimeUTC``), and the lineage of others stays as it is.
    """
    table = LakeTable(spark, spec.target_path, spec.partition_by)

    def apply(step: _Step, now) -> None:
        if spec.null_safe:
            with _source(spark, spec, step.files, now) as (rows, order):
                _scd1_apply(spark, spec, table, step, rows.withColumn(SEEN, F.col(ARCHIVED)), order)
            return
        for files, mark in _singly(step, table):
            with _source(spark, spec, files, now) as (rows, order):
                merged = _Step(files, mark)
                _scd1_apply(spark, spec, table, merged, rows.withColumn(SEEN, F.col(ARCHIVED)), order)

    return _load(spark, spec, now, table, apply, exact=False)


def _scd1_apply(spark, spec, table, step, rows, order) -> None:
    target = table.read()
    if step.spliced:
        if SEEN not in target.columns:
            target = target.withColumn(SEEN, F.lit(None).cast("timestamp"))
        rows = unseen_since(target, rows, spec.bk)

    def state(part: DataFrame | None) -> DataFrame:
        if not spec.null_safe:
            return scd1_merge(part, rows, spec.bk, **_merge_options(spec))
        if part is not None and step.again_from is not None and spec.update_filter is None:
            # What stems from files that are read again is decided anew.
            part = part.where(F.col(ARCHIVED) < F.lit(step.again_from))
        if spec.update_filter is not None:
            return scd1_fold_filtered(part, rows, spec.bk, order, spec.update_filter, **_options(spec))
        return scd1_fold(part, rows, spec.bk, order, chunk_files=_chunk(spec, step.files), **_options(spec))

    if target is None or not spec.partition_by:
        table.write(state(target), **step.mark)
    else:
        touched = _touched(target, rows, spec)
        table.replace(lambda parts: state(restrict_partitions(target, parts, spec.partition_by)), touched, **step.mark)


def _chunk(spec: LoadSpec, files: list[Row]) -> int | None:
    """A batch that fits one chunk needs no second level."""
    return spec.chunk_files if spec.chunk_files and len(files) > spec.chunk_files else None


def load_scd2(spark: SparkSession, spec: LoadSpec, now: dt.datetime | None = None) -> LoadResult:
    """Bring a full-history table up to date with all pending files.

    Extracts are folded in one pass, also those that speak for slices only (``delete_filter``); with an
    update filter or plain key equality they are merged in order.  The table is partitioned by the
    date a version ended, so a load reads and rewrites the current versions and the dates it closes
    versions on, and leaves older history alone.  With ``partition_by`` and files that speak for slices,
    of these only the partitions that the files can touch.  A full extract that turns up late is put
    in its place; else the history is taken back to its time, and later files are applied again.
    """
    table = LakeTable(spark, spec.target_path, [END_DATE, *spec.partition_by])

    def apply(step: _Step, now) -> None:
        if spec.folds:
            with _source(spark, spec, step.files, now) as (rows, order):
                _scd2_apply(spark, spec, table, step, rows, order, now)
            return
        start = step.again_from
        for files, mark in _singly(step, table):
            with _source(spark, spec, files, now) as (rows, order):
                _scd2_apply(spark, spec, table, _Step(files, mark, again_from=start), rows, order, now)
            start = None

    return _load(spark, spec, now, table, apply)


def _scd2_apply(spark, spec, table, step, rows, order, now) -> None:
    target = table.read()
    back = step.files[0]["ArchiveDatetimeUTC"] if step.spliced else step.again_from
    dates = {_OPEN_DATE, *(f["ArchiveDatetimeUTC"].astimezone(dt.timezone.utc).date() for f in step.files)}
    part, touched = None, spark.createDataFrame([(d,) for d in sorted(dates)], f"{END_DATE} date")
    if target is not None:
        chosen = F.col(END_DATE).isin(sorted(dates))
        if back is not None:
            since_day = utc_clock(F.lit(back)).cast("date")
            chosen = chosen | (F.col(END_DATE) >= since_day)
            later = target.where(F.col(END_DATE) >= since_day).select(END_DATE)
            touched = touched.union(later).distinct()
        part = target.where(chosen)
        if spec.partition_by and spec.delete_filter and back is None:
            part, touched = _scd2_partitions(spec, part, rows, sorted(dates))
        part = part.drop(END_DATE)
        if step.again_from is not None:
            part = scd2_rewind(part, F.lit(step.again_from))
    if step.spliced:
        applied, late = _applied_stamps(spark, spec, step, table)
        state = scd2_splice(part, rows, spec.bk, applied, late, now, **_options(spec))
    elif spec.folds:
        state = scd2_from_snapshots(
            rows,
            spec.bk,
            target=part,
            snapshots=order,
            filter_cols=spec.delete_filter or None,
            slices=_few_slices(spec, rows),
            chunk_files=_chunk(spec, step.files),
            **_options(spec),
        )
    else:
        state = scd2_merge(
            part,
            rows,
            spec.bk,
            F.lit(step.files[0]["ArchiveDatetimeUTC"]),
            delete="filtered" if spec.delete_filter else "full",
            filter_cols=spec.delete_filter or None,
            **_merge_options(spec),
        )
    ended_on = utc_clock(column(END)).cast("date")
    state = state.withColumn(END_DATE, F.when(column(CURRENT), F.lit(_OPEN_DATE)).otherwise(ended_on))
    if target is None:
        table.write(state, **step.mark)
    else:
        table.replace(lambda _: state, touched, **step.mark)


def _few_slices(spec: LoadSpec, rows: DataFrame) -> DataFrame | None:
    """The slices each file names, as a short list; None where they are many or not asked for."""
    if not spec.delete_filter:
        return None
    named = rows.select(*[column(c) for c in spec.delete_filter], column(ARCHIVED)).distinct()
    few = named.limit(_FEW_PARTITIONS + 1).collect()
    return rows.sparkSession.createDataFrame(few, named.schema) if len(few) <= _FEW_PARTITIONS else None


def _scd2_partitions(
    spec: LoadSpec, part: DataFrame, rows: DataFrame, dates: list[dt.date]
) -> tuple[DataFrame, DataFrame]:
    """Of the dates to rewrite the partitions that files speaking for slices can touch.

    These are the partitions of the rows, of the versions in their slices, and of keys that live
    elsewhere (not searched for with ``partition_stable``); their values are named in the scan.
    """
    current = part.where(column(CURRENT))
    named = _touched(current, rows, spec)
    few = named.limit(_FEW_PARTITIONS + 1).collect()
    if len(few) <= _FEW_PARTITIONS:
        # As plain values they cost no second search.
        named = part.sparkSession.createDataFrame(few, named.schema)
    narrowed = restrict_partitions(part, named, spec.partition_by)
    both = named.withColumn(END_DATE, F.explode(F.array(*[F.lit(d) for d in dates])))
    return narrowed, both.select(END_DATE, *[column(c) for c in spec.partition_by])


def load_fact(spark: SparkSession, spec: LoadSpec, now: dt.datetime | None = None) -> LoadResult:
    """Bring a fact table with soft deletes up to date with all pending files.

    Extracts are folded in one pass while the files bring every table column, also those that speak for
    slices only, which rewrite just the partitions they touch.  A full extract that turns up late
    is put in its place; behind one that speaks for slices, later files are applied again.
    """
    table = LakeTable(spark, spec.target_path, spec.partition_by)

    def apply(step: _Step, now) -> None:
        _fact_steps(spark, spec, table, step, now)

    return _load(spark, spec, now, table, apply)


def _fact_steps(spark, spec, table, step, now) -> None:
    if spec.folds:
        with _source(spark, spec, step.files, now) as (rows, order):
            rows, target = _with_delete_time(rows, spec), table.read()
            if target is not None and ABSENT not in target.columns:
                target = target.withColumn(ABSENT, F.lit(None).cast("timestamp"))
            if step.spliced:
                applied, late = _applied_stamps(spark, spec, step, table)
                table.write(fact_splice(target, rows, spec.bk, applied, late, now, **_options(spec)), **step.mark)
                return
            if target is None or set(target.columns) <= set(rows.columns):
                fold = {
                    "snapshots": order,
                    "filter_cols": spec.delete_filter or None,
                    "slices": _few_slices(spec, rows),
                    "chunk_files": _chunk(spec, step.files),
                    **_options(spec),
                }
                _fact_write(spec, table, target, rows, step.mark, lambda part: fact_fold(part, rows, spec.bk, now, **fold))
                return
    for files, mark in _singly(step, table):
        with _source(spark, spec, files, now) as (rows, _):
            rows = _with_delete_time(rows, spec)
            merge = {
                "delete": "filtered" if spec.delete_filter else "full",
                "filter_cols": spec.delete_filter or None,
                "absent_at": F.lit(files[0]["ArchiveDatetimeUTC"]),
                **_merge_options(spec),
            }
            _fact_write(spec, table, table.read(), rows, mark, lambda part: fact_merge(part, rows, spec.bk, now, **merge))


def _fact_write(spec, table, target, rows, mark, state) -> None:
    if target is None or not spec.partition_by or not spec.delete_filter:
        table.write(state(target), **mark)
        return
    table.replace(
        lambda parts: state(restrict_partitions(target, parts, spec.partition_by)), _touched(target, rows, spec), **mark
    )


def _with_delete_time(rows: DataFrame, spec: LoadSpec) -> DataFrame:
    """The empty delete time: a timestamp, or text for tables that keep it as text."""
    kind = "string" if spec.string_delete_time else "timestamp"
    return rows.withColumns({DELETED: F.lit(None).cast(kind), ABSENT: F.lit(None).cast("timestamp")})


def load_scd1_jdbc(
    spark: SparkSession,
    url: str,
    source_sql: str,
    target_path: str,
    bk: str | Sequence[str],
    *,
    extract: str | Sequence[str] = "*",
    exclude: str | Sequence[str] = "",
    null_safe: bool = False,
    hash_mode: str = "safe",
    table_name: str | None = None,
    now: dt.datetime | None = None,
    keep_versions: int = 2,
    **jdbc,
) -> str:
    """Current image of a database query; keys match by plain equality unless ``null_safe``."""
    return load_scd1_frame(
        read_jdbc(spark, url, source_sql, extract, **jdbc),
        target_path,
        bk,
        exclude=exclude,
        null_safe=null_safe,
        hash_mode=hash_mode,
        table_name=table_name,
        now=now,
        keep_versions=keep_versions,
    )


def load_scd1_frame(
    df: DataFrame,
    target_path: str,
    bk: str | Sequence[str],
    *,
    exclude: str | Sequence[str] = "",
    null_safe: bool = False,
    hash_mode: str = "safe",
    table_name: str | None = None,
    now: dt.datetime | None = None,
    keep_versions: int = 2,
) -> str:
    """Merge any frame, such as a query result, into a current-image table."""
    now = now or dt.datetime.now(dt.timezone.utc)
    table = LakeTable(df.sparkSession, target_path)
    rows = prepare_source(df, excluded=exclude, hash_mode=hash_mode).withColumn(MODIFIED, instant(now))
    folder = table.write(scd1_merge(table.read(), rows, parse_columns(bk), null_safe=null_safe))
    if table_name:
        table.register(table_name)
    table.expire(keep_versions)
    return folder
