import datetime as dt
import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeload.functions import archive_calendar, file_name
from lakeload.plans import (
    LoadSpec,
    archive_job,
    export_query,
    export_table,
    load_fact,
    load_scd1,
    load_scd1_jdbc,
    load_scd2,
    publish_as_is,
    publish_select,
    purge_job,
    stage_to_jdbc,
    stage_to_warehouse,
)
from lakeload.plans import load as load_module
from lakeload.plans import publish as publish_module
from lakeload.plans.load import END_DATE
from lakeload.schemas import ARCHIVE_LOG, DELETED
from lakeload.sinks import jdbc, tables
from lakeload.sinks.logs import append_archive_log, repair_archive_log
from lakeload.sinks.tables import LakeTable
from lakeload.sources import (
    archive_tables,
    attach_lineage,
    jdbc_options,
    read_archive,
    read_archive_log,
    read_archive_tables,
    read_process_log,
    read_query,
    read_table,
)
from tests.conftest import day, rows

EPOCH = dt.datetime(1990, 1, 1)


class Archive:
    """Archive folder with its log, filled file by file."""

    def __init__(self, spark, root):
        self.spark, self.root, self.log = spark, root, f"{root}/archive/log"

    def add(self, n, name, write):
        path = f"{self.root}/archive/data/{name}"
        write(path)
        ts = F.lit(day(n))
        row = self.spark.range(1).select(
            ts.alias("ArchiveDatetimeUTC"),
            *[v.alias(k) for k, v in archive_calendar(ts).items()],
            F.lit(f"in/{name}").alias("OriginalStagingFilePath"),
            F.lit(name).alias("OriginalStagingFileName"),
            F.lit(100).cast("long").alias("OriginalStagingFileSize"),
            ts.alias("OriginalModificationTime"),
            F.lit(path).alias("ArchiveFilePath"),
            file_name(F.lit(path)).alias("ArchiveFileName"),
            F.lit(False).alias("IsPurged"),
            F.lit(None).cast("timestamp").alias("PurgeDatetimeUTC"),
            F.lit(False).alias("IsIgnorable"),
            F.lit(None).cast("string").alias("Notes"),
        )
        append_archive_log(row, self.log)
        return path

    def parquet(self, n, data, schema="k int, a string, d string"):
        table = self.spark.createDataFrame(data, schema).toArrow()

        def write(path):
            Path(path).parent.mkdir(parents=True, exist_ok=True)
            pq.write_table(table, path)

        return self.add(n, f"{n}.parquet", write)

    def text(self, n, suffix, content: bytes):
        def write(path):
            Path(path).parent.mkdir(parents=True, exist_ok=True)
            Path(path).write_bytes(content)

        return self.add(n, f"{n}.{suffix}", write)

    def spec(self, **options):
        defaults = {"target_log_path": f"{self.root}/tablelog", "bk": "k", "initial": EPOCH}
        return LoadSpec(self.log, f"{self.root}/table", **{**defaults, **options})


@pytest.fixture
def archive(spark, lake):
    return Archive(spark, lake)


def landing(lake, **files):
    folder = Path(lake) / "ingest"
    folder.mkdir(exist_ok=True)
    for name, content in files.items():
        (folder / name.replace("__", ".")).write_bytes(content)
    return folder


def test_archive_takes_complete_files_only(spark, lake):
    folder = landing(lake, a__csv=b"one", b__csv__partial=b"half", empty__csv=b"", plain=b"three")
    (folder / "sub").mkdir()
    (folder / "sub" / "deep.csv").write_bytes(b"deep")
    now = dt.datetime(2030, 12, 31, 23, 5, tzinfo=dt.timezone.utc)
    assert archive_job(spark, str(folder), f"{lake}/archive", now=now, table_name="logs.archive_test") == 2
    assert sorted(os.listdir(folder)) == ["b.csv.partial", "empty.csv", "sub"]
    log = read_archive_log(spark, f"{lake}/archive/log")
    assert log.columns == [f for f in ARCHIVE_LOG.fieldNames() if f != "ArchiveyyyyMMddUTC"] + ["ArchiveyyyyMMddUTC"]
    for row in log.collect():
        path = row["ArchiveFilePath"]
        assert "/archive/2030/12/31/23_05_" in path
        assert len(Path(path).read_bytes()) == row["OriginalStagingFileSize"]
        assert os.path.splitext(path)[1] == os.path.splitext(row["OriginalStagingFileName"])[1]
    assert spark.table("logs.archive_test").count() == 2
    assert archive_tables(spark, "logs") == ["archive_test"]
    assert archive_tables(spark, "logs", exclude=["archive_t"]) == []
    assert read_archive_tables(spark, "logs", ["archive_test"]).columns[-1] == "ArchiveTable"
    # Nothing new: nothing happens.
    assert archive_job(spark, str(folder), f"{lake}/archive", now=now) == 0


def test_archive_after_a_crash_between_log_and_removal(spark, lake, monkeypatch):
    folder = landing(lake, a__csv=b"one")
    from lakeload.plans import archive as module

    real = module.delete_files
    monkeypatch.setattr(module, "delete_files", lambda df: df.limit(0).withColumn("problem", F.lit(None).cast("string")))
    archive_job(spark, str(folder), f"{lake}/archive")
    monkeypatch.setattr(module, "delete_files", real)
    (folder / "b.csv").write_bytes(b"two")
    archive_job(spark, str(folder), f"{lake}/archive")
    names = read_archive_log(spark, f"{lake}/archive/log").select("OriginalStagingFileName")
    assert rows(names) == [("a.csv",), ("b.csv",)]
    assert not [n for n in os.listdir(folder) if not n.startswith(".")]


def test_csv_load(spark, archive):
    archive.text(0, "csv", "my key,na me,secret\n1,Zoë,s\n,nobody,s\n2,Al,s\n".encode("latin-1"))
    archive.text(1, "csv", "secret,na me,my key\nx,Zoe,1\nx,Al,2\n".encode("latin-1"))
    spec = archive.spec(fmt="csv", bk="[my key]", exclude="[secret]")
    assert load_scd1(spark, spec).files == 2
    got = LakeTable(spark, spec.target_path).read()
    assert rows(got, "my_key", "na_me", "__OriginalStagingFileName") == [("1", "Zoe", "1.csv"), ("2", "Al", "0.csv")]
    assert "secret" not in got.columns


def test_json_load_with_complex_columns(spark, archive):
    archive.text(0, "json", b'{"k":1,"s":{"x":1,"y":"b"},"l":[1,2]}\n{"k":2}\n')
    spec = archive.spec(fmt="json", complex_as_string=True)
    load_scd1(spark, spec)
    assert rows(LakeTable(spark, spec.target_path).read(), "k", "s", "l") == [(1, "{1, b}", "[1, 2]"), (2, None, None)]
    archive.text(1, "json", b'{"k":2,"s":{"x":5,"y":"c"},"l":[]}\n')
    spec = archive.spec(fmt="json", complex_as_string=True, update_filter="t.s is not null")
    load_scd1(spark, spec)
    assert rows(LakeTable(spark, spec.target_path).read(), "k", "s") == [(1, "{1, b}"), (2, None)]


def test_scd1_load_again_and_a_late_file(spark, archive):
    archive.parquet(0, [(1, "a", "x"), (2, "b", "x")])
    archive.parquet(5, [(1, "newest", "x")])
    spec = archive.spec(pending_by="absence", table_name="lake.customer")
    assert load_scd1(spark, spec).files == 2
    assert load_scd1(spark, spec).files == 0
    archive.parquet(3, [(1, "late", "x"), (2, "late", "x"), (3, "late", "x")])
    assert load_scd1(spark, spec).files == 1
    want = [(1, "newest"), (2, "late"), (3, "late")]
    assert rows(LakeTable(spark, spec.target_path).read(), "k", "a") == want
    assert rows(read_table(spark, "lake.customer", "k, a")) == want
    assert rows(read_query(spark, "select * from lake.customer where k > 2", "[k]")) == [(3,)]


def test_scd1_load_of_drifting_types(spark, archive):
    archive.parquet(0, [(1, "a", "x")])
    archive.parquet(1, [(2**40, "b", 5)], "k long, a string, extra int")
    spec = archive.spec()
    load_scd1(spark, spec)
    assert rows(LakeTable(spark, spec.target_path).read(), "k", "a", "d", "extra") == [
        (1, "a", "x", None), (2**40, "b", None, 5),
    ]


def test_paths_with_blanks_and_signs(spark, lake):
    archive = Archive(spark, f"{lake}/my lake+é%")
    archive.parquet(0, [(1, "a", "x")])
    archive.parquet(1, [(2, "b", "x")])
    spec = archive.spec()
    load_scd1(spark, spec)
    got = LakeTable(spark, spec.target_path).read()
    assert rows(got, "k", "__ArchiveFilePath") == [(n + 1, f"{lake}/my lake+é%/archive/data/{n}.parquet") for n in (0, 1)]


def test_a_row_without_log_row_fails(spark, archive):
    a, b = archive.parquet(0, [(1, "a", "x")]), archive.parquet(1, [(2, "b", "x")])
    rows_of_files = read_archive(spark, [a, b], with_file=True)
    listed = read_archive_log(spark, archive.log).where(F.col("ArchiveFilePath") == a)
    with pytest.raises(Exception, match="no archive log row"):
        attach_lineage(rows_of_files, listed, {"OriginalStagingFileName": "n"}).collect()


def test_first_run_takes_all_files_by_default(spark, archive):
    archive.parquet(0, [(1, "a", "x")])
    assert load_scd1(spark, archive.spec(initial=None)).files == 1


FILES = {
    0: [(1, "a", "x"), (2, "b", "x"), (4, "d", "y")],
    1: [(1, "b", "x"), (3, "c", "x"), (4, "d", "y")],
    2: [(1, "a", "x"), (2, "b", "x"), (4, "e", "y")],
    3: [(1, "a", "x"), (2, "b2", "x"), (3, "c", "x")],
}
SHOWN = {
    load_scd1: ["k", "a", "d", "__ArchiveDatetimeUTC"],
    load_scd2: ["k", "a", "d", "__StartDatetimeUTC", "__EndDatetimeUTC", "__Current"],
    load_fact: ["k", "a", "d", f"{DELETED} IS NULL"],
}


@pytest.mark.parametrize("load", [load_scd1, load_scd2, load_fact])
@pytest.mark.parametrize("delete_filter", ["", "d"])
def test_the_order_of_arrival_makes_no_difference(spark, lake, load, delete_filter):
    def state(folder, steps):
        files = Archive(spark, f"{lake}/{folder}")
        spec = files.spec(delete_filter=delete_filter)
        for step in steps:
            for n in step:
                files.parquet(n, FILES[n], "k int, a string, d string")
            load(spark, spec)
        log = read_process_log(spark, spec.log_path).where("ArchiveFilePath IS NOT NULL")
        assert log.count() == log.select("ArchiveFilePath").distinct().count() == len(FILES)
        table = LakeTable(spark, spec.target_path, [END_DATE] if load is load_scd2 else [])
        return sorted(map(repr, table.read().selectExpr(*SHOWN[load]).collect()))

    assert state("late", [[3], [0], [2, 1]]) == state("timely", [[0, 1, 2, 3]])


@pytest.mark.parametrize("load", [load_scd1, load_scd2, load_fact])
def test_batches_of_drifting_files_make_no_difference(spark, lake, load):
    def state(max_files):
        files = Archive(spark, f"{lake}/{max_files}")
        files.parquet(0, [(1, "a"), (2, "b")], "k int, a string")
        files.parquet(1, [(1, "a"), (2, "b2")], "k int, a string")
        files.parquet(2, [(1, "a", None), (2, "b2", "new")])
        files.parquet(3, [(1, "a", None), (2, "b2", "new")])
        spec = files.spec(max_files=max_files)
        assert load(spark, spec).files == 4
        table = LakeTable(spark, spec.target_path, [END_DATE] if load is load_scd2 else [])
        return sorted(map(repr, table.read().selectExpr(*SHOWN[load]).collect()))

    assert state(1) == state(2) == state(10)


def test_first_run_skips_files_before_the_initial_watermark(spark, archive):
    archive.parquet(0, [(1, "a", "x")])
    spec = archive.spec(initial=None, initial_days=5)
    now = dt.datetime(2023, 1, 8, tzinfo=dt.timezone.utc)
    assert load_scd1(spark, spec, now).files == 0
    assert rows(read_process_log(spark, spec.log_path), "ArchiveDatetimeUTC", "ArchiveFilePath") == [(2, None)]


@pytest.mark.parametrize("delete_filter", ["", "d"])
def test_history_is_not_replayed_after_a_crash_before_the_log(spark, archive, delete_filter):
    archive.parquet(0, [(1, "a", "x"), (2, "b", "x")])
    archive.parquet(1, [(1, "a2", "x")])
    spec = archive.spec(delete_filter=delete_filter, partition_by="d")
    assert load_scd2(spark, spec).files == 2
    show = ["k", "a", "__StartDatetimeUTC", "__EndDatetimeUTC", "__Current"]
    table = LakeTable(spark, spec.target_path, [END_DATE, "d"])
    want = [(1, "a", 0, 1, False), (1, "a2", 1, "open", True), (2, "b", 0, 1, False)]
    assert rows(table.read(), *show) == want
    # The process log was lost: all files are pending again, and all are in the table.
    lost = archive.spec(delete_filter=delete_filter, partition_by="d", target_log_path=f"{archive.root}/other")
    result = load_scd2(spark, lost)
    assert (result.files, result.again) == (0, 0)
    assert rows(table.read(), *show) == want


def test_history_load_rewrites_only_open_versions_and_its_own_dates(spark, archive):
    archive.parquet(0, [(1, "a", "x"), (2, "b", "x")])
    archive.parquet(1, [(1, "a2", "x"), (2, "b", "x")])
    spec = archive.spec()
    load_scd2(spark, spec)
    closed = Path(LakeTable(spark, spec.target_path).current) / f"{END_DATE}=2023-01-02"
    before = {p.name: p.stat().st_mtime_ns for p in closed.glob("*.parquet")}
    archive.parquet(2, [(1, "a3", "x"), (2, "b", "x")])
    load_scd2(spark, spec)
    assert {p.name: p.stat().st_mtime_ns for p in closed.glob("*.parquet")} == before
    table = LakeTable(spark, spec.target_path, [END_DATE]).read()
    assert rows(table.where("k = 1"), "a", "__EndDatetimeUTC") == [("a", 1), ("a2", 2), ("a3", "open")]


def test_fact_load_full_and_text_delete_time(spark, archive):
    archive.parquet(0, [(1, "a", "x"), (2, "b", "x")])
    archive.parquet(1, [(1, "a", "x")])
    archive.parquet(2, [(1, "a", "x"), (2, "b", "x"), (3, "c", "x")])
    archive.parquet(3, [(1, "a", "x"), (2, "b", "x")])
    spec = archive.spec(string_delete_time=True, max_files=2)
    load_fact(spark, spec, dt.datetime(2023, 6, 1, 12, tzinfo=dt.timezone.utc))
    got = LakeTable(spark, spec.target_path).read()
    assert rows(got, "k", "__OriginalStagingFileName", DELETED) == [
        (1, "0.parquet", None), (2, "2.parquet", None), (3, "2.parquet", "2023-06-01 12:00:00"),
    ]


def test_publish_names_failed_files_and_tries_them_again(spark, archive):
    archive.parquet(0, [(1, "a", "x")])
    bad = archive.text(1, "parquet", b"not parquet at all")
    archive.parquet(2, [(2, "b", "x")])
    target, log = f"{archive.root}/out", f"{archive.root}/outlog"
    run = lambda: publish_select(spark, archive.log, log, target, extract="[k], upper([a]) as a", initial=EPOCH)
    result = run()
    assert (result.files, result.failed) == (2, [bad])
    assert rows(spark.read.parquet(target), "k", "a") == [(1, "A"), (2, "B")]
    pq.write_table(spark.createDataFrame([(3, "c", "x")], "k int, a string, d string").toArrow(), bad)
    result = run()
    assert (result.files, result.failed) == (1, [])
    assert rows(spark.read.parquet(target), "k", "__OriginalStagingFileName") == [
        (1, "0.parquet"), (2, "2.parquet"), (3, "1.parquet"),
    ]


def test_publish_as_is_doubles_the_extension_and_keeps_folders(spark, archive):
    archive.text(0, "csv", b"raw;bytes\n")
    target = Path(archive.root) / "out"
    (target / "kept").mkdir(parents=True)
    (target / "old.csv").write_bytes(b"old")
    publish_as_is(spark, archive.log, f"{archive.root}/l", str(target), ".csv", clear_target=True, initial=EPOCH)
    assert sorted(n for n in os.listdir(target) if not n.startswith(".")) == ["0.csv.csv", "kept"]
    assert (target / "0.csv.csv").read_bytes() == b"raw;bytes\n"


def test_stage_unites_files_and_writes_nothing_without_any(spark, archive, monkeypatch):
    written = []
    monkeypatch.setattr(publish_module, "overwrite_jdbc", lambda df, url, table, n: written.append((table, rows(df, "k", "a", "e"))))
    monkeypatch.setattr(publish_module, "overwrite_warehouse", lambda df, *a: written.append((a[1:], df.count())))
    log = f"{archive.root}/l"
    bad = archive.text(0, "parquet", b"junk")
    assert stage_to_jdbc(spark, archive.log, log, "jdbc:x", "t", initial=EPOCH).failed == [bad]
    assert written == []
    archive.parquet(1, [(1, "a", "x")])
    archive.parquet(2, [(2, "b", "n")], "k long, a string, e string")
    assert stage_to_jdbc(spark, archive.log, log, "jdbc:x", "t", initial=EPOCH).files == 2
    assert written == [("t", [(1, "a", None), (2, "b", "n")])]
    stage_to_warehouse(spark, archive.log, f"{archive.root}/l2", "jdbc:x", "t", distribution="HASH(k)", initial=EPOCH)
    assert written[1] == (("t", "HASH(k)", 250, None), 2)


def test_export_takes_changes_once(spark, lake):
    data = [(i, dt.datetime(2023, 1, i)) for i in range(1, 4)]
    spark.createDataFrame(data, "i int, __ModifiedDatetimeUTC timestamp").createOrReplaceTempView("changes")
    sent = []
    write = lambda df: sent.append(rows(df))
    first = export_table(spark, "changes", f"{lake}/log", write, columns="i", now=dt.datetime(2023, 1, 2, 12))
    assert first.until == dt.datetime(2023, 1, 2)
    # Changed after the first query began: written then, and again now.
    export_query(spark, "select * from changes", f"{lake}/log", write, columns="i")
    export_table(spark, "changes", f"{lake}/log", write, columns="i")
    export_table(spark, "changes", f"{lake}/log", write, columns="i", lookback_days=1, include_previous=True)
    assert sent == [[(1,), (2,), (3,)], [(3,)], [], [(2,), (3,)]]


def test_jdbc_options(spark):
    df = spark.createDataFrame([(1, "a")], "id int, `my name` string")
    assert jdbc.text_types(df.schema, 40) == "`my name` VARCHAR(40)"
    assert jdbc.warehouse_options(df.schema, "HASH(id)", 250) == {
        "createTableOptions": "WITH (DISTRIBUTION = HASH(id), HEAP)",
        "createTableColumnTypes": "`my name` VARCHAR(250)",
    }
    assert "createTableColumnTypes" not in jdbc.warehouse_options(df.schema, "ROUND_ROBIN", "max")
    options = jdbc_options("jdbc:x", "select 1", partition_column="id", lower=1, upper=9, partitions=4)
    assert options["dbtable"] == "(select 1) SRC" and options["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "select 1", partition_column="id")


def test_unbounded_text_is_written_in_two_phases(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(jdbc, "_write", lambda df, url, table, mode, n, options: calls.append((df.count(), mode, sorted(options))))
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    jdbc.overwrite_warehouse(df, "jdbc:x", "t", max_length="MAX")
    jdbc.overwrite_warehouse(df, "jdbc:x", "t")
    assert calls == [
        (0, "overwrite", ["createTableOptions"]), (1, "append", []),
        (1, "overwrite", ["createTableColumnTypes", "createTableOptions"]),
    ]


def test_jdbc_load_matches_by_plain_equality(spark, lake, monkeypatch):
    source = spark.createDataFrame([(1, "a"), (None, "n")], "k int, a string")
    monkeypatch.setattr(load_module, "read_jdbc", lambda *a, **k: source)
    for _ in range(2):
        load_scd1_jdbc(spark, "jdbc:x", "select 1", f"{lake}/t", "k")
    assert rows(LakeTable(spark, f"{lake}/t").read(), "k", "a") == [(1, "a"), (None, "n"), (None, "n")]


def test_table_keeps_text_partitions_and_finishes_replacements(spark, lake, monkeypatch):
    table = LakeTable(spark, f"{lake}/t", ["p"])
    df = spark.createDataFrame([(1, "01"), (2, "1"), (3, "a b/c=d"), (4, None)], "k int, p string")
    table.write(df, "1")
    assert rows(table.read(), "k", "p") == [(1, "01"), (2, "1"), (3, "a b/c=d"), (4, None)]
    # The overwrite breaks after everything was written aside; the next read finishes it.
    touched = df.where("k in (1, 3, 4)").select("p")
    new = df.where("k in (1, 4)").withColumn("k", F.col("k") + 10)
    real = tables._apply_stage
    monkeypatch.setattr(tables, "_apply_stage", lambda *a: None)
    table.replace(lambda _: new, touched, "2")
    monkeypatch.setattr(tables, "_apply_stage", real)
    assert table.applied() == "1"
    assert rows(table.read(), "k", "p") == [(11, "01"), (14, None), (2, "1")]
    assert table.applied() == "2"
    # An incomplete snapshot is no snapshot.
    os.makedirs(f"{lake}/t/v=00000009")
    assert table.versions() == [1]


def test_compaction_and_expiry(spark, lake):
    table = LakeTable(spark, f"{lake}/t", ["p"])
    df = spark.range(40).select("id", (F.col("id") % 2).cast("string").alias("p"))
    table.write(df)
    for i in range(8):
        spark.range(i, i + 1).select("id", F.lit("0").alias("p")).write.mode("append").partitionBy("p").parquet(table.current)
    count = lambda p: len(list(Path(table.current, f"p={p}").glob("*.parquet")))
    assert count(0) >= 8
    table.compact()
    assert count(0) == 1 and table.read().count() == 48
    table.write(df)
    assert len(table.expire(1)) == 1 and table.versions() == [2]


def test_repair_of_an_old_log(spark, lake):
    old = spark.createDataFrame([(dt.datetime(2023, 1, 1), 20230101, "a", 5, False, False)],
        "ArchiveDatetimeUTC timestamp, ArchiveyyyyMMddUTC int, ArchiveFilePath string, OriginalStagingFileSize int, IsPurged boolean, IsIgnorable boolean")
    for field in ARCHIVE_LOG.fields:
        if field.name not in old.columns and field.name != "OriginalModificationTime":
            old = old.withColumn(field.name, F.lit(None).cast(field.dataType))
    old.write.partitionBy("ArchiveyyyyMMddUTC").parquet(f"{lake}/log")
    repair_archive_log(spark, f"{lake}/log")
    raw = spark.read.parquet(f"{lake}/log")
    assert dict(raw.dtypes)["OriginalStagingFileSize"] == "bigint" and "OriginalModificationTime" in raw.columns
    assert raw.count() == 1


def test_purge_dry_run_and_real_run(spark, archive):
    first = archive.add(0, "folder", lambda path: os.makedirs(f"{path}/inside"))
    archive.text(1, "csv", b"x")
    missing = archive.text(2, "csv", b"x")
    last = archive.text(3, "csv", b"x")
    os.unlink(missing)
    logs = {"archive_a": archive.log, "archive_none": f"{archive.root}/nothing"}
    now = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rules = {"keep_day": False, "keep_week": False}
    summary = purge_job(spark, logs, now=now, **rules).first()
    assert (summary["BytesToPurge"], summary["BytesToRetain"]) == (300, 100)
    assert read_archive_log(spark, archive.log).where("IsPurged").count() == 0
    purge_job(spark, logs, now=now, dry_run=False, **rules)
    log = read_archive_log(spark, archive.log)
    # The first entry is a folder: it cannot be removed as a file, stays and is not marked.
    assert rows(log.where("not IsPurged"), "ArchiveFilePath") == sorted([(first,), (last,)])
    assert os.path.exists(first) and os.path.exists(last)
    assert log.where("IsPurged and PurgeDatetimeUTC is not null").count() == 2


def test_read_archive_rejects_unknown_formats(spark):
    with pytest.raises(ValueError):
        read_archive(spark, "x", "xml")
