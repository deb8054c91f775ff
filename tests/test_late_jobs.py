"""Jobs with late files behind purged ones, many files at once, listings, and repeated steps."""

import datetime as dt
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeload.operators import pending_files
from lakeload.plans import LateFileError, LoadSpec, load_fact, load_scd1, load_scd2, purge_catalog
from lakeload.plans import load as load_module
from lakeload.plans.load import END_DATE
from lakeload.schemas import DELETED
from lakeload.sinks.logs import commit_ignorable, commit_purged
from lakeload.sinks.storage import Storage
from lakeload.sinks.tables import LakeTable, clear_files
from lakeload.sources import list_landing, read_archive, read_archive_log, read_process_log
from lakeload.sources.landing import direct_files
from lakeload.streaming import export_stream, exported_rows
from tests.conftest import day, rows
from tests.test_jobs import FILES, SHOWN, Archive, archive  # noqa: F401

SCHEMA = "k int, a string, d string"


def purge(spark, archive, *numbers):
    gone = read_archive_log(spark, archive.log).where(F.col("ArchiveFileName").isin([f"{n}.parquet" for n in numbers]))
    for path in gone.select("ArchiveFilePath").collect():
        Path(path[0]).unlink()
    commit_purged(spark, archive.log, gone, dt.datetime(2023, 2, 1, tzinfo=dt.timezone.utc))


def state(spark, spec, load, drop=()):
    table = LakeTable(spark, spec.target_path, [END_DATE] if load is load_scd2 else [])
    return rows(table.read().selectExpr(*[c for c in SHOWN[load] if c not in drop]))


@pytest.mark.parametrize("load", [load_scd1, load_scd2, load_fact])
def test_late_files_behind_purged_ones(spark, lake, load):
    timely = Archive(spark, f"{lake}/timely")
    for n, data in FILES.items():
        timely.parquet(n, data, SCHEMA)
    load(spark, timely.spec())
    late = Archive(spark, f"{lake}/late")
    for n in (0, 3):
        late.parquet(n, FILES[n], SCHEMA)
    assert load(spark, late.spec()).files == 2
    purge(spark, late, 3)
    for n in (1, 2):
        late.parquet(n, FILES[n], SCHEMA)
    result = load(spark, late.spec())
    assert (result.files, result.again) == (2, 0)
    drop = ["__ArchiveDatetimeUTC"] if load is load_scd1 else []
    assert state(spark, late.spec(), load, drop) == state(spark, timely.spec(), load, drop)
    assert load(spark, late.spec()).files == 0


@pytest.mark.parametrize(("load", "options"), [(load_scd2, {"delete_filter": "d"}), (load_fact, {"delete_filter": "d"}), (load_scd1, {"update_filter": "true"})])
def test_a_late_file_that_needs_purged_ones_is_refused(spark, archive, load, options):
    for n in (0, 3):
        archive.parquet(n, FILES[n], SCHEMA)
    spec = archive.spec(**options)
    load(spark, spec)
    purge(spark, archive, 3)
    before = state(spark, spec, load)
    archive.parquet(1, FILES[1], SCHEMA)
    with pytest.raises(LateFileError, match="1.parquet belongs before"):
        load(spark, spec)
    assert state(spark, spec, load) == before
    # Set aside, it no longer stops the load.
    commit_ignorable(spark, archive.log, "ArchiveFileName = '1.parquet'", "too late")
    assert load(spark, spec).files == 0


def test_late_and_new_files_in_one_batch(spark, archive):
    archive.parquet(0, FILES[0], SCHEMA)
    archive.parquet(2, FILES[2], SCHEMA)
    load_scd2(spark, archive.spec())
    archive.parquet(1, FILES[1], SCHEMA)
    archive.parquet(3, FILES[3], SCHEMA)
    assert load_scd2(spark, archive.spec()).files == 2
    whole = LoadSpec(archive.log, f"{archive.root}/whole", f"{archive.root}/wholelog", "k")
    load_scd2(spark, whole)
    assert state(spark, archive.spec(), load_scd2) == state(spark, whole, load_scd2)


def test_files_read_again_come_in_pages(spark, archive, monkeypatch):
    for n in (0, 2, 3):
        archive.parquet(n, FILES[n], SCHEMA)
    for n in range(4, 9):
        archive.parquet(n, [(n, "x", "y"), (1, f"v{n}", "y")], SCHEMA)
    load_scd1(spark, archive.spec())
    archive.parquet(1, FILES[1], SCHEMA)
    sizes, real = [], load_module._scd1_apply
    monkeypatch.setattr(load_module, "_scd1_apply", lambda *a: (sizes.append(len(a[3].files)), real(*a)))
    result = load_scd1(spark, archive.spec(max_files=3))
    assert (result.files, result.again, sizes) == (1, 7, [3, 3, 2])
    whole = LoadSpec(archive.log, f"{archive.root}/whole", f"{archive.root}/wholelog", "k")
    load_scd1(spark, whole)
    assert state(spark, archive.spec(), load_scd1) == state(spark, whole, load_scd1)


def test_tables_of_older_releases(spark, archive):
    """Tables without the marks of late files take new ones; late ones only where nothing is unclear."""
    for load, mark in ((load_scd1, "__SeenDatetimeUTC"), (load_fact, "__AbsentDatetimeUTC")):
        old = Archive(spark, f"{archive.root}/{load.__name__}")
        old.parquet(0, FILES[0], SCHEMA)
        old.parquet(2, [(1, "a", "x"), (2, "b", "x")], SCHEMA)
        load(spark, old.spec())
        table = LakeTable(spark, old.spec().target_path)
        meta = table.meta()
        table.write(table.read().drop(mark), meta["applied"], meta["paths"])
        old.parquet(3, FILES[3], SCHEMA)
        load(spark, old.spec())
        assert (1, "a") in rows(table.read(), "k", "a")


def test_history_partitions_that_files_do_not_name_are_not_read(spark, archive, monkeypatch):
    schema = "k int, a string, d string"
    archive.parquet(0, [(k, "a", "xyz"[k % 3]) for k in range(9)], schema)
    spec = archive.spec(delete_filter="d", partition_by="d", partition_stable=True)
    load_scd2(spark, spec)
    archive.parquet(1, [(0, "b", "x"), (3, "a", "x")], schema)
    plans, real = [], LakeTable.replace

    def replace(self, state_of, touched, **mark):
        plans.append(state_of(touched)._jdf.queryExecution().toString())
        return real(self, state_of, touched, **mark)

    monkeypatch.setattr(LakeTable, "replace", replace)
    load_scd2(spark, spec)
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plans[0].split("== Physical Plan ==")[1])
    assert filters and all("d#" in f and "x" in f for f in filters if "__EndDate" in f)
    table = LakeTable(spark, spec.target_path, [END_DATE, "d"]).read()
    assert rows(table.where("__Current"), "k", "a", "d") == [
        (0, "b", "x"), (1, "a", "y"), (2, "a", "z"), (3, "a", "x"), (4, "a", "y"), (5, "a", "z"), (7, "a", "y"), (8, "a", "z"),
    ]
    assert rows(table.where("NOT __Current"), "k", "a") == [(0, "a"), (6, "a")]


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        result = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_headers_of_many_csv_files_are_found_in_one_job(spark, lake):
    counts = []
    # Beyond 32 paths Spark lists in a job of its own.
    for n in (120, 240):
        folder = Path(lake) / str(n)
        folder.mkdir()
        paths = []
        for i in range(n):
            head, row = (("a,b é", f"{i},x"), ("b é,a", f"x,{i}"), ("a,b é,c", f"{i},x,z"))[i % 3]
            text = f"\n{head}\r\n{row}\r\n" if i % 2 else f"{head}\n{row}\n"
            paths.append(str(folder / f"{i}.csv"))
            Path(paths[-1]).write_bytes(text.encode("latin-1"))
        (folder / "empty.csv").write_bytes(b"")
        df, jobs = jobs_of(spark, f"csv{n}", lambda: read_archive(spark, [*paths, str(folder / "empty.csv")], "csv", encoding="ISO-8859-1"))
        counts.append(jobs)
        assert sorted(df.columns) == ["a", "b é", "c"]
        got = sorted((int(r["a"]), r["b é"], r["c"]) for r in df.collect())
        assert got == [(i, "x", "z" if i % 3 == 2 else None) for i in range(n)]
    assert counts[0] == counts[1]


def test_schemas_of_many_parquet_files_are_found_in_one_job(spark, lake):
    counts = []
    # Beyond 32 paths Spark lists in a job of its own.
    for n in (120, 240):
        folder = Path(lake) / str(n)
        folder.mkdir()
        kinds = [spark.sql(f"SELECT CAST({v} AS {t}) AS k{more}").toArrow() for v, t, more in ((1, "int", ""), (2, "long", ", 'x' AS d"))]
        paths = [str(folder / f"{i}.parquet") for i in range(n)]
        for i, path in enumerate(paths):
            pq.write_table(kinds[i % 2], path)
        df, jobs = jobs_of(spark, f"parquet{n}", lambda: read_archive(spark, paths))
        counts.append(jobs)
        assert df.schema["k"].dataType.simpleString() == "bigint"
        assert rows(df.groupBy("k", "d").count()) == [(1, None, n // 2), (2, "x", n // 2)]
    assert counts[0] == counts[1]


def test_listing_takes_all_names_in_batches(spark, tmp_path, monkeypatch):
    for name in ("a.csv", "_b.csv", ".c.csv", "d é%.csv", "x.partial", "yr=1/e.csv", "_sub/f.csv"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("x")
    (tmp_path / "empty.csv").write_text("")
    names = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.collect())
    want = [".c.csv", "_b.csv", "a.csv", "d é%.csv"]
    assert names(list_landing(spark, str(tmp_path))) == want
    real = Storage.file_batches
    monkeypatch.setattr(Storage, "file_batches", lambda self, path: real(self, path, 2))
    assert names(list_landing(spark, str(tmp_path))) == want
    assert direct_files(spark, str(tmp_path)).count() == 6
    assert clear_files(spark, str(tmp_path)) == 6
    assert sorted(p.name for p in tmp_path.rglob("*.csv")) == ["e.csv", "f.csv"]


def test_compaction_leaves_large_files_alone(spark, lake):
    table = LakeTable(spark, f"{lake}/t")
    table.write(spark.range(200_000).coalesce(1), applied="2023")
    spark.range(200_000, 200_040).repartition(5).write.mode("append").parquet(table.folder(1))
    sizes = {p.name: p.stat().st_size for p in Path(table.folder(1)).glob("*.parquet")}
    limit = max(sizes.values())
    new = table.compact(limit)
    files = {p.name: p.stat().st_size for p in Path(new).glob("*.parquet")}
    assert new == table.folder(2) and len(files) == 2 and set(sizes.items()) & set(files.items())
    assert table.read().distinct().count() == table.read().count() == 200_040
    assert table.applied() == "2023" and table.compact(limit) == new


def test_pending_files_by_digest(spark, archive):
    paths = [archive.parquet(n, [(1, "a", "x")], SCHEMA) for n in range(5)]
    spec = archive.spec(pending_by="digest")
    assert load_scd1(spark, spec).files == 5
    log, done = read_archive_log(spark, archive.log), read_process_log(spark, spec.log_path)
    assert pending_files(log, done, by="digest").count() == 0
    left = done.where(~F.col("ArchiveFilePath").isin([paths[1], paths[3]]))
    found = pending_files(log, left.unionByName(left.limit(1)), by="digest")
    assert rows(found, "ArchiveFilePath") == rows(pending_files(log, left, by="absence"), "ArchiveFilePath") == sorted([(paths[1],), (paths[3],)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "20230102" in plan and "20230104" in plan and "PartitionFilters: [isnotnull(ArchiveyyyyMMddUTC" in plan


def test_a_repeated_export_batch_replaces_itself(spark, lake, monkeypatch):
    spark.range(5).write.parquet(f"{lake}/changes")
    run = {"target": f"{lake}/out", "available_now": True}
    paths = [f"{lake}/changes", spark.range(1).schema, f"{lake}/check"]
    from lakeload.streaming import export as module

    real = module._stream_id
    calls = []

    def failing(*a):
        calls.append(1)
        return real(*a)

    writes = []
    reader = module.extract

    def write_then_fail(batch, columns):
        df = reader(batch, columns)
        if not writes:
            writes.append(1)
            df.write.mode("overwrite").parquet(f"{lake}/out/{real(spark, paths[2])}/{0:012d}")
            raise OSError("lost after the write")
        return df

    monkeypatch.setattr(module, "_stream_id", failing)
    monkeypatch.setattr(module, "extract", write_then_fail)
    with pytest.raises(Exception, match="lost after the write"):
        export_stream(spark, *paths, **run).awaitTermination()
    assert exported_rows(spark, f"{lake}/out").count() == 5
    export_stream(spark, *paths, **run).awaitTermination()
    spark.range(5, 8).write.mode("append").parquet(f"{lake}/changes")
    export_stream(spark, *paths, **run).awaitTermination()
    assert rows(exported_rows(spark, f"{lake}/out"), "id") == [(i,) for i in range(8)]
    assert exported_rows(spark, f"{lake}/none") is None
    with pytest.raises(ValueError, match="either"):
        export_stream(spark, *paths)


def test_catalog_purge_deletes_and_totals(spark, lake):
    from lakeload.schemas import ARCHIVE_LOG, LOG_PARTITION
    from lakeload.sinks.tables import register_table

    archives = {}
    for name in ("archive_a", "archive_b", "archive_skip", "other"):
        archives[name] = Archive(spark, f"{lake}/{name}")
        for n in (0, 1):
            archives[name].parquet(n, [(1, "a", "x")], SCHEMA)
        register_table(spark, f"purge_test.{name}", archives[name].log, ARCHIVE_LOG, [LOG_PARTITION])
    rules = {"keep_year": False, "keep_month": True, "keep_week": False, "keep_day": False}
    options = {"exclude": ["archive_skip"], "now": dt.datetime(2023, 6, 1, tzinfo=dt.timezone.utc), **rules}
    want = [("`purge_test`.`archive_a`", False, 100, 100, 0), ("`purge_test`.`archive_b`", False, 100, 100, 0), (None, True, 200, 200, 0)]
    show = ["ArchiveTable", "IsTotal", "BytesToPurge", "BytesToRetain", "BytesPurged"]
    for dry_run in (True, False):
        assert rows(purge_catalog(spark, "purge_test", dry_run=dry_run, **options), *show) == sorted(want, key=repr)
    left = {name: sorted(p.name for p in Path(a.root).rglob("*.parquet") if "/data/" in str(p)) for name, a in archives.items()}
    assert left == {n: ["1.parquet"] if n in ("archive_a", "archive_b") else ["0.parquet", "1.parquet"] for n in archives}
    assert rows(read_archive_log(spark, archives["archive_a"].log), "IsPurged") == [(False,), (True,)]
