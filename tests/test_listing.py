"""Folders with sub-folders, settings of the cluster, and steps of a stream that fail."""

import pytest

from lakeload.functions import row_hash
from lakeload.operators.matching import broadcast_limit, fits_broadcast
from lakeload.session import require_single_machine
from lakeload.sinks.tables import clear_files
from lakeload.sources import list_landing
from lakeload.streaming import archive_stream
from lakeload.streaming import archive as streaming_archive


def put(path, text="x"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def names(df):
    return sorted(r.path.rsplit("/", 1)[1] for r in df.collect())


def test_listing_and_clearing_stay_on_one_level(spark, tmp_path):
    for name in ("a.csv", "yr=2001/b.csv", "plain/c.csv", "d.partial"):
        put(tmp_path / name)
    assert names(list_landing(spark, str(tmp_path))) == ["a.csv"]
    assert clear_files(spark, str(tmp_path)) == 2
    assert sorted(p.name for p in tmp_path.rglob("*.csv")) == ["b.csv", "c.csv"]
    assert list_landing(spark, str(tmp_path / "missing")).count() == 0


def test_broadcast_switched_off(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = spark.range(3)
        assert broadcast_limit(df) == 0 and not fits_broadcast(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_cluster_needs_a_shared_folder():
    for master in ("local", "local[8]", "local[*]"):
        require_single_machine(master)
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            require_single_machine(master)


def test_hash_does_not_depend_on_other_files_of_the_batch(spark):
    old = row_hash(spark.sql("SELECT 1 AS k, 'x' AS a")).first()["__HashDiff"]
    new = row_hash(spark.sql("SELECT CAST(NULL AS string) AS b, 'x' AS a, 1 AS k")).first()["__HashDiff"]
    assert old == new


def test_stream_repeats_a_step_whose_copy_failed(spark, tmp_path, monkeypatch):
    put(tmp_path / "in/a.csv")
    put(tmp_path / "in/b.csv")
    real, run = streaming_archive.archive_batch, {"available_now": True}
    paths = [str(tmp_path / "in"), str(tmp_path / "archive"), str(tmp_path / "check")]
    # As if the copy of one file had been refused: only the other one is in the log.
    monkeypatch.setattr(
        streaming_archive, "archive_batch", lambda s, files, *rest: real(s, files.where("path LIKE '%a.csv'"), *rest)
    )
    with pytest.raises(Exception, match="could not be archived"):
        archive_stream(spark, *paths, **run).awaitTermination()
    assert [p.name for p in (tmp_path / "in").iterdir()] == ["b.csv"]
    monkeypatch.setattr(streaming_archive, "archive_batch", real)
    archive_stream(spark, *paths, **run).awaitTermination()
    assert not list((tmp_path / "in").iterdir())
    assert len(list((tmp_path / "archive").rglob("*.csv"))) == 2
