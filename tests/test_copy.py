"""Copies that are not whole are reported, so that their sources stay."""

from pyspark.sql import functions as F

from lakeload.sinks.files import copy_files


def test_a_copy_is_compared_with_its_source(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_bytes(name.encode() * 5000)
    rows = [(str(tmp_path / n), str(tmp_path / "out" / n)) for n in ("a", "b", "missing")]
    found = copy_files(spark.createDataFrame(rows, "path string, target string"))
    got = {r.path.rsplit("/", 1)[1]: r.problem for r in found.orderBy(F.col("path")).collect()}
    assert got["a"] is None and got["b"] is None and got["missing"]
    assert (tmp_path / "out" / "b").read_bytes() == b"b" * 5000


def test_an_incomplete_copy_is_replaced(spark, tmp_path):
    (tmp_path / "source").write_bytes(b"x" * 100)
    (tmp_path / "half").write_bytes(b"x" * 60)
    df = spark.createDataFrame([(str(tmp_path / "source"), str(tmp_path / "half"))], "path string, target string")
    assert copy_files(df).first().problem is None
    assert (tmp_path / "half").read_bytes() == b"x" * 100
