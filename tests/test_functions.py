import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from lakeload import functions as fn
from lakeload.operators import choose_tables


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(
    ("text", "names"),
    [("[a], `b` , c", ["a", "b", "c"]), ("", []), (None, []), (["x ", "[y]"], ["x", "y"]), ("[my col]", ["my col"])],
)
def test_parse_columns(text, names):
    assert fn.parse_columns(text) == names


def test_identifiers():
    assert fn.brackets_to_backticks("[a b] as c, f([d])") == "`a b` as c, f(`d`)"
    assert fn.catalog_name("source/data-set\\x") == "archive_source_data_set_x"
    assert choose_tables(["archive_a", "archive_b1", "other"], ("archive_",), ("archive_b",)) == ["archive_a"]


def test_concat_hash_is_the_joined_text_and_skips_null(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, "b", None)], "k int, a string, b string")
    got = [r[0] for r in fn.row_hash(df, mode="concat").select("__HashDiff").collect()]
    assert got == [sha("1||b"), sha("1||b")]


def test_safe_hash_tells_shifted_nulls_and_separators_apart(spark):
    data = [(None, "b"), ("b", None), ("a||b", "c"), ("a", "b||c"), ("", None), (None, "")]
    df = spark.createDataFrame(data, "a string, b string")
    assert fn.row_hash(df).select("__HashDiff").distinct().count() == len(data)


def test_json_hash_takes_structs_and_leaves_null_out(spark):
    df = spark.sql("select 1 as a, cast(null as string) as b, named_struct('x', 2) as s")
    assert fn.row_hash(df, mode="json").first()["__HashDiff"] == sha('{"a":1,"s":{"x":2}}')
    assert fn.row_hash(df, mode="safe").first()["__HashDiff"]


def test_hash_columns_can_be_pinned(spark):
    df = spark.sql("select 1 as a, 2 as b")
    assert fn.row_hash(df, ["a"], "concat").first()["__HashDiff"] == sha("1")
    with pytest.raises(ValueError):
        fn.row_hash(df, mode="other")


@pytest.mark.parametrize(
    ("size", "text"),
    [(None, "0B"), (0, "0B"), (1, "1.0 B"), (1023, "1023.0 B"), (1024, "1.0 KB"), (1536, "1.5 KB"),
     (1024**3 - 1, "1024.0 MB"), (1024**3, "1.0 GB"), (5 * 1024**5, "5.0 PB"), (2**62, "4.0 EB")],
)
def test_human_bytes(spark, size, text):
    df = spark.createDataFrame([(size,)], "n long")
    assert df.select(fn.human_bytes(F.col("n"))).first()[0] == text


def test_file_names(spark):
    df = spark.createDataFrame([("a/b.c/d.tar.gz",), ("a/b.c/plain",), ("x/.hidden",)], "p string")
    got = df.select(fn.file_extension(F.col("p")), fn.file_name(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(".gz", "d.tar.gz"), ("", "plain"), ("", ".hidden")]


def test_calendar(spark):
    df = spark.range(1).select(fn.instant("2022-12-31 23:05:00").alias("t"))
    row = df.select(
        *[v.alias(k) for k, v in fn.archive_calendar(F.col("t")).items()], fn.name_prefix(F.col("t")).alias("p")
    ).first()
    assert tuple(row) == (2022, 12, 31, 20221231, "23_05")
    millis = spark.range(1).select(fn.epoch_millis(F.lit(1500)).cast("timestamp_ntz")).first()[0]
    assert millis == dt.datetime(1970, 1, 1, 0, 0, 1, 500000)
