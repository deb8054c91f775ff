"""The stages against plain versions, each on what the stage before kept."""

import inspect
import sys
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from lakeload.llm.common import SHUFFLE_CLEANUP, discard, staged
from tests.llm.test_operators import lowered, plain_components, plain_near, plain_repeats
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, rows_of(docs)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
    good = rows_of(kept["quality_classifier"])
    assert 0 < len(good) < len(before) and set(good) <= set(before)
    first = {}
    for i, t in sorted(good):
        first.setdefault(lowered(t), (i, t))
    assert sorted(rows_of(kept["exact_dedup"])) == sorted(first.values())
    texts = {i: t for i, t in first.values()}
    root = plain_components(texts, plain_near(texts))
    near = [(i, t) for i, t in first.values() if root[i] == i]
    assert sorted(rows_of(kept["simhash_near_dedup"])) == sorted(near)
    want = plain_repeats(near)
    for i, t in rows_of(kept["substring_dedup"]):
        assert t == (want[i][2] if want[i][1] else dict(near)[i])
    packed = kept["packing"].collect()
    assert {r.doc_id for r in packed} == set(want)
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_empty_and_odd_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema)
    for frame, least in ((docs.where("false"), 0), (odd, 1)):
        for _, stage in corpus_pipeline.STAGES[1:]:
            frame = staged(stage(spark, frame, SF), "odd")
            assert frame.count() >= least


STAGE = dict(corpus_pipeline.STAGES)


def test_one_survivor_of_repeated_rows(spark):
    """Rows are told apart by themselves, not by their ids."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    base = " ".join(f"word{i}" for i in range(40))
    texts = [(1, base), (1, base), (1, base.upper()), (2, "quite another text of a few words"), (2, f"{base} more"), (None, base), (None, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], schema)
    exact = rows_of(STAGE["exact_dedup"](spark, docs, SF))
    assert sorted(exact, key=repr) == sorted([(1, base), *texts[3:5], (None, "alone")], key=repr) or (1, base.upper()) in exact
    assert len(exact) == 4
    near = rows_of(STAGE["simhash_near_dedup"](spark, docs, SF))
    assert len(near) == 3 and (2, texts[3][1]) in near and (None, "alone") in near
    assert {i for i, t in near if "word1 " in t.lower()} == {1}
    nulls = spark.createDataFrame([(None, "same", "en", "s", 1)] * 5 + [(7, None, "en", "s", 1), (7, "", "en", "s", 1)], schema)
    for stage in ("exact_dedup", "simhash_near_dedup"):
        assert sorted(i or 0 for i, _ in rows_of(STAGE[stage](spark, nulls, SF))) == [0, 7]


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()])
def test_queries(spark, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql:
        assert compare(df, connect(SF), sql)[1] is None
    else:
        assert df.count() > 0


def test_nothing_else_needs_the_subpackage():
    for name, module in list(sys.modules.items()):
        if name.startswith(("lakeload", "registry")) and not name.startswith("lakeload.llm"):
            assert "lakeload.llm" not in inspect.getsource(module)


def test_staged_tables_leave_no_shuffle_files(spark):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in blocks.mkString("\n").split("\n") if b.startswith("shuffle_")}

    def wide():
        return spark.range(50_000).groupBy((F.col("id") % 7_000).alias("k")).agg(F.count("*").alias("n"))

    before, setting = shuffles(), spark.conf.get(SHUFFLE_CLEANUP, None)
    made = wide()
    table = staged(made, "shuffle-test")
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    # The source can be computed again, and other queries keep their shuffles.
    assert made.exceptAll(table).isEmpty() and table.count() == made.count() == 7_000
    discard(table)
