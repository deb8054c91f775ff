"""The corpus pipeline: classify, drop copies and near copies, cut repeats, pack.

Each stage takes what its predecessor kept; ``run`` writes each result as Parquet and reads it
again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.common import bounded_batches, marked, remainder, staged, table
from lakeload.llm.exact import exact_dedup
from lakeload.llm.packing import pack_documents
from lakeload.llm.quality import train_quality, with_quality
from lakeload.llm.simhash import near_copies
from lakeload.llm.substrings import substring_dedup
from lakeload.llm.tokens import default_vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are scored like others.  Each row is judged by its text, so repeated rows
    share a fate; an empty table stays empty.
    """
    bounded_batches(spark)
    labels = table(spark, sf_dir, "labels")
    model = train_quality(docs, labels, remainder("doc_id", 4) == 2)
    return with_quality(docs, model).where("predicted = 1").select(docs.columns)


def _kept(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows named by ``kept``, one of those that repeat; only these are compared with each other."""
    counted = kept.groupBy("__row").agg(F.count("*").alias("n"))
    once, several = (rows.join(counted.where(n).select("__row"), "__row", "left_semi") for n in ("n = 1", "n > 1"))
    return once.unionByName(several.dropDuplicates(["__row"]))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z one row stays: that of the smallest id, null last.

    Null counts as empty.  Of repeated rows one stays; an empty table stays empty.
    """
    rows = marked(docs)
    kept = exact_dedup(rows, "__row", keep="smallest", columns=["__row"]).where("kept").select("__row")
    return _kept(rows, staged(kept, "exact-rows")).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8 or more) one row stays: that of the
    smallest id, null last.

    Null and empty texts are copies of each other.  Rows are told apart by id and text, so other
    texts of a dropped id stay; of repeated rows one stays, an empty table stays empty.
    """
    bounded_batches(spark)
    rows = marked(docs)
    found = staged(near_copies(rows, "__row"), "near-rows")
    return _kept(rows, found.where("__row = component_id").select("__row")).select(docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document with a smaller id has are cut out.

    Null texts and rows with a null id stay as they are; repeated rows lose the same words.
    """
    bounded_batches(spark)
    cut = substring_dedup(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths up to 1024.

    A null text is an empty one and has the end token alone; an empty table has no sequences.
    """
    bounded_batches(spark)
    return pack_documents(docs, default_vocabulary())


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("substring_dedup", repeats),
    ("packing", pack),
]

#: SQL has no classifier; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return staged(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
