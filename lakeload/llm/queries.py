"""The registered queries of the training-data operators, and SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from lakeload.llm.bpe import round_trip_digests
from lakeload.llm.common import remainder, table
from lakeload.llm.crosstoken import align_tokenizers
from lakeload.llm.exact import exact_dedup
from lakeload.llm.frames import read_token_files, write_token_files
from lakeload.llm.lattice import lattice_scores
from lakeload.llm.mixing import mix_sources
from lakeload.llm.packing import pack_documents
from lakeload.llm.quality import train_quality, with_quality
from lakeload.llm.sharding import shard_rows
from lakeload.llm.simhash import simhash_groups
from lakeload.llm.substrings import substring_dedup
from lakeload.llm.tokens import default_vocabulary
from lakeload.llm.vectors import vector_groups
from lakeload.llm.whitening import component_rows, whiten
from lakeload.session import shared_dir

VOCABULARY, PIECES = default_vocabulary(), default_vocabulary("piece_bpe_32k.model")


def bpe(spark, sf_dir):
    return round_trip_digests(table(spark, sf_dir, "documents"), VOCABULARY)


def exact(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest", columns=["doc_id"])


def packing(spark, sf_dir):
    pieces = pack_documents(table(spark, sf_dir, "documents"), VOCABULARY)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def sharding(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard_rows(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def token_files(spark, sf_dir):
    files = write_token_files(table(spark, sf_dir, "documents"), VOCABULARY, shared_dir(spark, "token-files"))
    return read_token_files(files).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def substrings(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"), columns=["doc_id"], digest=True)


def simhash(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))


def vectors(spark, sf_dir):
    return vector_groups(table(spark, sf_dir, "embeddings"))


def lattice(spark, sf_dir):
    return lattice_scores(table(spark, sf_dir, "documents"), VOCABULARY, remainder("doc_id", 7) == 2)


def quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 4) == 2
    model = train_quality(docs, table(spark, sf_dir, "labels"), held_out)
    return with_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def crosstoken(spark, sf_dir):
    return align_tokenizers(table(spark, sf_dir, "documents"), VOCABULARY, PIECES)


def whitening(spark, sf_dir):
    rows = component_rows(whiten(table(spark, sf_dir, "embeddings")))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def mixing(spark, sf_dir):
    taken = mix_sources(table(spark, sf_dir, "documents"), [5, 2, 1]).taken()
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_bpe": bpe,
    "op2_substring_dedup": substrings,
    "op3_vectors": vectors,
    "op4_exact_dedup": exact,
    "op5_packing": packing,
    "op6_lattice": lattice,
    "op7_quality": quality,
    "op8_sharding": sharding,
    "op9_token_files": token_files,
    "op10_simhash": simhash,
    "op11_crosstoken": crosstoken,
    "op12_whitening": whitening,
    "op13_mixing": mixing,
    "pipeline": pipeline,
}

SQL = {
    "op4_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') AS n FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
        FROM t""",
}
