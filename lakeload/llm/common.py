"""Helpers shared by the operators: staged tables, documents as Arrow batches, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from decimal import Decimal
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.session import shared_dir
from lakeload.sinks.storage import Storage


ROW_GROUP_BYTES = 16 << 20
SLICE_BYTES = 2 << 20
#: While this is on, Spark removes the shuffle files of a query when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Arrow batches end at this size too, not only at a number of rows.
BATCH_BYTES, BATCH_BYTES_KEY = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in batches of a few MB from now on, unless the session has a size
    of its own; by the defaults a batch of 10,000 documents takes tens of MB in the executor and in
    the worker."""
    if spark.conf.get(BATCH_BYTES_KEY, None) is None:
        spark.conf.set(BATCH_BYTES_KEY, BATCH_BYTES)


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """Queries that end in here leave no shuffle files behind; the session's own setting comes back."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut.

    Any executor can read the files again, so a lost executor costs no recomputation.  Small row
    groups bound what the writers of an executor hold at once.  Shuffle files of the write are of no
    use once it is done and do not wait for the driver's next garbage collection.
    """
    path = shared_dir(df.sparkSession, f"llm-{purpose}")
    with _shuffles_removed(df.sparkSession):
        # The size of a row group is looked at from its first row on, not from the hundredth: rows can take MBs.
        writer = df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES)
        writer.option("parquet.page.size.row.check.min", 1).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._folder = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove staged tables of which all that was needed has been written."""
    for table in tables:
        Storage(table.sparkSession, table._folder).remove(table._folder)


def renamed(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own, where both sides of a cogroup come from one table."""
    return df.select(*[F.col(f"`{c}`").alias(c) for c in df.columns])


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal digits modulo ``modulus``; a null id counts as empty text."""
    digits = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % modulus


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does just that to pure ASCII, faster."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def slices(batch: pa.RecordBatch, column: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts take about ``limit`` bytes, so that few are Python objects at once."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _by_id(id_col: str, rest: Column) -> Column:
    """A number that orders rows by their integer id, null last, then by 56 bits of ``rest``."""
    lowest, beyond, step = (F.lit(Decimal(n)) for n in (1 << 63, 1 << 64, 1 << 56))
    place = F.coalesce((F.col(id_col).cast("decimal(20,0)") + lowest).cast("decimal(21,0)"), beyond.cast("decimal(21,0)"))
    return (place * step.cast("decimal(17,0)") + rest).cast("decimal(38,0)")


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``__row``, a number made from id and text: equal for repeated rows, other for
    other texts of one id."""
    content = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), 8)
    return docs.withColumn("__row", _by_id(id_col, content))


def per_document(
    docs: DataFrame, id_col: str, text_col: str, work: Callable[[list], list[tuple]], schema: str, binary: bool = False
) -> DataFrame:
    """``work(texts) -> rows`` over Arrow batches; gives the id and the columns of ``schema``.

    Null texts come as empty ones.  With ``binary`` texts come as UTF-8 bytes.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), (text.cast("binary") if binary else text).alias("text"))
    names = [part.split()[0] for part in schema.split(",")]
    id_type = source.schema["id"].dataType.simpleString()
    out = f"{id_col} {id_type}, {schema}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            rows = work(batch.column(1).to_pylist())
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True))],
                names=[id_col, *names],
            )

    kinds = [_ARROW[part.split()[1]] for part in schema.split(",")]
    return source.mapInArrow(run, out)


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
}


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a, b)``: the smallest node it can reach.

    Alternates large stars (larger neighbours move to the smallest one) and small stars
    (smaller neighbours do), a logarithmic number of rounds.  Edges never grow in number, a
    hub's edges are spread by joins, and each round is a written table.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = staged(edges, "edges")
    state = _edge_state(edges)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        before, edges = edges, staged(_small_star(_large_star(edges)), "edges")
        discard(before)
        after = _edge_state(edges)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _edge_state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    # Kept below 2^53 a row, so that sums of many rows do not overflow.
    return tuple(edges.agg(F.count("*"), F.sum(mixed.bitwiseAND(2**31 - 1)), F.bit_xor(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
