"""Mixing sources to target weights: blocks of words, multinomial shards, permuted block numbers.

The words of a source, in an order drawn from its rows, fill blocks of fixed length.  Each output
shard draws from a multinomial law how many of its slots every source gets, weighted by what is
still missing of the targets.  The slots of a source count through its blocks in a pseudorandom
order, a new one for each round, and meet the blocks by number.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.common import staged
from lakeload.operators.matching import members

#: Slots that one row of the draw stands for, and rows of one ordered bucket (about).
RUN_SLOTS = 65_536
BUCKET_ROWS = 4_096
#: A mixture is a list of sources with weights; the driver holds that list.
MOST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], most_times: float) -> list[float]:
    """Shares of the whole by weight; what exceeds ``most_times`` a source's size goes to the others."""
    size, weight = np.array(sizes, float), np.array(weights, float)
    limit, full = size * most_times, weight <= 0
    out = np.zeros(len(size))
    while not full.all():
        rest = size.sum() - out[full].sum()
        share = rest * weight / weight[~full].sum()
        above = ~full & (share > limit)
        if not above.any():
            out[~full] = share[~full]
            break
        out[above], full = limit[above], full | above
    return out.tolist()


def draw_counts(wanted: np.ndarray, room: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Slots of each source in each shard.

    A shard's slots follow a multinomial law whose weights are the slots still wanted, so that
    later shards make up for chance in earlier ones; slots beyond a source's ``room`` are drawn again.
    """
    rng = np.random.default_rng(seed)
    total = min(int(round(wanted.sum())), int(room.sum()))
    counts = np.zeros((shards, len(wanted)), np.int64)
    left, missing = room.astype(np.int64), wanted.astype(float)
    for shard, row in enumerate(counts):
        slots = total * (shard + 1) // shards - total * shard // shards
        while slots:
            law = np.where(left > 0, np.maximum(missing, 0), 0)
            if law.sum() <= 0:
                law = left.astype(float)
            drawn = np.minimum(rng.multinomial(slots, law / law.sum()), left)
            row += drawn
            left, missing, slots = left - drawn, missing - drawn, slots - int(drawn.sum())
    return counts


def _mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each value (the finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def permuted(numbers: np.ndarray, size: int, keys: np.ndarray) -> np.ndarray:
    """Images of ``numbers`` in pseudorandom permutations of ``range(size)``, one for each key.

    A Feistel network over the next even number of bits, walked until the image lies in the range.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out, keys = numbers.astype(np.uint64), keys.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & low
        for step in range(4):
            noise = _mixed(right + _mixed(keys[todo] + np.uint64(step)))
            left, right = right, left ^ (noise & low)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


@dataclass
class Mixture:
    """``sources`` (number, source, source_size, blocks, target), ``rows`` (the documents with
    their place in their source), ``slots`` (shard, slot, number, block) and ``pieces`` (which words
    of which document a block holds)."""

    sources: DataFrame
    rows: DataFrame
    slots: DataFrame
    pieces: DataFrame

    def spans(self) -> DataFrame:
        """The mix itself: for each slot the word ranges of documents that fill it."""
        return self.slots.join(self.pieces, ["number", "block"])

    def taken(self) -> DataFrame:
        """Each document with the words that the mix takes from it, repeats counted."""
        key = ["number", "id", "mark", "copy", "size"]
        used = self.spans().select(*key, "words")
        none = self.rows.select(*key, F.lit(0).cast("long").alias("words"))
        sums = used.unionByName(none).groupBy(*key).agg(F.sum("words").alias("taken"))
        return members(sums, self.sources, ["number"], "inner")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] | Mapping[str | None, float],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 128,
    shards: int = 64,
    most_times: int = 3,
    seed: int = 17,
) -> Mixture:
    """Mix whole documents so that sources have shares by weight.

    ``weights`` are given by source name (others get none), or as a list that repeats over the
    sources in code-point order, null last.  A source gives no block more than ``most_times``.

    A null source is a source of its own.  Null and empty texts have no words and give rows with
    nothing taken, as do null ids, which are ids like others.  Repeated rows are documents of
    their own that stand side by side.  An empty table, or one without words, gives no slots.
    Other columns are not read.  The order inside a source comes from the rows alone, so a
    second run on other partitions gives the same mix.

    Only sources (at most ``MOST_SOURCES``, else refused) and their counts a shard reach the driver.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    measured = staged(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(text).alias("size"),
            F.xxhash64(F.col(id_col), text).alias("mark"),
        ),
        "mixing",
    )
    found = measured.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    found = found.limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    size = [r["size"] for r in found]
    if isinstance(weights, Mapping):
        weight = [weights.get(r["source"], 0.0) for r in found]
    else:
        weight = [weights[i % len(weights)] for i in range(len(found))]
    target = targets(size, weight, most_times)
    blocks = [-(-s // block_words) for s in size]
    sources = spark.createDataFrame(
        [(i, r["source"], r["size"], b, t) for i, (r, b, t) in enumerate(zip(found, blocks, target))],
        f"number int, source {measured.schema['source'].dataType.simpleString()}, source_size long, blocks long, target double",
    )
    wanted = np.array([t * b / s if s else 0.0 for s, b, t in zip(size, blocks, target)])
    counts = draw_counts(wanted, np.array(blocks, np.int64) * most_times, shards, seed)
    rows = _placed(measured, sources, sum(r["n"] for r in found))
    return Mixture(sources, rows, _slots(spark, counts, blocks, seed), _pieces(rows, block_words))


def _placed(measured: DataFrame, sources: DataFrame, n_rows: int) -> DataFrame:
    """Each document with ``start``: the words of its source before it.

    Rows are ordered by hash within buckets of about ``BUCKET_ROWS``, and buckets have offsets, so
    no task holds a whole source.
    """
    buckets = -(-n_rows // BUCKET_ROWS) or 1
    numbered = members(measured, sources.select("source", "number"), ["source"], "inner").drop("source")
    equal = numbered.groupBy("number", "id", "mark", "size").agg(F.count("*").alias("copies"))
    equal = equal.withColumn("bucket", F.pmod(F.shiftrightunsigned("mark", 20), F.lit(buckets)))
    words = F.col("size") * F.col("copies")
    inside = Window.partitionBy("number", "bucket").orderBy("mark", "id", "size")
    ordered = equal.withColumn("start", F.sum(words).over(inside) - words)
    earlier = Window.partitionBy("number").orderBy("bucket")
    offsets = (
        equal.groupBy("number", "bucket")
        .agg(F.sum(words).alias("words"))
        .withColumn("before", F.sum("words").over(earlier) - F.col("words"))
        .drop("words")
    )
    placed = ordered.join(offsets, ["number", "bucket"])
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    placed = placed.select("number", "id", "mark", "size", (F.col("before") + F.col("start")).alias("start"), copy.alias("copy"))
    return placed.withColumn("start", F.col("start") + F.col("copy") * F.col("size"))


def _pieces(rows: DataFrame, block_words: int) -> DataFrame:
    """Documents cut at the borders of blocks: ``begin`` and ``words`` count words of the document."""
    start, size, length = F.col("start"), F.col("size"), F.lit(block_words).cast("long")
    first = (start - F.pmod(start, length)) / length
    last = start + size - 1
    blocks = F.sequence(first.cast("long"), ((last - F.pmod(last, length)) / length).cast("long"))
    cut = rows.where("size > 0").withColumn("block", F.explode(blocks))
    begin = F.greatest(F.col("block") * length - start, F.lit(0))
    end = F.least((F.col("block") + 1) * length - start, size)
    return cut.select(
        "number", "block", "id", "mark", "copy", "size", begin.alias("begin"), (end - begin).alias("words")
    )


def _slots(spark, counts: np.ndarray, blocks: list[int], seed: int) -> DataFrame:
    """A row for each slot.  Each task makes the slots of runs of bounded length."""
    before_source, before_shard = np.cumsum(counts, 0) - counts, np.cumsum(counts, 1) - counts
    cells = [
        (int(j), int(s), int(before_source[j, s]), int(before_shard[j, s]), int(counts[j].sum()), blocks[s], int(counts[j, s]))
        for j, s in np.argwhere(counts).tolist()
    ]
    drawn = spark.createDataFrame(
        cells, "shard int, number int, before_source long, before_shard long, shard_slots long, blocks long, n long"
    )
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN_SLOTS).cast("long")))
    # A given number of tasks: adaptive execution would join these few bytes, and one task would make all slots.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = drawn.withColumn("first", run).repartition(tasks, "shard", "number", "first")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                many = np.arange(r["first"], min(r["first"] + RUN_SLOTS, r["n"]))
                turn = r["before_source"] + many
                base = _mixed(np.array([seed, r["number"]], np.uint64) + np.array([0, 1 << 40], np.uint64))
                keys = _mixed((turn // r["blocks"]).astype(np.uint64) + base[0]) ^ base[1]
                place = np.full(len(many), (seed << 32) + r["shard"], np.uint64)
                slot = permuted(r["before_shard"] + many, r["shard_slots"], _mixed(place))
                block = permuted(turn % r["blocks"], r["blocks"], keys)
                alike = [pa.array(np.full(len(many), r[c]), pa.int32()) for c in ("shard", "number")]
                yield pa.RecordBatch.from_arrays(
                    [*alike, pa.array(slot), pa.array(block)], names=["shard", "number", "slot", "block"]
                )

    # As a table its size is known to the join with the pieces.
    return staged(runs.mapInArrow(make, "shard int, number int, slot long, block long"), "mixing-slots")
