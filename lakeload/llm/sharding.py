"""Uniform sharding by a hypergeometric communication matrix, in DataFrame operations only."""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric(rng: random.Random, marked: int, others: int, draws: int) -> int:
    """How many of ``draws`` rows, taken without return from both kinds, are marked.

    Rejection from a hat around the mode, valid for any log-concave law and any size of numbers.
    """
    low, high = max(0, draws - others), min(marked, draws)
    if low == high:
        return low
    mode = min(max((draws + 1) * (marked + 1) // (marked + others + 2), low), high)

    def log_weight(k: int) -> float:
        return _log_choose(marked, k) + _log_choose(others, draws - k)

    total = _log_choose(marked + others, draws)
    peak = math.exp(log_weight(mode) - total)
    edge = 1 + peak / 2
    while True:
        u, v = rng.random(), rng.random()
        away = v * edge / peak if u <= edge / (1 + edge) else (edge - math.log(1 - v)) / peak
        k = mode + (round(away) if rng.random() < 0.5 else -round(away))
        hat = min(1.0, math.exp(edge - peak * away))
        if low <= k <= high and rng.random() * hat * peak <= math.exp(log_weight(k) - total):
            return k


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Row counts from each partition to each shard, as a uniform shuffle of all rows has them."""
    if sum(rows) != sum(shards):
        raise ValueError("rows and shard sizes differ in sum")
    rng, left, matrix = random.Random(seed), list(shards), []
    for count in rows:
        draws, rest, line = count, sum(left), []
        for j, size in enumerate(left):
            rest -= size
            taken = hypergeometric(rng, size, rest, draws)
            line.append(taken)
            draws -= taken
            left[j] = size - taken
        matrix.append(line)
    return matrix


def shard_rows(
    df: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    rows_per_partition: int = 1_000_000,
    least_partitions: int = 64,
) -> DataFrame:
    """The rows of ``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each).

    A uniform random shuffle with exact shard sizes, at most one row apart:

    1. Rows fall into partitions by a hash of id and text; the partitions are counted.
    2. The counts from partition to shard are drawn exactly: a multivariate hypergeometric draw
       per partition, on a matrix of partitions x shards numbers.
    3. Each partition is permuted by a row hash and cut by those counts; rows go to their shards.
    4. Each shard is permuted by another hash.  Its order is cut into ranges of that hash, ranked
       within and moved by the counts before, so no task holds a whole shard.

    Permutations come from the row, so a task that runs again gives the same places.  Rows alike
    in id and text are interchangeable.  Null ids and texts are values like others, an empty table
    gives no rows, and columns ``shard`` and ``slot`` of the input are replaced.  The number of
    partitions grows with the rows; the driver holds that many counts times ``shards``.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    keys = [F.col(f"`{id_col}`"), F.col(f"`{text_col}`")]
    base = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")]).alias("row"),
        *[F.xxhash64(F.lit(f"{name} {seed}"), *keys).alias(name) for name in ("home", "first", "second")],
    )
    total = df.count()
    partitions = max(least_partitions, -(-total // rows_per_partition))
    base = base.withColumn("home", F.pmod("home", F.lit(partitions)))
    counted = {r["home"]: r["count"] for r in base.groupBy("home").count().collect()}
    counts = [counted.get(p, 0) for p in range(partitions)]
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix(counts, sizes, seed)
    bounds = [[sum(line[: s + 1]) for s in range(shards)] for line in matrix]
    spark = df.sparkSession
    kind = T.ArrayType(T.ArrayType(T.LongType()))
    plan = spark.range(partitions).select(
        F.col("id").alias("home"), F.get(F.from_json(F.lit(json.dumps(bounds)), kind), F.col("id")).alias("bounds")
    )
    place = F.row_number().over(Window.partitionBy("home").orderBy("first", "second"))
    sent = (
        base.withColumn("place", place)
        .join(plan, "home")
        .withColumn("shard", F.size(F.filter("bounds", lambda b: b < F.col("place"))))
    )
    # Ranges of the second hash are numbered in its order.
    ranges = min(1 << 20, max(1, -(-partitions // shards)))
    top = F.shiftright("second", 44) + F.lit(1 << 19)
    ranged = sent.select("row", "shard", "first", "second", F.shiftright(top * ranges, 20).alias("range"))
    before = (
        ranged.groupBy("shard", "range")
        .count()
        .withColumn(
            "before",
            F.coalesce(F.sum("count").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .select("shard", "range", "before")
    )
    rank = F.row_number().over(Window.partitionBy("shard", "range").orderBy("second", "first"))
    return (
        ranged.withColumn("rank", rank)
        .join(before, ["shard", "range"])
        .select("row.*", F.col("shard").cast("int").alias("shard"), (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"))
    )

