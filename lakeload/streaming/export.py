"""Continuous export of an append-only change folder."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeload.operators.projection import extract
from lakeload.sinks.storage import Storage


def export_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    write: Callable[[DataFrame], None] | None = None,
    *,
    target: str | None = None,
    columns: str | Sequence[str] = "*",
    poll: str = "1 minute",
    available_now: bool = False,
) -> StreamingQuery:
    """Hand each batch of new rows of a Parquet folder to a sink; the checkpoint is the watermark.

    A batch that fails after its write is repeated.  ``write`` may then append its rows twice.  With
    ``target`` each batch is a folder named by the stream and the batch number, which a repetition
    replaces: :func:`exported_rows` reads every row once.
    """
    if (write is None) == (target is None):
        raise ValueError("give either write or target")
    rows = spark.readStream.schema(schema).parquet(path)

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        changed = extract(batch, columns)
        if target is None:
            write(changed)
            return
        changed.write.mode("overwrite").parquet(f"{target}/{_stream_id(spark, checkpoint)}/{batch_id:012d}")

    writer = rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)
    return writer.start()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Spark keeps in the checkpoint: batch numbers are unique within it."""
    return json.loads(Storage(spark, checkpoint).read_text(f"{checkpoint}/metadata"))["id"]


def exported_rows(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of all batches that were written completely, None before the first."""
    storage = Storage(spark, target)
    folders = [f"{target}/{s}/{b}" for s in storage.folders(target) for b in storage.folders(f"{target}/{s}")]
    complete = [f for f in folders if storage.exists(f"{f}/_SUCCESS")]
    return spark.read.option("mergeSchema", True).parquet(*complete) if complete else None
