"""Continuous loading: new archive-log rows trigger a load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeload.operators.incremental import visible_files
from lakeload.plans.load import LoadSpec, load_scd1
from lakeload.schemas import ARCHIVE_LOG


def load_stream(
    spark: SparkSession,
    spec: LoadSpec,
    checkpoint: str,
    load: Callable = load_scd1,
    *,
    poll: str = "1 minute",
    available_now: bool = False,
) -> StreamingQuery:
    """Run a load whenever the archive log grows.

    The log rows of a micro-batch only say that there is work: the load itself takes
    the files its process log does not hold, so a repeated batch does nothing.
    """
    rows = spark.readStream.schema(ARCHIVE_LOG).parquet(spec.archive_log_path)

    def step(batch: DataFrame, batch_id: int) -> None:
        if not visible_files(batch).isEmpty():
            load(batch.sparkSession, spec)

    writer = rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)
    return writer.start()
