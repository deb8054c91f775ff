"""Continuous archiving of a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeload.plans.archive import archive_batch
from lakeload.schemas import BINARY_FILE
from lakeload.sources.landing import complete_file

POLL = "5 seconds"


def archive_stream(
    spark: SparkSession,
    ingest_path: str,
    archive_path: str,
    checkpoint: str,
    archive_log_path: str | None = None,
    *,
    max_files_per_trigger: int = 10_000,
    poll: str = POLL,
    available_now: bool = False,
) -> StreamingQuery:
    """Copy, log and remove each landing file once.

    The checkpoint knows every file seen, so a growing folder is not compared with
    the log again and again, and the number of files per step is bounded.  A path is
    taken when first seen: producers write under a ``.partial`` name and rename.
    A step whose files are not all archived fails and is repeated by the next start.
    Each step adds a small log file; ``compact_archive_log(..., to_day=yesterday)``
    joins those of past days, which the stream no longer writes to.
    """
    log_path = archive_log_path or f"{archive_path.rstrip('/')}/log"
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        # A step that is repeated finds the files gone that it archived before.
        .option("ignoreMissingFiles", True)
        .load(ingest_path)
        .drop("content")
    )

    def step(listing: DataFrame, batch_id: int) -> None:
        listing = listing.where(complete_file())
        seen = listing.count()
        if not seen:
            return
        done = archive_batch(listing.sparkSession, listing, archive_path, log_path)
        committed, failed = done.agg(F.count(F.lit(1)), F.count("problem")).first()
        if failed:
            raise OSError(f"{failed} archived landing files could not be removed")
        if committed < seen:
            # The checkpoint must not count them as done: the step fails and is repeated.
            raise OSError(f"{seen - committed} landing files could not be archived")

    writer = files.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)
    return writer.start()
