"""Structured Streaming jobs, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.plans import load_scd2
from lakeload.plans.load import END_DATE
from lakeload.schemas import END, START
from lakeload.sinks.tables import LakeTable
from lakeload.sinks.storage import Storage
from lakeload.streaming import archive_stream, export_stream, exported_rows, load_stream
from lakeload.session import shared_dir
from registry import extracts as x
from registry import query
from registry.files import (
    _SHOWN,
    _VALID,
    ORDER_ROWS_SQL,
    archived_rows,
    customer_archive,
    orders_landed,
    shown,
    spec_of,
)
from registry.histories import HISTORY_SQL


@query("archive_stream", ORDER_ROWS_SQL)
def archive_stream_query(spark, sf):
    """Landing files archived by a stream; a restart from its checkpoint adds nothing."""
    lake = orders_landed(spark, sf, "stream")
    for _ in range(2):
        archive_stream(
            spark, f"{lake}/ingest", f"{lake}/archive/orders", f"{lake}/checkpoint", f"{lake}/log", available_now=True
        ).awaitTermination()
    return archived_rows(spark, lake)


@query("load_stream", f"{HISTORY_SQL} SELECT {_SHOWN}, {_VALID} FROM h")
def load_stream_query(spark, sf):
    """A history table that follows the archive log."""
    lake = customer_archive(spark, sf, "loadstream")
    for _ in range(2):
        load_stream(
            spark, spec_of(lake), f"{lake}/checkpoint", load_scd2, available_now=True
        ).awaitTermination()
    return shown(LakeTable(spark, f"{lake}/table", [END_DATE]).read(), START, END, "__Current")


@query("export_stream", "SELECT event_id, upper(event_type) AS kind FROM events")
def export_stream_query(spark, sf):
    lake = shared_dir(spark, "exportstream")
    events = x.table(spark, sf, "events").select("event_id", "event_type")
    early = F.col("event_type") == "click"
    for part in (events.where(early), events.where(~early)):
        part.write.mode("append").parquet(f"{lake}/changes")
        export_stream(
            spark,
            f"{lake}/changes",
            events.schema,
            f"{lake}/checkpoint",
            lambda df: df.write.mode("append").parquet(f"{lake}/out"),
            columns="event_id, upper(event_type) as kind",
            available_now=True,
        ).awaitTermination()
    return spark.read.parquet(f"{lake}/out")


@query("export_stream_once", "SELECT event_id, user_id, event_type, value FROM events")
def export_stream_once(spark, sf):
    """A batch whose end was not recorded is written again and replaces itself."""
    lake = shared_dir(spark, "exportonce")
    events = x.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    early = F.col("event_type") == "click"
    for part in (events.where(early), events.where(~early)):
        part.write.mode("append").parquet(f"{lake}/changes")
        for _ in range(2):
            run = {"target": f"{lake}/out", "available_now": True}
            export_stream(spark, f"{lake}/changes", events.schema, f"{lake}/checkpoint", **run).awaitTermination()
            # As after a crash between the write of the batch and its mark in the checkpoint.
            commits = Storage(spark, lake)
            last = max(commits.names(f"{lake}/checkpoint/commits"), key=lambda n: int(n) if n.isdigit() else -1)
            commits.remove(f"{lake}/checkpoint/commits/{last}")
    return exported_rows(spark, f"{lake}/out")
