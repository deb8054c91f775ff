"""Incremental export by a change time: events changed since the last export."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.operators import changed_since, export_watermark, next_watermark
from registry import extracts as x
from registry import query

WM = "2024-01-12 10:22:47.179575"
UPPER = "2024-01-25 00:00:00"


def export_log(spark, sf):
    """Export times: the last event of each earlier day."""
    return (
        x.table(spark, sf, "events")
        .where(F.col("ts") < x.stamp(WM))
        .groupBy(F.to_date("ts"))
        .agg(F.max("ts").alias("ProcessDatetime"))
        .select("ProcessDatetime")
    )


LAST = f"(SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{WM}')"


@query("export_changed", f"SELECT * FROM events WHERE ts > {LAST}")
def export_changed(spark, sf):
    wm = export_watermark(export_log(spark, sf))
    return changed_since(x.table(spark, sf, "events"), "ts", wm)


@query("export_changed_inclusive", f"SELECT * FROM events WHERE ts >= {LAST}")
def export_changed_inclusive(spark, sf):
    wm = export_watermark(export_log(spark, sf))
    return changed_since(x.table(spark, sf, "events"), "ts", wm, inclusive=True)


@query("export_lookback", f"SELECT * FROM events WHERE ts > {LAST} - INTERVAL 3 DAY")
def export_lookback(spark, sf):
    wm = export_watermark(export_log(spark, sf), lookback_days=3)
    return changed_since(x.table(spark, sf, "events"), "ts", wm)


@query("export_first_run", "SELECT * FROM events WHERE ts > TIMESTAMP '1900-01-01 00:00:00'")
def export_first_run(spark, sf):
    wm = export_watermark(None, lookback_days=3)
    return changed_since(x.table(spark, sf, "events"), "ts", wm.cast("timestamp_ntz"))


@query(
    "export_next_watermark",
    f"SELECT max(ts) AS ProcessDatetime FROM events WHERE ts >= {LAST} AND ts <= TIMESTAMP '{UPPER}'",
)
def export_next_watermark(spark, sf):
    wm = export_watermark(export_log(spark, sf))
    return next_watermark(x.table(spark, sf, "events"), "ts", wm, x.stamp(UPPER))


@query(
    "export_nothing_new",
    "SELECT max(ts) AS ProcessDatetime FROM events WHERE ts >= TIMESTAMP '2031-01-01 00:00:00'",
)
def export_nothing_new(spark, sf):
    """Without changes there is no new watermark."""
    wm, upper = x.stamp("2031-01-01 00:00:00"), x.stamp("2032-01-01 00:00:00")
    return next_watermark(x.table(spark, sf, "events"), "ts", wm, upper)
