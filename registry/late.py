"""Late files behind purged ones, extracts that speak for slices, and folds with an update filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.operators import fact_fold, number_in_order, scd1_fold_filtered, scd2_from_snapshots
from lakeload.plans import LoadSpec, load_fact, load_scd1, load_scd2
from lakeload.plans.load import END_DATE
from lakeload.schemas import ARCHIVE_FILE, ARCHIVED, DELETED, END, START
from lakeload.session import shared_dir
from lakeload.sinks.files import delete_files
from lakeload.sinks.logs import commit_purged
from lakeload.sinks.tables import LakeTable
from lakeload.sources import read_archive_log
from registry import extracts as x
from registry import query
from registry.files import (
    _FACT_SQL,
    _LAST_CHANGE_SQL,
    _SHOWN,
    _VALID,
    LATE,
    NOW,
    customer_archive,
    log_files,
    shown,
    spec_of,
)
from registry.histories import HISTORY_SQL

# ---- late extracts whose successors are gone -----------------------------------------


def purged_then_late(spark, sf, purpose: str, load, **options) -> LoadSpec:
    """All extracts but two are loaded; those after 1999 are purged; then the two turn up."""
    lake = customer_archive(spark, sf, purpose, log=False)
    data, log, spec = f"{lake}/archive/data", f"{lake}/archive/log", spec_of(lake)
    log_files(spark, data, log, only=~F.col("path").rlike(LATE))
    load(spark, spec, **options)
    gone = read_archive_log(spark, log).where("ArchiveDatetimeUTC >= '2000-01-01'")
    deleted = delete_files(gone.select("ArchiveFilePath", "ArchiveDatetimeUTC"), "ArchiveFilePath")
    deleted.write.parquet(f"{lake}/deleted")
    commit_purged(spark, log, spark.read.parquet(f"{lake}/deleted").where("problem IS NULL"), NOW)
    log_files(spark, data, log, only=F.col("path").rlike(LATE))
    load(spark, spec, **options)
    return spec


@query(
    "load_scd1_late_purged",
    f"{_LAST_CHANGE_SQL} SELECT custkey, name, segment, status, __HashDiff FROM r WHERE rn = 1",
)
def load_scd1_late_purged(spark, sf):
    """Late extracts decide only customers that no later extract held."""
    spec = purged_then_late(spark, sf, "scd1purged", load_scd1)
    table = LakeTable(spark, spec.target_path).read()
    return table.select("custkey", "name", "segment", "status", "__HashDiff")


@query("load_scd2_late_purged", f"{HISTORY_SQL} SELECT {_SHOWN}, {_VALID} FROM h")
def load_scd2_late_purged(spark, sf):
    """The history is as if all extracts had come in order, though the later ones are gone."""
    spec = purged_then_late(spark, sf, "scd2purged", load_scd2)
    return shown(LakeTable(spark, spec.target_path, [END_DATE]).read(), START, END, "__Current")


@query("load_fact_late_purged", _FACT_SQL)
def load_fact_late_purged(spark, sf):
    spec = purged_then_late(spark, sf, "factpurged", load_fact, now=NOW)
    return shown(LakeTable(spark, spec.target_path).read(), DELETED)


# ---- extracts that speak for slices ---------------------------------------------------


def _names(col: str) -> str:
    """Which slices of ``col`` an extract speaks for: two of three, other ones each year."""
    return f"(ascii({col}) + year(__ArchiveDatetimeUTC)) % 3 <> 0"


def sliced_sql(col: str) -> str:
    """Sightings ``d`` with the extract in which they are due, and their runs ``g``."""
    return f"""WITH y AS ({x.CUSTOMER_YEARS_SQL}),
    n AS (SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY __ArchiveDatetimeUTC) AS seq FROM y) WHERE {_names(col)}),
    t AS (SELECT DISTINCT seq, __ArchiveDatetimeUTC AS ts FROM n),
    m AS (SELECT {col}, seq, lead(seq) OVER (PARTITION BY {col} ORDER BY seq) AS due FROM (SELECT DISTINCT {col}, seq FROM n)),
    d AS (SELECT n.*, m.due FROM n JOIN m ON n.{col} = m.{col} AND n.seq = m.seq),
    l AS (SELECT *, lag(seq) OVER w AS ps, lag(due) OVER w AS pd, lag(__HashDiff) OVER w AS ph, lead(seq) OVER w AS ns
          FROM d WINDOW w AS (PARTITION BY custkey ORDER BY seq)),
    g AS (SELECT *, sum(CASE WHEN ps IS NOT NULL AND ph = __HashDiff AND (pd IS NULL OR pd >= seq) THEN 0 ELSE 1 END)
               OVER (PARTITION BY custkey ORDER BY seq) AS run FROM l),
    e AS (SELECT *, row_number() OVER (PARTITION BY custkey, run ORDER BY seq) AS rn,
               last_value(due) OVER r AS last_due, last_value(ns) OVER r AS next_seen,
               max(run) OVER (PARTITION BY custkey) AS last_run
          FROM g WINDOW r AS (PARTITION BY custkey, run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def sliced_fact_sql(col: str) -> str:
    return f"""{sliced_sql(col)} SELECT {_SHOWN},
      CASE WHEN last_due IS NOT NULL THEN TIMESTAMP '2023-03-01 08:30:00' END AS __DeletedDatetimeUTC
    FROM e WHERE rn = 1 AND run = last_run"""


def sliced_history_sql(col: str) -> str:
    return f"""{sliced_sql(col)} SELECT {_SHOWN}, __ArchiveDatetimeUTC AS {START},
      coalesce(t.ts, TIMESTAMP '9999-12-31 00:00:00') AS {END}, t.ts IS NULL AS __Current
    FROM e LEFT JOIN t ON t.seq = least(last_due, next_seen) WHERE rn = 1"""


def sliced_years(spark, sf, col: str):
    return x.customer_years(spark, sf).where(_names(col))


def sliced_archive(spark, sf, purpose: str, col: str) -> str:
    """Yearly files, each with customers of some slices only."""
    lake = shared_dir(spark, purpose)
    orders = x.table(spark, sf, "orders").withColumn("yr", F.year("o_orderdate"))
    rows = x.customers_of(orders, x.table(spark, sf, "customer"), ["yr"])
    rows = rows.where(_names(col).replace("year(__ArchiveDatetimeUTC)", "(yr + 1)"))
    rows.repartition("yr").write.partitionBy("yr").parquet(f"{lake}/archive/data")
    log_files(spark, f"{lake}/archive/data", f"{lake}/archive/log")
    return lake


@query("fact_fold_sliced", sliced_fact_sql("status"))
def fact_fold_sliced(spark, sf):
    """A customer is deleted where the slice of its last row is next named without it."""
    rows = fact_fold(
        None, sliced_years(spark, sf, "status"), ["custkey"], x.stamp("2023-03-01 08:30:00"), filter_cols=["status"]
    )
    return shown(rows, DELETED)


@query("scd2_fold_sliced", sliced_history_sql("status"))
def scd2_fold_sliced(spark, sf):
    """A version ends with the next row of its key or the next extract that speaks for its slice."""
    rows = scd2_from_snapshots(sliced_years(spark, sf, "status"), ["custkey"], filter_cols=["status"])
    return shown(rows, START, END, "__Current")


@query("load_fact_slices", sliced_fact_sql("status"))
def load_fact_slices(spark, sf):
    """Batches of two files, each folded at once onto a partitioned table."""
    lake = sliced_archive(spark, sf, "factslices", "status")
    spec = spec_of(lake, delete_filter="status", partition_by="segment", max_files=2)
    load_fact(spark, spec, now=NOW)
    return shown(LakeTable(spark, spec.target_path, ["segment"]).read(), DELETED)


@query("scd2_partition_pruned", sliced_history_sql("segment"))
def scd2_partition_pruned(spark, sf):
    """A history by segment: files that name some segments read and rewrite only those."""
    lake = sliced_archive(spark, sf, "scd2pruned", "segment")
    spec = spec_of(lake, delete_filter="segment", partition_by="segment", partition_stable=True, max_files=2)
    load_scd2(spark, spec)
    return shown(LakeTable(spark, spec.target_path, [END_DATE, "segment"]).read(), START, END, "__Current")


# ---- an update filter over many files -------------------------------------------------

_FILTER = "s.status <> 'F' OR t.segment = 'BUILDING'"


@query(
    "scd1_fold_update_filter",
    f"""WITH RECURSIVE y AS ({x.CUSTOMER_YEARS_SQL}),
    n AS (SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY __ArchiveDatetimeUTC) AS i FROM y),
    f AS (
      SELECT custkey, name, segment, status, __HashDiff, __ArchiveDatetimeUTC, i FROM n WHERE i = 1
      UNION ALL
      SELECT s.custkey, CASE WHEN take THEN s.name ELSE t.name END, CASE WHEN take THEN s.segment ELSE t.segment END,
        CASE WHEN take THEN s.status ELSE t.status END, CASE WHEN take THEN s.__HashDiff ELSE t.__HashDiff END,
        CASE WHEN take THEN s.__ArchiveDatetimeUTC ELSE t.__ArchiveDatetimeUTC END, s.i
      FROM f t JOIN n s ON s.custkey = t.custkey AND s.i = t.i + 1,
      LATERAL (SELECT s.__HashDiff <> t.__HashDiff AND ({_FILTER}) AS take))
    SELECT {_SHOWN} FROM (SELECT *, max(i) OVER (PARTITION BY custkey) AS last FROM f) WHERE i = last""",
)
def scd1_fold_update_filter(spark, sf):
    """All yearly extracts in one pass; each row is taken or not by the row before it."""
    files = number_in_order(x.customer_files(spark, sf), ARCHIVED, [ARCHIVE_FILE])
    rows = scd1_fold_filtered(None, x.customer_years(spark, sf), ["custkey"], files, _FILTER)
    return rows.select(*[c.strip() for c in _SHOWN.split(",")])
