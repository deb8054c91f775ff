"""Jobs over files: the given tables are written as landing or archive files and go through."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions import archive_calendar, file_name, utc_clock
from lakeload.operators.projection import complex_as_string, underscore_names
from lakeload.plans import (
    LoadSpec,
    archive_job,
    export_frame,
    load_fact,
    load_scd1,
    load_scd1_frame,
    load_scd2,
    publish_as_is,
    publish_select,
    purge_job,
    stage_to,
)
from lakeload.plans.load import END_DATE, pending_batches
from lakeload.plans.publish import published_rows
from lakeload.schemas import DELETED, END, START
from lakeload.session import shared_dir
from lakeload.sinks.logs import append_archive_log, commit_ignorable, compact_archive_log
from lakeload.sinks.tables import LakeTable, clear_files
from lakeload.sources.archive import SOURCE_FILE
from lakeload.sources import (
    attach_lineage,
    direct_files,
    list_landing,
    list_tree,
    read_archive,
    read_archive_log,
    read_query,
    read_table,
)
from registry import extracts as x
from registry import query
from registry.histories import HISTORY_SQL

NOW = dt.datetime(2023, 3, 1, 8, 30, tzinfo=dt.timezone.utc)
START_OF_TIME = dt.datetime(1990, 1, 1, tzinfo=dt.timezone.utc)


def utc(ts):
    """Library stamps are instants; results show them without a zone."""
    return utc_clock(ts).cast("timestamp_ntz")


# ---- readers -------------------------------------------------------------------------


@query(
    "csv_scan",
    """SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_name AS part_name, p_type AS kind, p_brand AS brand
    FROM part""",
)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files of two layouts, names with spaces, all columns text."""
    folder = shared_dir(spark, "csv")
    part = x.table(spark, sf, "part")
    named = part.select(
        F.col("p_partkey").alias("part key"),
        F.col("p_name").alias("part name"),
        F.col("p_type").alias("kind"),
        F.col("p_brand").alias("brand"),
    )
    large = F.col("p_size") > 25
    first, second = f"{folder}/1", f"{folder}/2"
    writer = {"header": True, "sep": ";", "encoding": "ISO-8859-1"}
    named.where(large).write.options(**writer).csv(first)
    named.where(~large).select("brand", "part name", "kind", "part key").write.options(**writer).csv(second)
    rows = read_archive(spark, [first, second], "csv", encoding="ISO-8859-1", delimiter=";")
    return underscore_names(rows)


@query(
    "json_scan",
    """SELECT o_orderkey AS id, '{' || o_custkey || ', ' || o_orderstatus || '}' AS customer,
      '[' || o_orderkey || ', ' || o_custkey || ']' AS keys, o_orderpriority AS priority FROM orders""",
)
def json_scan(spark, sf):
    """Nested JSON lines, complex columns as text."""
    folder = shared_dir(spark, "json")
    x.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("a_key"), F.col("o_orderstatus").alias("b_status")).alias("customer"),
        F.array("o_orderkey", "o_custkey").alias("keys"),
        F.col("o_orderpriority").alias("priority"),
    ).write.json(f"{folder}/data")
    return complex_as_string(read_archive(spark, f"{folder}/data", "json"))


_DRIFT_SQL = """SELECT o_orderkey AS id, o_custkey AS cust,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority FROM orders"""


@query("parquet_scan_drifting", _DRIFT_SQL)
def parquet_scan_drifting(spark, sf):
    """A column appears and the key widens from int to long between files."""
    folder = shared_dir(spark, "parquet")
    rows = x.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cust"),
        F.col("o_orderpriority").alias("priority"),
        "o_orderstatus",
    )
    old = F.col("o_orderstatus") == "F"
    rows.where(old).select(F.col("id").cast("int"), "cust").write.parquet(f"{folder}/old")
    rows.where(~old).select("id", "cust", "priority").write.parquet(f"{folder}/new")
    return read_archive(spark, [f"{folder}/old", f"{folder}/new"])


# ---- landing to archive --------------------------------------------------------------

ORDER_ROWS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders"""


def whole_orders(spark, sf) -> DataFrame:
    """All columns; prices as decimals, which print alike everywhere."""
    return x.table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(15,2)"))


def orders_landed(spark, sf, purpose: str) -> str:
    """A lake with the orders as parquet files in its landing folder."""
    lake = shared_dir(spark, purpose)
    orders = whole_orders(spark, sf)
    orders.repartition("o_orderpriority").write.parquet(f"{lake}/ingest")
    return lake


def orders_by_day(spark, sf) -> DataFrame:
    """The orders of each day as one text; file names begin with a digit, ``_`` or ``.``."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    prefix = F.element_at(F.array(F.lit(""), F.lit("_"), F.lit(".")), F.dayofmonth("o_orderdate") % 3 + 1)
    keys = F.array_join(F.sort_array(F.collect_list("o_orderkey")), ";")
    return x.table(spark, sf, "orders").groupBy(F.concat(prefix, day).alias("name")).agg(keys.alias("value"))


@query(
    "list_landing",
    """SELECT ['', '_', '.'][CAST(day(o_orderdate) % 3 + 1 AS INTEGER)] || strftime(o_orderdate, '%Y%m%d') || '.csv' AS name,
      octet_length(encode(string_agg(CAST(o_orderkey AS VARCHAR), ';'))) + 1 AS size
    FROM orders GROUP BY ALL""",
)
def list_landing_query(spark, sf):
    """A file per day of orders, whatever its name; a folder named like a partition is not visited."""
    lake = shared_dir(spark, "landing")
    days = orders_by_day(spark, sf)
    x.write_named(days, "name", "value", f"{lake}/ingest", ".csv")
    x.write_named(days, "name", "value", f"{lake}/ingest/yr=2001", ".csv")
    files = list_landing(spark, f"{lake}/ingest")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))


@query("archive_batch", ORDER_ROWS_SQL)
def archive_batch_query(spark, sf):
    """Everything that landed is readable through the paths in the log."""
    lake = orders_landed(spark, sf, "archive")
    archive_job(spark, f"{lake}/ingest", f"{lake}/archive/orders", f"{lake}/log", now=NOW)
    return archived_rows(spark, lake)


def archived_rows(spark, lake: str) -> DataFrame:
    """Rows of all archived files; a file without its log row fails the query."""
    files = spark.read.option("recursiveFileLookup", True).parquet(f"{lake}/archive/orders")
    named = files.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    logged = attach_lineage(named, read_archive_log(spark, f"{lake}/log"), {"IsPurged": "purged"})
    return logged.where("NOT purged").drop(SOURCE_FILE, "purged")


@query(
    "archive_log_rows",
    """SELECT true AS sizes_kept, true AS named_by_time, true AS landing_empty, true AS order_kept,
      20230301 AS ArchiveyyyyMMddUTC, false AS IsPurged, false AS IsIgnorable FROM (SELECT max(o_orderkey) FROM orders)""",
)
def archive_log_rows(spark, sf):
    """The log matches the archived files; the landing folder is empty afterwards."""
    lake = orders_landed(spark, sf, "archivelog")
    archive_job(spark, f"{lake}/ingest", f"{lake}/archive/orders", now=NOW)
    log = read_archive_log(spark, f"{lake}/archive/orders/log")
    files = list_tree(spark, f"{lake}/archive/orders/2023").select(
        file_name(F.col("path")).alias("ArchiveFileName"), "length"
    )
    left = list_landing(spark, f"{lake}/ingest").agg(F.count(F.lit(1)).alias("n"))
    checked = log.join(files, "ArchiveFileName", "full")
    return checked.agg(
        F.bool_and(F.coalesce(F.col("length") == F.col("OriginalStagingFileSize"), F.lit(False))).alias("sizes_kept"),
        F.bool_and(F.col("ArchiveFilePath").rlike(r"/2023/03/01/08_30_[0-9a-f-]{36}\.parquet$")).alias("named_by_time"),
        (left.scalar() == 0).alias("landing_empty"),
        (F.count_distinct("ArchiveDatetimeUTC") == F.count(F.lit(1))).alias("order_kept"),
        F.max("ArchiveyyyyMMddUTC").alias("ArchiveyyyyMMddUTC"),
        F.max("IsPurged").alias("IsPurged"),
        F.max("IsIgnorable").alias("IsIgnorable"),
    )


# ---- archive to tables ---------------------------------------------------------------


def customer_archive(spark, sf, purpose: str, fmt: str = "parquet", log: bool = True) -> str:
    """A lake whose archive holds the yearly customer extracts and, unless told otherwise, their log."""
    lake = shared_dir(spark, purpose)
    orders = x.table(spark, sf, "orders").withColumn("yr", F.year("o_orderdate"))
    rows = x.customers_of(orders, x.table(spark, sf, "customer"), ["yr"])
    writer = rows.repartition("yr").write.partitionBy("yr")
    if fmt == "csv":
        writer.options(header=True, encoding="ISO-8859-1").csv(f"{lake}/archive/data")
    else:
        writer.format(fmt).save(f"{lake}/archive/data")
    if log:
        log_files(spark, f"{lake}/archive/data", f"{lake}/archive/log")
    return lake


def loaded_late(spark, lake: str, load, spec: LoadSpec, late, **options) -> None:
    """Load all files but those whose path matches ``late``, then these."""
    matches = F.col("path").rlike(late)
    for only in (~matches, matches):
        log_files(spark, f"{lake}/archive/data", f"{lake}/archive/log", only=only)
        load(spark, spec, **options)


LATE = "yr=(1996|1998)/"


def log_files(spark, data: str, log: str, every: str = "year", only=None) -> None:
    """Archive-log rows of the files below a folder, stamped by their ``yr=`` (and ``mon=``) folder;
    ``only`` chooses by the path."""
    # Files of one write share their names; archive file names are unique.
    folders = [F.regexp_extract("path", f"{k}=([0-9]+)", 1) for k in ("yr", "mon")]
    yr = folders[0].cast("int")
    if every == "year":
        ts = F.make_timestamp(yr + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    else:
        ts = F.make_timestamp(yr, folders[1].cast("int"), F.lit(28), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    files = list_tree(spark, data).where(F.col("path").contains("yr="))
    if only is not None:
        files = files.where(only)
    rows = files.select(
        ts.alias("ArchiveDatetimeUTC"),
        *[v.alias(k) for k, v in archive_calendar(utc_clock(ts)).items()],
        F.col("path").alias("OriginalStagingFilePath"),
        F.concat(F.lit("extract"), yr).alias("OriginalStagingFileName"),
        F.col("length").alias("OriginalStagingFileSize"),
        F.col("modificationTime").alias("OriginalModificationTime"),
        F.col("path").alias("ArchiveFilePath"),
        F.concat_ws("_", *folders, file_name(F.col("path"))).alias("ArchiveFileName"),
        F.lit(False).alias("IsPurged"),
        F.lit(None).cast("timestamp").alias("PurgeDatetimeUTC"),
        F.lit(False).alias("IsIgnorable"),
        F.lit(None).cast("string").alias("Notes"),
    )
    append_archive_log(rows, log)


def spec_of(lake: str, **options) -> LoadSpec:
    defaults = {"bk": "custkey", "hash_mode": "concat", "initial": START_OF_TIME}
    return LoadSpec(f"{lake}/archive/log", f"{lake}/table", f"{lake}/tablelog", **{**defaults, **options})


_SHOWN = "custkey, name, segment, status, __HashDiff, __ArchiveDatetimeUTC"
_LAST_CHANGE_SQL = f"""WITH {x.NUMBERED_YEARS_SQL},
    c AS (SELECT *, lag(__HashDiff) OVER (PARTITION BY custkey ORDER BY seq) AS prev FROM n),
    r AS (SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY seq DESC) AS rn FROM c
          WHERE prev IS NULL OR prev <> __HashDiff)"""


def shown(df: DataFrame, *more: str) -> DataFrame:
    names = [c.strip() for c in _SHOWN.split(",")] + list(more)
    return df.select(*[utc(F.col(c)).alias(c) if "Datetime" in c else F.col(c) for c in names])


@query("load_scd1", f"{_LAST_CHANGE_SQL} SELECT {_SHOWN} FROM r WHERE rn = 1")
def load_scd1_query(spark, sf):
    """All extracts loaded as one batch."""
    lake = customer_archive(spark, sf, "scd1")
    load_scd1(spark, spec_of(lake))
    return shown(LakeTable(spark, f"{lake}/table").read())


@query("load_scd1_in_batches", f"{_LAST_CHANGE_SQL} SELECT {_SHOWN} FROM r WHERE rn = 1")
def load_scd1_in_batches(spark, sf):
    """The same over several batches onto a partitioned table; customers move between partitions."""
    lake = customer_archive(spark, sf, "scd1b")
    spec = spec_of(lake, max_files=3, partition_by="status")
    load_scd1(spark, spec)
    return shown(LakeTable(spark, f"{lake}/table", ["status"]).read())


@query(
    "load_scd1_csv",
    f"""{_LAST_CHANGE_SQL} SELECT * REPLACE (CAST(custkey AS VARCHAR) AS custkey)
    FROM (SELECT {_SHOWN} FROM r WHERE rn = 1)""",
)
def load_scd1_csv(spark, sf):
    lake = customer_archive(spark, sf, "scd1csv", "csv")
    load_scd1(spark, spec_of(lake, fmt="csv"))
    return shown(LakeTable(spark, f"{lake}/table").read())


@query("load_scd1_json", f"{_LAST_CHANGE_SQL} SELECT {_SHOWN} FROM r WHERE rn = 1")
def load_scd1_json(spark, sf):
    lake = customer_archive(spark, sf, "scd1json", "json")
    load_scd1(spark, spec_of(lake, fmt="json", extract="custkey, name, segment, status"))
    return shown(LakeTable(spark, f"{lake}/table").read())


@query("load_scd1_late", f"{_LAST_CHANGE_SQL} SELECT {_SHOWN} FROM r WHERE rn = 1")
def load_scd1_late(spark, sf):
    """Two of the extracts are logged after all others were loaded."""
    lake = customer_archive(spark, sf, "scd1late", log=False)
    loaded_late(spark, lake, load_scd1, spec_of(lake, partition_by="status"), LATE)
    return shown(LakeTable(spark, f"{lake}/table", ["status"]).read())


@query(
    "load_first_run_lookback",
    f"""{_LAST_CHANGE_SQL.replace("*, dense_rank() OVER (ORDER BY __ArchiveDatetimeUTC) AS seq FROM y",
        "*, dense_rank() OVER (ORDER BY __ArchiveDatetimeUTC) AS seq FROM y WHERE __ArchiveDatetimeUTC > TIMESTAMP '1998-06-01 00:00:00'")}
    SELECT {_SHOWN}, 0 + (SELECT count(DISTINCT __ArchiveDatetimeUTC) FROM y
      WHERE __ArchiveDatetimeUTC <= TIMESTAMP '1998-06-01 00:00:00') AS before_start FROM r WHERE rn = 1""",
)
def load_first_run_lookback(spark, sf):
    """A first run that starts some days ago tells how many extracts are older."""
    lake = customer_archive(spark, sf, "lookback")
    days = (NOW.date() - dt.date(1998, 6, 1)).days
    result = load_scd1(spark, spec_of(lake, initial=None, initial_days=days), NOW)
    stamps = read_archive_log(spark, f"{lake}/archive/log").where("ArchiveDatetimeUTC <= '1998-06-01'")
    if result.before_start != stamps.count():
        raise AssertionError("the files left out are not counted")
    left = stamps.select(F.count_distinct("ArchiveDatetimeUTC").alias("before_start"))
    return shown(LakeTable(spark, f"{lake}/table").read()).withColumn("before_start", left.scalar())


@query("load_first_run_all", f"{_LAST_CHANGE_SQL} SELECT {_SHOWN} FROM r WHERE rn = 1")
def load_first_run_all(spark, sf):
    """Without a start a first run takes all extracts, however old."""
    lake = customer_archive(spark, sf, "firstall")
    load_scd1(spark, spec_of(lake, initial=None), NOW)
    return shown(LakeTable(spark, f"{lake}/table").read())


_VALID = f"{START}, {END}, __Current"


@query("load_scd2", f"{HISTORY_SQL} SELECT {_SHOWN}, {_VALID} FROM h")
def load_scd2_query(spark, sf):
    """Full history in batches of three files; older history is not rewritten."""
    lake = customer_archive(spark, sf, "scd2")
    load_scd2(spark, spec_of(lake, max_files=3))
    table = LakeTable(spark, f"{lake}/table", [END_DATE]).read()
    return shown(table, START, END, "__Current")


@query("load_scd2_late", f"{HISTORY_SQL} SELECT {_SHOWN}, {_VALID} FROM h")
def load_scd2_late(spark, sf):
    """The history is taken back to the late extracts' times and continued from there."""
    lake = customer_archive(spark, sf, "scd2late", log=False)
    loaded_late(spark, lake, load_scd2, spec_of(lake), LATE)
    return shown(LakeTable(spark, f"{lake}/table", [END_DATE]).read(), START, END, "__Current")


@query(
    "load_scd2_drifting",
    f"""WITH {x.NUMBERED_YEARS_SQL},
    d AS (SELECT * REPLACE (CASE WHEN __ArchiveDatetimeUTC > TIMESTAMP '1996-06-01 00:00:00' THEN segment END AS segment) FROM n),
    l AS (SELECT *, lag(seq) OVER w AS ps, lag(segment) OVER w AS pg, lag(name) OVER w AS pn, lag(status) OVER w AS pt
          FROM d WINDOW w AS (PARTITION BY custkey ORDER BY seq)),
    g AS (SELECT *, sum(CASE WHEN ps = seq - 1 AND pg IS NOT DISTINCT FROM segment AND pn IS NOT DISTINCT FROM name
                               AND pt IS NOT DISTINCT FROM status THEN 0 ELSE 1 END)
               OVER (PARTITION BY custkey ORDER BY seq) AS run FROM l),
    f AS (SELECT custkey, min(name) AS name, min(segment) AS segment, min(status) AS status, min(seq) AS lo, max(seq) AS hi
          FROM g GROUP BY custkey, run),
    t AS (SELECT DISTINCT seq, __ArchiveDatetimeUTC AS ts FROM n)
    SELECT custkey, name, segment, status, a.ts AS {START},
      coalesce(b.ts, TIMESTAMP '9999-12-31 00:00:00') AS {END}, b.ts IS NULL AS __Current
    FROM f JOIN t a ON a.seq = f.lo LEFT JOIN t b ON b.seq = f.hi + 1""",
)
def load_scd2_drifting(spark, sf):
    """Early extracts lack a column; the bounds of batches make no versions."""
    lake = shared_dir(spark, "scd2drift")
    orders = x.table(spark, sf, "orders").withColumn("yr", F.year("o_orderdate"))
    rows = x.customers_of(orders, x.table(spark, sf, "customer"), ["yr"])
    early = F.col("yr") < 1996
    for part in (rows.where(early).drop("segment"), rows.where(~early)):
        part.repartition("yr").write.mode("append").partitionBy("yr").parquet(f"{lake}/archive/data")
    log_files(spark, f"{lake}/archive/data", f"{lake}/archive/log")
    load_scd2(spark, spec_of(lake, hash_mode="safe", max_files=2))
    table = LakeTable(spark, f"{lake}/table", [END_DATE]).read()
    return table.select("custkey", "name", "segment", "status", utc(F.col(START)).alias(START), utc(F.col(END)).alias(END), "__Current")


_FACT_SQL = f"""WITH {x.NUMBERED_YEARS_SQL},
    c AS (SELECT *, lag(__HashDiff) OVER w AS ph, lag(seq) OVER w AS ps, max(seq) OVER (PARTITION BY custkey) AS hi,
                 (SELECT max(seq) FROM n) AS final FROM n WINDOW w AS (PARTITION BY custkey ORDER BY seq)),
    r AS (SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY seq DESC) AS rn FROM c
          WHERE ps IS NULL OR ps <> seq - 1 OR ph <> __HashDiff)
    SELECT {_SHOWN}, CASE WHEN hi < final THEN TIMESTAMP '2023-03-01 08:30:00' END AS __DeletedDatetimeUTC
    FROM r WHERE rn = 1"""


@query("load_fact", _FACT_SQL)
def load_fact_query(spark, sf):
    lake = customer_archive(spark, sf, "fact")
    load_fact(spark, spec_of(lake, max_files=3), now=NOW)
    return shown(LakeTable(spark, f"{lake}/table").read(), DELETED)


@query(
    "load_fact_sliced",
    """SELECT o_orderkey, o_custkey, o_orderpriority, year(o_orderdate) AS yr, month(o_orderdate) AS mon,
       CASE WHEN o_orderpriority = '1-URGENT' THEN TIMESTAMP '2023-03-01 08:30:00' END AS __DeletedDatetimeUTC FROM orders""",
)
def load_fact_sliced(spark, sf):
    """A second extract lacks the urgent orders: they are deleted inside the months it names."""
    lake = shared_dir(spark, "factslice")
    orders = x.table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.year("o_orderdate").cast("long").alias("year_of"),
        F.month("o_orderdate").cast("long").alias("month_of"),
    )
    kept = orders.where(F.col("o_orderpriority") != "1-URGENT")
    for year, part in ((2001, orders), (2002, kept)):
        part.repartition(4).write.parquet(f"{lake}/archive/data/yr={year}")
    log_files(spark, f"{lake}/archive/data", f"{lake}/archive/log")
    spec = spec_of(
        lake,
        bk="o_orderkey",
        extract="o_orderkey, o_custkey, o_orderpriority, year_of as yr, month_of as mon",
        delete_filter="yr, mon",
        partition_by="yr",
    )
    load_fact(spark, spec, now=NOW)
    table = LakeTable(spark, f"{lake}/table", ["yr"]).read()
    return table.select("o_orderkey", "o_custkey", "o_orderpriority", "yr", "mon", utc(F.col(DELETED)).alias(DELETED))


@query("load_fact_late", f"SELECT * EXCLUDE (__ArchiveDatetimeUTC) FROM ({_FACT_SQL})")
def load_fact_late(spark, sf):
    """A late full extract: the later ones decide again what exists.

    A row deleted since counts as revived by the late extract, so its lineage may name that one.
    """
    lake = customer_archive(spark, sf, "factlate", log=False)
    loaded_late(spark, lake, load_fact, spec_of(lake), LATE, now=NOW)
    return shown(LakeTable(spark, f"{lake}/table").read(), DELETED).drop("__ArchiveDatetimeUTC")


@query(
    "load_fact_csv",
    f"SELECT * REPLACE (CAST(custkey AS VARCHAR) AS custkey) FROM ({_FACT_SQL})",
)
def load_fact_csv(spark, sf):
    """CSV extracts: all columns text, rows without a key left out."""
    lake = customer_archive(spark, sf, "factcsv", "csv")
    load_fact(spark, spec_of(lake, fmt="csv", max_files=4), now=NOW)
    return shown(LakeTable(spark, f"{lake}/table").read(), DELETED)


@query("load_fact_json", _FACT_SQL)
def load_fact_json(spark, sf):
    """JSON extracts, their columns put in order by the select list."""
    lake = customer_archive(spark, sf, "factjson", "json")
    spec = spec_of(lake, fmt="json", extract="custkey, name, segment, status", max_files=4)
    load_fact(spark, spec, now=NOW)
    return shown(LakeTable(spark, f"{lake}/table").read(), DELETED)


def _entered(spark, sf) -> DataFrame:
    orders = x.table(spark, sf, "orders")
    return orders.select("o_orderkey", "o_orderpriority", F.month("o_orderdate").alias("mon"))


@query(
    "load_fact_late_slice",
    """SELECT o_orderkey, o_orderpriority, CAST(month(o_orderdate) AS INTEGER) AS mon,
      CASE WHEN o_orderpriority = '1-URGENT' AND month(o_orderdate) % 2 = 1
           THEN TIMESTAMP '2023-03-01 08:30:00' END AS __DeletedDatetimeUTC FROM orders""",
)
def load_fact_late_slice(spark, sf):
    """Urgent orders vanish in a late extract, and the even months, named later, have them again."""
    lake = shared_dir(spark, "factlateslice")
    orders = _entered(spark, sf)
    for year, part in ((2001, orders), (2002, orders.where("o_orderpriority <> '1-URGENT'")), (2003, orders.where("mon % 2 = 0"))):
        part.repartition(4).write.parquet(f"{lake}/archive/data/yr={year}")
    spec = spec_of(lake, bk="o_orderkey", delete_filter="mon", partition_by="mon")
    loaded_late(spark, lake, load_fact, spec, "yr=2002/", now=NOW)
    table = LakeTable(spark, f"{lake}/table", ["mon"]).read()
    return table.select("o_orderkey", "o_orderpriority", "mon", utc(F.col(DELETED)).alias(DELETED))


@query("load_fact_equal_stamp", "SELECT o_orderkey, o_orderpriority, false AS deleted FROM orders")
def load_fact_equal_stamp(spark, sf):
    """Two halves of one extract bear one stamp; the second is logged after the first was loaded."""
    lake = shared_dir(spark, "factequal")
    orders = _entered(spark, sf)
    for half in (0, 1):
        orders.where(F.col("o_orderkey") % 2 == half).repartition(3).write.parquet(f"{lake}/archive/data/yr=2001/half={half}")
    loaded_late(spark, lake, load_fact, spec_of(lake, bk="o_orderkey"), "half=1/", now=NOW)
    table = LakeTable(spark, f"{lake}/table").read()
    return table.select("o_orderkey", "o_orderpriority", F.col(DELETED).isNotNull().alias("deleted"))


@query(
    "load_scd1_frame",
    "SELECT s_suppkey, s_name, s_nationkey, sha256(concat_ws('||', s_suppkey, s_name, s_nationkey)) AS __HashDiff FROM supplier",
)
def load_scd1_frame_query(spark, sf):
    """A query result merged twice into a table; the second time nothing changes."""
    lake = shared_dir(spark, "frame")
    supplier = x.table(spark, sf, "supplier")
    for _ in range(2):
        load_scd1_frame(supplier, f"{lake}/table", "s_suppkey", exclude="s_acctbal", hash_mode="concat")
    return LakeTable(spark, f"{lake}/table").read().drop("__ModifiedDatetimeUTC")


@query(
    "skip_ignorable",
    f"""WITH {x.NUMBERED_YEARS_SQL} SELECT DISTINCT __ArchiveDatetimeUTC AS ArchiveDatetimeUTC FROM n
    WHERE __ArchiveDatetimeUTC <> TIMESTAMP '1998-01-01 00:00:00'""",
)
def skip_ignorable(spark, sf):
    """A file set aside by its operator is in no batch of files to load."""
    lake = customer_archive(spark, sf, "ignore")
    commit_ignorable(spark, f"{lake}/archive/log", "ArchiveYearUTC = 1998", "broken")
    seen: set[str] = set()
    stamps = []
    for batch in pending_batches(spark, spec_of(lake), NOW, seen):
        stamps += [(f["ArchiveDatetimeUTC"],) for f in batch]
        seen.update(f["ArchiveFilePath"] for f in batch)
    files = spark.createDataFrame(stamps, "ArchiveDatetimeUTC timestamp")
    return files.select(utc(F.col("ArchiveDatetimeUTC")).alias("ArchiveDatetimeUTC"))


# ---- publish, stage, export ----------------------------------------------------------

_PUBLISHED_SQL = f"""WITH {x.NUMBERED_YEARS_SQL}
  SELECT custkey, upper(segment) AS segment, __ArchiveDatetimeUTC,
         'extract' || (year(__ArchiveDatetimeUTC) - 1) AS __OriginalStagingFileName FROM n"""


@query("publish_select", _PUBLISHED_SQL)
def publish_select_query(spark, sf):
    """Two runs: the second finds nothing new."""
    lake = customer_archive(spark, sf, "publish")
    for _ in range(2):
        publish_select(
            spark,
            f"{lake}/archive/log",
            f"{lake}/publishlog",
            f"{lake}/published",
            extract="[custkey], upper([segment]) as segment",
            initial=START_OF_TIME,
        )
    rows = spark.read.parquet(f"{lake}/published")
    return rows.withColumn("__ArchiveDatetimeUTC", utc(F.col("__ArchiveDatetimeUTC")))


@query(
    "publish_select_csv",
    _PUBLISHED_SQL.replace("SELECT custkey,", "SELECT CAST(custkey AS VARCHAR) AS custkey,"),
)
def publish_select_csv(spark, sf):
    lake = customer_archive(spark, sf, "publishcsv", "csv")
    publish_select(
        spark,
        f"{lake}/archive/log",
        f"{lake}/publishlog",
        f"{lake}/published",
        "csv",
        extract="custkey, upper(segment) as segment",
        delimiter=",",
        initial=START_OF_TIME,
    )
    rows = spark.read.parquet(f"{lake}/published")
    return rows.withColumn("__ArchiveDatetimeUTC", utc(F.col("__ArchiveDatetimeUTC")))


@query("publish_as_is", f"WITH {x.NUMBERED_YEARS_SQL} SELECT custkey, name, segment, status FROM n")
def publish_as_is_query(spark, sf):
    """Copied byte for byte into a folder that is cleared first."""
    lake = customer_archive(spark, sf, "asis")
    x.table(spark, sf, "region").write.parquet(f"{lake}/published")
    publish_as_is(
        spark,
        f"{lake}/archive/log",
        f"{lake}/publishlog",
        f"{lake}/published",
        ".parquet",
        clear_target=True,
        initial=START_OF_TIME,
    )
    return spark.read.parquet(f"{lake}/published")


@query("clear_target", ORDER_ROWS_SQL)
def clear_target(spark, sf):
    """A published copy of the orders and files of any name go; a sub-folder stays."""
    lake = shared_dir(spark, "clear")
    orders = whole_orders(spark, sf)
    orders.repartition(8).write.parquet(f"{lake}/published")
    orders.write.parquet(f"{lake}/published/kept=1")
    x.write_named(orders_by_day(spark, sf), "name", "value", f"{lake}/published", ".csv")
    clear_files(spark, f"{lake}/published")
    if not direct_files(spark, f"{lake}/published").isEmpty():
        raise AssertionError("files are left")
    return spark.read.option("recursiveFileLookup", True).parquet(f"{lake}/published")


@query(
    "stage_rows",
    f"""WITH {x.NUMBERED_YEARS_SQL} SELECT custkey, name, segment, status, __ArchiveDatetimeUTC,
      'extract' || (year(__ArchiveDatetimeUTC) - 1) AS __OriginalStagingFileName FROM n""",
)
def stage_rows(spark, sf):
    """What a staging table receives: all pending files united."""
    lake = customer_archive(spark, sf, "stage")
    spec = spec_of(lake)
    seen: set[str] = set()
    files = []
    for batch in pending_batches(spark, spec, NOW, seen):
        files += batch
        seen.update(f["ArchiveFilePath"] for f in batch)
    rows = published_rows(spark, spec, files)
    return rows.withColumn("__ArchiveDatetimeUTC", utc(F.col("__ArchiveDatetimeUTC")))


@query(
    "stage_job",
    f"""WITH {x.NUMBERED_YEARS_SQL} SELECT custkey, name, segment, status, __ArchiveDatetimeUTC,
      'extract' || (year(__ArchiveDatetimeUTC) - 1) AS __OriginalStagingFileName FROM n""",
)
def stage_job(spark, sf):
    """The staging job in batches of two files, through a Parquet writer; a second run stages nothing."""
    lake = customer_archive(spark, sf, "stagejob")
    for _ in range(2):
        stage_to(
            spark,
            f"{lake}/archive/log",
            f"{lake}/stagelog",
            lambda df: df.write.mode("overwrite").parquet(f"{lake}/staged"),
            initial=START_OF_TIME,
            max_files=2,
        )
    rows = spark.read.parquet(f"{lake}/staged")
    return rows.withColumn("__ArchiveDatetimeUTC", utc(F.col("__ArchiveDatetimeUTC")))


@query("export_twice", "SELECT event_id, event_type FROM events")
def export_twice(spark, sf):
    """The first export takes all events, the second none: together each event once."""
    lake = shared_dir(spark, "export")
    events = x.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        export_frame(
            events,
            f"{lake}/log",
            lambda df: df.write.mode("append").parquet(f"{lake}/out"),
            columns="event_id, event_type",
            track_col="ts",
        )
    return spark.read.parquet(f"{lake}/out")


# ---- maintenance ---------------------------------------------------------------------


@query("compact_table", ORDER_ROWS_SQL)
def compact_table(spark, sf):
    """Many small files joined; the older snapshot removed."""
    lake = shared_dir(spark, "compact")
    table = LakeTable(spark, f"{lake}/table")
    table.write(whole_orders(spark, sf).repartition(16))
    table.compact()
    if table.expire(1) != [table.folder(1)]:
        raise AssertionError("the first snapshot should be removed")
    return table.read()


@query("compact_log", f"WITH {x.NUMBERED_YEARS_SQL} SELECT DISTINCT CAST(year(__ArchiveDatetimeUTC) AS INTEGER) AS ArchiveYearUTC FROM n")
def compact_log(spark, sf):
    lake = customer_archive(spark, sf, "compactlog")
    compact_archive_log(spark, f"{lake}/archive/log", min_files=1)
    return read_archive_log(spark, f"{lake}/archive/log").select("ArchiveYearUTC")


@query("table_partition_replace", f"SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END AS o_custkey) FROM ({ORDER_ROWS_SQL}) WHERE o_orderstatus <> 'F'")
def table_partition_replace(spark, sf):
    """One partition rewritten, one emptied, one left as it is."""
    lake = shared_dir(spark, "replace")
    orders = whole_orders(spark, sf)
    table = LakeTable(spark, f"{lake}/table", ["o_orderstatus"])
    table.write(orders)
    new = orders.where("o_orderstatus = 'P'").withColumn("o_custkey", F.lit(0).cast("long"))
    touched = orders.where("o_orderstatus in ('P', 'F')").select("o_orderstatus").distinct()
    table.replace(lambda _: new, touched)
    return table.read()


@query(
    "purge_files",
    """SELECT yr, mon, row_number() OVER (PARTITION BY yr ORDER BY mon DESC) > 1 AS IsPurged,
      row_number() OVER (PARTITION BY yr ORDER BY mon DESC) = 1 AS file_exists
    FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mon FROM orders)""",
)
def purge_files(spark, sf):
    """One file per month, only the last of each year kept: files go, the log says so."""
    lake = shared_dir(spark, "purge")
    orders = x.table(spark, sf, "orders").withColumns({"yr": F.year("o_orderdate"), "mon": F.month("o_orderdate")})
    orders.repartition("yr", "mon").write.partitionBy("yr", "mon").parquet(f"{lake}/archive/data")
    log_files(spark, f"{lake}/archive/data", f"{lake}/archive/log", "month")
    purge_job(
        spark,
        {"archive_orders": f"{lake}/archive/log"},
        now=NOW,
        dry_run=False,
        keep_month=False,
        keep_week=False,
        keep_day=False,
    )
    left = list_tree(spark, f"{lake}/archive/data").select(
        F.col("path").alias("ArchiveFilePath"), F.lit(True).alias("file_exists")
    )
    log = read_archive_log(spark, f"{lake}/archive/log").join(left, "ArchiveFilePath", "left")
    return log.select(
        F.col("ArchiveYearUTC").alias("yr"),
        F.col("ArchiveMonthUTC").alias("mon"),
        "IsPurged",
        F.coalesce("file_exists", F.lit(False)).alias("file_exists"),
    )


@query("lake_table_scan", "SELECT o_orderkey, upper(o_orderstatus) AS status FROM orders")
def lake_table_scan(spark, sf):
    x.table(spark, sf, "orders").createOrReplaceTempView("lake_orders")
    return read_table(spark, "lake_orders", "[o_orderkey], upper(o_orderstatus) as status")


@query("lake_query_scan", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 5")
def lake_query_scan(spark, sf):
    x.table(spark, sf, "orders").createOrReplaceTempView("lake_orders")
    return read_query(spark, "SELECT o_custkey, count(*) AS n FROM lake_orders GROUP BY o_custkey HAVING count(*) > 5")
