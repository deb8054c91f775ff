"""Extracts derived from the given tables, as Spark frames and as SQL.

Customer extracts show each customer by its latest order in a period, so that
customers change, stay, appear and vanish between periods.  Order extracts show
orders first as entered (all open) and later with their real status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions import row_hash
from lakeload.operators import keep_last
from lakeload.sinks.files import locator
from lakeload.schemas import ARCHIVE_FILE, ARCHIVED, MODIFIED, STAGING_NAME

SPLIT = "1998-06-01 00:00:00"
BASE_TS = "2023-01-01 06:00:00"
DELTA_TS = "2023-02-01 06:00:00"
NOW_BASE = "2023-01-01 07:00:00"
NOW_DELTA = "2023-02-01 07:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def lineage(df: DataFrame, now: Column, archive_ts: Column, path: Column, name: Column) -> DataFrame:
    return df.withColumns({MODIFIED: now, ARCHIVED: archive_ts, ARCHIVE_FILE: path, STAGING_NAME: name})


def base_lineage(df: DataFrame, entity: str) -> DataFrame:
    return lineage(
        df, stamp(NOW_BASE), stamp(BASE_TS), F.lit(f"archive/{entity}/1.parquet"), F.lit(f"{entity}1.parquet")
    )


def delta_lineage(df: DataFrame, entity: str) -> DataFrame:
    return lineage(
        df, stamp(NOW_DELTA), stamp(DELTA_TS), F.lit(f"archive/{entity}/2.parquet"), F.lit(f"{entity}2.parquet")
    )


def lineage_sql(entity: str, n: int) -> str:
    now, ts = (NOW_BASE, BASE_TS) if n == 1 else (NOW_DELTA, DELTA_TS)
    return (
        f"TIMESTAMP '{now}' AS __ModifiedDatetimeUTC, TIMESTAMP '{ts}' AS __ArchiveDatetimeUTC, "
        f"'archive/{entity}/{n}.parquet' AS __ArchiveFilePath, '{entity}{n}.parquet' AS __OriginalStagingFileName"
    )


LINEAGE_COLS = ["__ModifiedDatetimeUTC", "__ArchiveDatetimeUTC", "__ArchiveFilePath", "__OriginalStagingFileName"]

# ---- customers by their latest order in a period -------------------------------------

CUSTOMER_COLS = ["custkey", "name", "segment", "status"]


def customers_of(orders: DataFrame, customer: DataFrame, per: list[str] | None = None) -> DataFrame:
    """One row per customer (and period): the latest order's status beside the customer's data."""
    per = per or []
    last = keep_last(
        orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", *per),
        ["o_custkey", *per],
        ["o_orderdate", "o_orderkey"],
    )
    return last.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderstatus").alias("status"),
        *per,
    )


def customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < stamp(SPLIT))
    rows = customers_of(orders, table(spark, sf_dir, "customer"))
    return base_lineage(row_hash(rows, mode="concat"), "customer")


def customer_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= stamp(SPLIT))
    rows = customers_of(orders, table(spark, sf_dir, "customer"))
    return delta_lineage(row_hash(rows, mode="concat"), "customer")


def hash_sql(cols: list[str]) -> str:
    return f"sha256(concat_ws('||', {', '.join(cols)})) AS __HashDiff"


def _customer_sql(period: str, n: int) -> str:
    return f"""
      SELECT custkey, name, segment, status, {hash_sql(CUSTOMER_COLS)}, {lineage_sql('customer', n)}
      FROM (
        SELECT c_custkey AS custkey, c_name AS name, c_mktsegment AS segment, o_orderstatus AS status,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE {period}
      ) WHERE rn = 1"""


CUSTOMER_BASE_SQL = _customer_sql(f"o_orderdate < TIMESTAMP '{SPLIT}'", 1)
CUSTOMER_DELTA_SQL = _customer_sql(f"o_orderdate >= TIMESTAMP '{SPLIT}'", 2)

# ---- a full customer extract per year of orders --------------------------------------


def _taken() -> Column:
    return F.make_timestamp_ntz(F.col("yr") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def _year_path() -> Column:
    return F.concat(F.lit("archive/customer/"), F.col("yr"), F.lit(".parquet"))


def customer_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each extract has a customer once, by construction."""
    orders = table(spark, sf_dir, "orders").withColumn("yr", F.year("o_orderdate"))
    rows = row_hash(customers_of(orders, table(spark, sf_dir, "customer"), ["yr"]), CUSTOMER_COLS, "concat")
    name = F.concat(F.lit("customer"), F.col("yr"), F.lit(".parquet"))
    return lineage(rows, stamp(NOW_DELTA), _taken(), _year_path(), name).drop("yr")


def customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of yearly extracts: path and archive time."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("yr")).distinct()
    return years.select(_year_path().alias(ARCHIVE_FILE), _taken().alias(ARCHIVED))


CUSTOMER_YEARS_SQL = f"""
      SELECT custkey, name, segment, status, {hash_sql(CUSTOMER_COLS)},
             TIMESTAMP '{NOW_DELTA}' AS __ModifiedDatetimeUTC,
             make_timestamp(yr + 1, 1, 1, 0, 0, 0.0) AS __ArchiveDatetimeUTC,
             'archive/customer/' || yr || '.parquet' AS __ArchiveFilePath,
             'customer' || yr || '.parquet' AS __OriginalStagingFileName
      FROM (
        SELECT c_custkey AS custkey, c_name AS name, c_mktsegment AS segment, o_orderstatus AS status,
               year(o_orderdate) AS yr,
               row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders JOIN customer ON o_custkey = c_custkey
      ) WHERE rn = 1"""

# Rows of the yearly extracts with the dense number of their extract.
NUMBERED_YEARS_SQL = f"""
      y AS ({CUSTOMER_YEARS_SQL}),
      n AS (SELECT *, dense_rank() OVER (ORDER BY __ArchiveDatetimeUTC) AS seq FROM y)"""

# ---- orders: as entered, then with their real status ---------------------------------

ORDER_COLS = ["orderkey", "custkey", "status", "total", "orderdate", "yr", "mon"]


def _order_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("total"),
        F.col("o_orderdate").cast("date").alias("orderdate"),
        F.year("o_orderdate").alias("yr"),
        F.month("o_orderdate").alias("mon"),
    )


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < stamp("2000-01-01"))
    rows = _order_rows(orders.withColumn("o_orderstatus", F.lit("O")))
    return base_lineage(row_hash(rows, mode="concat"), "orders")


def order_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= stamp("1998-01-01"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    kept = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return delta_lineage(row_hash(_order_rows(kept), mode="concat"), "orders")


def _order_sql(status: str, where: str, n: int) -> str:
    return f"""
      SELECT *, {hash_sql(ORDER_COLS)}, {lineage_sql('orders', n)}
      FROM (
        SELECT o_orderkey AS orderkey, o_custkey AS custkey, {status} AS status,
               CAST(o_totalprice AS DECIMAL(15,2)) AS total, CAST(o_orderdate AS DATE) AS orderdate,
               CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mon
        FROM orders WHERE {where}
      )"""


ORDER_BASE_SQL = _order_sql("'O'", "o_orderdate < TIMESTAMP '2000-01-01'", 1)
ORDER_DELTA_SQL = _order_sql(
    "o_orderstatus",
    "o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)",
    2,
)


def write_named(df: DataFrame, name_col: str, text_col: str, folder: str, suffix: str) -> None:
    """One text file per row, named by a column; the tasks write."""
    locate = locator()

    def run(batches):
        for batch in batches:
            system, target = locate(folder)
            system.create_dir(target, recursive=True)
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_output_stream(f"{target}/{name}{suffix}") as out:
                    out.write(f"{text}\n".encode())
            yield batch.slice(0, 0)

    chosen = df.select(name_col, text_col)
    chosen.mapInArrow(run, chosen.schema).count()
