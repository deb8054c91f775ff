"""Lake tables, lake queries, archive-log tables and JDBC queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.identifiers import quote
from lakeload.operators.projection import extract
from lakeload.operators.retention import choose_tables


def read_table(spark: SparkSession, name: str, columns: str | Sequence[str] = "*") -> DataFrame:
    return extract(spark.table(name), columns)


def read_query(spark: SparkSession, sql: str, columns: str | Sequence[str] = "*") -> DataFrame:
    return extract(spark.sql(sql), columns)


def archive_tables(
    spark: SparkSession,
    database: str,
    include: Sequence[str] = ("archive_",),
    exclude: Sequence[str] = (),
) -> list[str]:
    """Registered archive logs by name prefix."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return choose_tables(sorted(names), tuple(include), tuple(exclude))


def archive_log_locations(
    spark: SparkSession, database: str, include: Sequence[str] = ("archive_",), exclude: Sequence[str] = ()
) -> dict[str, str]:
    """Folders of the registered archive logs chosen by prefix, by qualified table name."""
    found = {}
    for name in archive_tables(spark, database, include, exclude):
        qualified = f"{quote(database)}.{quote(name)}"
        about = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}").where("col_name = 'Location'")
        found[qualified] = about.first()["data_type"]
    return found


def read_archive_tables(spark: SparkSession, database: str, names: Sequence[str]) -> DataFrame:
    """Several archive logs as one frame with ``ArchiveTable``, for one retention job over all."""
    frames = []
    for name in names:
        qualified = f"{quote(database)}.{quote(name)}"
        frames.append(spark.table(qualified).withColumn("ArchiveTable", F.lit(qualified)))
    if not frames:
        raise ValueError("no archive tables")
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)
    return union


def jdbc_options(
    url: str,
    sql: str,
    *,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options of a source query; with a partition column Spark reads ranges in parallel."""
    options = {"url": url, "dbtable": f"({sql}) SRC", "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partition column needs lower, upper and partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(
    spark: SparkSession, url: str, sql: str, columns: str | Sequence[str] = "*", **options
) -> DataFrame:
    return extract(spark.read.format("jdbc").options(**jdbc_options(url, sql, **options)).load(), columns)
