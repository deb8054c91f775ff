"""Readers for archived files and logs."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.captured import CapturedException

from lakeload.functions.identifiers import column
from lakeload.operators.alignment import union_drifting
from lakeload.operators.matching import members
from lakeload.schemas import ARCHIVE_LOG, EXPORT_LOG, PROCESS_LOG
from lakeload.sources.census import header_census, reachable, schema_census

# CSV defaults of table loads and of publish and staging jobs.
LOAD_CSV = {"encoding": "ISO-8859-1", "sep": ","}
PUBLISH_CSV = {"sep": ";"}

SOURCE_FILE = "__SourceFile"

# What Spark raises for data it cannot read or write.
SPARK_ERRORS = (CapturedException, Py4JJavaError)


def read_archive(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "parquet",
    *,
    encoding: str | None = None,
    delimiter: str | None = None,
    with_file: bool = False,
) -> DataFrame:
    """Archived files of one format as one frame; drifting schemas are united.

    ``with_file`` adds the path of each row's file, the key to the archive log.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "parquet":
        return _read_parquet(spark, paths, with_file)
    if fmt == "json":
        return _named(spark.read.json(paths), with_file)
    if fmt == "csv":
        return _read_csv(spark, paths, encoding, delimiter or ",", with_file)
    raise ValueError(f"unknown format: {fmt}")


def _named(df: DataFrame, with_file: bool) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path")) if with_file else df


def _read_parquet(spark: SparkSession, paths: list[str], with_file: bool) -> DataFrame:
    try:
        # Columns that come and go are merged by the scan itself.
        return _named(spark.read.option("mergeSchema", True).parquet(*paths), with_file)
    except SPARK_ERRORS as error:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    # A column changed its type: one scan per distinct schema, widened and united.
    if reachable(paths):
        kinds = list(schema_census(spark, paths).values())
    else:
        kinds = [[path] for path in paths]
    by_schema: dict[str, list[str]] = {}
    for same in kinds:
        by_schema.setdefault(spark.read.parquet(same[0]).schema.json(), []).extend(same)
    return union_drifting([_named(spark.read.parquet(*group), with_file) for group in by_schema.values()])


def _read_csv(
    spark: SparkSession, paths: list[str], encoding: str | None, delimiter: str, with_file: bool
) -> DataFrame:
    options = {"header": True, "sep": delimiter}
    if encoding:
        options["encoding"] = encoding
    # Spark takes the header of one file for all, so files are read per distinct header.
    if len(paths) > 1 and reachable(paths):
        kinds = list(header_census(spark, paths, encoding).values())
    else:
        kinds = [[path] for path in paths]
    by_header: dict[tuple[str, ...], list[str]] = {}
    for same in kinds or [paths[:1]]:
        by_header.setdefault(tuple(spark.read.options(**options).csv(same[0]).columns), []).extend(same)
    frames = []
    for header, group in by_header.items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        frames.append(_named(spark.read.options(**options).schema(schema).csv(group), with_file))
    return union_drifting(frames)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A log written by this library, None before its first row."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise


def log_frame(spark: SparkSession, files: Sequence[Row]) -> DataFrame:
    """Collected archive-log rows of one batch as a frame again."""
    names = ARCHIVE_LOG.fieldNames()
    return spark.createDataFrame([tuple(f[n] for n in names) for f in files], ARCHIVE_LOG)


def read_archive_log(spark: SparkSession, path: str) -> DataFrame | None:
    return read_log(spark, path, ARCHIVE_LOG)


def read_process_log(spark: SparkSession, path: str) -> DataFrame | None:
    return read_log(spark, path, PROCESS_LOG)


def read_export_log(spark: SparkSession, path: str) -> DataFrame | None:
    return read_log(spark, path, EXPORT_LOG)


def attach_lineage(rows: DataFrame, files: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Log columns of each row's file, found by its path; ``columns`` maps log to result names.

    A row whose file is not listed fails the query instead of vanishing.
    """
    lookup = files.select(
        scan_path(column("ArchiveFilePath")).alias(SOURCE_FILE),
        *[column(k).alias(v) for k, v in columns.items()],
        F.lit(True).alias("__listed"),
    )
    # Scans name their files URL-encoded, the log as they are.
    scanned = F.url_decode(F.replace(F.col(SOURCE_FILE), F.lit("+"), F.lit("%2B")))
    keyed = rows.withColumn(SOURCE_FILE, scan_path(scanned))
    found = members(keyed, lookup, [SOURCE_FILE], "left_outer")
    failure = F.raise_error(F.concat(F.lit("no archive log row for "), F.col(SOURCE_FILE))).cast("boolean")
    return found.where(F.when(F.col("__listed").isNull(), failure).otherwise(F.lit(True))).drop("__listed")


def read_logged(
    spark: SparkSession,
    files: Sequence[Row],
    columns: dict[str, str],
    fmt: str,
    encoding: str | None = None,
    delimiter: str | None = None,
) -> DataFrame:
    """Rows of the logged files with log columns beside them."""
    paths = [f["ArchiveFilePath"] for f in files]
    if len(files) == 1:
        raw = read_archive(spark, paths, fmt, encoding=encoding, delimiter=delimiter)
        types = ARCHIVE_LOG
        return raw.withColumns({v: F.lit(files[0][k]).cast(types[k].dataType) for k, v in columns.items()})
    raw = read_archive(spark, paths, fmt, encoding=encoding, delimiter=delimiter, with_file=True)
    return attach_lineage(raw, log_frame(spark, files), columns).drop(SOURCE_FILE)


def scan_path(path):
    """One spelling of a path: plain local paths and ``file:/x``, ``file:///x`` agree."""
    plain = F.regexp_replace(path, "^file:/*", "/")
    return F.when(path.rlike("^(file:)?/"), plain).otherwise(path)
