"""Listing of a landing folder."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.schemas import FILE_LISTING
from lakeload.session import shared_dir
from lakeload.sinks.storage import Storage


def complete_file() -> Column:
    """Files that are uploaded whole: not empty and without the upload suffix."""
    return (F.col("length") > 0) & ~F.col("path").endswith(".partial")


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """Complete files directly below a folder: path, modificationTime, length; none without the folder."""
    return direct_files(spark, path).where(complete_file())


def direct_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder itself, whatever they or its sub-folders are called.

    The file system's own listing of the one folder, taken in batches: sub-folders are not
    visited.  More than a batch is written to the shared folder, so the driver holds one batch.
    """
    batches = Storage(spark, path).file_batches(path)
    first = next(batches, [])
    second = next(batches, None)
    if second is None:
        return spark.createDataFrame(first, FILE_LISTING)
    folder = shared_dir(spark, "listing")
    for batch in chain([first, second], batches):
        spark.createDataFrame(batch, FILE_LISTING).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema(FILE_LISTING).parquet(folder)


def list_tree(spark: SparkSession, path: str) -> DataFrame:
    """All files below a folder, sub-folders included."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.load(path).select(FILE_LISTING.fieldNames())
