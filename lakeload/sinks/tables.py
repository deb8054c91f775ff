"""Parquet tables as snapshot folders, and replacement of single partitions.

A table is ``<path>/v=<n>/``; the newest folder with Spark's ``_SUCCESS`` mark is the
table.  One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.identifiers import column, quote
from lakeload.operators.matching import members
from lakeload.session import COMPACT_FILE_BYTES
from lakeload.sinks.storage import Storage

_FOLDER = r"^(.*)/[^/]*$"


def save_meta(spark: SparkSession, path: str, meta: dict) -> None:
    Storage(spark, path).write_text(path, json.dumps(meta))


def load_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(Storage(spark, path).read_text(path))


def write_balanced(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append") -> None:
    """Write in files of the advisory size: adaptive execution splits large partitions and joins small ones."""
    writer = df.hint("rebalance", *partition_by).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(
    spark: SparkSession,
    path: str,
    state_of: Callable[[DataFrame], DataFrame],
    touched: DataFrame,
    partition_by: Sequence[str],
    schema: T.StructType | None = None,
    notes: dict | None = None,
) -> None:
    """Give the touched partitions of a folder the content ``state_of(touched)``.

    The new content may be computed from the folder itself: it is written aside
    first, as are the touched values, so neither is computed twice.  What was written
    aside is complete or absent, so an interrupted replacement is finished by
    :func:`finish_replacements`.  Without a ``schema`` the folder keeps its column
    types in ``_meta``.
    """
    stage = f"{path}/_stage/{uuid.uuid4().hex}"
    touched.distinct().write.parquet(f"{stage}/touched")
    df = state_of(spark.read.schema(touched.schema).parquet(f"{stage}/touched"))
    if schema is None:
        save_meta(spark, f"{stage}/meta", {"schema": df.schema.jsonValue(), **(notes or {})})
    write_balanced(df, f"{stage}/data", partition_by)
    _apply_stage(spark, path, stage, partition_by, schema or df.schema)


def restrict_partitions(df: DataFrame, touched: DataFrame, columns: Sequence[str], limit: int = 1000) -> DataFrame:
    """Rows in the touched partitions; the join makes the result exact in any case."""
    return members(name_partitions(df, touched, columns, limit), touched, columns)


def name_partitions(df: DataFrame, touched: DataFrame, columns: Sequence[str], limit: int = 1000) -> DataFrame:
    """Up to ``limit`` touched values named in a filter, so that the scan lists and reads only
    their folders; beyond that all of ``df``."""
    few = touched.select(*[column(c) for c in columns]).limit(limit + 1).collect()
    if len(few) <= limit:
        for i, name in enumerate(columns):
            values = {r[i] for r in few}
            named = column(name).isin([v for v in values if v is not None])
            df = df.where(named | column(name).isNull() if None in values else named)
    return df


def finish_replacements(
    spark: SparkSession, path: str, partition_by: Sequence[str], schema: T.StructType
) -> None:
    storage = Storage(spark, path)
    for name in storage.folders(f"{path}/_stage"):
        stage = f"{path}/_stage/{name}"
        if storage.exists(f"{stage}/data/_SUCCESS"):
            _apply_stage(spark, path, stage, partition_by, schema)
        else:
            storage.remove(stage)


def _apply_stage(
    spark: SparkSession, path: str, stage: str, partition_by: Sequence[str], schema: T.StructType
) -> None:
    storage = Storage(spark, path)
    meta = load_meta(spark, f"{stage}/meta") if storage.exists(f"{stage}/meta") else None
    if meta is not None:
        schema = T.StructType.fromJson(meta["schema"])
    data = spark.read.schema(schema).parquet(f"{stage}/data")
    touched = spark.read.parquet(f"{stage}/touched")
    emptied: list[str] = []
    if storage.exists(path) and any("=" in f for f in storage.folders(path)):
        # Partitions that were touched but hold no rows any more.
        parts = [column(c) for c in partition_by]
        old = name_partitions(spark.read.schema(schema).parquet(path), touched, touched.columns)
        folders = old.select(*parts, F.regexp_extract("_metadata.file_path", _FOLDER, 1).alias("__folder")).distinct()
        folders = members(folders, touched, touched.columns)
        left = members(folders, data.select(*parts).distinct(), partition_by, "left_anti")
        emptied = [unquote(r[0]) for r in left.select("__folder").toLocalIterator()]
    # The staged files are balanced already, each of one partition.
    writer = data.write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    for folder in emptied:
        storage.remove(folder)
    if meta is not None:
        save_meta(spark, f"{path}/_meta", meta)
    storage.remove(stage)


def compact_partitions(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    schema: T.StructType,
    small_bytes: int = COMPACT_FILE_BYTES // 2,
    min_files: int = 8,
    where: Column | None = None,
) -> bool:
    """Rewrite the partitions that hold many small files; False when there are none.

    ``where`` names the partitions to look at, so that a long log is not searched whole.
    """
    parts = [column(c) for c in partition_by]
    stored = spark.read.schema(schema).parquet(path)
    files = (
        (stored if where is None else stored.where(where))
        .select(*parts, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size"))
        .distinct()
    )
    crowded = (
        files.where(F.col("size") < small_bytes)
        .groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_files)
        .select(*parts)
    )
    if crowded.isEmpty():
        return False
    replace_partitions(
        spark, path, lambda touched: restrict_partitions(stored, touched, partition_by), crowded, partition_by, schema
    )
    return True


class LakeTable:
    """Snapshot table at a path, optionally partitioned."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)
        self._storage = Storage(spark, self.path)

    def versions(self) -> list[int]:
        """Numbers of the complete snapshots, oldest first."""
        found = [f for f in self._storage.folders(self.path) if f.startswith("v=")]
        return [int(f[2:]) for f in found if self._storage.exists(f"{self.path}/{f}/_SUCCESS")]

    def folder(self, version: int) -> str:
        return f"{self.path}/v={version:08d}"

    @property
    def current(self) -> str | None:
        versions = self.versions()
        return self.folder(versions[-1]) if versions else None

    def exists(self) -> bool:
        return self.current is not None

    def meta(self) -> dict:
        """Column types as written (folder names alone would turn text like ``01`` into
        numbers), ``applied``, the last stamp in the table, and ``paths``, the files of the
        last batch that went into it."""
        return load_meta(self.spark, f"{self.current}/_meta")

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.meta()["schema"])

    def applied(self) -> str | None:
        return self.meta().get("applied") if self.exists() else None

    def paths(self) -> set[str]:
        return set(self.meta().get("paths") or ()) if self.exists() else set()

    def read(self) -> DataFrame | None:
        folder = self.current
        if folder is None:
            return None
        if self.partition_by:
            finish_replacements(self.spark, folder, self.partition_by, self.schema())
        return self.spark.read.schema(self.schema()).parquet(folder)

    def write(self, df: DataFrame, applied: str | None = None, paths: Sequence[str] = ()) -> str:
        """A new snapshot.

        Without partitions the rows are written as the plan deals them out: adaptive execution
        sizes the tasks of its last shuffle, and another one would only move the table again.
        """
        folder = self.folder((self.versions() or [0])[-1] + 1)
        self._storage.remove(folder)
        save_meta(self.spark, f"{folder}/_meta", {"schema": df.schema.jsonValue(), "applied": applied, "paths": list(paths)})
        if self.partition_by:
            write_balanced(df, folder, self.partition_by)
        else:
            df.write.mode("append").parquet(folder)
        return folder

    def replace(
        self,
        state_of: Callable[[DataFrame], DataFrame],
        touched: DataFrame,
        applied: str | None = None,
        paths: Sequence[str] = (),
    ) -> str:
        """New content of the touched partitions inside the current snapshot."""
        replace_partitions(self.spark, self.current, state_of, touched, self.partition_by, notes={"applied": applied, "paths": list(paths)})
        return self.current

    def compact(self, small_bytes: int = COMPACT_FILE_BYTES // 2) -> str | None:
        """Join small files: those of the table, or crowded partitions.

        The new snapshot of an unpartitioned table takes large files as they are, copied by the
        executors, and the rows of files below ``small_bytes`` in files of the advisory size.  With
        less than two of these nothing is done.
        """
        folder = self.current
        if folder is None:
            return None
        if self.partition_by:
            # The column types stay as they are, so the table's own notes do too.
            compact_partitions(self.spark, folder, self.partition_by, self.schema())
            return folder
        return self._compact_files(folder, small_bytes)

    def _compact_files(self, folder: str, small_bytes: int) -> str:
        from lakeload.sinks.files import copy_files
        from lakeload.sources.landing import direct_files

        files = direct_files(self.spark, folder).where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))
        small = [r[0] for r in files.where(F.col("length") < small_bytes).select("path").toLocalIterator()]
        if len(small) < 2:
            return folder
        new = self.folder(self.versions()[-1] + 1)
        self._storage.remove(new)
        save_meta(self.spark, f"{new}/_meta", load_meta(self.spark, f"{folder}/_meta"))
        large = files.where(F.col("length") >= small_bytes)
        target = F.concat(F.lit(self._storage.qualified(new) + "/"), F.element_at(F.split("path", "/"), -1))
        problem = copy_files(large.withColumn("target", target)).where("problem IS NOT NULL").select("problem").first()
        if problem is not None:
            raise OSError(f"a file of {folder} could not be copied: {problem[0]}")
        # Written last: its mark makes the snapshot complete.
        rows = self.spark.read.schema(self.schema()).parquet(*small)
        rows.hint("rebalance").write.mode("append").parquet(new)
        return new

    def expire(self, keep: int = 1) -> list[str]:
        """Remove all but the newest complete snapshots, and incomplete ones before them."""
        kept = {self.folder(v) for v in self.versions()[-keep:]}
        if not kept:
            return []
        newest = max(kept)
        removed = []
        for name in self._storage.folders(self.path):
            folder = f"{self.path}/{name}"
            if name.startswith("v=") and folder not in kept and folder < newest:
                self._storage.remove(folder)
                removed.append(folder)
        return removed

    def register(self, name: str) -> None:
        """Point an external catalog table at the current snapshot."""
        register_table(self.spark, name, self.current, self.schema(), self.partition_by)


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """External parquet table over a folder; an older registration is replaced, its files stay."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name.split('.')[0].strip('`'))}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(quote(c) for c in partition_by)})" if partition_by else ""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def clear_files(spark: SparkSession, path: str) -> int:
    """Remove the files directly in a folder, keep its sub-folders; executors delete."""
    from lakeload.sinks.files import delete_files
    from lakeload.sources.landing import direct_files

    if not Storage(spark, path).exists(path):
        return 0
    return delete_files(direct_files(spark, path).select("path")).where(F.col("problem").isNull()).count()
