"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

COMPACT_FILE_BYTES = 134_217_728

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(COMPACT_FILE_BYTES),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Old parquet files hold INT96 stamps written with the hybrid calendar.
    "spark.sql.parquet.int96RebaseModeInRead": "LEGACY",
    "spark.sql.parquet.int96RebaseModeInWrite": "LEGACY",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def require_single_machine(master: str) -> None:
    if not re.match(r"local($|\[)", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``.  Where that is unset a local
    temporary folder is taken on a single machine, and a cluster is refused: its executors
    would not see each other's files.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if parent:
        return f"{parent.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    require_single_machine(spark.conf.get("spark.master", "local"))
    return tempfile.mkdtemp(prefix=f"run-{purpose}-", dir="/tmp")
