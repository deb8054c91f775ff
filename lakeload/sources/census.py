"""What many files look like, found on the executors in one job: headers and schemas."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakeload.sinks.files import locator, spread

#: Bytes of a file's beginning that may hold its first line.
HEADER_BYTES = 1 << 24


def reachable(paths: list[str]) -> bool:
    """Whether tasks can open the files themselves; other stores are read through Spark only."""
    return all(re.match("(/|(file|s3[an]?|gs|gcs|hdfs|abfss?):)", p) for p in paths)


def _census(spark: SparkSession, paths: list[str], look: Callable, ends_with: str) -> dict[str, list[str]]:
    """Paths by what ``look(file system, name)`` finds in their files, None left out.

    A folder whose files differ is replaced by its files.  The driver holds the paths, which it
    was given, and one text for each kind of file.
    """
    locate = locator()

    def files_of(path: str):
        from pyarrow import fs

        system, name = locate(path)
        info = system.get_file_info(name)
        if info.type == fs.FileType.File:
            return [(path, system, name)]
        inside = system.get_file_info(fs.FileSelector(name, recursive=True))
        shown = [i for i in inside if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))]
        root = path.rstrip("/")
        return [(root + i.path[len(name.rstrip("/")) :], system, i.path) for i in shown if i.path.endswith(ends_with)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                found = [(file, look(system, name)) for file, system, name in files_of(path)]
                kinds = {kind for _, kind in found}
                rows = [(path, kinds.pop())] if len(kinds) == 1 else found
                yield pd.DataFrame(rows, columns=["path", "kind"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    looked = spread(listed).mapInPandas(run, "path string, kind string")
    groups = looked.where("kind IS NOT NULL").groupBy("kind").agg(F.collect_list("path").alias("paths")).collect()
    place = {p: i for i, p in enumerate(paths)}
    return {r["kind"]: sorted(r["paths"], key=lambda p: (place.get(p, 0), p)) for r in groups}


def header_census(spark: SparkSession, paths: list[str], encoding: str | None = None) -> dict[str, list[str]]:
    """CSV files by their first line that is not blank; empty files are left out."""
    name_of_encoding = encoding or "utf-8"

    def first_line(system, name: str) -> str | None:
        import codecs

        decoder, text = codecs.getincrementaldecoder(name_of_encoding)("replace"), ""
        with system.open_input_stream(name) as data:
            while len(text) < HEADER_BYTES:
                chunk = data.read(1 << 16)
                text += decoder.decode(chunk, final=not chunk)
                lines = text.splitlines()
                # The last line may go on in the next chunk.
                for line in lines if not chunk else lines[:-1]:
                    if line.strip():
                        return line
                if not chunk:
                    return None
        raise ValueError(f"no line end in the first {HEADER_BYTES} characters of {name}")

    return _census(spark, paths, first_line, "")


def schema_census(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Parquet files by the schema in their footers."""

    def schema(system, name: str) -> str:
        import pyarrow.parquet as pq

        with system.open_input_file(name) as data:
            arrow = pq.ParquetFile(data).schema_arrow
        written = (arrow.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
        return written.decode() if written else arrow.to_string(show_schema_metadata=False)

    return _census(spark, paths, schema, "")
