"""Copying and removing whole files on the executors.

The listing is a frame; each task handles its part of it.  File names are a
function of the source file, so a repeated task writes the same names again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.scalars import archive_calendar, file_extension, file_name, instant, name_prefix, utc_clock
from lakeload.operators.fold import number_in_order
from lakeload.schemas import ARCHIVE_LOG


def spread(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """Listing rows dealt out over as many tasks as a shuffle has.

    The number is given, or adaptive execution would join these few bytes of rows
    into one task, and one task would move all the files.
    """
    tasks = int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listing.repartition(tasks, F.col(path_col))


def locator():
    """File system and name of a path; made by a function so that tasks carry it with them."""

    def locate(path: str):
        import re

        from pyarrow import fs

        if path.startswith("/"):
            return fs.LocalFileSystem(), path
        # Local paths may contain signs that a URI would have to escape.
        local = re.match("^file:/*(/.*)$", path)
        if local:
            return fs.LocalFileSystem(), local.group(1)
        return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))

    return locate


def copy_files(listing: DataFrame) -> DataFrame:
    """Copy ``path`` to ``target`` per row; ``problem`` is NULL where the whole file is there.

    Running the frame copies: write it once and read the written rows.
    """
    locate = locator()

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            problems = []
            for source, target in zip(batch["path"], batch["target"]):
                try:
                    from_fs, from_path = locate(source)
                    to_fs, to_path = locate(target)
                    to_fs.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
                    with from_fs.open_input_stream(from_path) as data, to_fs.open_output_stream(to_path) as out:
                        while chunk := data.read(1 << 22):
                            out.write(chunk)
                    sizes = [f.get_file_info(p).size for f, p in ((from_fs, from_path), (to_fs, to_path))]
                    # The source may go once its copy is logged: it must be there whole.
                    problems.append(None if sizes[0] == sizes[1] else f"copied {sizes[1]} of {sizes[0]} bytes")
                except OSError as error:
                    problems.append(str(error))
            yield batch.assign(problem=problems)

    schema = listing.schema.add("problem", "string")
    return spread(listing).mapInPandas(copy, schema)


def delete_files(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """Delete the files; a file that is gone already counts as deleted."""
    locate = locator()

    def delete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            problems = []
            for path in batch[path_col]:
                try:
                    where, name = locate(path)
                    if where.get_file_info(name).type.name != "NotFound":
                        where.delete_file(name)
                    problems.append(None)
                except OSError as error:
                    problems.append(str(error))
            yield batch.assign(problem=problems)

    schema = listing.schema.add("problem", "string")
    return spread(listing, path_col).mapInPandas(delete, schema)


def archive_name(path: Column, modified: Column, size: Column, at: Column) -> Column:
    """``HH_mm_<uuid><ext>``; the uuid is made from the source file's identity."""
    digest = F.md5(F.concat_ws("|", path, F.unix_micros(modified).cast("string"), size.cast("string")))
    groups = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(name_prefix(at), F.lit("_"), F.concat_ws("-", *groups), file_extension(path))


def plan_archive(listing: DataFrame, archive_path: str, now) -> DataFrame:
    """Archive-log rows of a listing, with the copy still to be done.

    ``ArchiveFilePath`` is ``<archive>/yyyy/MM/dd/HH_mm_<uuid><ext>``.  Archive times
    follow the modification times, one microsecond apart, so that no two files of a
    batch share one and loads apply them in the order they were produced.
    """
    listing = number_in_order(listing, "modificationTime", ["path"])
    at = instant(now) + F.col("__seq") * F.expr("INTERVAL '0.000001' SECOND")
    clock = utc_clock(at)
    name = archive_name(F.col("path"), F.col("modificationTime"), F.col("length"), clock)
    target = F.concat(F.lit(archive_path.rstrip("/") + "/"), F.date_format(clock, "yyyy/MM/dd"), F.lit("/"), name)
    rows = listing.select(
        at.alias("ArchiveDatetimeUTC"),
        *[v.alias(k) for k, v in archive_calendar(clock).items()],
        F.col("path").alias("OriginalStagingFilePath"),
        file_name(F.col("path")).alias("OriginalStagingFileName"),
        F.col("length").alias("OriginalStagingFileSize"),
        F.col("modificationTime").alias("OriginalModificationTime"),
        target.alias("ArchiveFilePath"),
        name.alias("ArchiveFileName"),
        F.lit(False).alias("IsPurged"),
        F.lit(None).cast("timestamp").alias("PurgeDatetimeUTC"),
        F.lit(False).alias("IsIgnorable"),
        F.lit(None).cast("string").alias("Notes"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in ARCHIVE_LOG.fields])


def archive_files(listing: DataFrame, archive_path: str, now) -> DataFrame:
    """Copy a listing into the archive; one log row per copied file, ``problem`` set where it failed."""
    planned = plan_archive(listing, archive_path, now)
    work = planned.withColumns({"path": F.col("OriginalStagingFilePath"), "target": F.col("ArchiveFilePath")})
    return copy_files(work).drop("path", "target")
