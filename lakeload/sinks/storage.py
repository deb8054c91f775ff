"""Small folder operations of the driver, through Spark's own file systems."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import SparkSession

LISTING_BATCH = 10_000


class Storage:
    """Folder listing, removal and small text files with the session's storage settings."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path_of = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def qualified(self, path: str) -> str:
        """The path as Spark's listings spell it."""
        return self._fs.makeQualified(self._path_of(path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path_of(path))

    def folders(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path_of(path)) if s.isDirectory())

    def names(self, path: str) -> list[str]:
        """Names of the files of a small folder."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path_of(path)) if s.isFile())

    def file_batches(self, path: str, size: int = LISTING_BATCH) -> Iterator[list[tuple]]:
        """The files of one folder as ``(path, modification time, length)``, ``size`` at a time."""
        if not self.exists(path):
            return
        found, entries = [], self._fs.listStatusIterator(self._path_of(path))
        while entries.hasNext():
            status = entries.next()
            if not status.isFile():
                continue
            at = dt.datetime.fromtimestamp(status.getModificationTime() / 1000, dt.timezone.utc)
            found.append((status.getPath().toString(), at, status.getLen()))
            if len(found) == size:
                yield found
                found = []
        if found:
            yield found

    def remove(self, path: str, recursive: bool = True) -> bool:
        return self._fs.delete(self._path_of(path), recursive)

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._path_of(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        data = self._fs.open(self._path_of(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
        finally:
            data.close()
