"""Token files: independent zstandard frames, a trailing seek table, a checksum per frame.

Layout of a file (numbers are little-endian):

* frames, each a zstandard frame with its own content checksum, holding ids of one document as
  unsigned 32-bit integers; a document longer than ``FRAME_BYTES`` takes several frames in a row,
* a skippable frame (magic 0x184D2A50) with the document index: a compressed list of
  (has id: 1 byte, id: signed 64 bits, frames: unsigned 32 bits) per document,
* a skippable frame (magic 0x184D2A5E), the seek table of the public seekable format: per frame
  compressed size, content size and the low 32 bits of the content's XXH64; then the number of
  frames, a descriptor byte (0x80: checksums follow) and the magic 0x8F92EAB1.

Ordinary zstandard tools read such a file front to back; a reader with the table fetches and
decompresses only the frames of the documents asked for.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeload.llm.common import staged
from lakeload.llm.tokens import encoder, packed

INDEX_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 1 << 26
_FOOTER = 9
_INDEX = np.dtype([("known", "u1"), ("id", "<i8"), ("frames", "<u4")])
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])


class TokenFileWriter:
    def __init__(self, stream, level: int = 3):
        self.stream = stream
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        parts = [ids[a : a + FRAME_BYTES] for a in range(0, len(ids), FRAME_BYTES)] or [b""]
        for part in parts:
            frame = self.compressor.compress(part)
            self.stream.write(frame)
            self.entries.append((len(frame), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        self.index.append((doc_id is not None, doc_id or 0, len(parts)))

    def close(self) -> None:
        index = self.compressor.compress(np.array(self.index, _INDEX).tobytes())
        self.stream.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self.entries, _ENTRY).tobytes() + struct.pack("<IBI", len(self.entries), 0x80, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class TokenFile:
    """Random access to one file."""

    def __init__(self, stream):
        self.stream, end = stream, stream.size()
        frames, _, magic = struct.unpack("<IBI", self._read(end - _FOOTER, _FOOTER))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table at the end of the file")
        at = end - _FOOTER - frames * _ENTRY.itemsize
        self.entries = np.frombuffer(self._read(at, frames * _ENTRY.itemsize), _ENTRY)
        self.places = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        begin = int(self.places[-1])
        magic, size = struct.unpack("<II", self._read(begin, 8))
        if magic != INDEX_MAGIC:
            raise ValueError("no document index before the seek table")
        self.index = np.frombuffer(zstandard.decompress(self._read(begin + 8, size)), _INDEX)
        self.first = np.concatenate([[0], np.cumsum(self.index["frames"], dtype=np.int64)])
        sizes = np.concatenate([[0], np.cumsum(self.entries["size"], dtype=np.int64)])
        #: Ids before each document, and at last in all.
        self.starts = sizes[self.first] // 4

    def _read(self, at: int, size: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(size)

    def read(self, number: int) -> bytes:
        """The ids of the document with this number in the file; only its frames are fetched."""
        a, b = int(self.first[number]), int(self.first[number + 1])
        raw = self._read(int(self.places[a]), int(self.places[b] - self.places[a]))
        parts, base = [], self.places[a]
        for k in range(a, b):
            part = zstandard.decompress(raw[int(self.places[k] - base) : int(self.places[k + 1] - base)])
            if xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != self.entries["check"][k]:
                raise ValueError(f"frame {k}: checksum differs")
            parts.append(part)
        return b"".join(parts)

    def find(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, bytes]]:
        """(id, ids) of the documents asked for."""
        known = self.index["known"] == 1
        for doc_id in doc_ids:
            for number in np.flatnonzero(known & (self.index["id"] == doc_id)).tolist():
                yield doc_id, self.read(number)


def open_file(uri: str, write: bool = False):
    system, path = fs.FileSystem.from_uri(uri)
    if write:
        system.create_dir(path.rpartition("/")[0], recursive=True)
        return system.open_output_stream(path, compression=None)
    return system.open_input_file(path)


def write_token_files(
    docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2
) -> DataFrame:
    """Encodes all documents and writes one file per range of ids below ``folder``.

    Returns the written list of files ``(part, file, documents, tokens)``; parts are in ascending
    id order and so are the documents within one; ties on the id are ordered by a text hash, null
    ids come first.  A task names its file by itself and the list is committed by Spark, so a task
    that runs twice leaves a file that no list names.  Null and empty texts are documents of the
    end id alone; an empty table gives an empty list; other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order)
    end = packed([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        writer = name = None
        tokens = 0
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(names), 500):
                for doc_id, ids in zip(names[at : at + 500], encoder(path).encode(texts[at : at + 500])):
                    if writer is None:
                        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tok.zst"
                        writer = TokenFileWriter(open_file(name, write=True))
                    writer.add(doc_id, ids + end)
                    tokens += len(ids) // 4 + 1
        if writer is not None:
            writer.close()
            writer.stream.close()
            row = ([part], [name], [len(writer.index)], [tokens])
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names=["part", "file", "documents", "tokens"]
            )

    return staged(ordered.mapInArrow(run, "part int, file string, documents long, tokens long"), "token-files")


def read_token_files(files: DataFrame, id_col: str = "doc_id", batch_bytes: int = 1 << 22) -> DataFrame:
    """``(id, start, n_tokens, ids)`` of each document; ``start`` counts all ids before it."""
    parts = files.count()
    # One row per file, not per document: a running sum over them fits one task.
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.select("file", F.coalesce(before, F.lit(0)).alias("base")).repartition(max(1, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_file(name) as stream:
                    file = TokenFile(stream)
                    rows, size = [], 0
                    for k, entry in enumerate(file.index):
                        ids = file.read(k)
                        rows.append((int(entry["id"]) if entry["known"] else None, base + int(file.starts[k]), len(ids) // 4, ids))
                        size += len(ids)
                        if size >= batch_bytes or k + 1 == len(file.index):
                            columns = zip(*rows, strict=True)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], names=[id_col, "start", "n_tokens", "ids"]
                            )
                            rows, size = [], 0

    return placed.mapInArrow(run, f"{id_col} long, start long, n_tokens long, ids binary")
