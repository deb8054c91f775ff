"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Token-byte incidence matrices A and B in compressed sparse rows; the products A x B' (Gustavson, row
by row) are the overlap links, the products of token-group incidences the shared-group links.

Both tokenizers treat a blank or line feed between two characters that are no white space as the
start of a word, so a text is a sequence of such words, each aligned by itself and once per worker.  Counts
over the corpus come from joins of the pairs that occur in blocks of documents.
"""

from __future__ import annotations

import copy
import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.common import bounded_batches, staged
from lakeload.llm.tokens import Encoder, vocabulary

#: Text of one block in characters; a longer document is a block of its own.
BLOCK_CHARS = 2 << 20
#: Words aligned by one product, in characters, and words a worker remembers, no longer than that.
BATCH_CHARS = 1 << 18
KNOWN_WORDS = 400_000
KNOWN_CHARS = 64


@dataclass
class Csr:
    """A sparse matrix: row ``i`` has entries ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @staticmethod
    def of_runs(lengths: np.ndarray) -> Csr:
        """Row ``i`` covers the next ``lengths[i]`` columns: tokens over bytes."""
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return Csr(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int64), int(starts[-1]))

    @staticmethod
    def of_labels(labels: np.ndarray, width: int) -> Csr:
        """Row ``i`` has one entry, in column ``labels[i]``: tokens in groups."""
        return Csr(np.arange(len(labels) + 1), labels, np.ones(len(labels), np.int64), width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, self.rows()[order], self.values[order], len(self.starts) - 1)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: each entry (i, k) adds row k of ``other``, scaled, to row i."""
        lengths = np.diff(other.starts)[self.columns]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        at = at + np.repeat(other.starts[self.columns], lengths)
        keys = np.repeat(self.rows(), lengths) * max(other.width, 1) + other.columns[at]
        found, back = np.unique(keys, return_inverse=True)
        products = np.repeat(self.values, lengths) * other.values[at]
        values = np.bincount(back, products, len(found)).astype(np.int64)
        rows, columns = np.divmod(found, max(other.width, 1))
        starts = np.searchsorted(rows, np.arange(len(self.starts)))
        return Csr(starts, columns, values, other.width)


class Aligner:
    """Two tokenizers and the alignments of the words seen lately.

    A word is given with the blank or line feed before it, which is its first token's first byte.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        plain = copy.copy(vocabulary(path_a))
        # Special strings in a text are ordinary text.
        plain.special = {}
        self.a = Encoder(path_a, cached_words=100_000)
        self.a.vocabulary = plain
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_a = plain.bytes
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.long_a, self.long_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        # A piece with a blank or line feed after another character would join words.
        cut = None if any("▁" in p.lstrip("▁") for p in pieces) else r" "
        if cut and not any("\n" in p for p in pieces) and self._pieces(["\na"])[0][:1] == [b"\n"]:
            cut = r"[ \n]"
        self.cut = re.compile(rf"(?<=\S)(?={cut}\S)") if cut else None
        # Ids as text, with what may follow them in the text of groups.
        self.names_a = [f"{i}{c}" for c in ",|" for i in range(len(self.bytes_a))]
        self.names_b = [f"{i}{c}" for c in ",;" for i in range(len(self.bytes_b))]
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}

    def words_of(self, text: str) -> list[str]:
        text = " " + text
        return self.cut.split(text) if self.cut else [text]

    def _encode_b(self, words: list[str]) -> list[list[int]]:
        """B puts a blank before each text: it stands for a word's own one, or is taken off again."""
        ids = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        return [i if w[0] == " " else i[1:] for i, w in zip(ids, words)]

    def _pieces(self, words: list[str]) -> list[list[bytes]]:
        return [[self.bytes_b[i] for i in ids] for ids in self._encode_b(words)]

    def word_alignments(self, words: list[str]) -> list[bytes | None]:
        """For each word ``n_a, n_b, n_groups, n_links, n_shared`` as 32-bit integers, its pairs as 64-bit
        ones and the text of its groups, in one object; None where the tokens do not spell it."""
        found = list(map(self.known.get, words, repeat(0)))
        unknown = [w for w, f in zip(words, found) if f == 0]
        # Words met again come over from the older half; what stays there is forgotten.
        fresh = {w: f for w, f in zip(unknown, map(self.older.get, unknown, repeat(0))) if f != 0}
        missing = [w for w in unknown if w not in fresh]
        if len(self.known) + len(unknown) > KNOWN_WORDS // 2:
            self.known, self.older = {}, self.known
        begin = size = 0
        for i, word in enumerate(missing):
            size += len(word)
            if size >= BATCH_CHARS or i + 1 == len(missing):
                part = missing[begin : i + 1]
                fresh.update(zip(part, self._align(part)))
                begin, size = i + 1, 0
        short = {w: f for w, f in fresh.items() if len(w) <= KNOWN_CHARS}
        if len(short) <= KNOWN_WORDS // 2:
            self.known.update(short)
        return [fresh[w] if f == 0 else f for w, f in zip(words, found)]

    def _align(self, words: list[str]) -> list[bytes | None]:
        ids_a, ids_b = self.a.encode(words), self._encode_b(words)
        n_a = np.array([len(x) for x in ids_a]) // 4
        n_b = np.array([len(x) for x in ids_b])
        flat_a = np.frombuffer(b"".join(ids_a), "<u4").astype(np.int64)
        flat_b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
        texts = [w.encode() for w in words]
        good = self._spelt(flat_a, n_a, self.long_a, self.bytes_a, texts) & self._spelt(
            flat_b, n_b, self.long_b, self.bytes_b, texts
        )
        out: list[bytes | None] = [None] * len(words)
        if not good.any():
            return out
        flat_a, flat_b = flat_a[np.repeat(good, n_a)], flat_b[np.repeat(good, n_b)]
        n_a, n_b = n_a[good], n_b[good]
        a, b = Csr.of_runs(self.long_a[flat_a]), Csr.of_runs(self.long_b[flat_b])
        borders = np.intersect1d(a.starts[1:], b.starts[1:], assume_unique=True)
        group_a, group_b = np.searchsorted(borders, a.starts[1:]), np.searchsorted(borders, b.starts[1:])
        links = a.times(b.transposed())
        shared = Csr.of_labels(group_a, len(borders)).times(Csr.of_labels(group_b, len(borders)).transposed())
        pairs = (flat_a[links.rows()] << 32) | flat_b[links.columns]
        # The tokens of each group, those of A first; the last one of each side has another sign behind it.
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        names = list(map(self.names_a.__getitem__, (flat_a + last_a * len(self.bytes_a)).tolist()))
        names += map(self.names_b.__getitem__, (flat_b + last_b * len(self.bytes_b)).tolist())
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        names = list(map(names.__getitem__, order.tolist()))
        # Words end where tokens of both end, so groups and links lie within words.
        ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
        ends_group = group_a[ends_a - 1] + 1
        ends_link, ends_shared = links.starts[ends_a], shared.starts[ends_a]
        counts = [n_a, n_b, *(np.diff(x, prepend=0) for x in (ends_group, ends_link, ends_shared))]
        heads = np.stack(counts, 1).astype("<i4").tobytes()
        raw, x, y = pairs.tobytes(), 0, 0
        rows = zip(np.flatnonzero(good).tolist(), (ends_a + ends_b).tolist(), ends_link.tolist())
        for k, (i, name, link) in enumerate(rows):
            out[i] = b"".join((heads[_HEAD * k : _HEAD * (k + 1)], raw[8 * y : 8 * link], "".join(names[x:name])[:-1].encode()))
            x, y = name, link
        return out

    @staticmethod
    def _spelt(flat: np.ndarray, n: np.ndarray, long: np.ndarray, table: list[bytes], texts: list[bytes]) -> np.ndarray:
        """Which texts their tokens spell."""
        ends = np.cumsum(n)
        total = np.concatenate([[0], np.cumsum(long[flat])])
        sizes = total[ends] - total[ends - n]
        good = (sizes == np.array([len(t) for t in texts])) & (n > 0)
        if good.all() and b"".join(map(table.__getitem__, flat.tolist())) == b"".join(texts):
            return good
        for i in np.flatnonzero(good).tolist():
            good[i] = b"".join(map(table.__getitem__, flat[ends[i] - n[i] : ends[i]].tolist())) == texts[i]
        return good


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per pair of files and Python worker."""
    return Aligner(path_a, path_b)


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")
_HEAD = 4 * len(_COUNTS)


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds them, after a byte that names it."""
    kind = np.min_scalar_type(int(values.max()) if len(values) else 0)
    return kind.char.encode() + values.astype(kind.newbyteorder("<")).tobytes()


def _widened(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:1].decode()).newbyteorder("<")
    return np.frombuffer(data, kind, offset=1).astype(np.int32)


class _Block:
    """Documents gathered until their texts are long enough for one row."""

    def __init__(self, tool: Aligner):
        self.tool, self.numbers, self.ids, self.words, self.chars = tool, _Numbers(), [], [], 0

    def add(self, ident, text: str) -> None:
        words = self.tool.words_of(text) if text else []
        self.ids.append(ident)
        self.words.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.chars += len(text)

    def row(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        found = self.tool.word_alignments(list(self.numbers))
        spelt = np.array([f is not None for f in found], bool)
        table = np.frombuffer(b"".join([f[:_HEAD] if f else bytes(_HEAD) for f in found]), "<i4").reshape(-1, 5).astype(np.int64)
        widths = table[:, 3]
        ends = (_HEAD + 8 * widths).tolist()
        flat = np.frombuffer(b"".join([f[_HEAD:end] for f, end in zip(found, ends) if f]), np.int64)
        texts = [f[end:] if f else b"" for f, end in zip(found, ends)]
        del found
        counts, digests, kept = [], [], []
        for words in self.words:
            fine = len(words) > 0 and spelt[words].all()
            kept.append(words if fine else words[:0])
            counts.append(table[words].sum(0) if fine else np.zeros(5, np.int64))
            digests.append(hashlib.sha256(b";".join(map(texts.__getitem__, words.tolist()))).hexdigest() if fine else "")
        times = np.bincount(np.concatenate([np.zeros(0, np.int32), *kept]), minlength=len(texts))
        del texts
        pairs, position = np.unique(flat, return_inverse=True)
        often = np.bincount(position, np.repeat(times, widths), len(pairs)).astype(np.int64)
        columns = {
            "block": pa.array([number], pa.int64()),
            "ids": pa.array([self.ids], pa.list_(id_type)),
            **{c: pa.array([x], pa.list_(pa.int64())) for c, x in zip(_COUNTS, np.array(counts).T)},
            "groups": pa.array([digests], pa.list_(pa.string())),
            "words": pa.array([_narrow(np.concatenate([np.zeros(0, np.int32), *kept]))], pa.binary()),
            "lengths": pa.array([_narrow(np.array([len(x) for x in kept]))], pa.binary()),
            "places": pa.array([_narrow(position)], pa.binary()),
            "widths": pa.array([_narrow(widths)], pa.binary()),
            "pairs": pa.array([pairs], pa.list_(pa.int64())),
            "often": pa.array([often], pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Links between the tokens of a byte-level BPE file (A) and a sentencepiece model (B).

    Gives ``(id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256)``.  Links are pairs
    of tokens whose byte ranges overlap, ``n_shared`` counts pairs of tokens in one group.  A pair of
    ids counts its links in all documents; ``count_sum`` adds that over a document's links, and ``n_best``
    counts links whose pair is the commonest of its B id, ties included.

    A null or empty text, or one whose tokens do not spell it, has no tokens: zeros and an empty
    digest.  Repeated rows and null ids give a row each and count each; an empty table gives
    none.  Other columns are not read.  Texts of any length are taken whole, word by word.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    lists = ", ".join(f"{c} array<long>" for c in _COUNTS)
    schema = (
        f"block long, ids array<{id_type}>, {lists}, groups array<string>, words binary, lengths binary, "
        "places binary, widths binary, pairs array<long>, often array<long>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        number, block = TaskContext.get().partitionId() << 32, _Block(tool)
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(ident, text.as_py())
                if block.chars >= BLOCK_CHARS or len(block.ids) >= 10_000:
                    yield block.row(number, kind)
                    number, block = number + 1, _Block(tool)
        if block.ids:
            yield block.row(number, kind)

    bounded_batches(docs.sparkSession)
    blocks = staged(source.mapInArrow(run, schema), "crosstoken")
    found = _corpus_counts(blocks)
    joined = blocks.select("block", "ids", *_COUNTS, "groups", "words", "lengths", "places", "widths").join(
        # No sort: it would hold the blocks of a task, which are MBs each.
        found.hint("shuffle_hash"), "block", "left"
    )
    names = [*_COUNTS, "n_best", "count_sum"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                best, sums = _document_sums(row)
                columns = [row[c].values for c in ("ids", *_COUNTS)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(best), pa.array(sums), row["groups"].values],
                    names=[id_col, *names, "groups_sha256"],
                )

    out = f"{id_col} {id_type}, {', '.join(f'{c} long' for c in names)}, groups_sha256 string"
    return joined.mapInArrow(finish, out)


def _corpus_counts(blocks: DataFrame) -> DataFrame:
    """For each block the counts of its pairs over all blocks: ``(block, at, count)``, lists in step.

    The last bit of ``count`` tells whether the pair is the commonest of its B id.
    """
    entry = F.posexplode(F.arrays_zip("pairs", "often")).alias("at", "entry")
    pairs = blocks.select("block", entry).select(
        "block", "at", F.col("entry.pairs").alias("pair"), F.col("entry.often").alias("often")
    )
    totals = pairs.groupBy("pair").agg(F.sum("often").alias("total"))
    # A B id has at most as many pairs as A has ids.
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    best = (F.max("total").over(same_b) == F.col("total")).cast("long")
    totals = totals.select("pair", (F.col("total") * 2 + best).alias("count"))
    counted = pairs.select("block", "at", "pair").join(totals, "pair")
    return counted.groupBy("block").agg(F.collect_list(F.struct("at", "count")).alias("found"))


def _document_sums(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """``n_best`` and ``count_sum`` of each document of a block."""
    words, lengths, places, widths = (_widened(row[c].as_py()) for c in ("words", "lengths", "places", "widths"))
    found = row["found"]
    if not found.is_valid or not len(places):
        return np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    entries = found.values
    at, count = (entries.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    counts = np.zeros(len(at), np.int64)
    counts[at] = count
    links = counts[places]
    word = np.repeat(np.arange(len(widths)), widths)
    out = []
    for values in (links & 1, links >> 1):
        by_word = _sums(word, values, len(widths))
        out.append(_sums(np.repeat(np.arange(len(lengths)), lengths), by_word[words], len(lengths)))
    return out[0], out[1]


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of the values of each group; groups are in order."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.searchsorted(group, np.arange(n), "right")
    return total[ends] - total[np.concatenate([[0], ends[:-1]]).astype(np.int64)]
