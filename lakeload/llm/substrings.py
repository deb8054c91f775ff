"""Substring dedup: winnowed anchors as seeds, extension to both sides, maximal repeats removed.

Every window of ``threshold`` words has one anchor: the run of ``anchor`` words with the smallest
hash in it, the rightmost of equal ones.  Equal windows have equal anchors at equal places, so two
documents that share a window share its anchor, and a window is its anchor with so many words to
the left and so many to the right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import staged
from lakeload.operators.matching import members

#: Bases of the two rolling hashes, polynomials modulo a prime: modulo a power of two every odd base
#: would collide on the same inputs.
BASES = (0x19E3779B97F4A7C1, 0x12B2AE3D27D4EB4F)
PRIME = (1 << 61) - 1
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_30, _31, _61 = np.uint64(30), np.uint64(31), np.uint64(61)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo ``PRIME`` of numbers below it, from halves of 31 bits."""
    a_up, a_low, b_up, b_low = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a_low * b_up + a_up * b_low
    return _reduced(a_up * b_up * np.uint64(2) + (middle >> _30) + ((middle & _LOW30) << _31) + a_low * b_low)


class _Powers:
    """Powers of a base and of its inverse modulo ``PRIME``, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base % PRIME, pow(base, -1, PRIME)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (self._of(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _of(base: int, size: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < size:
            step = np.full(len(out), pow(base, len(out), PRIME), np.uint64)
            out = np.concatenate([out, _product(out, step)])
        return out


_POWERS = [_Powers(b) for b in BASES]


def _prefix(values: np.ndarray, which: int) -> np.ndarray:
    up, _ = _POWERS[which].get(len(values) + 1)
    terms = _product(values, up[: len(values)])
    # Sums of the halves stay below 2^64 for any batch; they are put together modulo the prime.
    low, high = np.cumsum(terms & _LOW31, dtype=np.uint64), np.cumsum(terms >> _31, dtype=np.uint64)
    out = np.zeros(len(values) + 1, np.uint64)
    out[1:] = _reduced(_reduced(low) + _product(_reduced(high), np.full(len(high), 1 << 31, np.uint64)))
    return out


def _run(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hash of values ``begin`` to ``end``, the same wherever they stand."""
    _, down = _POWERS[which].get(len(prefix))
    between = _reduced(prefix[end] + (_P - prefix[begin]))
    return _mixed(_product(between, down[begin]) + (end - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Word hashes of a batch of texts, one buffer of bytes after another.

    A word is known by the two halves of its XXH3-128, each a number modulo ``PRIME``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        raw = data.tobytes()
        words = [raw[a:b].split() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
        digests = b"".join(map(xxhash.xxh3_128_digest, chain.from_iterable(words)))
        halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
        self.hash = [_reduced(np.ascontiguousarray(halves[:, k])) for k in (0, 1)]
        #: Words before each text, and at last in all.
        self.bounds = np.cumsum([0, *map(len, words)])
        self.prefix = [_prefix(h, k) for k, h in enumerate(self.hash)]

    def run(self, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        return _run(self.prefix[which], begin, end, which)


def anchors_of(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` hashes the place of its smallest one, the rightmost of equals."""
    count = len(hashes) - span + 1
    # Doubling: the best of 2^k neighbours, then of two overlapping runs.
    best, width = np.arange(len(hashes)), 1

    def better(a, b):
        return np.where(hashes[b] <= hashes[a], b, a)

    while width * 2 <= span:
        best = better(best[:-width], best[width:])
        width *= 2
    return better(best[:count], best[span - width : span - width + count])


def _texts(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    array = batch.column(column)
    kind = np.int64 if pa.types.is_large_binary(array.type) else np.int32
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(array):
        upto = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        upto = min(len(array), max(at + 1, upto))
        yield at, upto, data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
        at = upto


_LIMIT = 1 << 21


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _windows(words: Words, text: int, threshold: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of a text and the places of their anchors, counted in the batch."""
    begin, end = int(words.bounds[text]), int(words.bounds[text + 1])
    if end - begin < threshold:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(begin, end - anchor + 1)
    hashes = words.run(at, at + anchor, 0)
    return np.arange(begin, end - threshold + 1), begin + anchors_of(hashes, threshold - anchor + 1)


def seeds(docs: DataFrame, threshold: int, anchor: int) -> DataFrame:
    """``(doc, mark, anchor, context1, context2, first, last)``: anchors of each document.

    ``first`` to ``last`` are the starts of the windows that have this anchor; the context is a
    two-part hash of all words of those windows and of where the anchor stands among them.
    """

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in _texts(batch, 2, _LIMIT):
                words, found = Words(data, offsets), []
                for text in range(b - a):
                    starts, places = _windows(words, text, threshold, anchor)
                    if len(starts):
                        change = np.flatnonzero(np.diff(places)) + 1
                        firsts = starts[np.concatenate([[0], change])]
                        lasts = starts[np.concatenate([change - 1, [len(starts) - 1]])]
                        found.append((np.full(len(firsts), text), places[np.concatenate([[0], change])], firsts, lasts))
                if not found:
                    continue
                text, place, first, last = map(np.concatenate, zip(*found))
                base = words.bounds[text]
                shape = ((place - first) * 4096 + (last - first)).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(text)),
                        batch.column(1).slice(a, b - a).take(pa.array(text)),
                        _signed(words.run(place, place + anchor, 0)),
                        *[_signed(_mixed(words.run(first, last + threshold, k) + shape)) for k in (0, 1)],
                        pa.array((first - base).astype(np.int32)),
                        pa.array((last - base).astype(np.int32)),
                    ],
                    names=["doc", "mark", "anchor", "context1", "context2", "first", "last"],
                )

    return docs.select("doc", "mark", "bytes").mapInArrow(
        run, "doc long, mark long, anchor long, context1 long, context2 long, first int, last int"
    )


def _extended(docs: DataFrame, wanted: DataFrame, threshold: int) -> DataFrame:
    """``(doc, mark, window1, window2, first)``: hashes of the windows around the seeds ``wanted``."""
    listed = wanted.groupBy("doc", "mark").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("runs"))
    source = listed.join(docs, ["doc", "mark"]).select("doc", "mark", "bytes", "runs")

    def run(batches):
        for batch in batches:
            runs = batch.column(3)
            for a, b, data, offsets in _texts(batch, 2, _LIMIT):
                words, found = Words(data, offsets), []
                for text in range(b - a):
                    pairs = runs[a + text].values
                    first = pairs.field("first").to_numpy(zero_copy_only=False)
                    last = pairs.field("last").to_numpy(zero_copy_only=False)
                    sizes = last - first + 1
                    skip = np.cumsum(sizes) - sizes
                    starts = np.arange(sizes.sum()) - np.repeat(skip, sizes) + np.repeat(first, sizes)
                    found.append((np.full(len(starts), text), starts.astype(np.int64)))
                text, start = map(np.concatenate, zip(*found))
                at = start + words.bounds[text]
                for cut in range(0, len(text), 50_000):
                    part = slice(cut, cut + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(a, b - a).take(pa.array(text[part])),
                            batch.column(1).slice(a, b - a).take(pa.array(text[part])),
                            *[_signed(words.run(at[part], at[part] + threshold, k)) for k in (0, 1)],
                            pa.array(start[part].astype(np.int32)),
                        ],
                        names=["doc", "mark", "window1", "window2", "first"],
                    )

    return source.mapInArrow(run, "doc long, mark long, window1 long, window2 long, first int")


def repeats(docs: DataFrame, threshold: int = 50, anchor: int = 17) -> DataFrame:
    """``(doc, mark, first, last)``: runs of starts of windows that also start in a smaller document."""
    found = staged(seeds(docs.where("doc IS NOT NULL"), threshold, anchor), "seeds")
    # Most anchors stand in one document only and go before anything else is compared.
    shared = staged(
        found.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("anchor"), "shared-anchors"
    )
    some = staged(found.join(shared, "anchor"), "shared-seeds")
    contexts = some.groupBy("anchor", "context1", "context2").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    several = some.groupBy("anchor").agg((F.min("context1") < F.max("context1")).alias("several"))
    # An anchor may stand in many neighbourhoods.
    known = members(contexts, several, ["anchor"], "inner").where("several OR least < most").drop("most")
    hits = staged(some.join(known, ["anchor", "context1", "context2"]).select("doc", "mark", "first", "last", "least", "several"), "seed-hits")
    # The whole neighbourhood of the anchor stands in a smaller document: all its windows do.
    whole = hits.where("doc > least").select("doc", "mark", "first", "last")
    # The first of its neighbourhood, where others differ: extend to each side, window by window.
    edges = staged(_extended(docs, hits.where("several AND doc = least"), threshold), "windows")
    least = edges.groupBy("window1", "window2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    partly = edges.join(least, ["window1", "window2"]).where("doc > least").select("doc", "mark", "first", F.col("first").alias("last"))
    return whole.union(partly)


def keep(words: list[bytes], runs: list[tuple[int, int]], threshold: int) -> list[bytes]:
    """The words outside all windows whose starts are in ``runs``."""
    gone = np.zeros(len(words) + 1, np.int64)
    for first, last in runs:
        gone[first] += 1
        gone[last + threshold] -= 1
    inside = np.cumsum(gone[:-1]) > 0
    return [w for w, x in zip(words, inside.tolist()) if not x]


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 50, anchor: int = 17, columns=None, digest: bool = False
) -> DataFrame:
    """The rows of ``docs`` with what is left in the text column, ``n_words`` and ``n_removed``;
    with ``digest`` the text column gives way to ``kept_sha256``.

    Words are runs of bytes other than ASCII blanks, unchanged.  Removed is each word in a window
    of ``threshold`` words that also starts in a document with a smaller id, judged on the input.
    Kept words are joined by a blank; a text without repeats keeps its own white space (the digest
    is of the joined words).

    Seeds are joined by anchor hash through aggregates: a passage in any number of documents costs
    rows in proportion.  Where a seed's whole neighbourhood repeats, all its windows are taken at
    once; only the first document of each neighbourhood is extended window by window against the
    others.  Windows are compared by two hashes of 61 bits, made from 128 bits of each word.

    Null texts stay null and have no words.  Rows with a null id lose nothing and make others lose
    nothing.  Repeated rows are alike and lose the same words; rows of one id and other texts are
    never smaller than each other.  Empty tables give no rows; added columns replace those of
    their name.  ``columns`` limits what is carried along.
    """
    if not 0 < anchor <= threshold < 2048:
        raise ValueError("0 < anchor <= threshold < 2048")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = [F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(text).alias("mark")]
    lists = (
        repeats(docs.select(*key, text.cast("binary").alias("bytes")), threshold, anchor)
        .groupBy("doc", "mark")
        .agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("runs"))
    )
    made = ("n_words", "n_removed", text_col, *(["kept_sha256"] if digest else []))
    carried = [c for c in (docs.columns if columns is None else columns) if c not in made]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), *key, F.col(f"`{text_col}`").cast("binary").alias("text"))
    joined = rows.join(lists, ["doc", "mark"], "left").select("row", "text", "runs")
    kind = joined.schema["row"].dataType.simpleString()
    cut = joined.mapInArrow(_cutter(threshold, digest), f"row {kind}, n_words long, n_removed long, kept string")
    return cut.select("row.*", F.col("kept").alias("kept_sha256" if digest else text_col), "n_words", "n_removed")


def _cutter(threshold: int, digest: bool):
    def left(text: bytes | None, runs) -> tuple[int, int, str | None]:
        words = (text or b"").split()
        kept = words
        if runs.is_valid:
            pairs = runs.values
            kept = keep(words, list(zip(pairs.field("first").to_pylist(), pairs.field("last").to_pylist())), threshold)
        if digest:
            value = hashlib.sha256(b" ".join(kept)).hexdigest()
        elif text is None:
            value = None
        else:
            value = (b" ".join(kept) if len(kept) < len(words) else text).decode("utf-8", "replace")
        return len(words), len(words) - len(kept), value

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 1_000):
                part = batch.slice(at, 1_000)
                out = [left(text.as_py(), runs) for text, runs in zip(part.column(1), part.column(2))]
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)]],
                    names=["row", "n_words", "n_removed", "kept"],
                )

    return run
