"""BPE encoding and decoding: speculate, verify, and merge only what fails.

Greedy longest match proposes the tokens of a word.  A token sequence is the result of merging
exactly when each adjacent pair is, so one vectorised check over all pairs of a batch accepts most
proposals; words with a failing pair are merged exactly.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame

from lakeload.llm.common import per_document
from lakeload.llm.tokens import Encoder, Vocabulary, packed, vocabulary


class PairCheck:
    """Which pairs of tokens may stand side by side in a merged word."""

    def __init__(self, vocabulary: Vocabulary):
        left, right, made = np.array(vocabulary.merges, np.int64).reshape(-1, 3).T
        size = vocabulary.size
        self.size = size
        order = np.argsort(left * size + right)
        self.keys, self.made = (left * size + right)[order], made[order]
        # Halves of each token; a single byte is its own half.
        self.left = np.arange(size)
        self.right = np.arange(size)
        self.left[made], self.right[made] = left, right
        stable = np.ones(size, bool)
        # A token whose own bytes merge to something else can never be proposed.
        stable[made] = self.compatible(left, right, made)
        self.stable = stable

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that joins each pair, or one past every id."""
        if not len(self.keys):
            return np.full(len(a), self.size)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], self.size)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """True where merging the bytes of ``a`` and ``b`` leaves just these two tokens.

        Merges are undone from the last one back.  At each state the tokens that touch the border
        must not join earlier than the merge that was undone there.  ``limit``: only joins made
        before this token count.
        """
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), self.size) if limit is None else limit.copy()
        result = np.ones(len(a), bool)
        active = np.arange(len(a))
        while len(active):
            x, y, bound = a[active], b[active], limit[active]
            joined = self._merged(x, y) < bound
            result[active[joined]] = False
            # Undo the later of the two merges; of a single byte there is nothing to undo.
            undo_x, undo_y = self.right[x], self.left[y]
            can_x, can_y = undo_x != x, undo_y != y
            take_x = can_x & ((x > y) | ~can_y)
            # On the left side a join of equal age would have come first, on the right side later.
            limit[active] = np.where(take_x, x, y + 1)
            a[active] = np.where(take_x, undo_x, x)
            b[active] = np.where(take_x, y, undo_y)
            active = active[~joined & (can_x | can_y)]
        return result


class SpeculativeEncoder(Encoder):
    def __init__(self, path: str, **options):
        super().__init__(path, **options)
        self.pairs = PairCheck(self.vocabulary)
        stable = self.pairs.stable
        self.tokens = {w: i for w, i in self.vocabulary.ids.items() if stable[i]}
        # The longest token for each pair of first bytes bounds the search.
        self.longest: dict[bytes, int] = {}
        for word in self.tokens:
            head = word[:2]
            self.longest[head] = max(self.longest.get(head, 1), len(word))
        self.counts = {"words": 0, "merged": 0}

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        get, longest, out, i, n = self.tokens.get, self.longest, [], 0, len(word)
        while i < n:
            for j in range(min(n, i + longest.get(word[i : i + 2], 1)), i, -1):
                token = get(word[i:j])
                if token is not None:
                    break
            out.append(token)
            i = j
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        proposed = [self.propose(w.encode()) for w in words]
        sizes = np.array([len(p) for p in proposed])
        flat = np.array([t for p in proposed for t in p], np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        keys, back = np.unique(flat[inner] * self.pairs.size + flat[inner + 1], return_inverse=True)
        good = self.pairs.compatible(keys // self.pairs.size, keys % self.pairs.size)[back]
        failed = np.unique(owner[inner[~good]])
        raw, bounds = flat.astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
        out = [raw[b - 4 * n : b] for b, n in zip(bounds, sizes.tolist())]
        for i in failed.tolist():
            out[i] = packed(self.vocabulary.merge(words[i]))
        self.counts["words"] += len(words)
        self.counts["merged"] += len(failed)
        return out


@functools.lru_cache(maxsize=4)
def speculative_encoder(path: str) -> SpeculativeEncoder:
    """One per file and Python worker, with its cache of words."""
    return SpeculativeEncoder(path)


def decode(path: str, ids: bytes) -> str:
    """The text of ids, special ones included; bytes that are no UTF-8 become U+FFFD."""
    table = vocabulary(path).bytes
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids)`` of each row; ``ids`` are little-endian unsigned 32-bit integers.

    A null or empty text has no tokens.  Rows are independent: repeated rows, null ids and ties
    give a row each, an empty table none, and other columns, whatever their names, are not read.
    Very long texts are cut into chunks at places where a word begins anyway.  No shuffle.
    """

    def work(texts):
        return [(len(ids) // 4, ids) for ids in speculative_encoder(path).encode(texts)]

    return per_document(docs, id_col, text_col, work, "n_tokens long, ids binary")


def bpe_decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` of each row of ids; null ids give an empty text."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [decode(path, ids or b"") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    source = encoded.select(id_col, ids_col)
    return source.mapInArrow(run, f"{id_col} {source.schema[id_col].dataType.simpleString()}, text string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes each text and gives digests of both, so that only digests leave the task.

    Rows, nulls and empty texts as in ``bpe_encode``.
    """

    def work(texts):
        out = []
        for ids in speculative_encoder(path).encode(texts):
            numbers = ",".join(map(str, np.frombuffer(ids, "<u4").tolist()))
            out.append(
                (
                    len(ids) // 4,
                    hashlib.sha256(numbers.encode()).hexdigest(),
                    hashlib.sha256(decode(path, ids).encode()).hexdigest(),
                )
            )
        return out

    return per_document(docs, id_col, text_col, work, "n_tokens long, ids_sha256 string, decoded_sha256 string")
