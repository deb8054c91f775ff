"""Byte-level BPE of whole texts in Arrow batches: words, cached ids, byte tables.

Words are cut by numpy over code points instead of a pattern per text.  Which class a code point
has (letter, number, white space, other) is asked of the tokenizer's own pre-tokenizer, once for
each code point that occurs, so both always agree.
"""

from __future__ import annotations

import functools
import json
import re
import sys
from array import array
from collections.abc import Iterable

import numpy as np

LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
#: A cut may fall before such white space: a word always begins there.
SAFE_CUT = re.compile(r"(?<=[A-Za-z0-9])[ \n]")


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    values = array("I", ids)
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, as letter -> byte.

    Visible Latin-1 characters stand for themselves, the other bytes take code points from 256 on.
    """
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level BPE file: token bytes by id, the merge that makes each token, special strings."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        as_bytes = {t: bytes(map(letters.__getitem__, t)) for t in model["vocab"]}
        self.ids = {as_bytes[t]: i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*self.ids.values(), *self.special.values()])
        self.bytes = [b""] * self.size
        for word, i in [*self.ids.items(), *((k.encode(), v) for k, v in self.special.items())]:
            self.bytes[i] = word
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = [(model["vocab"][a], model["vocab"][b], model["vocab"][a + b]) for a, b in pairs]
        made = [m[2] for m in self.merges]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError(f"merge order is not id order: {path}")
        # Every piece is one word here: the merges alone decide.
        self._merger = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=self.ids, special_tokens={})
        self._cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.classes = np.zeros(0x110000, np.uint8)
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def merge(self, word: str) -> list[int]:
        """Exact merging of one word."""
        return self._merger.encode_ordinary(word)

    def classify(self, points: np.ndarray) -> np.ndarray:
        found = self.classes[points]
        if not found.all():
            for point in np.unique(points[found == 0]).tolist():
                c = chr(point)
                alone = [k for k, x in ((LETTER, "x"), (NUMBER, "1"), (OTHER, ".")) if len(self._cut(x + c + x)) == 1]
                self.classes[point] = alone[0] if alone else SPACE
            found = self.classes[points]
        return found


def default_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file installed beside the tokenizer libraries."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One per file and Python worker."""
    return Vocabulary(path)


def word_starts(points: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where words begin.  ``first`` marks the first character of each text.

    A word is a run of one class, with the single blank before it; a contraction after a run that
    is not punctuation stands alone; white space before a word gives up only its last character.
    """
    last = np.append(first[1:], True)
    space = kind == SPACE
    new = first.copy()
    new[1:] |= kind[1:] != kind[:-1]
    blank_before = np.zeros(len(points), bool)
    blank_before[1:] = (points[:-1] == 32) & ~first[1:]
    word_next = np.zeros(len(points), bool)
    word_next[:-1] = ~space[1:] & ~last[:-1]
    starts = np.where(space, new | word_next, new & ~blank_before)
    for at in np.flatnonzero((points == 39) & starts & ~last).tolist():
        if kind[at + 1] != LETTER:
            continue
        tail = "".join(map(chr, points[at + 1 : at + 3].tolist()))
        if len(tail) == 2 and last[at + 1]:
            tail = tail[0]
        length = 1 if tail[0] in "stmd" else 2 if tail in ("re", "ve", "ll") else 0
        if length:
            starts[at + 1] = False
            end = at + length
            if not last[end] and kind[end + 1] == LETTER:
                starts[end + 1] = True
    return starts


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit bytes, words cached for each Python worker."""

    def __init__(self, path: str, cached_words: int = 300_000, chunk: int = 1 << 20):
        self.vocabulary = vocabulary(path)
        self.cached_words, self.chunk = cached_words, chunk
        self.cache: dict[str, bytes] = {}

    def encode_words(self, words: list[str]) -> Iterable[bytes]:
        """Ids of words that are not cached."""
        merge = self.vocabulary.merge
        return [packed(merge(w)) for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text, in chunks of bounded size."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in self._parts(text):
                if isinstance(part, bytes):
                    self._flush(waiting, out)
                    waiting, size = [], 0
                    out[i].append(part)
                    continue
                waiting.append((i, part))
                size += len(part)
                if size >= self.chunk:
                    self._flush(waiting, out)
                    waiting, size = [], 0
        self._flush(waiting, out)
        return [b"".join(parts) for parts in out]

    def _parts(self, text: str):
        special = self.vocabulary.special
        pieces = [text]
        if special and any(s in text for s in special):
            pieces = self.vocabulary.split_special.split(text)
        for piece in pieces:
            if piece in special:
                yield packed([special[piece]])
                continue
            begin = 0
            while len(piece) - begin > self.chunk:
                cut = SAFE_CUT.search(piece, begin + self.chunk)
                if not cut:
                    break
                yield piece[begin : cut.start()]
                begin = cut.start()
            if begin < len(piece):
                yield piece[begin:]

    def _flush(self, waiting: list[tuple[int, str]], out: list[list[bytes]]) -> None:
        if not waiting:
            return
        joined = "".join(t for _, t in waiting)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.cumsum([0, *(len(t) for _, t in waiting)])
        first = np.zeros(len(points), bool)
        first[offsets[:-1]] = True
        begins = np.flatnonzero(word_starts(points, self.vocabulary.classify(points), first))
        bounds = [*begins.tolist(), len(joined)]
        words = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        ids = self.ids_of(words)
        at = np.searchsorted(begins, offsets).tolist()
        for (i, _), a, b in zip(waiting, at, at[1:]):
            out[i].append(b"".join(ids[a:b]))

    def ids_of(self, words: list[str]) -> list[bytes]:
        ids = list(map(self.cache.get, words))
        at = [k for k, v in enumerate(ids) if v is None]
        if at:
            missing = list({words[k] for k in at})
            if len(self.cache) + len(missing) > self.cached_words:
                self.cache.clear()
            found = dict(zip(missing, self.encode_words(missing)))
            for k in at:
                ids[k] = found[words[k]]
            self.cache.update(found)
        return ids


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
