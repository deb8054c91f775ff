"""Language-model scores: the likelihood of a text over all its segmentations into subwords."""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakeload.llm.common import renamed, staged
from lakeload.llm.tokens import encoder, vocabulary

#: The end of a text is a token of its own; no word is empty.
END = b""


def token_blocks(docs: DataFrame, id_col: str, text_col: str, held_out: Column, block_bytes: int) -> DataFrame:
    """Documents in blocks: each block's distinct words, their training counts, and the documents
    as numbers of those words.

    Whatever needs a word's statistics is joined to a block's words, a small part of its tokens,
    and never to the tokens.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    source = docs.select(F.col(f"`{id_col}`").alias("id"), held_out.alias("held"), text.alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids, held, texts = (batch.column(k) for k in range(3))
            texts, flags = texts.to_pylist(), held.to_pylist()
            at = 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size + len(texts[upto]) <= block_bytes):
                    size += len(texts[upto])
                    upto += 1
                yield _block(base + number, ids.slice(at, upto - at), flags[at:upto], texts[at:upto])
                at, number = upto, number + 1

    return source.mapInArrow(
        run, f"block long, ids array<{kind}>, held array<boolean>, sizes array<int>, codes binary, words array<binary>, counts array<long>"
    )


def _block(number: int, ids: pa.Array, held: list[bool], texts: list[bytes]) -> pa.RecordBatch:
    fresh = count()

    class Numbers(dict):
        def __missing__(self, word):
            self[word] = value = next(fresh)
            return value

    codes = Numbers()
    codes[END]
    parts, training = [], []
    for text, out in zip(texts, held):
        words = text.lower().split()
        words.append(END)
        part = np.fromiter(map(codes.__getitem__, words), np.uint32, len(words))
        parts.append(part)
        if not out:
            training.append(part)
    seen = np.bincount(np.concatenate(training), minlength=len(codes)) if training else np.zeros(len(codes), np.int64)

    def one(values, kind):
        return pa.array([values], pa.list_(kind))

    return pa.RecordBatch.from_arrays(
        [
            pa.array([number]),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            one(held, pa.bool_()),
            one([len(p) for p in parts], pa.int32()),
            pa.array([np.concatenate(parts).tobytes()], pa.binary()),
            one(list(codes), pa.binary()),
            one(seen, pa.int64()),
        ],
        names=["block", "ids", "held", "sizes", "codes", "words", "counts"],
    )


class Lattice:
    """Unigram scores of subwords, and the likelihood of words under them.

    A word is written with a blank before it, so a text is a sequence of such words and the end.
    """

    def __init__(self, path: str, log_pieces: np.ndarray, log_end: float):
        self.log_end = log_end
        self.scores = {w: float(log_pieces[i]) for w, i in vocabulary(path).ids.items()}
        self.longest: dict[bytes, int] = {}
        for piece in self.scores:
            head = piece[:2]
            self.longest[head] = max(self.longest.get(head, 1), len(piece))
        self.ring = max(self.longest.values(), default=1) + 1

    def word(self, word: bytes) -> float:
        """Natural log of the summed probability of all segmentations, by forward recursion.

        Only the sums that a piece can still reach are kept, in a ring, however long the word is.
        """
        if word == END:
            return self.log_end
        text = b" " + word
        get, n, ring = self.scores.get, len(text), self.ring
        reached: list[list[float]] = [[] for _ in range(ring)]
        reached[0].append(0.0)
        for i in range(n):
            into = reached[i % ring]
            if not into:
                continue
            total, reached[i % ring] = _log_sum(into), []
            for j in range(i + 1, min(n, i + self.longest.get(text[i : i + 2], 1)) + 1):
                score = get(text[i:j])
                if score is not None:
                    reached[j % ring].append(total + score)
        return _log_sum(reached[n % ring])


def _log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    most = max(values)
    return most + math.log(sum(math.exp(v - most) for v in values))


@functools.lru_cache(maxsize=2)
def _lattice(path: str, log_pieces: bytes, log_end: float) -> Lattice:
    return Lattice(path, np.frombuffer(log_pieces, np.float64), log_end)


def piece_counts(words: DataFrame, path: str) -> DataFrame:
    """``(piece, n)``: how often the vocabulary's pieces occur in the training words ``(word, c)``."""

    def run(batches):
        for batch in batches:
            found: Counter = Counter()
            texts = [" " + w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            for ids, c in zip(encoder(path).ids_of(texts), batch.column(1).to_pylist()):
                for piece in np.frombuffer(ids, "<u4").tolist():
                    found[piece] += c
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], names=["piece", "n"])

    return words.select("word", "c").mapInArrow(run, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def lattice_scores(
    docs: DataFrame,
    path: str,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, both log10 probabilities.

    A-Z is lower-cased; tokens are words and one end.  The pieces are those of the public
    vocabulary; a piece's score is its relative frequency, one added, in all training documents
    (those not ``held_out``) when the vocabulary's merges cut each word.  ``score`` adds the log of each word's
    probability summed over every segmentation; ``base_score`` is the word unigram with one added.

    Counts are taken over all training documents.  A block's words, not its tokens, are joined to
    them.  The driver gets one count per piece of the vocabulary and three totals.

    Null and empty texts are one end.  Repeated rows get a row each, null ids are carried, an
    empty table gives no rows, other columns are not read.
    """
    blocks = staged(token_blocks(docs, id_col, text_col, held_out, block_bytes), "token-blocks")
    entries = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("k", "e")).select(
        "block", "k", F.col("e.words").alias("word"), F.col("e.counts").alias("n")
    )
    counts = staged(entries.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    seen, distinct, ends = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.coalesce(F.max(F.when(F.octet_length("word") == 0, F.col("c"))), F.lit(0))
    ).first()
    size = vocabulary(path).size
    pieces = np.zeros(size, np.int64)
    for piece, n in piece_counts(counts.where("c > 0 AND octet_length(word) > 0"), path).collect():
        pieces[piece] = n
    mass = int(pieces.sum()) + ends + size + 1
    log_pieces = np.log((pieces + 1) / mass).tobytes()
    log_end = math.log((ends + 1) / mass)
    base_mass = seen + distinct + 1

    def weigh(batches):
        for batch in batches:
            model = _lattice(path, log_pieces, log_end)
            words, c = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            score = np.array([model.word(w) for w in words]) / math.log(10)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.log10((c + 1) / base_mass)), pa.array(score), pa.array(c > 0)], names=["word", "base", "score", "known"]
            )

    lexicon = counts.mapInArrow(weigh, "word binary, base double, score double, known boolean")
    scored = entries.select("block", "k", "word").join(lexicon, "word").select("block", "k", "base", "score", "known")

    def gather(words: pa.Table, block: pa.Table) -> pa.Table:
        order = np.argsort(words["k"].to_numpy())
        base, score, known = (words[c].to_numpy()[order] for c in ("base", "score", "known"))
        out = []
        for row in range(len(block)):
            codes = np.frombuffer(block["codes"][row].as_py(), np.uint32)
            sizes = block["sizes"][row].values.to_numpy()
            begin = np.cumsum(sizes) - sizes
            out.append(
                pa.table(
                    [
                        block["ids"][row].values,
                        block["held"][row].values,
                        pa.array(sizes.astype(np.int64)),
                        *[pa.array(np.add.reduceat(v[codes], begin)) for v in (known.astype(np.int64), base, score)],
                    ],
                    names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )
            )
        return pa.concat_tables(out) if out else EMPTY

    kind = blocks.schema["ids"].dataType.elementType
    EMPTY = pa.table(
        [pa.array([], t) for t in (to_arrow_type(kind), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())],
        names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"],
    )
    rows = (
        renamed(scored).groupBy("block")
        .cogroup(blocks.select("block", "ids", "held", "sizes", "codes").groupBy("block"))
        .applyInArrow(gather, f"id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    )
    return rows.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(seen).cast("long").alias("train_tokens"), "base_score", "score")
