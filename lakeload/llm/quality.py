"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_STOP = b".,;:?!'\"()-"
_ODD = bytes(b for b in range(33, 127) if b not in _UPPER + _LOWER + _DIGIT + _STOP)

FEATURES = (
    "log_words",
    "word_length",
    "upper",
    "digits",
    "stops",
    "odd",
    "odd_words",
    "bang_words",
    "lone_signs",
    "distinct",
    "top_word",
    "same_next",
    "line_words",
    "line_copies",
    "line_ends",
)


def features(text: bytes) -> list[float]:
    """Shape of a whole text; nothing in it names a language, a source or a document."""
    words = text.split()
    n, size = len(words), len(text) or 1

    def share(signs: bytes) -> float:
        return (len(text) - len(text.translate(None, signs))) / size

    if not n:
        return [0.0] * len(FEATURES)
    upper, lower = share(_UPPER), share(_LOWER)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = [w[-1:] for w in words]
    tails = Counter(ends)
    odd_ends = sum(tails[bytes([b])] for b in _ODD)
    return [
        math.log(n),
        size / n,
        upper / (upper + lower + 1e-9),
        share(_DIGIT),
        share(_STOP),
        share(_ODD),
        odd_ends / n,
        tails[b"!"] / n,
        sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum()) / n,
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines),
    ]


def feature_rows(texts: list[bytes | None]) -> np.ndarray:
    return np.array([features(t or b"") for t in texts], np.float64).reshape(-1, len(FEATURES))


def _best_cuts(gain_g: np.ndarray, gain_h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """A shallow tree over the bins of one feature: its leaf of each bin, by greedy cuts."""
    g, h = np.concatenate([[0], np.cumsum(gain_g)]), np.concatenate([[0], np.cumsum(gain_h)])
    cuts = [0, len(gain_g)]

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            m = np.arange(a + 1, b)
            m = m[(h[m] - h[a] >= least) & (h[b] - h[m] >= least)]
            if len(m):
                rise = worth(a, m) + worth(m, b) - worth(a, b)
                k = int(rise.argmax())
                if rise[k] > best[0]:
                    best = (rise[k], int(m[k]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    return np.searchsorted(np.array(cuts[1:-1]), np.arange(len(gain_g)), "right")


@dataclass
class AdditiveModel:
    """Lookup tables by feature and by pair of features; a score is a sum of bin entries."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for k, (edge, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edge, x[:, k], "right")]
        for a, b, table in self.pairs:
            out += table[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -500, 500)))


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 64, coarse_bins: int = 12, rounds: int = 200, pairs: int = 6, pair_rounds: int = 60, rate: float = 0.1
) -> AdditiveModel:
    """Cyclic boosting: each round visits every feature with one shallow tree on its bins, then the
    pairs of features that explain most of what is left get tables of their own.

    Without rows the model keeps everything (score 1); with one class its score leans that way.
    """
    if not len(y):
        return AdditiveModel(intercept=50.0)
    yes = y.sum()
    model = AdditiveModel(intercept=math.log((yes + 1) / (len(y) - yes + 1)))

    def cut(values, k):
        return np.unique(np.quantile(values, np.linspace(0, 1, k + 1)[1:-1]))

    model.edges = [cut(v, bins) for v in x.T]
    model.coarse = [cut(v, coarse_bins) for v in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = [np.searchsorted(e, v, "right") for e, v in zip(model.edges, x.T)]
    wide = [np.searchsorted(e, v, "right") for e, v in zip(model.coarse, x.T)]
    logit = np.full(len(y), model.intercept)
    least = 2.0 if len(y) > 500 else 0.5

    def gradient():
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, where in enumerate(fine):
            g, h = gradient()
            size = len(model.tables[k])
            sum_g, sum_h = np.bincount(where, g, size), np.bincount(where, h, size)
            leaf = _best_cuts(sum_g, sum_h, 3, least)
            step = rate * (np.bincount(leaf, sum_g) / (np.bincount(leaf, sum_h) + 1.0))[leaf]
            model.tables[k] += step
            logit += step[where]

    def grid(a, b, g, h):
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        cell = wide[a] * shape[1] + wide[b]
        return cell, shape, *(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    def quadrants(sum_g, sum_h):
        """The best cut of both features at once: gain, cuts, and the four leaves."""
        cg, ch = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (sum_g, sum_h))
        best = (0.0, None)
        for i in range(1, sum_g.shape[0]):
            for j in range(1, sum_g.shape[1]):
                q = []
                for c in (cg, ch):
                    a, b, d = c[i, j], c[i, -1] - c[i, j], c[-1, j] - c[i, j]
                    q.append(np.array([a, b, d, c[-1, -1] - a - b - d]))
                if q[1].min() < least:
                    continue
                gain = float((q[0] ** 2 / (q[1] + 1.0)).sum())
                if gain > best[0]:
                    best = (gain, (i, j, q[0] / (q[1] + 1.0)))
        return best

    g, h = gradient()
    ranked = sorted(
        ((quadrants(*grid(a, b, g, h)[2:])[0], a, b) for a in range(x.shape[1]) for b in range(a)), reverse=True
    )
    chosen = [(a, b, np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1))) for gain, a, b in ranked[:pairs] if gain > 0]
    for _ in range(pair_rounds):
        for a, b, table in chosen:
            g, h = gradient()
            cell, shape, sum_g, sum_h = grid(a, b, g, h)
            _, found = quadrants(sum_g, sum_h)
            if found is None:
                continue
            i, j, leaf = found
            step = np.empty(shape)
            step[:i, :j], step[:i, j:], step[i:, :j], step[i:, j:] = rate * leaf
            table += step
            logit += step.ravel()[cell]
    model.pairs = chosen
    return model


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = 20_000,
    **options,
) -> AdditiveModel:
    """Fits the model on at most ``sample_rows`` labelled rows that are not ``held_out``.

    The rows are the first in the order of a hash of the id, so the sample is the same however the
    tables are laid out.  Rows without a label or an id teach nothing.  Only the sampled ids, a
    bounded number, are broadcast; only features reach the driver.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out)
    chosen = (
        usable.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "label")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            x = feature_rows(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "label", "x"])

    kind = texts.schema["id"].dataType.simpleString()
    found = (
        texts.join(F.broadcast(chosen), "id").select("id", "label", "text").mapInArrow(run, f"id {kind}, label int, x array<double>").toArrow()
    )
    found = found.sort_by([("id", "ascending"), ("label", "ascending")])
    x = np.asarray(found["x"].combine_chunks().flatten() if len(found) else [], np.float64).reshape(-1, len(FEATURES))
    return fit(x, found["label"].to_numpy().astype(np.float64), **options)


def quality_score(model: AdditiveModel, text: Column) -> Column:
    """Score of a text, 0 to 1; null and empty texts get the score of a text without words."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [model.scores(feature_rows(texts.slice(at, 512).to_pylist())) for at in range(0, len(texts), 512)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(F.coalesce(text, F.lit("")).cast("binary"))


def with_quality(docs: DataFrame, model: AdditiveModel, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on).

    Scores depend on the text alone: repeated rows score alike, nulls in other columns do not
    matter, an empty table stays empty.  Columns named like the added ones are replaced.
    """
    return docs.withColumn("score", quality_score(model, F.col(f"`{text_col}`"))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
