"""Tokenizer alignment, whitening and source mixing against plain versions."""

import collections
import hashlib
import math
import os
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeload.llm import crosstoken, mixing, whitening
from lakeload.llm.common import staged
from lakeload.llm.queries import PIECES, VOCABULARY
from lakeload.llm.tokens import byte_letters
from tests.llm.test_operators import ODD, texts

WORD = r"[^\x20\x09-\x0D]+"


# Cross-tokenizer alignment


def plain_tokens(text, library, pieces):
    letters = byte_letters()
    a = [(i, bytes(letters[c] for c in library.id_to_token(i))) for i in library.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in pieces.encode(text):
        p = pieces.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if text and all(b"".join(t for _, t in x) == whole for x in (a, b)) else ([], [])


def spans(tokens):
    out, at = [], 0
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    done, count = [], collections.Counter()
    for ident, text in rows:
        a, b = (spans(x) for x in plain_tokens(text or "", library, pieces))
        links = [(i, j) for i, x0, x1 in a for j, y0, y1 in b if x0 < y1 and y0 < x1]
        count.update(links)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([i for i, _, e in a if lo < e <= hi], [j for j, _, e in b if lo < e <= hi]) for lo, hi in zip([0, *ends], ends)]
        done.append((ident, a, b, links, groups))
    top = collections.Counter()
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    out = []
    for ident, a, b, links, groups in done:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        shared = sum(len(x) * len(y) for x, y in groups)
        best = sum(count[p] == top[p[1]] for p in links)
        out.append((ident, len(a), len(b), len(groups), len(links), shared, best, sum(count[p] for p in links), digest))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def mixed_texts():
    rng = random.Random(4)
    signs = ["a", "b", "the", " ", "  ", "\n", "é", "日", "▁", "<0x41>", "<s>", "<|endoftext|>", "'s", "1", ".", " ", "\x1c"]
    odd = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(150)]
    odd += [" lead", "trail ", "a b c", "\u0085 x", "x\x00y z", "😀😀 ﬁ ½", "é q"]
    found = list(enumerate([*texts(60), *ODD, *odd]))
    return [*found, (9001, None), (9002, ""), (None, "no id here"), (3, found[3][1])]


def test_alignment(spark, mixed_texts, monkeypatch):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in mixed_texts], "doc_id long, text string, block int, ids string")
    want = plain_alignment(mixed_texts)
    assert sum(r[1] == 0 for r in want) > 3
    got = crosstoken.align_tokenizers(docs.repartition(3), VOCABULARY, PIECES)
    names = "doc_id n_a n_b n_groups n_links n_shared n_best count_sum groups_sha256".split()
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert crosstoken.align_tokenizers(docs.where("false"), VOCABULARY, PIECES).count() == 0
    nulls = crosstoken.align_tokenizers(docs.where("text is null"), VOCABULARY, PIECES)
    assert [tuple(r)[1:] for r in nulls.collect()] == [(0,) * 7 + ("",)]


def test_alignment_of_a_long_text_and_small_blocks(spark):
    long = " ".join(f"wörd{i % 977} {i}" for i in range(150_000))
    rows = [(1, long), (2, "x" * 60_000), (3, "some wörd5 17"), (4, long[:9000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in crosstoken.align_tokenizers(docs, VOCABULARY, PIECES).collect()}
    few = plain_alignment(rows[2:])
    assert [(i, got[i].n_a, got[i].n_b, got[i].n_groups, got[i].n_links) for i, *_ in few] == [r[:5] for r in few]
    assert got[1].n_a > 300_000 and got[1].count_sum > got[4].count_sum > 0


def test_rows_of_megabytes_are_staged_in_small_row_groups(spark):
    """An executor holds a row group of the writer or the reader at once, whatever a task writes."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    def wide(batches):
        for batch in batches:
            for ident in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([ident]), pa.array([np.random.default_rng(ident).bytes(1 << 20)])], names=["id", "row"])

    table = staged(spark.range(60).coalesce(1).mapInArrow(wide, "id long, row binary"), "wide")
    files = [f"{table._folder}/{f}" for f in os.listdir(table._folder) if f.endswith(".parquet")]
    groups = [pq.ParquetFile(f).metadata.row_group(k).num_rows for f in files for k in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert sum(groups) == 60 and max(groups) <= 20
    assert table.agg(F.sum(F.length("row"))).first()[0] == 60 << 20


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(crosstoken, "KNOWN_WORDS", 200)
    tool = crosstoken.Aligner(VOCABULARY, PIECES)
    words = [f" word{i}" for i in range(90)] + [" " + "xyz" * 5000, " short"]
    first = tool.word_alignments(words)
    assert len(tool.known) == 91 and not any(len(w) > crosstoken.KNOWN_CHARS for w in tool.known)
    tool.word_alignments([f" other{i}" for i in range(95)])
    assert len(tool.known) + len(tool.older) <= 200
    assert tool.word_alignments(words) == first and all(isinstance(f, bytes) for f in first)


def test_numbers_in_the_least_width():
    for top in (0, 255, 256, 65_535, 65_536, 2**31 - 1):
        values = np.array([0, top, top // 2], np.int64)
        data = crosstoken._narrow(values)
        assert crosstoken._widened(data).tolist() == values.tolist()
        assert len(data) == 1 + 3 * (1 if top < 256 else 2 if top < 65_536 else 4)
    assert len(crosstoken._widened(crosstoken._narrow(np.zeros(0, np.int32)))) == 0


def test_sparse_products():
    rng = np.random.default_rng(2)
    for _ in range(20):
        shape = rng.integers(0, 7, 3)
        left, right = rng.integers(0, 3, shape[:2]), rng.integers(0, 3, shape[1:])

        def sparse(m):
            rows, columns = np.nonzero(m)
            starts = np.searchsorted(rows, np.arange(len(m) + 1))
            return crosstoken.Csr(starts, columns, m[rows, columns], m.shape[1])

        got = sparse(left).times(sparse(right))
        dense = np.zeros((shape[0], shape[2]), np.int64)
        dense[got.rows(), got.columns] = got.values
        assert (dense == left @ right).all() and (got.values != 0).all()
        back = sparse(left).transposed()
        again = np.zeros(left.T.shape, np.int64)
        again[back.rows(), back.columns] = back.values
        assert (again == left.T).all()


# Whitening


def plain_whitening(vectors, k):
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in vectors.items()}
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * c - s for c, s in zip(v, sums)] for v in fit], float) / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in x.items()}
    white = {i: np.array([n * c - s for c, s in zip(v, sums)], float) / n @ turn / np.sqrt(values) for i, v in x.items()}
    return n, deviation, white, values / (centred**2).sum() * n


@pytest.mark.parametrize("d", [3, 24, 90])
def test_whitening(spark, d):
    rng = np.random.default_rng(d)
    data = rng.standard_normal((400, d)) * np.linspace(3, 0.3, d) + rng.standard_normal(d) * 5
    vectors = {i: v.tolist() for i, v in enumerate(data)} | {1000 + i: data[i % 7].tolist() for i in range(200)}
    bad = [(2000, None), (2001, []), (2002, [None] * d), (2003, [float("nan")] * d), (2004, [float("inf")] + [0.0] * (d - 1)), (2005, [1.0] * (d - 1))]
    rows = [(i, v, 5, 1.0) for i, v in [*vectors.items(), *bad]] + [(None, vectors[0], 5, 1.0), (1, vectors[1], 5, 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, x double").repartition(3)
    n, deviation, white, explained = plain_whitening(vectors, 16)
    got = whitening.component_rows(whitening.whiten(df)).toPandas()
    k = min(16, d)
    assert len(got) == k * (len(vectors) + 2) and (got.n == n).all()
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    table = {i: part.sort_values("component") for i, part in got[got.vec_id.notna()].drop_duplicates(["vec_id", "component"]).groupby("vec_id")}
    sign = np.sign([(table[0].whitened.to_numpy() * white[0])]).ravel()
    for i in vectors:
        assert table[i].deviation.iloc[0] == Decimal(deviation[i])
        assert np.allclose(table[i].whitened.to_numpy() * sign, white[i], atol=1e-8)
        assert np.allclose(table[i].explained, explained, rtol=1e-10)


def test_whitening_of_tables_without_spread(spark):
    schema = "vec_id long, embedding array<double>"
    for rows, left in (([], 0), ([(1, None)], 0), ([(1, [1.0, 2.0]), (2, [1.0, 2.0])], 2)):
        white = whitening.whiten(spark.createDataFrame(rows, schema))
        assert white.count() == left and whitening.component_rows(white).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], schema)
    got = whitening.component_rows(whitening.whiten(line)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-9


def test_components_by_few_products():
    """Far fewer products than dimensions, repeated eigenvalues, and residuals at rounding level."""
    rng = np.random.default_rng(8)
    q = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    values = np.concatenate([[9.0, 9.0, 8.0], 5 * 0.9 ** np.arange(297)])
    matrix, columns = (q * values) @ q.T, []

    def product(v):
        columns.append(v.shape[1])
        return matrix @ v

    found, vectors, residual = whitening.leading_components(product, 300, 8)
    assert np.allclose(found, np.sort(values)[::-1][:8], rtol=1e-12) and residual < 1e-13
    assert np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-13)
    assert len(columns) < 60


def test_minres():
    rng = np.random.default_rng(3)
    m = rng.standard_normal((30, 30))
    m = m + m.T
    b = rng.standard_normal((30, 3))
    assert np.allclose(m @ whitening.minres(lambda v: m @ v, b, 60, 1e-13), b, atol=1e-7)


# Mixing


def test_targets():
    assert mixing.targets([10, 10, 10], [1, 1, 2], 3) == [7.5, 7.5, 15]
    got = mixing.targets([1, 100, 50, 0], [5, 2, 1, 5], 3)
    assert got[0] == 3 and got[3] == 0 and abs(sum(got) - 151) < 1e-9 and abs(got[1] / got[2] - 2) < 1e-9
    assert mixing.targets([], [], 3) == [] and mixing.targets([0, 0], [1, 1], 3) == [0, 0]


def test_permutations():
    for size in (1, 2, 3, 17, 1000, 4097):
        for key in (0, 5):
            got = mixing.permuted(np.arange(size), size, np.full(size, key, np.uint64))
            assert sorted(got.tolist()) == list(range(size))
    a, b = (mixing.permuted(np.arange(1000), 1000, np.full(1000, k, np.uint64)) for k in (1, 2))
    assert (a == b).mean() < 0.02 and abs(np.corrcoef(a, np.arange(1000))[0, 1]) < 0.15


def test_draws_keep_to_the_room():
    wanted, room = np.array([50.0, 9.0, 3.2, 0.0]), np.array([60, 9, 12, 9])
    counts = mixing.draw_counts(wanted, room, 16, 1)
    assert counts.sum() == 62 and (counts.sum(0) <= room).all() and counts[:, 3].sum() == 0
    assert np.abs(counts.sum(0) - wanted).max() <= 3


@pytest.fixture(scope="module")
def mixture_rows():
    rng = random.Random(9)
    rows = []
    for i in range(600):
        source = rng.choice(["big", "big", "big", "big", "mid", "mid", "small", None])
        rows.append((i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 200))), source, 3, "y"))
    rows += [(700, None, "small", 3, "y"), (701, "", None, 3, "y"), (None, "a b c", "mid", 3, "y"), (702, " \t\n", "void", 3, "y")]
    return rows + [(5, "same words twice", "big", 3, "y")] * 2 + [(800, "long " * 40_000, "mid", 3, "y")]


def test_mixing(spark, mixture_rows):
    docs = spark.createDataFrame(mixture_rows, "doc_id long, text string, source string, block int, size string")
    mixture = mixing.mix_sources(docs.repartition(5), [5, 2, 1])
    got = mixture.taken().collect()
    assert len(got) == len(mixture_rows)
    size = collections.Counter()
    for _, text, source, *_ in mixture_rows:
        size[source] += len((text or "").split())
    names = [*sorted(s for s in size if s is not None), None]
    target = dict(zip(names, mixing.targets([size[s] for s in names], [[5, 2, 1][i % 3] for i in range(len(names))], 3)))
    taken = collections.Counter()
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(0.03 * target[s], 3 * 128)
    again = mixing.mix_sources(docs.repartition(2), [5, 2, 1]).taken().collect()
    key = lambda r: (r.id or -1, r.mark, r.copy, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_spans_fill_blocks(spark, mixture_rows):
    docs = spark.createDataFrame(mixture_rows, "doc_id long, text string, source string, block int, size string")
    mixture = mixing.mix_sources(docs, {"big": 1.0, "small": 3.0}, block_words=50, shards=7)
    slots = mixture.slots.collect()
    by_shard = collections.defaultdict(list)
    for r in slots:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    used = collections.Counter((r.number, r.block) for r in slots)
    assert max(used.values()) <= 3
    rounds = collections.defaultdict(set)
    for (number, _), n in used.items():
        rounds[number].add(n)
    assert all(max(r) - min(r) <= 1 for r in rounds.values())
    blocks = collections.defaultdict(int)
    for r in mixture.spans().collect():
        assert 0 <= r.begin and r.words >= 1 and r.begin + r.words <= r.size
        blocks[r.shard, r.slot] += r.words
    assert len(blocks) == len(slots) and max(blocks.values()) == 50
    assert sum(n < 50 for n in blocks.values()) <= 2 * 3
    names = {r.number: r.source for r in mixture.sources.collect()}
    assert {names[r.number] for r in slots} == {"big", "small"}


def test_mixing_empty_tables(spark, mixture_rows):
    docs = spark.createDataFrame(mixture_rows, "doc_id long, text string, source string, block int, size string")
    assert mixing.mix_sources(docs.where("false"), [5, 2, 1]).taken().count() == 0
    blank = mixing.mix_sources(docs.where("coalesce(trim(text), '') = ''"), [5, 2, 1]).taken()
    assert all(r.taken == 0 and r.target == 0 for r in blank.collect()) and blank.count() > 1


def test_word_counts(spark):
    import re

    odd = [*ODD, "a b c\x1cd", "x\x0by\x0cz\r\n", "  "]
    df = spark.createDataFrame(list(enumerate(odd)), "i int, t string")
    got = {r[0]: r[1] for r in df.select("i", mixing.word_count(F.col("t"))).collect()}
    assert got == {i: len(re.findall(WORD, t)) for i, t in enumerate(odd)}
