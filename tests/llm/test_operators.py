"""Each operator against a plain version, on small tables with nulls, empty texts, ties and copies."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeload.llm import bpe, exact, frames, lattice, packing, quality, sharding, simhash, substrings, vectors
from lakeload.llm.common import components, remainder
from lakeload.llm.tokens import Encoder, default_vocabulary, vocabulary
from lakeload.session import shared_dir

PATH = default_vocabulary()
ODD = ["", " ", "it's 'twas''s 're we'll'd", "a<|endoftext|>b", "x  \n\n  y", "日本語 テキスト" * 9, "\U0001f600é", "a" * 4000, "\x00\x1c\x85 x", " " * 500]


def texts(n=120, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 260))) for _ in range(n // 2)]
    out = list(base)
    for text in base[: n // 3]:
        parts = text.split(" ")
        if len(parts) > 3:
            parts[rng.randrange(len(parts))] = "changed"
        out.append(" ".join(parts))
    passage = " ".join(rng.choice(words) for _ in range(57))
    out += [f"{w} {passage} {w}" for w in words[:12]] + ["same text here"] * 5 + [passage.upper()] * 2
    return out


@pytest.fixture(scope="module")
def rows():
    found = list(enumerate(texts())) + [(900 + k, t) for k, t in enumerate(ODD)]
    return [*found, (990, None), (991, None), (None, "text without id"), (5, found[5][1])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With extra columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "x", 7, 1.5) for i, t in rows], "doc_id long, text string, shard string, keep_id long, score double"
    ).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoders_agree_with_the_library(library):
    rng = random.Random(1)
    signs = "abcdelrstvm'' '  \n\t.,1é日  ½"
    odd = ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    want = [ids_of(library, t) for t in odd]
    for encoder in (Encoder(PATH), bpe.SpeculativeEncoder(PATH), bpe.SpeculativeEncoder(PATH, chunk=40, cached_words=50)):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(odd)] == want
    assert 0 < encoder.counts["merged"] < encoder.counts["words"]


def test_bpe_round_trip(docs, empty, rows, library):
    got = bpe.round_trip_digests(docs, PATH).collect()
    assert len(got) == len(rows)
    by_id = {i: t or "" for i, t in rows}
    for r in got:
        text = by_id[r.doc_id]
        ids = ids_of(library, text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.bpe_decode(bpe.bpe_encode(docs, PATH), PATH)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(i, t or "") for i, t in rows}
    assert bpe.round_trip_digests(empty, PATH).count() == 0


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact(docs, empty, rows, keep):
    got = exact.exact_dedup(docs, keep=keep)
    assert got.columns == ["doc_id", "text", "shard", "score", "keep_id", "group_size", "kept", "text_sha256"]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    pick = min if keep == "smallest" else max
    assert got.count() == len(rows)
    for r in got.collect():
        ids = groups[lowered(r.text)]
        best = pick((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (best, len(ids), r.doc_id == best)
        assert r.text_sha256 == hashlib.sha256(lowered(r.text).encode()).hexdigest()
    assert exact.exact_dedup(empty).count() == 0


def plain_repeats(rows, threshold=50):
    least = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - threshold + 1):
            key = b" ".join(words[k : k + threshold])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = {}
    for i, t in rows:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - threshold + 1):
            if i is not None and least[b" ".join(words[k : k + threshold])] < i:
                gone[k : k + threshold] = [True] * threshold
        out[i] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return out


@pytest.mark.parametrize("threshold, anchor", [(50, 17), (8, 3), (5, 5)])
def test_substrings(docs, empty, rows, threshold, anchor):
    want = plain_repeats(rows, threshold)
    assert sum(w[1] for w in want.values()) > 0
    got = substrings.substring_dedup(docs, threshold=threshold, anchor=anchor).collect()
    assert len(got) == len(rows)
    for r in got:
        n, removed, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed) == (n, removed), r.doc_id
        if removed:
            assert r.text == kept
    assert {r.text for r in got if r.doc_id in (990, 991)} == {None}
    assert substrings.substring_dedup(empty).count() == 0


def plain_print(text, size=3):
    words = lowered(text).encode().split()
    runs = [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(names, linked):
    root = {n: n for n in names}
    for _ in names:
        before = dict(root)
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    return root


@pytest.mark.parametrize("hot", [0, 256])
def test_simhash(docs, empty, rows, hot):
    prints = {i: plain_print(t) for i, t in rows if i is not None}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    root = plain_components(prints, linked)
    got = simhash.simhash_groups(docs, hot=hot).collect()
    assert len(got) == len(rows) and linked
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", root[r.doc_id])
    assert simhash.simhash_groups(empty).count() == 0


@pytest.mark.parametrize("distance, segments", [(0, 8), (1, 8), (2, 8), (2, 4), (2, 16)])
@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_near_links_reach_what_all_pairs_reach(spark, distance, segments, hot):
    rng = random.Random(distance * 7 + segments)
    prints = {rng.getrandbits(64) for _ in range(20)}
    for p in list(prints):
        for _ in range(6):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fingerprint long"), distance, segments, hot)
    want = plain_components(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance])
    got = {r.node: r.root for r in components(links).collect()}
    assert {s: got.get(s, s) for s in signed} == want


def plain_set(text, size=5):
    words = lowered(text or "").encode().split()
    return {b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}


def plain_near(texts, similarity=0.8):
    """All pairs of ids whose five-word shingle sets are similar."""
    sets = {i: plain_set(t) for i, t in texts.items()}
    return [
        (a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])
    ]


def test_near_copies(spark, docs, empty, rows):
    texts = {i: t for i, t in rows if i is not None}
    linked = plain_near(texts)
    root = plain_components(texts, linked)
    got = simhash.near_copies(docs).collect()
    assert len(got) == len(rows) and any(texts[a] != texts[b] for a, b in linked)
    assert all(r.component_id == root[r.doc_id] for r in got if r.doc_id is not None)
    assert simhash.near_copies(empty).count() == 0


@pytest.mark.parametrize("hot", [1, 8])
def test_near_copies_of_a_crowd(spark, hot):
    """Copies of two texts, each with two words changed, and texts that share half with one."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    one, two = [word() for _ in range(200)], [word() for _ in range(160)]
    found = []
    for base in (one, two):
        for _ in range(40):
            copy = list(base)
            for _ in range(2):
                copy[rng.randrange(len(copy))] = word()
            found.append(" ".join(copy))
    found += [" ".join(one[:100] + [word() for _ in range(100)]) for _ in range(10)]
    texts = dict(enumerate(found))
    root = plain_components(texts, plain_near(texts))
    assert len(set(root.values())) == 12
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.component_id for r in simhash.near_copies(frame, hot=hot).collect()} == root


def near_as_all_pairs(spark, found):
    """Components of ``near_copies``, held against all pairs."""
    texts = dict(enumerate(found))
    root = plain_components(texts, plain_near(texts))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.component_id for r in simhash.near_copies(frame).collect()} == root
    return root


def test_near_copies_of_short_texts(spark):
    """Eight words and the same with one appended: similar by exactly 0.8."""
    rng = random.Random(29)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    short = [[word() for _ in range(8)] for _ in range(60)]
    root = near_as_all_pairs(spark, [" ".join(w) for w in short] + [" ".join([*w, word()]) for w in short])
    assert len(set(root.values())) == 60


def test_near_copies_of_a_star(spark):
    """An original amid 1,000 copies that link to it and mostly not to each other."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    base, star = [word() for _ in range(204)], []
    for _ in range(1000):
        copy, at = list(base), rng.randrange(0, 180)
        copy[at : at + 12] = [word() for _ in range(12)]
        star.append(" ".join(copy))
    star.insert(500, " ".join(base))
    assert len(plain_near(dict(enumerate(star[:100])))) < 1000
    assert set(near_as_all_pairs(spark, star).values()) == {0}


def test_near_copies_amid_boilerplate(spark):
    """Near pairs among texts of which most is the same, though too little to link them all."""
    rng = random.Random(37)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    form, own = [word() for _ in range(90)], [[word() for _ in range(30)] for _ in range(100)]
    root = near_as_all_pairs(spark, [" ".join(form + w) for w in own] + [" ".join([*form, *w[:-2], word(), word()]) for w in own[:40]])
    assert len(set(root.values())) == 100


def test_near_copies_of_a_crowd_in_small_blocks(spark, monkeypatch):
    """Near pairs of all sizes amid boilerplate, where a key takes many blocks and bands."""
    monkeypatch.setattr(simhash, "BLOCK_NODES", 4)
    rng = random.Random(43)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    form, found = [word() for _ in range(60)], []
    for k in range(60):
        own = [word() for _ in range(20 + k)]
        found += [" ".join(form + own), " ".join([*form, *own[:-1], word()]), " ".join([*form, *own, *[word() for _ in range(5)]])]
    root = near_as_all_pairs(spark, found)
    assert 2 <= len(set(root.values())) <= 60


def test_tiles_of_a_crowd(spark, monkeypatch):
    """Nodes of many small keys are sent once a key, whatever keys the others have; in a key of many
    blocks each pair of similar sizes meets in one tile."""
    rng = random.Random(47)
    mixed = [(key, node, node, 100) for key in range(100) for node in rng.sample(range(200), 20)]
    columns = "key long, node long, root long, size int"
    assert simhash.crowd_tiles(spark.createDataFrame(mixed, columns), 0.8).count() == len(mixed)
    monkeypatch.setattr(simhash, "BLOCK_NODES", 8)
    sizes = {node: rng.randrange(1, 400) for node in range(120)}
    crowd = [(5, node, node, size) for node, size in sizes.items()]
    sent = simhash.crowd_tiles(spark.createDataFrame(crowd, columns), 0.8).collect()
    tiles = {}
    for r in sent:
        tiles.setdefault((r.block, r.block2), ([], []))[r.second].append(r.node)
    met = []
    for (one, two), (left, right) in tiles.items():
        pairs = itertools.combinations(left, 2) if one == two else itertools.product(left, right)
        met += [tuple(sorted(p)) for p in pairs]
    near = {(a, b) for a, b in itertools.combinations(sizes, 2) if min(sizes[a], sizes[b]) >= 0.8 * max(sizes[a], sizes[b])}
    assert len(met) == len(set(met)) and near <= set(met)
    assert len(sent) < 120 * len({r.block for r in sent})


def test_sketch_and_similarity():
    text = b" ".join(b"w%d" % (k % 700) for k in range(3000))
    hashes = simhash.shingle_set(text, 5)
    assert len(hashes) == 700 and simhash.sketch(hashes) == simhash.sketch(hashes[::-1])
    assert simhash.jaccard(hashes.tobytes(), hashes[70:].tobytes()) == 0.9
    drawn = [simhash.sketch(h) for h in (hashes, hashes[70:], hashes[:350], hashes[350:])]
    assert simhash.sketches_near(drawn, drawn, np.array([0, 2]), np.array([1, 3])).tolist() == [True, False]


def test_sketches_rule_out_no_similar_sets():
    """Sets of 1 to 9,000 numbers, so that sketches of several widths meet, against whole sets."""
    rng = np.random.default_rng(41)
    sets = []
    for size in (1, 2, 9, 120, 1000, 1020, 1100, 8100, 9000):
        base = np.unique(rng.integers(0, 1 << 63, size, np.uint64))
        for share in (1, 0.95, 0.9, 0.85, 0.8, 0.6, 0.3):
            kept = base[: max(1, round(len(base) * share))]
            sets.append(kept)
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, size - len(kept), np.uint64)])))
    sketches = [simhash.sketch(s) for s in sets]
    i, j = (k.ravel() for k in np.indices((len(sets), len(sets))))
    near = simhash.sketches_near(sketches, sketches, i, j)
    similar = np.array([simhash.jaccard(sets[a].tobytes(), sets[b].tobytes()) for a, b in zip(i, j, strict=True)])
    assert near[similar >= 0.8].all() and not near[similar < 0.5].any()
    assert 0 < (near & (similar < 0.8)).sum() < (similar >= 0.8).sum()


def test_chains_of_segments_go_no_further_than_the_whole_distance():
    rng = np.random.default_rng(43)
    apart = rng.integers(0, 9, (4_000, simhash.SKETCH_SEGMENTS)).astype(np.int32)
    budget = rng.uniform(20, 120, len(apart))
    assert (simhash._chains_near(apart, budget) == (apart.sum(axis=1) <= budget)).all()


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 103), (103, 101), (7, 7)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, 0) for k in range(61)} | {(k, 100) for k in (100, 101, 103)}


def test_packing(docs, empty, rows, library):
    got = packing.pack_documents(docs, PATH, group_tokens=2000, step_tokens=4096).collect()
    want = collections.Counter((i, *ids_of(library, t), 0) for i, t in rows)
    pieces = collections.defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        pieces[r.doc_id, r.doc_tokens].append((r.start, ids))
    for (i, tokens), found in pieces.items():
        copies = [k for k in want if k[0] == i and len(k) - 1 == tokens]
        ids = [x for _, part in sorted(found) for x in part]
        assert len(ids) == sum(want[k] for k in copies) * tokens
        if len(copies) == 1 and want[copies[0]] == 1:
            assert ids == list(copies[0][1:])
    assert len(pieces) == len({(k[0], len(k) - 1) for k in want})
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length, r.tier))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _, _ in parts] == [sum(n for _, n, _ in parts[:k]) for k in range(len(parts))]
        total = sum(n for _, n, _ in parts)
        assert total == parts[0][2] <= 1024 and total & (total - 1) == 0
    assert packing.pack_documents(empty, PATH).count() == 0


def test_steps_hold_no_more_than_their_tokens():
    held, seen = collections.Counter(), []
    packer = packing.Packer(packing.TIERS, 4096, lambda sequence, length, step, pieces: (held.update({step: length}), seen.append(length)))
    for doc, tokens in enumerate([1024] * 10 + [512] * 40 + [128] * 11):
        packer.add(doc, tokens)
    packer.pack()
    packer.finish()
    assert sum(seen) == 1024 * 10 + 512 * 40 + 128 * 11 and set(seen) >= {1024, 512}
    assert max(held.values()) <= 4096


def test_token_files(spark, docs, empty, rows, library):
    files = frames.write_token_files(docs, PATH, shared_dir(spark, "token-test"))
    got = sorted(frames.read_token_files(files).collect(), key=lambda r: r.start)
    assert sorted([(r.doc_id or -1, np.frombuffer(r.ids, "<u4").tolist()) for r in got]) == sorted([(i or -1, [*ids_of(library, t), 2]) for i, t in rows])
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    found = {}
    for r in files.collect():
        with frames.open_file(r.file) as stream:
            found |= dict(frames.TokenFile(stream).find([7, 8]))
    assert {k: np.frombuffer(v, "<u4").tolist() for k, v in found.items()} == {k: [*ids_of(library, rows[k][1]), 2] for k in (7, 8)}
    assert frames.read_token_files(frames.write_token_files(empty, PATH, shared_dir(spark, "token-test"))).count() == 0


def test_token_file_checksum(tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "FRAME_BYTES", 8)
    name = str(tmp_path / "a.tok.zst")
    with frames.open_file(name, write=True) as stream:
        writer = frames.TokenFileWriter(stream)
        writer.add(1, b"0123456789abcdef")
        writer.add(None, b"")
        writer.close()
    with frames.open_file(name) as stream:
        file = frames.TokenFile(stream)
        assert (file.read(0), file.read(1)) == (b"0123456789abcdef", b"")
        file.entries = file.entries.copy()
        file.entries["check"][1] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            file.read(0)


def test_sharding(docs, empty, rows):
    got = sharding.shard_rows(docs, 7, rows_per_partition=10, least_partitions=3)
    assert got.columns == ["doc_id", "text", "keep_id", "score", "shard", "slot"]
    found = got.collect()
    assert collections.Counter((r.doc_id, r.text) for r in found) == collections.Counter(rows)
    slots = collections.defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    sizes = [len(v) for v in slots.values()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_rows(empty, 7).count() == 0


def test_hypergeometric_follows_its_law():
    rng = random.Random(5)
    draws = [sharding.hypergeometric(rng, 12, 18, 10) for _ in range(20_000)]
    for k in range(11):
        p = math.comb(12, k) * math.comb(18, 10 - k) / math.comb(30, 10)
        assert abs(draws.count(k) / len(draws) - p) < 5 * math.sqrt(p / len(draws)) + 1e-3
    big = [sharding.hypergeometric(rng, 10**10, 23 * 10**10, 10**6) for _ in range(300)]
    assert abs(sum(big) / 300 - 10**6 / 24) < 60
    matrix = sharding.communication_matrix([5, 0, 9], [7, 7], 1)
    assert [sum(r) for r in matrix] == [5, 0, 9] and [sum(c) for c in zip(*matrix)] == [7, 7]


def plain_score(word, scores, memo):
    """Sum over all segmentations, by recursion."""
    if not word:
        return 1.0
    if word not in memo:
        memo[word] = sum(scores[word[:k]] * plain_score(word[k:], scores, memo) for k in range(1, len(word) + 1) if word[:k] in scores)
    return memo[word]


def test_lattice(docs, empty, rows, library):
    got = lattice.lattice_scores(docs, PATH, remainder("doc_id", 7) == 2, block_bytes=2000).collect()
    tokens = [(i, lowered(t).encode().split() + [b""]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    c = collections.Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    pieces, ends = collections.Counter(), c[b""]
    for word, k in c.items():
        if word:
            for p in vocabulary(PATH).merge(" " + word.decode()):
                pieces[p] += k
    size = library.get_vocab_size()
    mass = sum(pieces.values()) + ends + size + 1
    scores = {w: (pieces[i] + 1) / mass for w, i in vocabulary(PATH).ids.items()}
    want = collections.Counter()
    for (i, ws), h in zip(tokens, held):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        if max(map(len, ws)) < 100:
            score = sum(math.log10(plain_score(b" " + w, scores, {})) if w else math.log10((ends + 1) / mass) for w in ws)
            want[i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6), round(score, 6)] += 1
    have = collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert len(got) == len(rows) and want <= have and {True, False} <= {r.held_out for r in got}
    assert lattice.lattice_scores(empty, PATH, remainder("doc_id", 7) == 2).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    data = [(k, (centres[k % 30] + rng.normal(size=16) * 0.11 * (k % 3)).tolist(), k % 4 // 2) for k in range(300)]
    data += [(400 + k, data[3][1], data[3][2]) for k in range(5)] + [(420, [2 * x for x in data[4][1]], data[4][2]), (421, [1e-30 * x for x in data[4][1]], data[4][2])]
    odd = [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] + [1.0] * 15, 1), (503, [None] + [1.0] * 15, 1), (504, data[3][1], None), (505, [], 1), (506, [1.0, 2.0], 0), (507, [float("inf")] * 16, 0)]
    frame = spark.createDataFrame([(i, v, m, 1) for i, v, m in data + odd + [(None, data[0][1], 0)]], "vec_id long, embedding array<double>, label int, n_links int")
    x = np.array([v for _, v, _ in data])
    x /= np.sqrt((x * x).sum(1))[:, None]
    label = np.array([m for *_, m in data])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    names = [i for i, *_ in data]
    root = plain_components(names, [(names[a], names[b]) for a, b in zip(*np.nonzero(linked))])
    want = {i: (int(linked[k].sum()), root[i], root[i] == i) for k, i in enumerate(names)}
    want |= {i: (0, i, True) for i, *_ in odd} | {None: (0, None, True)}
    assert linked.sum() > 100
    for options in ({}, {"block": 3, "rows_per_list": 20, "sample_rows": 200}):
        got = vectors.vector_groups(frame, **options).collect()
        assert len(got) == len(want)
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want
    assert vectors.vector_groups(frame.where("false")).count() == 0


def test_vectors_of_many_groups(spark, monkeypatch):
    """No step ships more than twice the rows, however many lists a vector is asked in; old code
    shipped each vector to every such list at once."""
    rng = np.random.default_rng(4)
    data = rng.normal(size=(1200, 24)).astype(np.float32)
    data[600:900] = data[:300] * 3 + rng.normal(size=(300, 24)) * 0.15
    data[900:950] = data[0] + rng.normal(size=(50, 24)) * 0.02
    label = [int(k % 10 == 7) for k in range(600)] * 2
    frame = spark.createDataFrame([(k, v.tolist(), m) for k, (v, m) in enumerate(zip(data, label))], "vec_id long, embedding array<float>, label int")
    x = data.astype(float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    linked = (x @ x.T >= 0.98) & (np.array(label)[:, None] == label)
    np.fill_diagonal(linked, False)
    root = plain_components(range(1200), zip(*map(np.ndarray.tolist, np.nonzero(linked))))
    assert linked.sum() > 1500 and (linked.sum(1) == 0).sum() > 300
    plain, met = vectors._steps, []

    def steps(placed, total, item_bytes):
        for size, dealt in plain(placed, total, item_bytes):
            tiles = dealt.groupBy("label", "width", "g", "h").count().collect()
            met.append((sum(t["count"] for t in tiles) / total, size / total, max(t["count"] for t in tiles), len(tiles)))
            yield size, dealt

    monkeypatch.setattr(vectors, "_steps", steps)
    for group_bytes, most in ((140 * 160, 340), (60 * 160, 180)):
        monkeypatch.setattr(vectors, "GROUP_BYTES", group_bytes)
        met.clear()
        got = vectors.vector_groups(frame, rows_per_list=40, block=64).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {k: (int(linked[k].sum()), root[k], root[k] == k) for k in range(1200)}
        assert len(met) > 1 and all(rows < 2.2 and size < 2.001 and tile < most for rows, size, tile, _ in met)


def test_lookups_are_the_distances_of_the_codes():
    rng = np.random.default_rng(8)
    x = vectors._unit(rng.normal(size=(1500, 20)))
    index = vectors.Quantiser.fit(x[:900], 30, 8, 32, 1)
    home, codes, error = index.encode(x)
    order = np.argsort(home, kind="stable")
    x, home, codes, error = x[order], home[order], codes[order], error[order]
    assert np.allclose(((x - index.decode(home, codes)) ** 2).sum(1), error**2)
    assert (np.diff(index.areas) >= 0).all() and index.areas[0] == 0
    far = ((x[:, None] - index.decode(home, codes)) ** 2).sum(2)
    for own in (None, np.arange(700, 1500)):
        asked = np.arange(1500 if own is None else 700)
        for block in (64, 4096):
            got = set()
            for i, j in vectors._near(index, x, home, codes, np.full(1500, 0.9), asked, own, 2.0, block):
                got |= set(zip(i.tolist(), j.tolist()))
            a, b = np.nonzero(far <= 0.9)
            keep = a < b if own is None else (a < 700) & (b >= 700)
            border = np.abs(far - 0.9) < 1e-5
            assert got ^ set(zip(a[keep].tolist(), b[keep].tolist())) <= set(zip(*map(np.ndarray.tolist, np.nonzero(border))))
            assert len(got) > 100
    assert (index.reach(x, 0.2) >> index.areas[home] & 1).all()


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = remainder("doc_id", 4) == 2
    model = quality.train_quality(docs, labels, held)
    found = quality.with_quality(docs, model).join(labels, "doc_id").where(held).select("score", "predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.95 * len(found) > 50
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 100_000), (None, "a b")], "doc_id long, text string")
    scored = {r.doc_id: r.score for r in quality.with_quality(odd, model).collect()}
    assert len(scored) == 4 and scored[1] == scored[2]
    assert quality.with_quality(odd.where("false"), model).count() == 0
    unknown = quality.train_quality(docs, labels.where("false"), F.lit(False))
    assert {r.predicted for r in quality.with_quality(odd, unknown).collect()} == {1}


def test_quality_learns_an_interaction():
    x = np.random.default_rng(0).random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    alone = quality.fit(x, y, rounds=30, pairs=0)
    both = quality.fit(x, y, rounds=30, pair_rounds=60)
    assert ((alone.scores(x) > 0.5) == y).mean() < 0.75 < 0.97 < ((both.scores(x) > 0.5) == y).mean()


def test_words_that_collide_modulo_powers_of_two(spark):
    """Polynomials modulo 2^64 give these two words one hash, whatever their odd base."""
    pattern = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = pattern.translate(str.maketrans("ab", "ba"))
    assert substrings.Words(*_buffers([pattern])).hash[0] != substrings.Words(*_buffers([other])).hash[0]
    around = " ".join(["same"] * 60)
    docs = spark.createDataFrame([(1, f"{around} {pattern} {around}"), (2, f"{around} {other} {around}"[:1390])], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substrings.substring_dedup(docs).collect()}
    want = plain_repeats([(r.doc_id, r.text) for r in docs.collect()])
    assert {i: v[:2] for i, v in got.items()} == {i: tuple(v[:2]) for i, v in want.items()}
    sequence = [pattern[i] for i in range(1024)]
    swapped = [other[i] for i in range(1024)]
    one, two = (substrings.Words(*_buffers([" ".join(w)])) for w in (sequence, swapped))
    for k in (0, 1):
        ends = np.array([0]), np.array([1024])
        assert one.run(*ends, k) != two.run(*ends, k)


def _buffers(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def test_products_modulo_the_prime():
    rng = random.Random(6)
    a, b = ([rng.randrange(substrings.PRIME) for _ in range(300)] + [0, 1, substrings.PRIME - 1] for _ in range(2))
    got = substrings._product(np.array(a, np.uint64), np.array(b, np.uint64)).tolist()
    assert got == [x * y % substrings.PRIME for x, y in zip(a, b)]
    values = np.array(a, np.uint64)
    sums = substrings._prefix(values, 1)
    base = substrings.BASES[1]
    want = [0]
    for i, x in enumerate(a):
        want.append((want[-1] + x * pow(base, i, substrings.PRIME)) % substrings.PRIME)
    assert sums.tolist() == want


def test_lattice_of_long_words():
    """Against a recursion that keeps every position, in the same and in other scripts."""
    size = vocabulary(PATH).size
    weights = np.log(np.random.default_rng(1).random(size) / size)
    model = lattice.Lattice(PATH, weights, -3.0)
    rng = random.Random(2)
    for word in ("a" * 5000, "".join(rng.choice("abcdetion") for _ in range(3000)), "日本語テキスト" * 150, "x", "é" * 300):
        text = b" " + word.encode()
        sums = [-math.inf] * (len(text) + 1)
        sums[0] = 0.0
        for j in range(1, len(text) + 1):
            ways = [sums[i] + model.scores[text[i:j]] for i in range(max(0, j - model.ring), j) if text[i:j] in model.scores]
            sums[j] = float(np.logaddexp.reduce(ways)) if ways else -math.inf
        assert math.isclose(model.word(word.encode()), sums[-1], rel_tol=1e-12)


def test_quality_tables_are_sums_of_trees():
    """Tables against trees that are kept apart and walked for each row."""
    rng = np.random.default_rng(5)
    x = rng.random((700, 3)).round(2)
    y = (x[:, 0] + rng.normal(0, 0.2, 700) > 0.5).astype(float)
    model = quality.fit(x, y, bins=8, rounds=6, pairs=0)
    edges = [np.unique(np.quantile(v, np.linspace(0, 1, 9)[1:-1])) for v in x.T]
    logit, trees = np.full(700, math.log((y.sum() + 1) / (700 - y.sum() + 1))), []

    def worth(g, h, rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + 1)

    for _ in range(6):
        for k in range(3):
            p = 1 / (1 + np.exp(-logit))
            g, h = y - p, p * (1 - p)
            leaves = [(-math.inf, math.inf)]
            for _ in range(2):
                best = (1e-9, None)
                for a, b in leaves:
                    inside = (x[:, k] >= a) & (x[:, k] < b)
                    for e in edges[k]:
                        left, right = inside & (x[:, k] < e), inside & (x[:, k] >= e)
                        if a < e < b and h[left].sum() >= 2 and h[right].sum() >= 2:
                            rise = worth(g, h, left) + worth(g, h, right) - worth(g, h, inside)
                            if rise > best[0] + 1e-12:
                                best = (rise, (a, e, b))
                if best[1]:
                    a, e, b = best[1]
                    leaves = sorted([leaf for leaf in leaves if leaf != (a, b)] + [(a, e), (e, b)])
            rows = [(x[:, k] >= a) & (x[:, k] < b) for a, b in leaves]
            trees.append((k, [(a, b, 0.1 * g[r].sum() / (h[r].sum() + 1)) for (a, b), r in zip(leaves, rows)]))
            for r, (_, _, value) in zip(rows, trees[-1][1]):
                logit[r] += value
    fresh = rng.random((300, 3))
    want = [trees and logit0 + sum(v for k, leaves in trees for a, b, v in leaves if a <= row[k] < b) for row in fresh for logit0 in [model.intercept]]
    assert np.allclose(model.logits(fresh), want, atol=1e-9)


def test_quality_is_blind_to_held_out_labels_and_origin(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = remainder("doc_id", 4) == 2
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    moved = docs.withColumns({"lang": F.lit("xx"), "source": F.reverse("source"), "n_chars": F.lit(0)})
    scores = []
    for d, wanted in ((docs, labels), (docs, flipped), (moved, labels)):
        model = quality.train_quality(d, wanted, held, rounds=20, pair_rounds=5)
        scores.append({r.doc_id: r.score for r in quality.with_quality(d, model).collect()})
    assert scores[0] == scores[1] == scores[2]


def test_digest_columns(spark, docs, rows, library):
    """The columns that queries derive: kept words, sizes and checksums."""
    cut = {(r.doc_id, r.n_words): r.kept_sha256 for r in substrings.substring_dedup(docs, digest=True).collect()}
    # Id 5 stands for two texts.
    for i, (n, _, text) in plain_repeats([r for r in rows if r[0] is not None]).items():
        assert i == 5 or cut[i, n] == hashlib.sha256(text.encode()).hexdigest()


def test_checksums_of_the_queries(spark, library):
    from lakeload.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = {i: ids_of(library, t) for i, t in texts.items()}
    crc = lambda values: zlib.crc32(np.array(values, "<u4").tobytes())
    for r in QUERIES["op8_sharding"](spark, sf).collect():
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    for r in QUERIES["op5_packing"](spark, sf).collect():
        whole = [*ids[r.doc_id], 0]
        assert (r.doc_tokens, r.ids_crc32) == (len(whole), crc(whole[r.start : r.start + r.length]))
    start = 0
    for r in sorted(QUERIES["op9_token_files"](spark, sf).collect(), key=lambda r: r.doc_id):
        whole = [*ids[r.doc_id], 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(whole), crc(whole))
        start += len(whole)
