"""SimHash near-dedup with pigeonring filtering; near copies by whole shingle sets."""

from __future__ import annotations

import functools
import math
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import components, discard, per_document, renamed, slices, staged
from lakeload.llm.vectors import _forest

BITS = 64


def shingle_hashes(words: list[bytes], size: int, seed: int = 42) -> bytes:
    """XXH64 of each run of ``size`` words joined by blanks, big-endian, one after another."""
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_digest(joined, seed)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())])


#: The bits of each byte value, highest first.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, size: int = 3) -> int:
    """Bit by bit the majority of the shingles' hashes, as a signed 64-bit number; no word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    hashes = np.frombuffer(shingle_hashes(words, size), np.uint8).reshape(-1, 8)
    if len(hashes) < 512:
        votes = np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    else:
        votes = np.concatenate([np.bincount(hashes[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    bits = np.packbits(votes * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, fingerprint)`` of each whole text, a signed 64-bit number."""
    return per_document(docs, id_col, text_col, lambda texts: [(fingerprint(t, size),) for t in texts], "fingerprint long", binary=True)


def _turned(value: Column, start: int) -> Column:
    """``value`` with bit ``start`` (counted from the top) first and the rest around the ring."""
    if not start:
        return value
    return F.shiftleft(value, start).bitwiseOR(F.shiftrightunsigned(value, BITS - start))


def near_links(prints: DataFrame, distance: int = 2, segments: int = 8, hot: int = 256) -> DataFrame:
    """Links ``(a, b)`` that connect distinct fingerprints exactly as all pairs of at most
    ``distance`` differing bits do.

    Pigeonring: the 64 bits form a ring of equal segments.  If two fingerprints differ in at most
    ``d`` bits, then from some segment on every chain of ``l`` segments differs in at most
    ``l * d / segments`` bits.  The longest chains without any difference give the join key; in the
    join each longer chain is held against its own budget before the whole distance is.

    A key shared by more than ``hot`` fingerprints is not joined pair by pair.  Its members go
    another exact way: each is listed under itself and under each number one bit away, and two
    fingerprints at a distance of two or less always meet under one of those, where all are linked
    to the smallest one.  That costs 65 rows a member, however many meet.
    """
    if BITS % segments or not 0 <= distance <= 2 or distance >= segments:
        raise ValueError("segments must divide 64; distance is at most 2")
    width = BITS // segments
    chain = min(segments, -(-segments // distance) - 1) if distance else segments
    if chain < 1:
        raise ValueError("too few segments for this distance")
    prints = prints.select(F.col("fingerprint").alias("f")).distinct()
    keyed = prints.select(
        "f", F.explode(F.array(*[F.struct(F.lit(k).alias("start"), _turned(F.col("f"), k * width).alias("ring")) for k in range(segments)])).alias("s")
    ).select("f", "s.start", "s.ring", F.shiftrightunsigned("s.ring", BITS - chain * width).alias("key"))
    crowds = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = staged(keyed.join(crowds, ["start", "key"]), "ring-keys")
    few = keyed.where(F.col("n") <= hot)
    other = few.select(F.col("f").alias("g"), F.col("ring").alias("ring2"), F.col("start").alias("start2"), F.col("key").alias("key2"))
    apart = F.col("ring").bitwiseXOR(F.col("ring2"))
    within = F.lit(True)
    for length in range(chain + 1, segments + 1):
        within &= F.bit_count(F.shiftrightunsigned(apart, BITS - length * width)) <= length * distance // segments
    joined = few.join(
        other, (F.col("start") == F.col("start2")) & (F.col("key") == F.col("key2")) & (F.col("f") < F.col("g")) & within
    ).select(F.col("f").alias("a"), F.col("g").alias("b"))
    many = keyed.where(F.col("n") > hot).select("f").distinct()
    flips = [F.lit(0).cast("long"), *[F.lit(1 << k if k < 63 else -(1 << 63)).cast("long") for k in range(BITS)]]
    if distance == 0:
        flips = flips[:1]
    met = many.select("f", F.explode(F.array(*flips)).alias("flip")).select("f", "flip", F.col("f").bitwiseXOR(F.col("flip")).alias("near"))
    if distance == 1:
        # A meeting needs one side to be the number itself.
        centre = met.where("flip = 0").select("near", F.col("f").alias("b"))
        star = met.where("flip <> 0").select(F.col("f").alias("a"), "near").join(centre, "near").select("a", "b")
    else:
        least = met.groupBy("near").agg(F.min("f").alias("b"), F.count("*").alias("n")).where("n > 1")
        star = met.join(least, "near").select(F.col("f").alias("a"), "b")
    return joined.union(star).where("a <> b")


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 3,
    distance: int = 2,
    segments: int = 8,
    hot: int = 256,
) -> DataFrame:
    """``(id, fingerprint, component_id)`` of each row: 16 hex digits, and the smallest id that
    links of at most ``distance`` bits reach.

    Copies share a fingerprint and are one node, whatever their number.  Null, empty and blank
    texts have the fingerprint zero and link like any other; fewer words than a shingle are hashed
    as they are.  Rows with a null id take part in links and get the component's smallest id, null
    if there is none.  Repeated rows get a row each, an empty table none; other columns are not
    read.
    """
    rows = staged(fingerprints(docs, id_col, text_col, size), "fingerprints")
    roots = components(near_links(rows, distance, segments, hot))
    nodes = rows.groupBy("fingerprint").agg(F.min(id_col).alias("least"))
    rooted = staged(
        nodes.join(roots.distinct(), nodes["fingerprint"] == roots["node"], "left").select(
            "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
        ),
        "roots",
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.join(named, "root").select("fingerprint", "component_id")
    return rows.join(members, "fingerprint").select(
        id_col, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


#: Fewest bits of a sketch, segments that the pigeonring chains run over, and the longest chain.
SKETCH_BITS, SKETCH_SEGMENTS, SKETCH_CHAIN = 1024, 16, 4
#: The similarity that near copies have at least.
SIMILARITY = 0.8
#: Bytes of sketches that are held against each other at once.
SKETCH_SLICE = 4 << 20
#: Documents that the order of shingles is drawn from, and shingles with a rank of their own in it.
ORDER_DOCS, ORDER_SHINGLES = 8_192, 200_000
#: Nodes and shingles of a block of a crowd.
BLOCK_NODES, BLOCK_SHINGLES = 512, 1 << 18


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending; fewer words: one of the whole sequence."""
    return np.unique(np.frombuffer(shingle_hashes(text.lower().split(), size), ">u8").astype(np.uint64))


def sketch(hashes: np.ndarray) -> bytes:
    """The number of hashes, and for each place whether an odd number fell there.

    A hash that only one of two sets has changes one bit, so sketches differ in no more bits than
    sets do in hashes.  Places are a power of two, no fewer than the hashes: a wider sketch folds to
    the sketch of fewer places, so that sets of any size are told apart.
    """
    width = max(SKETCH_BITS, 1 << (len(hashes) - 1).bit_length())
    places = np.bincount((hashes % np.uint64(width)).astype(np.int64), minlength=width)
    return np.int64(len(hashes)).tobytes() + np.packbits(places & 1 == 1).tobytes()


def _folded(bodies: list, width: int) -> np.ndarray:
    """Sketches without their counts as rows of ``width`` bytes, wider ones folded."""
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint8, offset=8).reshape(-1, width)) for x in bodies]).view(np.uint64)


def _chains_near(apart: np.ndarray, budget: np.ndarray) -> np.ndarray:
    """Whether rows of differences by segment sum to no more than their budgets.

    Pigeonring: a row within its budget has a segment from which on every chain of ``l`` segments of
    the ring stays within ``l`` parts of it.  Rows without such a chain go before the whole sum is
    formed.
    """
    alive, run = np.ones(apart.shape, bool), np.zeros(apart.shape, np.int32)
    for length in range(SKETCH_CHAIN):
        run += np.roll(apart, -length, axis=1)
        alive &= run * SKETCH_SEGMENTS <= (length + 1) * budget[:, None]
    near = alive.any(axis=1)
    near[near] = apart[near].sum(axis=1) <= budget[near]
    return near


def sketches_near(left: list, right: list, i: np.ndarray, j: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """For each pair ``left[i], right[j]`` of sketches: false only if the sets cannot be similar."""
    counts = [np.array([np.frombuffer(x, np.int64, 1)[0] for x in side], np.int64) for side in (left, right)]
    widths = [np.array([len(x) - 8 for x in side], np.int64) for side in (left, right)]
    small, large = np.minimum(counts[0][i], counts[1][j]), np.maximum(counts[0][i], counts[1][j])
    budget = (1 - similarity) / (1 + similarity) * (small + large) + 1e-6
    near = small >= similarity * large - 1e-6
    width = np.minimum(widths[0][i], widths[1][j])
    for w in np.unique(width[near]).tolist():
        at = np.flatnonzero(near & (width == w))
        (one, x), (two, y) = (np.unique(k[at], return_inverse=True) for k in (i, j))
        a, b = _folded([left[k] for k in one], w), _folded([right[k] for k in two], w)
        step = max(1, SKETCH_SLICE // w)
        for k in range(0, len(at), step):
            part = slice(k, k + step)
            apart = np.bitwise_count(a[x[part]] ^ b[y[part]])
            apart = apart.reshape(len(apart), SKETCH_SEGMENTS, -1).sum(axis=2, dtype=np.int32)
            near[at[part]] = _chains_near(apart, budget[at[part]])
    return near


def jaccard(x, y) -> float:
    """Similarity of two sets given as ascending 64-bit numbers."""
    one, two = (np.frombuffer(v, np.uint64) for v in (x, y))
    common = len(np.intersect1d(one, two, assume_unique=True))
    return common / (len(one) + len(two) - common)


def shingle_order(docs: DataFrame, text_col: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles of a sample, ascending, and the number of documents of each.

    All documents arrange their shingles by it, unknown ones first, equal ones by hash.  Any one
    order serves, so the sample decides only how many documents meet at a key.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    part = F.pmod(F.xxhash64(text), F.lit(max(1, docs.count() // ORDER_DOCS))) == 0

    def hashed(batches):
        for batch in batches:
            for body in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(body, size).view(np.int64))], names=["shingle"])

    drawn = docs.where(part).select(text.cast("binary").alias("body")).mapInArrow(hashed, "shingle long")
    counted = drawn.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    top = counted.orderBy(F.desc("n"), "shingle").limit(ORDER_SHINGLES).toArrow()
    known = top["shingle"].to_numpy().view(np.uint64)
    by = np.argsort(known)
    return known[by], top["n"].to_numpy()[by]


def prefix(hashes: np.ndarray, known: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set in the common order: as many as can be absent from a similar set,
    and one more.  So similar sets share one of these."""
    size = len(hashes) - math.ceil(similarity * len(hashes) - 1e-6) + 1
    if not len(known):
        return hashes[:size]
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return hashes[np.argsort(np.where(known[at] == hashes, counts[at], 0), kind="stable")[:size]]


def shared_keys(nodes: DataFrame) -> DataFrame:
    """``(key, node, place, size, n, leader)``: each shingle in the prefixes of ``n`` nodes, more
    than one, with its place in the node's order and the smallest of the nodes."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(2)]
                sizes = [len(k) for k in keys]
                rows = pa.array(np.repeat(np.arange(len(keys)), sizes))
                places = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), part.column(0).take(rows), pa.array(places), part.column(1).take(rows)],
                    names=["key", "node", "place", "size"],
                )

    keyed = nodes.select("node", "size", "prefix").mapInArrow(run, "key long, node long, place int, size int")
    met = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("leader")).where("n > 1")
    return keyed.join(met, "key")


def _checked(pairs: DataFrame, nodes: DataFrame, column: str, test) -> DataFrame:
    """The pairs ``(a, b)`` for which ``test(values of a, values of b)`` gives true."""

    def run(batches):
        for batch in chain.from_iterable(slices(b, 2) for b in batches):
            good = test([x.as_buffer() for x in batch.column(2)], [y.as_buffer() for y in batch.column(3)])
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    one = nodes.select(F.col("node").alias("a"), F.col(column).alias("x"))
    two = nodes.select(F.col("node").alias("b"), F.col(column).alias("y"))
    full = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return full.mapInArrow(run, "a long, b long")


def leader_candidates(keyed: DataFrame) -> DataFrame:
    """Each node with the smallest one of each of its keys."""
    return keyed.where("leader < node").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()


def open_keys(keyed: DataFrame, roots: DataFrame) -> DataFrame:
    """The keys that still join several components; pairs inside one cannot change the result."""
    rooted = keyed.drop("leader").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return rooted.join(mixed, "key")


def open_pairs(keyed: DataFrame, similarity: float) -> DataFrame:
    """All pairs of two components that share a key, but for those that their sizes and the places
    of the key in both orders rule out."""
    others = keyed.select("key", *[F.col(c).alias(f"{c}2") for c in ("node", "root", "place", "size")])
    most = F.least("place", "place2") + F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2"))
    least = (F.col("size") + F.col("size2")) * (similarity / (1 + similarity)) - 1e-6
    near = F.least("size", "size2") >= F.greatest("size", "size2") * similarity - 1e-6
    found = keyed.join(others, "key").where((F.col("node") < F.col("node2")) & (F.col("root") != F.col("root2")) & near & (most >= least))
    return found.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4_096) -> np.ndarray:
    """How many members each set of one side shares with each of the other."""
    out = np.zeros((len(left), len(right)))
    sides = [np.concatenate(s) for s in (left, right)]
    rows = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right)]
    both = np.intersect1d(*sides)
    kept = [np.isin(s, both) for s in sides]
    rows = [r[k] for r, k in zip(rows, kept, strict=True)]
    cols = [np.searchsorted(both, s[k]) for s, k in zip(sides, kept, strict=True)]
    for at in range(0, len(both), width):
        parts = []
        for r, c, n in zip(rows, cols, out.shape, strict=True):
            inside = (c >= at) & (c < at + width)
            part = np.zeros((n, min(width, len(both) - at)), np.float32)
            part[r[inside], c[inside] - at] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def _tile_links(left: pa.Table, right: pa.Table, similarity: float, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(node, smallest node reached)`` by the similar pairs of two blocks that are in different
    components."""
    sets = [[shingle_set(x.as_py(), size) for x in t["body"]] for t in (left, right)]
    roots = [t["root"].to_numpy() for t in (left, right)]
    names, back = np.unique(np.concatenate([left["node"].to_numpy(), right["node"].to_numpy()]), return_inverse=True)
    common = overlaps(*sets)
    sizes = [np.array([len(x) for x in s]) for s in sets]
    near = common / (sizes[0][:, None] + sizes[1] - common) >= similarity
    i, j = np.nonzero(near & (roots[0][:, None] != roots[1]))
    a, b = back[i], back[len(left) + j]
    reached, met = _forest(a, b, names), np.unique(np.concatenate([a, b]))
    return names[met], reached[met]


def _tile_nodes(left: pa.Table, right: pa.Table | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two blocks (one, with itself, if ``right`` is None) are of a pair in different
    components that the sketches do not rule out and that does not meet at an earlier key."""
    other = left if right is None else right
    roots = [t["root"].to_numpy() for t in (left, other)]
    apart = roots[0][:, None] != roots[1]
    i, j = np.nonzero(apart if right is not None else np.triu(apart))
    bodies = [[x.as_buffer() for c in t["sketch"].chunks for x in c] for t in (left, other)]
    if len(i):
        near = sketches_near(*bodies, i, j, similarity)
        i, j = i[near], j[near]
    before = [{k: frozenset(t["earlier"][k].as_py()) for k in np.unique(at).tolist()} for t, at in ((left, i), (other, j))]
    first = [before[0][x].isdisjoint(before[1][y]) for x, y in zip(i.tolist(), j.tolist())]
    sides = np.zeros(len(left), bool), np.zeros(len(other), bool)
    sides[0][i[first]] = sides[1][j[first]] = True
    return sides if right is not None else (sides[0] | sides[1], np.zeros(0, bool))


def crowd_tiles(keyed: DataFrame, similarity: float) -> DataFrame:
    """``(key, node, root, block, block2, second)``: the tiles that each node of a key goes to, and
    on which side.

    A key whose nodes fit a block is one tile.  Those of a larger key lie in bands of their sizes, a
    band in as many blocks as it needs, and the blocks of one band or of two neighbours meet: sizes
    of a similar pair are no further apart.
    """
    # A little wider than the similarity asks for, so that rounding cannot part a pair by two bands.
    banded = keyed.select("key", "node", "root", "size", F.floor(F.log("size") / (1e-9 - math.log(similarity))).alias("band"))

    def needed(nodes: Column, shingles: Column) -> Column:
        return F.ceil(F.greatest(nodes / BLOCK_NODES, shingles / BLOCK_SHINGLES))

    bands = banded.groupBy("key", "band").agg(F.count("*").alias("nodes"), F.sum("size").alias("shingles"))
    whole = bands.groupBy("key").agg((needed(F.sum("nodes"), F.sum("shingles")) <= 1).alias("whole"))
    parts = F.when(F.col("whole"), F.lit(1).cast("long")).otherwise(needed(F.col("nodes"), F.col("shingles")))
    cut = bands.join(whole, "key").select("key", "band", F.when(~F.col("whole"), F.col("band")).otherwise(-1).alias("span"), parts.alias("parts"))
    cut = staged(cut, "crowd-bands")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    at = cut.select("key", "span", every).distinct().withColumn("block", F.xxhash64("key", "span", "part"))
    others = at.select("key", F.col("span").alias("span2"), F.col("block").alias("block2"))
    tiles = at.join(others, "key").where((F.col("block") <= F.col("block2")) & (F.abs(F.col("span") - F.col("span2")) <= 1))
    sides = F.when(F.col("block") < F.col("block2"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    sent = tiles.select("block", "block2", F.explode(sides).alias("second"))
    sent = sent.withColumn("own", F.when(F.col("second"), F.col("block2")).otherwise(F.col("block")))
    own = F.xxhash64("key", "span", F.pmod(F.xxhash64("node"), F.col("parts")))
    placed = banded.join(cut, ["key", "band"]).select("key", "node", "root", own.alias("own"))
    tiled = staged(placed.join(sent, "own").drop("own"), "crowd-tiles")
    discard(cut)
    return tiled


def crowd_links(keyed: DataFrame, nodes: DataFrame, texts_of, similarity: float, size: int) -> DataFrame:
    """Links ``(a, b)`` that connect what all similar pairs of different components at crowded keys
    connect.

    The nodes of a key meet in its own tiles (``crowd_tiles``): a key of few blocks costs a row or
    two per node, whatever other keys these have.  Tiles are sent sketches first, and all pairs of a
    tile are held against each other inside a task, which names the nodes of pairs that may be
    similar, each pair at the first key that both have.  Only texts of these go to the tile
    (``texts_of``), where all their pairs are compared exactly; one edge per node comes back.  The
    links are a written table.
    """
    tile = ["block", "block2"]
    tiled = crowd_tiles(keyed, similarity)
    listed = tiled.groupBy("node").agg(
        F.first("root").alias("root"), F.collect_list(F.struct("key", *tile, "second")).alias("sent"), F.collect_set("key").alias("keys")
    )
    each = listed.join(nodes.select("node", "sketch"), "node").select("node", "root", "sketch", "keys", F.inline("sent"))
    rows = each.select(*tile, "second", "node", "root", "sketch", F.filter("keys", lambda k: k < F.col("key")).alias("earlier"))

    def sift(key: tuple, table: pa.Table) -> pa.Table:
        one, two = (table.filter(x) for x in (pc.invert(table["second"]), table["second"]))
        found = _tile_nodes(one, two if key[0] != key[1] else None, similarity)
        kept = [t.filter(pa.array(f, pa.bool_())) for t, f in zip((one, two), found, strict=True)]
        return pa.concat_tables(kept).select([*tile, "node", "root", "second"])

    wanted = rows.groupBy(*tile).applyInArrow(sift, "block long, block2 long, node long, root long, second boolean")
    wanted = staged(wanted, "crowd-nodes")
    discard(tiled)
    texts = texts_of(wanted)

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        found = _tile_links(one, two if len(two) else one, similarity, size)
        return pa.table([pa.array(v) for v in found], names=["a", "b"])

    sent = wanted.join(texts, "node")
    left, right = (sent.where(side).select(*tile, "node", "root", "body") for side in ("not second", "second"))
    met = left.groupBy(*tile).cogroup(renamed(right).groupBy(*tile)).applyInArrow(compare, "a long, b long")
    links = staged(met.where("a <> b"), "crowd-links")
    discard(wanted, texts)
    return links


def _texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(node, body)``: a text of each node in ``wanted``.

    Texts take a fraction of the room that their hashes take on disk and in shuffles, so these are
    moved, and the sets are made again where they are compared.
    """
    wanted = staged(wanted.select("node").distinct().join(nodes, "node").select("node", "same", "least"), "wanted")
    texts = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    found = texts.join(wanted, F.col("doc").eqNullSafe(F.col("least"))).select("node", "same", "body")

    def right(batches):
        # Rows of one id may hold other texts.
        for batch in chain.from_iterable(slices(b, 2) for b in batches):
            good = [
                xxhash.xxh3_128_digest(shingle_set(t, size).tobytes()) == same
                for t, same in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist())
            ]
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(2)], names=["node", "body"])

    same = found.mapInArrow(right, "node long, body binary")
    texts = staged(same.groupBy("node").agg(F.first("body").alias("body")), "node-texts")
    discard(wanted)
    return texts


@functools.lru_cache(maxsize=64)
def _known_set(text: bytes, size: int) -> np.ndarray:
    """The last sets of a worker: a text often meets several others in a row."""
    return shingle_set(text, size)


def _similar_texts(size: int, similarity: float):
    """A test of two texts by the Jaccard similarity of their whole sets."""

    def test(left: list, right: list) -> list[bool]:
        sets = ([_known_set(x.to_pybytes(), size) for x in pair] for pair in zip(left, right, strict=True))
        return [jaccard(x, y) >= similarity for x, y in sets]

    return test


def _similar_sketches(similarity: float):
    """A test of two sketches that only sets which cannot be similar fail."""

    def test(left: list, right: list) -> np.ndarray:
        every = np.arange(len(left))
        return sketches_near(left, right, every, every, similarity)

    return test


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    similarity: float = SIMILARITY,
    hot: int = 8,
) -> DataFrame:
    """``(id, component_id)`` of each row: the smallest id that links reach.  Two texts are linked
    if the sets of their ``size``-word shingles, A-Z in lower case, have at least the Jaccard
    ``similarity``, which is computed from the whole sets.

    Texts of one shingle set are one node (by 128 bits of hash).  Every similar pair is a candidate:
    its sets share one of their first shingles in an order common to all (``prefix``), the rarer ones
    of a sample first.  Only what cannot be similar is ruled out, by sizes, places and sketches, the
    latter by pigeonring chains before their whole Hamming distance.
    First each node is held against the smallest one of each of its keys.  At keys that then still
    join several components all pairs are, those of more than ``hot`` nodes by tiles
    (``crowd_links``).

    Null, empty and blank texts share the empty set, fewer words than a shingle count as one.  Rows
    with a null id take part and get the smallest id, null if there is none.  Repeated rows get a
    row each, an empty table none; other columns are not read.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be in (0, 1]")
    known, counts = shingle_order(docs, text_col, size)

    def described(bodies: list) -> list[tuple]:
        sets = [shingle_set(t, size) for t in bodies]
        return [
            (xxhash.xxh3_128_digest(x.tobytes()), len(x), sketch(x), prefix(x, known, counts, similarity).tobytes()) for x in sets
        ]

    described_as = "same binary, size int, sketch binary, prefix binary"
    rows = per_document(docs, id_col, text_col, described, described_as, binary=True)
    firsts = [F.first(c).alias(c) for c in ("size", "sketch", "prefix")]
    # Numbered once, in a written table.
    full = staged(rows.groupBy("same").agg(F.min(id_col).alias("least"), *firsts).withColumn("node", F.monotonically_increasing_id()), "nodes")
    keyed = staged(shared_keys(full), "shared-keys")
    # Prefixes are most of the table and done with.
    nodes = staged(full.drop("prefix"), "nodes")
    discard(full)

    def texts_of(wanted: DataFrame) -> DataFrame:
        return _texts_of(wanted, nodes, docs, id_col, text_col, size)

    def similar(pairs: DataFrame) -> DataFrame:
        pairs = staged(_checked(pairs, nodes, "sketch", _similar_sketches(similarity)), "sketch-pairs")
        texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        links = staged(_checked(pairs, texts, "body", _similar_texts(size, similarity)), "near-links")
        discard(pairs, texts)
        return links

    links = similar(leader_candidates(keyed))
    roots = staged(components(links).distinct(), "near-roots")
    every, keyed = keyed, staged(open_keys(keyed, roots), "open-keys")
    discard(every)
    few, many = keyed.where(F.col("n") <= hot), keyed.where(F.col("n") > hot)
    found = []
    if not few.isEmpty():
        found.append(similar(open_pairs(few, similarity)))
    if not many.isEmpty():
        found.append(crowd_links(many, nodes, texts_of, similarity, size))
    if found:
        roots = staged(components(reduce(DataFrame.union, found, links)).distinct(), "near-roots")
    rooted = staged(
        nodes.join(roots, "node", "left").select("same", "least", F.coalesce("root", "node").alias("root")), "rooted"
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.join(named, "root").select("same", "component_id")

    def known(bodies: list) -> list[tuple]:
        return [(xxhash.xxh3_128_digest(shingle_set(t, size).tobytes()),) for t in bodies]

    # The sets are made again: writing them beside the prefixes would cost more than their words do.
    again = per_document(docs, id_col, text_col, known, "same binary", binary=True)
    return again.join(members, "same").select(id_col, "component_id")
