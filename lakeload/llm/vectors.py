"""Embedding near-dedup by product quantisation: inverted lists, residual codes, exact rerank."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from lakeload.llm.common import components, discard, staged

_SLACK = 1e-4
#: Vectors of one group, which meets another group in one task.
GROUP_BYTES = 16 << 20
#: Rows that one step ships to tasks, as a multiple of all nodes.
STEP_COPIES = 2
#: Rows whose distances to all centres are held at once.
_AT_ONCE = 2_000


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``x`` to ``centres``."""
    found = (x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)
    return np.maximum(found, 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[at : at + _AT_ONCE], centres).argmin(1) for at in range(0, max(len(x), 1), _AT_ONCE)])


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """k-means; centres without rows keep their place."""
    centres = x[rng.permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(rounds):
        home = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        sizes = np.bincount(home, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def _areas(centres: np.ndarray, rng: np.random.Generator, most: int = 63) -> np.ndarray:
    """A number for each centre, the same for centres that lie together; near numbers lie nearer than others."""
    middles = _means(centres, most, rng, 4)
    spread = middles - middles.mean(0)
    along = spread @ np.linalg.svd(spread, full_matrices=False)[2][0]
    order = np.argsort(np.argsort(along, kind="stable"), kind="stable")
    return np.unique(order[_nearest(centres, middles)], return_inverse=True)[1]


@dataclass
class Quantiser:
    """Coarse centres in the order of their areas, and codebooks of the residuals for each subspace."""

    centres: np.ndarray
    parts: list[np.ndarray]
    books: list[np.ndarray]
    areas: np.ndarray

    @staticmethod
    def fit(sample: np.ndarray, lists: int, subspaces: int, codewords: int, seed: int) -> Quantiser:
        rng = np.random.default_rng(seed)
        centres = _means(sample, max(1, min(lists, len(sample) // 8)), rng)
        areas = _areas(centres, rng)
        order = np.argsort(areas, kind="stable")
        centres, areas = centres[order], areas[order]
        rest = sample - centres[_nearest(sample, centres)]
        parts = [p for p in np.array_split(np.arange(sample.shape[1]), subspaces) if len(p)]
        return Quantiser(centres, parts, [_means(rest[:, p], codewords, rng) for p in parts], areas)

    @staticmethod
    def trivial(dimensions: int) -> Quantiser:
        """One list and one code: every vector of the list is a candidate."""
        return Quantiser(np.zeros((1, dimensions)), [np.arange(dimensions)], [np.zeros((1, dimensions))], np.zeros(1, np.int64))

    @functools.cached_property
    def between(self) -> np.ndarray:
        return np.sqrt(_squares(self.centres, self.centres))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home list, codes and distance to what the codes stand for."""
        home = _nearest(x, self.centres)
        rest = x - self.centres[home]
        codes = np.stack([_squares(rest[:, p], b).argmin(1) for p, b in zip(self.parts, self.books)], 1).astype(np.uint8)
        return home, codes, np.sqrt(((x - self.decode(home, codes)) ** 2).sum(1))

    def decode(self, home: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What list and codes stand for."""
        out = self.centres[home]
        for k, (p, b) in enumerate(zip(self.parts, self.books)):
            out[:, p] += b[codes[:, k]]
        return out

    def probes(self, x: np.ndarray, radius: float) -> np.ndarray:
        """All lists that can hold a vector within ``radius``: those whose border is that near.

        The border of two lists is the plane half way between their centres.
        """
        far = _squares(x, self.centres)
        home = far.argmin(1)
        return far - far[np.arange(len(x)), home][:, None] <= 2 * radius * self.between[home] + _SLACK

    def reach(self, x: np.ndarray, radius: float) -> np.ndarray:
        """The areas of these lists, a bit for each."""
        starts = np.flatnonzero(np.diff(self.areas, prepend=-1))
        found = np.logical_or.reduceat(self.probes(x, radius), starts, axis=1)
        return found @ (np.int64(1) << self.areas[starts].astype(np.int64))

    def tables(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """-2 times the products of each row with the centres, and with the codewords by subspace."""
        return -2 * (self.centres @ x.T), [-2 * (b @ x[:, p].T) for p, b in zip(self.parts, self.books)]


def _unit(values: np.ndarray) -> np.ndarray:
    return values / np.sqrt((values * values).sum(1))[:, None]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two: squares of tiny and huge ones stay in range, and no digit changes."""
    return np.ldexp(x, 1 - np.frexp(np.abs(x).max(1))[1][:, None])


def _forest(a: np.ndarray, b: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The smallest name that each position reaches by links a-b."""
    root = names.copy()
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        if (new == root).all():
            return root
        root = new


def _joint(sizes: list[int], rows: int) -> list[list[int]]:
    """Subspaces looked up together: neighbours whose sums fill a table smaller than the rows."""
    out, k = [], 0
    while k < len(sizes):
        two = k + 1 < len(sizes) and sizes[k] * sizes[k + 1] <= min(1_024, rows)
        out.append([k, k + 1] if two else [k])
        k += len(out[-1])
    return out


def _near(index: Quantiser, y: np.ndarray, home: np.ndarray, codes: np.ndarray, reach: np.ndarray, asked: np.ndarray, own: np.ndarray | None, radius: float, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions (asked, own) that table lookups put within the distance; with no ``own``
    each pair of ``asked`` once.  Positions are in the order of their lists.

    Far is |x|^2 - 2 x (c + q) + |c + q|^2, c the centre and q what the codes stand for: lookups give
    the products with x, and the rest is known of each row.
    """
    limit = np.empty(len(y), np.float32)
    for at in range(0, len(y), _AT_ONCE):
        cut = slice(at, at + _AT_ONCE)
        limit[cut] = reach[cut] - 1 - (index.decode(home[cut], codes[cut]) ** 2).sum(1)
    sizes = [len(b) for b in index.books]
    joint = _joint(sizes, len(y))
    places = [codes[:, p[0]].astype(np.intp) * sizes[p[1]] + codes[:, p[1]] if len(p) == 2 else codes[:, p[0]].astype(np.intp) for p in joint]
    others = asked if own is None else own
    room = np.empty((block, 256), np.float32)
    for at in range(0, len(asked), 256):
        part = asked[at : at + 256]
        x = _unit(y[part])
        lists = index.probes(x, radius).any(0)
        rows = others[at:] if own is None else others
        rows = rows[lists[home[rows]]]
        centre, single = index.tables(x)
        centre = np.ascontiguousarray(centre, np.float32)
        tables = [
            np.ascontiguousarray(single[p[0]] if len(p) == 1 else (single[p[0]][:, None] + single[p[1]]).reshape(-1, len(part)), np.float32)
            for p in joint
        ]
        for cut in range(0, len(rows), block):
            some = rows[cut : cut + block]
            far = centre[home[some]]
            for t, place in zip(tables, places):
                far += np.take(t, place[some], axis=0, out=room[: len(some)], mode="clip") if len(part) == 256 else t[place[some]]
            j, i = np.divmod(np.flatnonzero(far <= limit[some][:, None]), len(part))
            i, j = part[i], some[j]
            if own is None:
                once = i < j
                i, j = i[once], j[once]
            if len(i):
                yield i, j


def _compare(index: Quantiser, rows: pa.Table, threshold: float, radius: float, block: int):
    """Links of one tile: (node, number of links, root).  Rows of side 0 meet those of side 1, and
    each other where there is no side 1."""
    rows = rows.take(pa.array(np.argsort(rows["list"].to_numpy(), kind="stable")))
    side = rows["side"].to_numpy()
    every, name = np.unique(rows["node"].to_numpy(), return_inverse=True)
    y = _scaled(_matrix(rows["vector"]))
    codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(rows), -1)
    reach = (radius + rows["error"].to_numpy()) ** 2 + _SLACK
    copies = rows["copies"].to_numpy()
    norm = np.sqrt((y * y).sum(1))
    asked, own = np.flatnonzero(side == 0), np.flatnonzero(side == 1) if side.any() else None
    count, root, met = np.zeros(len(every), np.int64), np.arange(len(every)), np.zeros(len(every), bool)
    for i, j in _near(index, y, rows["list"].to_numpy(), codes, reach, asked, own, radius, block):
        other = name[i] != name[j]
        i, j = i[other], j[other]
        cosine = np.empty(len(i))
        for cut in range(0, len(i), 1 << 16):
            p, q = i[cut : cut + (1 << 16)], j[cut : cut + (1 << 16)]
            cosine[cut : cut + len(p)] = np.einsum("ij,ij->i", y[p], y[q]) / (norm[p] * norm[q])
        i, j = i[cosine >= threshold], j[cosine >= threshold]
        a, b = name[i], name[j]
        np.add.at(count, a, copies[j])
        np.add.at(count, b, copies[i])
        met[a] = met[b] = True
        a, b = root[a], root[b]
        if (a != b).any():
            root = _forest(a[a != b], b[a != b], np.arange(len(every)))[root]
    return every[met], count[met], every[root[met]]


def _steps(placed: DataFrame, total: int, item_bytes: int) -> Iterator[tuple[float, DataFrame]]:
    """``placed`` dealt to tiles ``(label, width, g, h)`` and sides, step by step, with the rows of a step.

    A label of few rows is one tile, (0, 0).  Others are cut into groups in the order of areas; only
    the list of these groups' pairs is broadcast.
    """
    bucket = ["label", "width"]
    whole = Window.partitionBy(*bucket)
    upto = whole.orderBy("area").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    most = F.greatest(F.lit(1), F.floor(F.lit(GROUP_BYTES) / (F.col("width") * item_bytes + 64)))
    areas = (
        placed.groupBy(*bucket, "area")
        .agg(F.count("*").alias("n"), F.bit_or("reach").alias("reach"))
        .select("*", F.sum("n").over(whole).alias("rows"), (F.sum("n").over(upto) - F.col("n")).alias("before"))
        .withColumn("groups", F.ceil(F.col("rows") / most).cast("long"))
        .where("groups > 1")
    )
    areas = staged(areas, "vector-areas")
    zero = F.lit(0).cast("long")
    one_tile = {"g": zero, "h": zero, "side": F.lit(0)}
    if areas.isEmpty():
        yield total, placed.withColumns(one_tile)
        return
    first, last = F.expr("before * groups div rows"), F.expr("(before + n - 1) * groups div rows")
    members = (
        areas.select(*bucket, "groups", "rows", "reach", "area", F.explode(F.sequence(first, last)).alias("g"))
        .groupBy(*bucket, "groups", "rows", "g")
        .agg(F.bit_or("reach").alias("reach"), F.expr("bit_or(shiftleft(1L, area))").alias("held"))
    )
    other = members.select(*bucket, F.col("g").alias("h"), F.col("reach").alias("reach_h"), F.col("held").alias("held_h"))
    apart = F.least(F.col("h") - F.col("g"), F.col("groups") - F.col("h") + F.col("g"))
    tiles = (
        members.join(other, bucket)
        .where("g = h or g < h and (reach & held_h | reach_h & held) <> 0")
        .select(*bucket, "g", "h", F.when(F.col("groups") > 2, apart).otherwise(0).alias("round"), (F.col("rows") / F.col("groups")).alias("size"))
    )
    tiles = staged(tiles, "vector-tiles")
    rounds = tiles.groupBy("round").agg(F.sum(F.when(F.col("g") == F.col("h"), 1).otherwise(2) * F.col("size"))).orderBy("round").collect()
    alone = total - areas.agg(F.sum("n")).first()[0]
    steps = [[0, 0, float(alone)]]
    for number, size in rounds:
        if number and steps[-1][2] + size > STEP_COPIES * total:
            steps.append([number, number, 0.0])
        steps[-1][1] = number
        steps[-1][2] += size
    asked = tiles.select(*bucket, F.col("g").alias("group"), "g", "h", F.lit(0).alias("side"), "round")
    asked = asked.union(tiles.where("g < h").select(*bucket, F.col("h").alias("group"), "g", "h", F.lit(1).alias("side"), "round"))
    group = F.expr("(before + pmod(xxhash64('group', node), n)) * groups div rows").alias("group")
    cut = placed.join(F.broadcast(areas.drop("reach")), [*bucket, "area"], "left").select(*placed.columns, group)
    for low, high, size in steps:
        met = F.broadcast(asked.where(F.col("round").between(low, high)).drop("round"))
        dealt = cut.join(met, [*bucket, "group"], "inner" if low else "left")
        yield size, dealt.withColumns({c: F.coalesce(c, v) for c, v in one_tile.items()})


def vector_groups(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    sample_rows: int = 50_000,
    rows_per_list: int = 1_000,
    subspaces: int = 8,
    codewords: int = 32,
    block: int = 4_096,
    seed: int = 1,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` and ``kept``.

    Vectors of one label whose cosine is at least ``threshold`` are linked.  Equal vectors are one
    node.  Centres and codebooks are fitted on at most ``sample_rows`` nodes, taken in the order of
    a hash; every node is indexed.  A node is asked for in all lists whose border lies within the
    distance that the threshold allows, and a candidate is what the table lookups put within that
    distance plus the known error of its code.  Both bounds hold for every vector, so no link is
    missed; the cosine in double precision decides.

    The rows of a label lie in the order of their lists and are cut into groups of ``GROUP_BYTES``.
    Two groups meet in one task if a list of one is asked from the other; there each pair is looked up
    once, ``block`` rows at a time.  A task returns a count and a root per node instead of its pairs.
    Groups meet in steps that each ship ``STEP_COPIES`` times the nodes at most, and the shuffle of a
    step goes before the next, so disk grows with the rows.

    Vectors that are null, empty, zero or hold null or non-finite parts, and vectors with a null
    label or a null id, link with nothing: no links, their own id as component, kept.  Vectors of
    different lengths do not link.  Equal vectors are links of each other, repeated rows too.  An
    empty table gives no rows; other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    given = F.col(f"`{vector_col}`")
    kind = vectors.select(given).schema[0].dataType
    narrow = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    vector = given.cast("array<double>")
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"), vector.alias("vector"), (given if narrow else vector).alias("stored")
    )
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    rows = rows.withColumn("linked", F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & fine, F.lit(False)))
    key = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit("second seed"), "vector").alias("h2")]
    nodes = staged(
        rows.where("linked")
        .select("id", "label", "stored", *key)
        .groupBy("label", "h1", "h2")
        .agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.first("stored").alias("vector"))
        .withColumn("width", F.size("vector")),
        "vectors",
    )
    total, values = nodes.agg(F.count("*"), F.coalesce(F.sum("width"), F.lit(0))).first()
    hashed, some = F.xxhash64("node"), nodes.select("node", "width", "vector")
    if total > 2 * sample_rows:
        # The rows that sorting would take, and few others.
        some = some.where(hashed <= int(2**64 * (1.2 * sample_rows + 1_000) / total) - 2**63)
    taken = some.orderBy(hashed).limit(sample_rows).select("width", "vector").toArrow()
    indexes: dict[int, Quantiser] = {}
    widths = taken["width"].to_numpy()
    for width in np.unique(widths).tolist():
        sample = _unit(_scaled(_matrix(taken.filter(pa.array(widths == width))["vector"])))
        lists = min(max(1, total // rows_per_list), max(1, len(sample) // 40))
        indexes[width] = Quantiser.fit(sample, lists, subspaces, min(codewords, 256), seed)
    del taken

    def index_of(width: int) -> Quantiser:
        return indexes.get(width) or Quantiser.trivial(width)

    def place(batches):
        for batch in batches:
            for at in range(0, len(batch), _AT_ONCE):
                part = batch.slice(at, _AT_ONCE)
                sizes = part.column("width").to_numpy()
                for width in np.unique(sizes).tolist():
                    some = part.filter(pa.array(sizes == width))
                    index, x = index_of(width), _unit(_scaled(_matrix(some.column("vector"))))
                    home, codes, error = index.encode(x)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *some.columns,
                            pa.array(home.astype(np.int32)),
                            pa.array(index.areas[home].astype(np.int32)),
                            pa.array([c.tobytes() for c in codes], pa.binary()),
                            pa.array(error),
                            pa.array(index.reach(x, radius)),
                        ],
                        names=[*some.schema.names, "list", "area", "code", "error", "reach"],
                    )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    placed = staged(nodes.mapInArrow(place, f"{types}, list int, area int, code binary, error double, reach long"), "placed-vectors")
    discard(nodes)

    def compare(tile: pa.Table) -> pa.Table:
        found = _compare(index_of(tile["width"][0].as_py()), tile, threshold, radius, block)
        return pa.table([pa.array(v) for v in found], names=["node", "links", "root"])

    linked = None
    for rows_met, dealt in _steps(placed, total, 4 if narrow else 8):
        size = rows_met * (values / max(total, 1) * (4 if narrow else 8) + 100)
        tasks = max(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (4 << 20)))
        tile = ["label", "width", "g", "h"]
        met = dealt.select(*tile, "side", "node", "copies", "list", "code", "error", "vector").repartition(tasks, *tile)
        step = staged(met.groupBy(*tile).applyInArrow(compare, "node long, links long, root long"), "vector-links")
        linked = step if linked is None else linked.union(step)
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b"))).distinct()
    known = (
        placed.select("label", "h1", "h2", "node", "copies")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    )
    whole = rows.select("id", "linked", F.when(F.col("linked"), F.col("label")).alias("label"), *key)
    joined = whole.join(known, ["label", "h1", "h2"], "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
