"""Embedding whitening by Jacobi-Davidson on a covariance that is never formed.

The covariance is known by its products with a few vectors, each a pass of centred rows over all
tasks.  Correction equations of all open components are solved together by inner MINRES, and the
search space is reduced by Rayleigh-Ritz until every residual is at the level of rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import staged

EPS = np.finfo(float).eps
#: Partial sums meet in this many groups before the driver adds those up.
LANES = 32


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, x)`` with x = floor(64 c) of every entry; rows without a whole finite vector are dropped."""
    entries = F.col(vector_col).cast("array<double>")
    finite = F.forall(entries, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    whole = rows.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    return whole.select(F.col(id_col).alias("id"), F.transform(entries, lambda c: F.floor(c * 64).cast("long")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _totals(fit: DataFrame, work: Callable[[np.ndarray], np.ndarray], kind: str) -> list[np.ndarray]:
    """The sums of ``work(rows)`` over all rows, added within tasks, then within lanes."""

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            lane = TaskContext.get().partitionId() % LANES
            yield pa.RecordBatch.from_arrays(
                [pa.array([lane], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["lane", "part"]
            )

    def together(found: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p, kind) for p in found.column("part").to_pylist())
        return pa.table({"part": pa.array([total.tobytes()], pa.binary())})

    parts = fit.select("x").mapInArrow(inside, "lane int, part binary")
    lanes = parts.groupBy("lane").applyInArrow(together, "part binary")
    return [np.frombuffer(r["part"], kind) for r in lanes.collect()]


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Solutions of one symmetric system for each column of ``b``, all advanced by the same products."""
    beta = np.linalg.norm(b, axis=0)
    start = beta.copy()
    ok = beta > 0
    v_old, v = np.zeros_like(b), np.where(ok, b / np.where(ok, beta, 1), 0)
    x, w_old, w = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    c_old = c = np.ones(b.shape[1])
    s_old = s = np.zeros(b.shape[1])
    eta, beta_k = beta.copy(), np.zeros(b.shape[1])
    for _ in range(steps):
        if not ok.any():
            break
        p = apply(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta_k * v_old
        beta_next = np.linalg.norm(p, axis=0)
        # The new column of the tridiagonal matrix, after the two rotations before.
        delta = c * alpha - c_old * s * beta_k
        rho = np.hypot(delta, beta_next)
        rho2, rho3 = s * alpha + c_old * c * beta_k, s_old * beta_k
        safe = np.where(rho > 0, rho, 1)
        c_old, s_old, c, s = c, s, np.where(rho > 0, delta / safe, 1), np.where(rho > 0, beta_next / safe, 0)
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / safe
        x = np.where(ok, x + c * eta * w, x)
        eta = -s * eta
        v_old, v = v, np.where(beta_next > 0, p / np.where(beta_next > 0, beta_next, 1), 0)
        beta_k = beta_next
        ok = ok & (rho > 0) & (np.abs(eta) > tol * start) & (beta_next > EPS * start)
    return x


def _orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Columns that span what ``new`` adds to ``basis``, which is orthonormal."""
    out = basis
    for column in new.T:
        scale = np.linalg.norm(column)
        if scale == 0 or out.shape[1] == len(column):
            continue
        column = column / scale
        for _ in range(3):
            column = column - out @ (out.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            out = np.column_stack([out, column])
    return out[:, basis.shape[1] :]


def leading_components(
    product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, *, inner: int = 10, rounds: int = 60, seed: int = 5
) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues of a symmetric positive matrix, unit vectors, and the
    largest residual relative to the first eigenvalue."""
    wanted = min(wanted, d)
    block = min(d, wanted + 4)
    search = _orthonormal(np.random.default_rng(seed).standard_normal((d, block)), np.zeros((d, 0)))
    image = product(search)
    locked, locked_image = np.zeros((d, 0)), np.zeros((d, 0))
    for _ in range(rounds):
        small = search.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        values, turn = values[order], turn[:, order]
        search, image = search @ turn, image @ turn
        norm = max(np.linalg.norm(locked_image, axis=0).max(initial=0.0), values[0], 0.0)
        residual = image - search * values
        size = np.linalg.norm(residual, axis=0)
        # Rounding of n products of length d leaves residuals of about this size.
        done = size <= 16 * EPS * norm * np.sqrt(d)
        missing = wanted - locked.shape[1]
        front = int(np.argmin(done[:missing])) if not done[:missing].all() else missing
        locked = np.column_stack([locked, search[:, :front]])
        locked_image = np.column_stack([locked_image, image[:, :front]])
        search, image, values, residual, done = search[:, front:], image[:, front:], values[front:], residual[:, front:], done[front:]
        missing -= front
        if missing <= 0:
            break
        if locked.shape[1] + search.shape[1] == d:
            # The space is whole: Rayleigh-Ritz of it is exact up to rounding.
            locked = np.column_stack([locked, search[:, :missing]])
            break
        open_ = np.flatnonzero(~done[:missing])
        known = np.column_stack([locked, search[:, :block]])
        theta = values[open_]

        def outside(v: np.ndarray) -> np.ndarray:
            return v - known @ (known.T @ v)

        def corrected(v: np.ndarray) -> np.ndarray:
            v = outside(v)
            return outside(product(v) - v * theta)

        step = minres(corrected, -outside(residual[:, open_]), inner, 1e-3)
        if search.shape[1] + len(open_) > max(6 * block, 40):
            search, image = search[:, : 2 * block], image[:, : 2 * block]
        new = _orthonormal(outside(step), np.column_stack([locked, search]))
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(seed + 1).standard_normal((d, 1)), np.column_stack([locked, search]))
        search, image = np.column_stack([search, new]), np.column_stack([image, product(new)])
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # A last reduction on fresh products undoes the rounding of the combined ones.
    vectors = np.linalg.qr(locked)[0]
    image = product(vectors)
    small = vectors.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)
    values, vectors, image = values[order], vectors @ turn[:, order], image @ turn[:, order]
    norm = max(values[0], 0.0) or 1.0
    return values, vectors, float(np.linalg.norm(image - vectors * values, axis=0).max() / norm)


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16
) -> DataFrame:
    """``(id, n, deviation, whitened, explained, identity_error)`` of each row with a valid vector.

    Statistics are over the distinct vectors x = floor(64 c); a constant added to x changes none.
    ``whitened`` and ``explained`` are arrays over the components, by falling eigenvalue; those
    whose eigenvalue is rounding noise (below 1e-12 of the first) are left out, so vectors that are
    all equal get empty arrays.  ``deviation`` is the exact sum over dimensions of (n x - S)^2.

    Dropped are vectors that are null, empty, hold a null or non-finite entry, or are shorter than
    the longest (their last entries are missing).  Null ids and repeated rows stay, each a row; an
    empty table gives none.  Other columns are not read.  Copies of a vector meet in an aggregate that
    combines before the shuffle.  The driver holds sums of d x ``components`` numbers.
    """
    valid = valid_vectors(rows, id_col, vector_col)
    d = valid.agg(F.max(F.size("x"))).first()[0]
    out = f"id {valid.schema['id'].dataType.simpleString()}, n long, deviation decimal(38,0), whitened array<double>"
    extra = {"explained": F.array().cast("array<double>"), "identity_error": F.lit(0.0)}
    if d is None:
        return rows.sparkSession.createDataFrame([], out).withColumns(extra).withColumnRenamed("id", id_col)
    valid = valid.where(F.size("x") == d)
    fit = staged(valid.select("x").distinct(), "whitening")
    n = fit.count()
    # Within a task sums stay far below 2^63 for entries of a few digits; tasks are added as whole numbers.
    parts = [_as_integers(p) for p in _totals(fit, _exact_sums, "<i8")]
    total = [sum(column) for column in zip(*parts)]
    mean = np.array([s // n + (s % n) / n for s in total])

    def product(v: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ v)

        return sum(_totals(fit, work, "<f8")).reshape(d, -1) / n

    def squares(x: np.ndarray) -> np.ndarray:
        return np.array([((x - mean) ** 2).sum()])

    trace = float(sum(_totals(fit, squares, "<f8"))[0] / n)
    if trace > 0:
        values, vectors, _ = leading_components(product, d, components)
        good = values > 1e-12 * values[0]
        values, scaled = values[good], vectors[:, good] / np.sqrt(values[good])
    else:
        values, scaled = np.zeros(0), np.zeros((d, 0))
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ scaled
        return np.concatenate([(z.T @ z).ravel(), z.sum(0)])

    error = 0.0
    if k:
        found = sum(_totals(fit, moments, "<f8")) / n
        centre = found[k * k :]
        error = float(np.abs(found[: k * k].reshape(k, k) - np.outer(centre, centre) - np.eye(k)).max())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(total, object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            far = max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, total))
            if far * far * d < 2**63:
                exact = ((n * x - np.array(total, np.int64)) ** 2).sum(1).tolist()
            else:
                exact = ((x.astype(object) * n - sums) ** 2).sum(1).tolist()
            z = (x - mean) @ scaled
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(x), n), pa.int64()),
                    pa.array(map(Decimal, exact), pa.decimal128(38, 0)),
                    pa.array(list(z), pa.list_(pa.float64())),
                ],
                names=["id", "n", "deviation", "whitened"],
            )

    shares = [F.lit(float(v / trace)) for v in values]
    extra = {"explained": F.array(*shares).cast("array<double>"), "identity_error": F.lit(error)}
    return valid.mapInArrow(apply, out).withColumns(extra).withColumnRenamed("id", id_col)


def _exact_sums(x: np.ndarray) -> np.ndarray:
    """Sums of the low 32 bits and of the rest, so that no entry is too large to add up."""
    return np.concatenate([(x & 0xFFFFFFFF).sum(0), (x >> 32).sum(0)])


def _as_integers(parts: np.ndarray) -> list[int]:
    low, high = np.split(parts, 2)
    return [int(a) + (int(b) << 32) for a, b in zip(low, high)]


def component_rows(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """A row for each vector and component, numbered from 1."""
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("component", "pair")
    flat = whitened.select(id_col, "n", "deviation", "identity_error", pairs)
    return flat.select(
        id_col,
        (F.col("component") + 1).alias("component"),
        "n",
        "deviation",
        F.col("pair.whitened").alias("whitened"),
        F.col("pair.explained").alias("explained"),
        "identity_error",
    )
