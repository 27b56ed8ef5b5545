"""Whitening by principal components from a block Jacobi-Davidson method.

The covariance is never built. It is known by its products with a few directions at a
time: tasks centre their vectors, multiply them with the directions and back, and Spark
adds the partial sums. Ritz pairs come from a small subspace (Rayleigh-Ritz). Each pair
that is not exact yet gives a correction equation, projected off what is found so far and
solved roughly by MINRES, all pairs of a step together, so that one pass over the data
serves them all. Corrections widen the subspace; pairs whose residual has reached double
precision are locked and stay projected off; a subspace that grew large is restarted from
its best pairs. The driver holds only directions: vectors of one row's length.

Sums of whole numbers are exact: tasks add them as integers and Spark as decimals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provender.session import written

#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100000
#: Entries beyond this are no measurements; sums of any batch of smaller ones fit 64 bits.
LARGEST = float(1 << 30)
#: A residual of so many roundings of the largest eigenvalue is zero.
EXACT = 64
#: MINRES steps of one correction, directions of a subspace, corrections in all.
INNER, SUBSPACE, OUTER = 3, 96, 60
#: Pairs beyond the wanted ones that are corrected with them: a pass costs the same, and close neighbours separate sooner.
GUARD = 8
#: Rows that are multiplied at a time.
BLOCK = 4096
EPS = float(np.finfo(float).eps)
SEED = 13


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: whole-number vectors of the rows that take part.

    Rows whose vector is null or empty, or holds a null or non-finite entry or one beyond
    ``LARGEST``, take no part. All vectors must have one length: should they differ, the
    most frequent length (of several, the greatest) takes part.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT)
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.coalesce(fine, F.lit(False)) & (F.size("v") > 0)).select("vec_id", x.alias("x"))


def _rows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The vectors of a batch as integer matrices of bounded size."""
    lists = batch.column(batch.schema.get_field_index("x"))
    flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    for at in range(0, len(flat), BLOCK):
        yield flat[at:at + BLOCK]


def added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], cells: int) -> np.ndarray:
    """Sum over all rows of what ``part`` makes of blocks of them, ``cells`` numbers.

    Tasks add their blocks; Spark adds one short row per task and cell.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in _rows(batch) if len(batch) else ():
                found = part(block)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total.reshape(-1))], names=["cell", "value"])

    sums = rows.select("x").mapInArrow(partial, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(cells)
    for r in sums.collect():  # ``cells`` rows
        out[r.cell] = r.value
    return out


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for block in _rows(batch) if len(batch) else ():
                n += len(block)
                found = block.sum(axis=0).tolist()
                total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        if total is not None:
            texts = [str(v) for v in [n, *total]]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["cell", "value"])

    sums = rows.select("x").mapInArrow(partial, "cell bigint, value string").groupBy("cell").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    values = [int(r.value) for r in sums.orderBy("cell").collect()]  # one row per dimension
    return (values[0], values[1:]) if values else (0, [])


@dataclass(frozen=True)
class Whitening:
    """What the fit found: exact sums, the trace of the covariance, eigenvalues falling, components as columns."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit(rows: DataFrame, k: int) -> Whitening:
    """The ``k`` leading components of ``rows.x``, fewer if the covariance has no more eigenvalues above zero."""
    n, sums = exact_sums(rows)
    if not n:
        return Whitening(0, sums, 0.0, np.zeros(0), np.zeros((0, 0)))
    d = len(sums)
    mean = np.array([s / n for s in sums])
    trace = float(added(rows, lambda x: np.array([((x - mean) ** 2).sum()]), 1)[0]) / n

    def product(w: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``w``: one pass over the data."""
        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ w)
        return added(rows, part, w.size).reshape(w.shape) / n

    values, components = jacobi_davidson(product, d, min(k, d), trace)
    return Whitening(n, sums, trace, values, components)


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Directions of ``new`` that are left off the given ones, twice for rounding; none if nothing is left."""
    kept: list[np.ndarray] = []
    for column in new.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            for basis in against:
                column = column - basis @ (basis.T @ column)
            for other in kept:
                column = column - other * (other @ column)
        size = np.linalg.norm(column)
        if size > 1e-8:
            column = column / size
            for basis in against:
                column = column - basis @ (basis.T @ column)
            kept.append(column / np.linalg.norm(column))
    return np.array(kept).T if kept else np.zeros((len(new), 0))


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, trace: float,
                    inner: int = INNER, subspace: int = SUBSPACE, outer: int = OUTER) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenpairs of a symmetric, positive semidefinite matrix known by its products.

    Ends when the residuals of all pairs are zero to double precision. Eigenvalues that
    are zero to that precision are left out. Raises if ``outer`` corrections were not
    enough, rather than return something less exact.
    """
    locked, values = np.zeros((d, 0)), np.zeros(0)
    if trace <= 0:
        return values, locked
    random = np.random.default_rng(SEED)
    space = _orthonormal(random.standard_normal((d, min(d, k + GUARD))))
    image = product(space)
    for _ in range(outer):
        # Rayleigh-Ritz on what is not locked yet.
        wanted = k - locked.shape[1]
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        vectors, images = space @ turn, image @ turn
        scale = max([*values, theta[0]]) if len(theta) else 0.0
        tolerance = EXACT * EPS * scale
        pairs = min(wanted + GUARD, len(theta))
        residual = images[:, :pairs] - vectors[:, :pairs] * theta[:pairs]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        # Only a run of leading pairs is locked: one behind an inexact pair may still change its rank.
        ready = 0
        while ready < min(wanted, len(size)) and size[ready] <= tolerance:
            ready += 1
        whole = locked.shape[1] + space.shape[1] == d
        if whole:  # the subspace is everything there is: its pairs are as exact as products are
            ready = wanted
        locked = np.hstack([locked, vectors[:, :ready]])
        values = np.append(values, theta[:ready])
        if locked.shape[1] >= min(k, d):
            break
        if np.all(theta[ready:] <= tolerance) and np.all(size[ready:] <= tolerance):
            break  # nothing but zeros is left
        space, image = vectors[:, ready:], images[:, ready:]
        wanted -= ready
        if space.shape[1] + wanted + GUARD > subspace:
            space, image = space[:, :2 * (wanted + GUARD)], image[:, :2 * (wanted + GUARD)]
        open_ = [i for i in range(pairs - ready) if size[ready + i] > tolerance]
        found = _corrections(product, locked, space[:, open_], theta[ready:][open_], residual[:, ready:][:, open_], inner)
        more = _orthonormal(found, locked, space)
        if not more.shape[1]:  # corrections lie in the subspace already: look elsewhere
            more = _orthonormal(random.standard_normal((d, max(1, wanted))), locked, space)
        space, image = np.hstack([space, more]), np.hstack([image, product(more)])
    else:
        raise ArithmeticError(f"eigenpairs are not exact after {outer} corrections")
    order = np.argsort(-values, kind="stable")[:k]
    order = order[values[order] > d * EPS * max(values.max(initial=0.0), 0.0)] if len(values) else order
    values, locked = values[order], locked[:, order]
    flip = np.sign(locked[np.abs(locked).argmax(axis=0), np.arange(locked.shape[1])]) if locked.size else np.zeros(0)
    return values, locked * flip


def _corrections(product, locked: np.ndarray, ritz: np.ndarray, theta: np.ndarray, residual: np.ndarray, steps: int) -> np.ndarray:
    """MINRES on (I - QQ')(A - theta I)(I - QQ') t = -r for every Ritz pair at once.

    Q holds the locked vectors and all open Ritz vectors. Each column has its own
    Lanczos recurrence and rotations; a step costs one product for all of them.
    """
    q = np.hstack([locked, ritz])

    def project(w: np.ndarray) -> np.ndarray:
        return w - q @ (q.T @ w)

    start = project(-residual)
    beta = np.linalg.norm(start, axis=0)
    floor = np.where(beta > 0, beta, 1.0)
    v_old, v = np.zeros_like(start), start / floor
    solution, eta = np.zeros_like(start), beta.copy()
    c_old, c, s_old, s = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    w_old, w = np.zeros_like(start), np.zeros_like(start)
    beta = np.zeros_like(beta)
    live = eta > 0
    for _ in range(steps):
        if not live.any():
            break
        image = project(product(v) - v * theta)
        alpha = (v * image).sum(axis=0)
        image = project(image - v * alpha - v_old * beta)
        beta_next = np.linalg.norm(image, axis=0)
        delta = c * alpha - c_old * s * beta
        r1 = np.hypot(delta, beta_next)
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        live &= r1 > 0
        safe = np.where(r1 > 0, r1, 1.0)
        c_old, c, s_old, s = c, delta / safe, s, beta_next / safe
        direction = (v - w * r2 - w_old * r3) / safe
        solution = solution + np.where(live, c * eta, 0.0) * direction
        w_old, w = w, direction
        eta = -s * eta
        live &= beta_next > EPS * floor
        v_old, v, beta = v, image / np.where(beta_next > 0, beta_next, 1.0), beta_next
    return solution


def whitened(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened`` of all ``rows``; ``whitened`` has an entry per component.

    ``deviation`` is the exact sum over dimensions of ``(n * x - S) ** 2``, or null if 64
    bits don't hold it.
    """
    n, sums, mean = fitted.n, fitted.sums, fitted.mean
    to = fitted.components / np.sqrt(fitted.values)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(sums, dtype=object)
        for batch in batches:
            if not len(batch):
                continue
            found, far = [], []
            for block in _rows(batch):
                found.append((block - mean) @ to)
                far += (((block.astype(object) * n - exact) ** 2).sum(axis=1)).tolist()
            values = np.vstack(found)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([f if f < 1 << 63 else None for f in far], pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.reshape(-1))),
            ], names=["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(made, "vec_id bigint, deviation bigint, whitened array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    at = [F.col("whitened")[i] for i in range(k)]
    means = white.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cells = white.agg(*[F.avg((at[i] - means[i]) * (at[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(cells[at_] - (1.0 if i == j else 0.0)) for at_, (i, j) in enumerate(pairs))


def whiten(vectors: DataFrame, k: int = 8) -> DataFrame:
    """Whitened vectors as ``vec_id, n, deviation, whitened, explained, identity_error``.

    ``whitened`` and ``explained`` are arrays with an entry per component, ``k`` or as
    many as the covariance has eigenvalues above zero; see ``integer_vectors`` for the
    rows that take part. Repeated rows and ids count and are returned each; a null id is
    kept. Without rows, or if all vectors are equal, there is no component and the result
    is empty. Extra columns are left out.
    """
    spark = vectors.sparkSession
    rows = written(integer_vectors(vectors).withColumn("d", F.size("x")), "integers")
    # One row per length.
    lengths = sorted(((r["count"], r.d) for r in rows.groupBy("d").count().collect()), reverse=True)
    rows = rows.where(F.col("d") == (lengths[0][1] if lengths else 0)).select("vec_id", "x")
    fitted = fit(rows, k)
    schema = "vec_id bigint, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"
    if not len(fitted.values):
        return spark.createDataFrame([], schema)
    white = written(whitened(rows, fitted), "whitened")
    error = identity_error(white, len(fitted.values))
    explained = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values])
    return white.select("vec_id", F.lit(fitted.n).cast("bigint").alias("n"), "deviation", "whitened",
                        explained.alias("explained"), F.lit(error).alias("identity_error"))
