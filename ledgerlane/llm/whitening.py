"""Whitening of embeddings by a matrix-free Jacobi-Davidson solver.

The covariance matrix of the vectors is never built: what the solver needs of it are products with a few
vectors at a time, each one pass over the table in which every task centres its rows, multiplies them and
adds up, and the tasks' sums are added by an aggregation. The driver holds the search space only, at most
``SPACE`` vectors.

* A search space is kept orthonormal, with its product. Rayleigh-Ritz on it gives the best pairs it holds.
* Pairs whose residual is down to rounding are locked, from the largest eigenvalue on; the rest of the search is
  orthogonal to them.
* For the first pairs that are not, the correction equation ``(I - QQ')(A - e)(I - QQ')t = -r``, projected away from the
  locked vectors and the pair itself, is solved roughly by ``INNER`` steps of MINRES, for all these pairs in the same passes.
  The solutions extend the space; beyond ``SPACE`` vectors it starts anew from its best pairs.

A locked pair is held against the full residual, so no pair is taken that is not an eigenpair to double precision; the
solver ends with an error when it does not get there.

Vectors: rows whose vector is NULL or has NULL or non-finite entries are dropped, also entries whose scaled value is beyond
62 bits, and vectors of another length than most (of equally frequent lengths: the longer). Each entry c becomes the whole number
floor(``scale`` * c) + ``shift``. Sums are exact. Rows that are repeated, also with one id, count each; a NULL id is handed
through. Components without variance get NULL as whitened value, and all components when nothing varies. A deviation beyond 64 bits is NULL. Without
vectors the result is empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
SPACE = 40
INNER = 4
ROUNDS = 200
EPSILON = float(np.finfo(np.float64).eps)


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): the rows that remain, with whole numbers."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    fits = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 62) / scale))
    clean = rows.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), entries.alias("c")).filter(F.col("c").isNotNull() & fits)
    clean = materialize(clean.select("vec_id", F.transform("c", lambda c: F.floor(c * float(scale)).cast("bigint") + shift).alias("x")), "vectors")
    sizes = clean.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    return clean.join(sizes, F.size("x") == F.col("d")).select("vec_id", "x") if clean.select(F.size("x")).distinct().limit(2).count() > 1 else clean


def _matrix(column: pa.ListArray) -> np.ndarray:
    """The vectors of a batch as rows."""
    borders = column.offsets.to_numpy()
    return column.values.to_numpy()[borders[0] : borders[-1]].reshape(len(column), -1)


@dataclass(frozen=True)
class Centre:
    """Number of vectors and exact sums; ``middle`` are the nearest whole means, ``rest`` what the means have beyond these."""

    n: int
    sums: list[int]

    @property
    def middle(self) -> np.ndarray:
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times the rest of each mean, exact."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.middle)]


def centre(vectors: DataFrame) -> Centre | None:
    """Exact sums per dimension; entries are added in two halves, so that nothing overflows within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            part = [(int(h) << 31) + int(l) for h, l in zip((x >> 31).sum(axis=0), (x & 0x7FFFFFFF).sum(axis=0))]
            n, total = n + len(x), part if total is None else [a + b for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(total))], pa.int32()), pa.array(map(Decimal, [n, *total]), pa.decimal128(38, 0))], names=["k", "s"])

    found = dict(vectors.select("x").mapInArrow(run, "k int, s decimal(38,0)").groupBy("k").agg(F.sum("s").cast("string").alias("s")).collect())  # a row per dimension
    return Centre(int(found[-1]), [int(found[k]) for k in range(len(found) - 1)]) if found else None


def centred(x: np.ndarray, middle: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - middle).astype(np.float64) - rest


def summed(vectors: DataFrame, at: Centre, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all batches of ``part(centred rows)``, an array of ``shape``; one pass."""
    middle, rest = at.middle, np.array([r / at.n for r in at.rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += part(centred(_matrix(batch.column(0)), middle, rest))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["k", "s"])

    out = np.zeros(int(np.prod(shape)))
    for k, s in vectors.select("x").mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s")).collect():  # as many rows as numbers in ``shape``
        out[k] = s
    return out.reshape(shape)


def _orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """``vectors`` made orthonormal to ``against`` and each other; those that depend on the others go."""
    basis = against
    for v in vectors.T:
        norm = np.linalg.norm(v)
        if not np.isfinite(norm) or norm == 0:
            continue
        v = v / norm
        for _ in range(3):
            before = np.linalg.norm(v)
            v = v - basis @ (basis.T @ v)
            norm = np.linalg.norm(v)
            if norm < 1e-10:
                break
            v = v / norm
            if norm > 0.7 * before:
                break
        if norm >= 1e-10:
            basis = np.concatenate([basis, v[:, None]], axis=1)
    return basis[:, against.shape[1] :]


def corrections(times: Callable[[np.ndarray], np.ndarray], values: np.ndarray, ritz: np.ndarray, residuals: np.ndarray, locked: np.ndarray, steps: int) -> np.ndarray:
    """MINRES on the projected correction equation of each pair, side by side: a product a step serves them all."""

    def project(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - locked @ (locked.T @ v)
            v = v - ritz * np.einsum("ij,ij->j", ritz, v)
        return v

    right = project(-residuals)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    safe = np.where(live, beta, 1.0)
    v_old, v = np.zeros_like(right), right / safe
    d_old = d_older = np.zeros_like(right)
    out = np.zeros_like(right)
    c, s = -np.ones(len(beta)), np.zeros(len(beta))
    delta_bar = epsilon = np.zeros(len(beta))
    phi, b = beta.copy(), np.zeros(len(beta))
    for _ in range(steps):
        if not live.any():
            break
        w = project(times(v) - v * values)
        alpha = np.einsum("ij,ij->j", v, w)
        w = w - v * alpha - v_old * b
        b_next = np.linalg.norm(w, axis=0)
        # The two rotations before act on the new column of the tridiagonal matrix, then one of its own.
        delta = c * delta_bar + s * alpha
        gamma_bar = s * delta_bar - c * alpha
        epsilon_next, delta_next = s * b_next, -c * b_next
        gamma = np.hypot(gamma_bar, b_next)
        live &= gamma > 1e-300
        gamma_safe = np.where(live, gamma, 1.0)
        c, s = np.where(live, gamma_bar / gamma_safe, c), np.where(live, b_next / gamma_safe, s)
        d = (v - d_old * delta - d_older * epsilon) / gamma_safe
        out = out + np.where(live, c * phi, 0.0) * d
        phi = s * phi
        d_older, d_old = d_old, d
        epsilon, delta_bar = epsilon_next, delta_next
        live &= b_next > 1e-14 * np.maximum(np.abs(values), 1e-300)
        v_old, v, b = v, np.where(live, w / np.where(b_next > 0, b_next, 1.0), 0.0), b_next
    return out


def largest_pairs(times: Callable[[np.ndarray], np.ndarray], size: int, count: int, inner: int = INNER, space: int = SPACE, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their vectors of a symmetric matrix of which only ``times`` is known."""
    count = min(count, size)
    space = max(space, 3 * count)
    locked, products, values = np.empty((size, 0)), np.empty((size, 0)), np.empty(0)
    basis = _orthonormal(np.random.default_rng(seed).normal(size=(size, min(size, count + 4))), locked)
    images = times(basis)
    best, stuck = np.inf, 0
    for _ in range(ROUNDS):
        small = basis.T @ images
        found, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-found, kind="stable")
        found, ritz, ritz_images = found[order], basis @ turn[:, order], images @ turn[:, order]
        residuals = ritz_images - ritz * found
        residuals -= locked @ (locked.T @ residuals)
        norms = np.linalg.norm(residuals, axis=0)
        missing = count - locked.shape[1]
        floor = 8 * EPSILON * np.sqrt(size) * max([*np.abs(values), *np.abs(found), 1e-300])
        # What does not get any better over several rounds and is within a hundred of rounding is done as well.
        worst = norms[:missing].max()
        best, stuck = (worst, 0) if worst < 0.5 * best else (best, stuck + 1)
        limit = floor * (100 if stuck > 4 else 1)
        done = 0
        while done < missing and norms[done] <= limit:
            done += 1
        whole = locked.shape[1] + basis.shape[1] == size and missing == done
        if done and (done == missing or not whole):
            locked = np.concatenate([locked, ritz[:, :done]], axis=1)
            products = np.concatenate([products, ritz_images[:, :done]], axis=1)
            values = np.concatenate([values, found[:done]])
            basis, images, found, ritz, ritz_images, residuals = (a[..., done:] for a in (ritz, ritz_images, found, ritz, ritz_images, residuals))
            best, stuck = np.inf, 0
        missing = count - locked.shape[1]
        if not missing:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        basis, images = ritz, ritz_images
        if basis.shape[1] + missing > space:
            keep = min(basis.shape[1], 2 * missing + 4)
            basis, images = basis[:, :keep], images[:, :keep]
        some = slice(0, missing)
        if locked.shape[1] + basis.shape[1] < size:
            steps = corrections(times, found[some], ritz[:, some], residuals[:, some], locked, inner)
            new = _orthonormal(np.concatenate([steps, residuals[:, some]], axis=1), np.concatenate([locked, basis], axis=1))[:, : max(missing, 1)]
            if not new.shape[1]:
                # The space is closed under the matrix; something from outside of it.
                new = _orthonormal(np.random.default_rng(seed + basis.shape[1]).normal(size=(size, missing)), np.concatenate([locked, basis], axis=1))
        else:
            # The space is the whole one: only rounding is left, taken out by a fresh product.
            basis = _orthonormal(basis, locked)
            images, new = times(basis), np.empty((size, 0))
        if new.shape[1]:
            basis, images = np.concatenate([basis, new], axis=1), np.concatenate([images, times(new)], axis=1)
    raise RuntimeError(f"only {locked.shape[1]} of {count} pairs came down to rounding in {ROUNDS} rounds")


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """A row per remaining vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue."""
    vectors = whole_vectors(rows, vec_id, vector, scale, shift)
    at = centre(vectors)
    fields = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, eigenvalue double"
    if at is None or not at.sums:
        return rows.sparkSession.createDataFrame([], fields)
    n, size = at.n, len(at.sums)
    trace = float(summed(vectors, at, lambda y: np.array([np.einsum("ij,ij->", y, y)]), (1,))[0]) / n
    values, axes = largest_pairs(lambda w: summed(vectors, at, lambda y: y.T @ (y @ w), w.shape) / n, size, components) if trace else (np.zeros(min(components, size)), np.eye(size, min(components, size)))
    real = values > 64 * EPSILON * size * trace
    k = int(real.sum())
    scaled = axes[:, :k] / np.sqrt(values[:k])

    def moments(y: np.ndarray) -> np.ndarray:
        z = y @ scaled
        return np.concatenate([z.sum(axis=0)[None], z.T @ z])

    error = None
    if k:
        found = summed(vectors, at, moments, (k + 1, k)) / n
        error = float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max())
    middle, rest, exact = at.middle, np.array([r / n for r in at.rest]), at.rest
    shares = [float(e) / trace if trace else None for e in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m, x = len(values), _matrix(batch.column(1))
            off = x - middle
            reach = n * int(np.abs(off).max(initial=0)) + n
            if reach * reach * size < 1 << 63:
                far = n * off - np.array(exact, np.int64)
                deviation = np.einsum("ij,ij->i", far, far).tolist()
            else:
                deviation = [sum((n * a - r) ** 2 for a, r in zip(row, exact)) for row in off.tolist()]
            z = np.full((len(x), m), np.nan)
            z[:, :k] = centred(x, middle, rest) @ scaled
            each = np.repeat(np.arange(len(x)), m)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, m + 1), len(x)), pa.int32()), pa.array(np.full(len(each), n), pa.int64()),
                pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64()).take(pa.array(each)), pa.array(z.ravel(), pa.float64(), from_pandas=True),
                pa.array(shares * len(x), pa.float64()), pa.array([error] * len(each), pa.float64()), pa.array(np.tile(values, len(x)), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"])

    return vectors.select("vec_id", "x").mapInArrow(run, fields)
