"""Whitening of embeddings by the leading eigenvectors of their covariance, found by a block Jacobi-Davidson method.

The covariance is never formed. Spark multiplies it with a thin block of vectors: each task centres its rows and sends one
row per dimension, whatever its number of rows. The driver holds blocks of ``dimensions x basis`` numbers only, whose size
does not depend on the table.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import bare, col, map_batches, materialize

log = logging.getLogger(__name__)

# A component counts as found when its residual is below this share of the largest eigenvalue: double precision.
RESIDUAL = 2.0**-44
# Directions with less than this share of the largest eigenvalue carry rounding only.
NOTHING = 1e-10
COMPONENTS = 16
# MINRES steps for a correction, and the share of the residual at which they end early.
INNER_STEPS, INNER_GAIN = 6, 0.02
# The basis is cut back to the best two blocks when it exceeds this many blocks.
BASIS_BLOCKS = 8
MAX_ROUNDS = 200


@dataclass(frozen=True)
class Whitening:
    """What the fit found: ``vectors`` has a unit eigenvector per column, by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def base(self) -> np.ndarray:
        """The mean rounded to whole numbers, so that rows lose no digits when it is taken off."""
        return np.array([round(Fraction(s, self.n)) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """What ``base`` leaves of the sums."""
        return [s - self.n * int(b) for s, b in zip(self.sums, self.base, strict=True)]


def whole_numbers(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` with ``x``, its vector as longs ``floor(64 c) + 1000000``; an ``x`` of its own is replaced.

    Rows whose vector is null or holds null or non-finite entries go, and so do vectors of another length than the
    commonest (of equally common lengths the greatest counts).
    """
    good = df.filter(
        col(vector).isNotNull()
        & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        & (F.size(vector) > 0)
    )
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * 64) + 1_000_000)
    lengths = good.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    wanted = lengths[0]["d"] if lengths else 0
    return good.filter(F.size(vector) == wanted).select(*[col(c) for c in bare(df, "x")], x.alias("x"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _totals(fit: DataFrame, width: int) -> tuple[int, list[int], list[int]]:
    """Exact number of rows, and per dimension the sum and the sum of squares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        n, sums, squares = 0, [0] * width, [0] * width
        for batch in batches:
            x = _matrix(batch, width) - 1_000_000
            if len(x) and np.abs(x).max() >= 1 << 20:  # their squares would overflow a sum of longs
                x = x.astype(object)
            n += len(x)
            sums = [s + int(t) for s, t in zip(sums, x.sum(axis=0), strict=True)]
            squares = [s + int(t) for s, t in zip(squares, (x * x).sum(axis=0), strict=True)]
        number = pa.decimal128(38, 0)
        yield [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(sums, number), pa.array(squares, number)]

    big = T.DecimalType(38, 0)
    schema = T.StructType().add("dim", "integer").add("n", "long").add("s", big).add("q", big)
    parts = map_batches(fit, run, schema).groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])
    rows = sorted(parts.collect())
    n = rows[0]["n"] if rows else 0
    return n, [int(r["s"]) + n * 1_000_000 for r in rows], [int(r["q"]) for r in rows]


def _column_sums(fit: DataFrame, width: int, run: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of ``run(rows)``, a matrix of ``shape``: one row per task and matrix row is exchanged."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        total = np.zeros(shape)
        for batch in batches:
            total += run(_matrix(batch, width))
        yield [pa.array(range(shape[0]), pa.int32()), *[pa.array(total[:, j]) for j in range(shape[1])]]

    schema = T.StructType().add("row", "integer")
    for j in range(shape[1]):
        schema = schema.add(f"v{j}", "double")
    summed = map_batches(fit, go, schema).groupBy("row").agg(*[F.sum(f"v{j}").alias(f"v{j}") for j in range(shape[1])])
    out = np.zeros(shape)
    for r in summed.collect():
        out[r["row"]] = r[1:]
    return out


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` has outside of the given orthonormal bases; dependent columns go."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(3):
        for basis in against:
            block = block - basis @ (basis.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-8]
    return block


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, gain: float) -> np.ndarray:
    """Some MINRES steps on each column of ``rhs``; the columns only share the product."""
    beta = np.linalg.norm(rhs, axis=0)
    start, eta = beta.copy(), beta.copy()
    v, v_old = rhs / np.where(beta > 0, beta, 1), np.zeros_like(rhs)
    x, w, w_old = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    c = c_old = np.ones_like(beta)
    s = s_old = np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_next = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        rho1 = np.hypot(delta, beta_next)
        rho2 = s * alpha + c_old * c * beta
        rho3 = s_old * beta
        safe = np.where(rho1 > 0, rho1, 1)
        w_old, w = w, np.where(rho1 > 0, (v - rho3 * w_old - rho2 * w) / safe, 0)
        c_old, c, s_old, s = c, delta / safe, s, beta_next / safe
        x = x + c * eta * w
        eta = -s * eta
        v_old, v = v, p / np.where(beta_next > 0, beta_next, 1)
        beta = beta_next
        if (np.abs(eta) <= gain * start).all():
            break
    return x


def jacobi_davidson(
    apply: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a positive operator and their unit vectors, at most ``wanted`` and falling.

    ``apply`` multiplies it with the columns of a matrix. Each round takes the Ritz pairs of a growing basis, locks the
    leading ones whose residuals have reached ``RESIDUAL``, and adds corrections for the others: inner MINRES on the operator
    shifted by each Ritz value and projected off the locked and the current vectors. Values of nothing but rounding end it.
    """
    wanted = min(wanted, width)
    locked, values = np.zeros((width, 0)), []
    basis = _orthonormal(np.random.default_rng(seed).normal(size=(width, wanted)))
    image = apply(basis)
    for round_no in range(MAX_ROUNDS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        turn, theta = turn[:, ::-1], theta[::-1]
        basis, image = basis @ turn, image @ turn
        largest = max([*values, theta[0], 0.0])
        open_ = min(wanted - len(values), basis.shape[1])
        ritz, residual = basis[:, :open_], image[:, :open_] - basis[:, :open_] * theta[:open_]
        residual = residual - locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        log.info("round %d: basis of %d, %d locked, residuals %s", round_no, basis.shape[1], len(values), norms)
        # In a basis of the whole space the Ritz pairs are the eigenpairs, up to the rounding of the products.
        whole = basis.shape[1] + len(values) == width
        done = (norms <= RESIDUAL * largest) | whole
        lead = int(np.cumprod(done).sum())
        values += theta[:lead].tolist()
        locked = np.hstack([locked, ritz[:, :lead]])
        if len(values) >= wanted or lead == basis.shape[1] or theta[lead] <= NOTHING * largest:
            break
        basis, image = basis[:, lead:], image[:, lead:]
        # The others: those locked, and the current vectors of the rest, are projected out.
        ritz, residual, shift = ritz[:, lead:], residual[:, lead:], theta[lead:open_]
        late = ~done[lead:]
        if basis.shape[1] + late.sum() > BASIS_BLOCKS * wanted:
            basis, image = basis[:, : 2 * wanted], image[:, : 2 * wanted]
        fixed = np.hstack([locked, ritz])

        def project(y: np.ndarray, fixed=fixed) -> np.ndarray:
            return y - fixed @ (fixed.T @ y)

        def shifted(y: np.ndarray, shift=shift[late], project=project) -> np.ndarray:
            y = project(y)
            return project(apply(y) - y * shift)

        correction = minres(shifted, project(-residual[:, late]), INNER_STEPS, INNER_GAIN)
        added = _orthonormal(correction, locked, basis)
        if not added.shape[1]:  # the corrections lie in the basis already: go on with a fresh direction
            added = _orthonormal(np.random.default_rng((seed, round_no)).normal(size=(width, 1)), locked, basis)
        basis, image = np.hstack([basis, added]), np.hstack([image, apply(added)])
    else:
        raise ArithmeticError(f"no convergence in {MAX_ROUNDS} rounds")
    order = np.argsort(-np.array(values), kind="stable")
    found = np.array(values)[order]
    kept = found > NOTHING * (found[0] if len(found) else 0.0)
    return found[kept], locked[:, order[kept]]


def fit(rows: DataFrame, components: int = COMPONENTS, seed: int = 0) -> Whitening:
    """Fit on the distinct vectors ``x`` of ``rows`` (see ``whole_numbers``).

    Copies are combined before they are exchanged and count once. Vectors without any spread, or none, give no component.
    """
    stored = materialize(rows.select("x").distinct(), "whitening-fit")
    first = stored.limit(1).collect()
    width = len(first[0]["x"]) if first else 0
    if not width:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    n, sums, squares = _totals(stored, width)
    # The trace in whole numbers, about the offset that every entry has.
    spread = sum(n * q - (s - n * 1_000_000) ** 2 for s, q in zip(sums, squares, strict=True))
    trace = float(Fraction(spread, n * n))
    if not spread:
        return Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), trace, 0.0)
    model = Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), trace, 0.0)
    base, rest = model.base, np.array([float(Fraction(r, n)) for r in model.rest])

    def product(block: np.ndarray) -> np.ndarray:
        def run(x: np.ndarray) -> np.ndarray:
            centred = (x - base) - rest
            return centred.T @ (centred @ block)

        return _column_sums(stored, width, run, block.shape) / n

    values, vectors = jacobi_davidson(product, width, components, seed)
    scaled = vectors / np.sqrt(values)

    def whitened_squares(x: np.ndarray) -> np.ndarray:
        z = ((x - base) - rest) @ scaled
        return z.T @ z

    k = len(values)
    error = np.abs(_column_sums(stored, width, whitened_squares, (k, k)) / n - np.eye(k)).max() if k else 0.0
    return Whitening(n, sums, values, vectors, trace, float(error))


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` with ``deviation`` (exact) and ``whitened``, an entry per component; columns of these names are replaced."""
    kept = bare(rows, "deviation", "whitened")
    schema = T.StructType([rows.select(*[col(c) for c in kept]).schema[c] for c in kept])
    out = T.StructType([*schema.fields]).add("deviation", T.DecimalType(38, 0)).add("whitened", T.ArrayType(T.DoubleType()))
    width = len(model.sums)
    if not model.n:
        return rows.filter(F.lit(False)).select(
            *[col(c) for c in kept], F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")
        )
    n, base, exact = model.n, model.base, model.rest
    rest = np.array([float(Fraction(r, n)) for r in exact])
    scaled = model.vectors / np.sqrt(model.values)
    at = kept.index("x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            x = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - base
            bound = n * int(np.abs(x).max(initial=0)) + max(map(abs, exact))
            whole = bound * bound * width < 1 << 63
            gap = (x if whole else x.astype(object)) * n - (np.array(exact) if whole else np.array(exact, dtype=object))
            deviation = [int(v) for v in (gap * gap).sum(axis=1)]
            z = (x - rest) @ scaled
            ends = np.arange(len(x) + 1, dtype=np.int32) * z.shape[1]
            yield [
                *batch.columns, pa.array(deviation, pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel())),
            ]

    return map_batches(rows.select(*[col(c) for c in kept]), run, out)
