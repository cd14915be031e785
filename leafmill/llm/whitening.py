"""Whitening of embeddings by the leading eigenvectors of their covariance, from Chebyshev-filtered subspace iteration.

1. Vectors become whole numbers; each distinct one is kept once, packed in blocks. One pass
   gives their number and the exact sums, and so the mean.
2. A pass multiplies a thin block Q by the covariance, Y = Xc'(Xc Q) / n, where Xc are the
   vectors less their mean: tasks return a (dimension x columns) matrix for all their
   blocks, which Spark adds up by dimension. The covariance itself is never formed.
3. A sweep is a Chebyshev polynomial of such passes, scaled so that the unwanted part of the
   spectrum stays within one and what lies above it grows; then comes a QR step and a
   Rayleigh-Ritz step. The unwanted part's upper end is the least Ritz value; its lower end
   is estimated by Lanczos steps whose vector rides along in the first sweep's passes.
4. Sweeps end when the residuals |V p - e p| of the wanted pairs are down to rounding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import stored
from leafmill.llm.tokens import python_ready

SCALE = 256
COMPONENTS = 4
# Columns that are iterated, wanted ones included.
BLOCK = 32
# Degrees of a sweep's polynomial, the first of which also carries the Lanczos vector.
LEAST_DEGREE, MOST_DEGREE = 4, 16
# A sweep may lift the largest eigenvalue over the unwanted ones by this much, so that QR keeps the columns apart.
GROWTH = 1e9
# Residuals, as a share of the largest eigenvalue, that count as rounding; and sweeps after which the best is taken.
TOLERANCE, SWEEPS = 2e-15, 40
# Vectors per stored block.
BLOCK_ROWS = 2048


@dataclass(frozen=True)
class Whitening:
    """What a fit knows: `values` fall, and the columns of `vectors` belong to them."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    residual: float
    passes: int


def whole_numbers(vector: Column) -> Column:
    """floor(256 * entry) of every entry; null where the vector or an entry is null or not finite."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(entries, lambda c: F.floor(c * SCALE)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors in blocks of the narrowest integer type that holds them."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            x = _matrix(batch.column("x").slice(start, BLOCK_ROWS))
            kind = next(k for k in ("<i2", "<i4", "<i8") if x.size == 0 or (np.iinfo(k).min <= x.min() and x.max() <= np.iinfo(k).max))
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x)], pa.int32()), pa.array([kind]), pa.array([x.astype(kind).tobytes()], pa.binary())], ["n", "kind", "block"]
            )


def _unpacked(batch: pa.RecordBatch, dim: int) -> Iterator[np.ndarray]:
    for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block"), strict=True):
        yield np.frombuffer(block.as_buffer(), kind).reshape(-1, dim)


def _sums(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Halves of 32 bits, whose sums fit whatever the vectors hold.
        high, low, n = [0] * dim, [0] * dim, 0
        for batch in batches:
            for x in _unpacked(batch, dim):
                x = x.astype(np.int64)
                high = [a + int(b) for a, b in zip(high, (x >> 32).sum(axis=0), strict=True)]
                low = [a + int(b) for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0), strict=True)]
                n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
            ["dim", "n", "high", "low"],
        )

    return run


def _times(dim: int, mean: np.ndarray, q: np.ndarray):
    """Sums of Xc'(Xc Q), and of the squares of Xc as one more column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((dim, q.shape[1] + 1))
        for batch in batches:
            for x in _unpacked(batch, dim):
                centred = x - mean
                out[:, :-1] += centred.T @ (centred @ q)
                out[:, -1] += (centred * centred).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array(out.tolist(), pa.list_(pa.float64()))], ["dim", "row"]
        )

    return run


class _Covariance:
    """The covariance of stored blocks as something that multiplies."""

    def __init__(self, blocks: DataFrame, dim: int):
        self.blocks, self.dim, self.passes, self.trace = blocks, dim, 0, 0.0
        got = blocks.mapInArrow(_sums(dim), "dim int, n long, high long, low long").groupBy("dim")
        kept = got.agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low"))).orderBy("dim").collect()
        self.n = kept[0]["n"] if kept else 0
        self.sums = tuple((int(r["high"]) << 32) + int(r["low"]) for r in kept)
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(dim)

    def __call__(self, q: np.ndarray) -> np.ndarray:
        parts = self.blocks.mapInArrow(_times(self.dim, self.mean, q), "dim int, row array<double>")
        # One row per dimension comes back, of as many numbers as q has columns.
        total = parts.groupBy("dim").agg(*(F.sum(F.col("row")[j]).alias(f"c{j}") for j in range(q.shape[1] + 1)))
        out = np.array([r[1:] for r in sorted(total.collect())], float) / self.n
        self.passes += 1
        self.trace = float(out[:, -1].sum())
        return out[:, :-1]


def _ritz(times, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Falling Ritz values of the space that q's columns span, their vectors, and the covariance times these."""
    q = np.linalg.qr(q)[0]
    y = times(q)
    small = q.T @ y
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, y @ turn


def _degree(top: float, low: float, high: float) -> int:
    """The degree at which the polynomial lifts `top` by GROWTH over what lies between `low` and `high`."""
    reach = (2 * top - high - low) / max(high - low, 1e-300)
    return int(min(MOST_DEGREE, max(LEAST_DEGREE, math.log(2 * GROWTH) / math.acosh(max(reach, 1 + 1e-9)))))


def _filtered(times, q: np.ndarray, degree: int, top: float, low: float, high: float, rider=None) -> np.ndarray:
    """The scaled Chebyshev polynomial of the covariance times q: within one on low .. high, one at `top`."""
    centre, half = (high + low) / 2, max((high - low) / 2, 1e-300)
    sigma = first = half / (top - centre)

    def product(block: np.ndarray) -> np.ndarray:
        if rider is None:
            return times(block)
        both = times(np.column_stack([block, rider.vector]))
        rider.step(both[:, -1])
        return both[:, :-1]

    before, now = q, (product(q) - centre * q) * (first / half)
    for _ in range(degree - 1):
        follow = 1 / (2 / first - sigma)
        before, now = now, 2 * (follow / half) * (product(now) - centre * now) - (sigma * follow) * before
        sigma = follow
    return now


class _Lanczos:
    """Lanczos steps with full orthogonalisation, for the lower end of the spectrum."""

    def __init__(self, start: np.ndarray):
        self.basis, self.alpha, self.beta = [start / np.linalg.norm(start)], [], []

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def step(self, product: np.ndarray) -> None:
        if len(self.alpha) == len(self.basis):
            return  # the space is used up
        self.alpha.append(float(self.vector @ product))
        held = np.array(self.basis)
        for _ in range(2):
            product = product - held.T @ (held @ product)
        norm = float(np.linalg.norm(product))
        self.beta.append(norm)
        if norm > 1e-12 * abs(self.alpha[0]) and len(self.basis) < len(product):
            self.basis.append(product / norm)

    def least(self) -> float:
        """The least Ritz value less its residual, 0 at least."""
        k = len(self.alpha)
        values, vectors = np.linalg.eigh(np.diag(self.alpha) + np.diag(self.beta[: k - 1], 1) + np.diag(self.beta[: k - 1], -1))
        return max(0.0, values[0] - abs(self.beta[k - 1] * vectors[-1, 0]))


def eigenpairs(times, dim: int, wanted: int, block: int = BLOCK, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest `wanted` eigenvalues of a symmetric positive operator, their vectors, and the operator times these."""
    dice = np.random.default_rng(seed)
    wanted, rider, best = min(wanted, dim), _Lanczos(dice.standard_normal(dim)), None
    values, vectors, products = _ritz(times, dice.standard_normal((dim, min(dim, max(block, wanted)))))
    low, since = 0.0, 0
    for sweep in range(SWEEPS + 1):
        residual = float(np.abs(products[:, :wanted] - vectors[:, :wanted] * values[:wanted]).max())
        if best is None or residual < best[0]:
            since = 0 if best is None or residual < best[0] / 2 else since + 1
            best = residual, values, vectors, products
        else:
            since += 1
        # Certified: down to rounding, or so near it that sweeps no longer help.
        close = residual <= 1e-12 * max(values[0], 0.0)
        if residual <= TOLERANCE * max(values[0], 0.0) or (close and since >= 2) or sweep == SWEEPS or len(values) == dim:
            break
        high = max(values[-1], 1e-12 * values[0])
        q = _filtered(times, vectors, _degree(values[0], low, high), values[0], low, high, None if sweep else rider)
        if not sweep:
            low = min(rider.least(), 0.99 * high)
        values, vectors, products = _ritz(times, q)
        low = min(low, 0.99 * max(values[-1], 0.0))
    _, values, vectors, products = best
    return values[:wanted], vectors[:, :wanted], products[:, :wanted]


def _vectors(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows with their vector as `x`, without those that have none; and the commonest length, of equally common ones the longest."""
    rows = rows.withColumn("x", whole_numbers(F.col(vector))).filter("x is not null")
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    return rows, sizes["dim"] if sizes else 0


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The leading components of the distinct vectors of a table; None where nothing varies, as in an empty table."""
    python_ready(rows.sparkSession)
    whole, dim = _vectors(rows.select(F.col(vector).alias(vector)), vector)
    if not dim:
        return None
    distinct = whole.filter(F.size("x") == dim).select("x").distinct()
    blocks = stored(distinct.mapInArrow(_packed, "n int, kind string, block binary"), "whitening-blocks")
    times = _Covariance(blocks, dim)
    values, vectors, products = eigenpairs(times, dim, components)
    # Directions without any variance are no components.
    keep = values > max(values[0] * dim * np.finfo(float).eps, 0.0)
    values, vectors, products = values[keep], vectors[:, keep], products[:, keep]
    if not len(values):
        return None
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    vectors, products = vectors * sign, products * sign
    root = np.sqrt(values)
    error = np.abs((vectors.T @ products) / np.outer(root, root) - np.eye(len(values))).max()
    residual = np.abs(products - vectors * values).max() / values[0]
    return Whitening(times.n, times.sums, values, vectors, times.trace, float(error), float(residual), times.passes)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum of (n x - S)^2 per row, exactly; None where it needs more than a long."""
    reach = max((max(abs(n * int(x.min()) - s), abs(n * int(x.max()) - s)) for s in sums), default=0)
    if reach * reach * len(sums) < 1 << 63:
        off = x * n - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [v if v < 1 << 63 else None for v in exact]


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row with a vector, and component from 1 on: key, component, n, deviation, whitened, explained, identity_error, eigenvalue, residual.

    The covariance is that of the distinct vectors of whole numbers floor(256 * entry).
    `whitened` is the row's centred projection on the component over the root of its
    eigenvalue, `explained` the eigenvalue's share of all variance, `identity_error` how far
    the whitened covariance is from the identity, `residual` |V p - e p| over the largest
    eigenvalue. A component's sign is such that its largest entry is positive.

    Rows without a vector, or with entries that are null or not finite, are left out, and so
    are vectors of another length than the commonest. Repeated vectors are fitted once and
    returned row by row; components of equal eigenvalues are some orthogonal ones; fewer
    dimensions or directions that vary give fewer components, none give no rows.
    A deviation beyond a long is null. Other columns are left aside.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    shape = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double, residual double"
    found = fit(rows, vector, components)
    if found is None:
        return spark.createDataFrame([], shape)
    dim, count = found.vectors.shape
    mean = np.array([s / found.n for s in found.sums])
    turn = found.vectors / np.sqrt(found.values)
    explained = found.values / found.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x")).astype(np.int64)
            away = pa.array(_deviations(x, found.n, found.sums), pa.int64())
            each = pa.array(np.repeat(np.arange(len(x)), count))
            size = len(x) * count
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, found.n)),
                    away.take(each),
                    pa.array(((x - mean) @ turn).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(size, found.identity_error)),
                    pa.array(np.tile(found.values, len(x))),
                    pa.array(np.full(size, found.residual)),
                ],
                [f.split()[0] for f in shape.split(", ")],
            )

    whole = rows.select(key, F.col(vector).alias(vector)).withColumn("x", whole_numbers(F.col(vector)))
    return whole.filter(F.size("x") == dim).select(key, "x").mapInArrow(run, shape)
