"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors are read on an integer grid, so that sums over them are exact. The distinct ones are the fit
list; they lie in packed blocks, written once. The covariance V is never formed: a pass multiplies it
with a thin matrix Q, block by block, as (X - mean)' ((X - mean) Q), and adds the small products up in
two steps (per task, then per one of `SLOTS` groups), so that the driver receives `SLOTS` matrices of
the size of Q whatever the number of tasks.

A few Lanczos steps with one vector find where the spectrum ends. Then, in turns: a Rayleigh-Ritz step
on the block, and a Chebyshev polynomial of V applied to it by the three-term recurrence, one pass per
degree, which stays within one on the unwanted part of the spectrum and grows fast above it; QR keeps
the block well conditioned. It ends when every wanted residual |Vq - eq| is at the level of rounding,
which bounds the distance of each e to an eigenvalue; without that it raises an error.

Defined results: rows with a null vector, or one that is empty, of another length than most, or holds
null or non-finite entries or such beyond 2^50 on the grid, take no part; repeated vectors count once
in the fit and each row has its result; a null id stays null; directions in which all vectors agree
(eigenvalue below 1e-12 of the largest) are no components, so equal vectors give no rows, as does an
empty table; `deviation` is null where the exact sum does not fit a long. A component's sign makes its
largest entry positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .vectors import matrix

COMPONENTS = 16
DEGREE = 10
LANCZOS = 12
MOST_TURNS = 60
BLOCK = 4096
SLOTS = 16
LARGEST = float(1 << 50)


def on_grid(vectors: DataFrame, id_col: str, vec_col: str, scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """(`id`, `x` array<bigint>): floor(scale * c) + shift per entry, of the rows that take part."""
    vec = F.transform(F.col(vec_col).cast("array<double>"), lambda c: F.lit(float(scale)) * c)
    rows = vectors.select(F.col(id_col).alias("id"), vec.alias("_v")).filter(F.size("_v") > 0)
    rows = rows.filter(F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)))
    usual = rows.groupBy(F.size("_v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("_v") == (usual["n"] if usual else 0))
    return rows.select("id", F.transform("_v", lambda c: F.floor(c).cast("bigint") + F.lit(shift).cast("bigint")).alias("x"))


def _packed(fit: DataFrame, size: int) -> DataFrame:
    """The fit list as matrices of at most `size` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0))
            for at in range(0, len(x), size):
                part = x[at:at + size]
                narrow = len(part) and np.abs(part).max() < 1 << 31
                data = part.astype("<i4" if narrow else "<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([4 if narrow else 8], pa.int32()), pa.array([data], pa.binary())], ["n", "width", "data"])

    return materialize(fit.mapInArrow(run, "n long, width int, data binary"), "fit_blocks")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for n, width, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            yield np.frombuffer(data.as_buffer(), f"<i{width}").reshape(n, -1).astype(np.int64)


def _summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str, length: int) -> np.ndarray:
    """The sum over all blocks of `part(x)`, `length` numbers of `kind`."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for x in _blocks(batches):
            found = part(x)
            total = found if total is None else total + found
        if total is not None:
            slot = TaskContext.get().partitionId() % SLOTS
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.astype(kind).tobytes()], pa.binary())], ["slot", "part"])

    def add(parts: pa.Table) -> pa.Table:
        total = np.zeros(length, dtype=kind)
        for value in parts.column("part"):
            total += np.frombuffer(value.as_buffer(), kind)
        return pa.table({"part": pa.array([total.tobytes()], pa.binary())})

    rows = blocks.mapInArrow(each, "slot int, part binary").groupBy("slot").applyInArrow(add, "part binary").collect()
    return sum((np.frombuffer(bytes(r["part"]), kind) for r in rows), np.zeros(length, dtype=kind))


@dataclass
class Moments:
    """Count and exact sums of the fit list; the mean is `whole` + `rest`, an integer and less than one."""

    n: int
    sums: list[int]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def left(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean without rounding before the last step, however far the mean is from zero."""
        return (x - self.whole).astype(np.float64) - self.left / self.n


def moments(blocks: DataFrame, dims: int) -> Moments:
    low_bits = 24

    def part(x: np.ndarray) -> np.ndarray:
        # two halves per sum, so that neither leaves 64 bits
        return np.concatenate([[len(x)], (x & ((1 << low_bits) - 1)).sum(axis=0), (x >> low_bits).sum(axis=0)])

    n, *halves = _summed(blocks, part, "<i8", 2 * dims + 1).tolist()
    return Moments(n, [(h << low_bits) + lo for lo, h in zip(halves[:dims], halves[dims:], strict=True)])


class Covariance:
    """V as an operator on thin matrices; `passes` counts the times the fit list was read."""

    def __init__(self, blocks: DataFrame, found: Moments):
        self.blocks, self.found, self.dims = blocks, found, len(found.sums)
        self.trace = 0.0
        self.passes = 0

    def times(self, q: np.ndarray) -> np.ndarray:
        found = self.found

        def part(x: np.ndarray) -> np.ndarray:
            c = found.centred(x)
            return np.concatenate([(c.T @ (c @ q)).ravel(), [np.einsum("ij,ij->", c, c)]])

        total = _summed(self.blocks, part, "<f8", q.size + 1)
        self.passes += 1
        self.trace = float(total[-1]) / found.n
        return total[:-1].reshape(q.shape) / found.n


def spectrum_ends(v: Covariance, steps: int, rng: np.random.Generator) -> tuple[float, float]:
    """Lower and upper end of the spectrum from Lanczos steps with full reorthogonalisation; the upper
    one is a bound, the lower one an estimate that filtering need not have exactly."""
    basis = np.zeros((v.dims, 0))
    q = rng.standard_normal((v.dims, 1))
    q /= np.linalg.norm(q)
    diagonal, beside = [], []
    for _ in range(min(steps, v.dims)):
        basis = np.hstack([basis, q])
        w = v.times(q)
        diagonal.append(float((q.T @ w)[0, 0]))
        for _ in range(2):
            w = w - basis @ (basis.T @ w)
        size = float(np.linalg.norm(w))
        beside.append(size)
        if size <= 1e-12 * abs(diagonal[0]):
            break
        q = w / size
    t = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    values = np.linalg.eigvalsh(t)
    return max(0.0, float(values[0]) - beside[-1] / 4), float(values[-1]) + beside[-1]


def filtered(v: Covariance, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V times q: within one on [low, high], scaled to one at `top`."""
    middle, half = (low + high) / 2, (high - low) / 2
    sigma = first = half / (top - middle)
    before, now = q, (v.times(q) - middle * q) * (sigma / half)
    for _ in range(2, degree + 1):
        following = 1 / (2 / first - sigma)
        before, now = now, 2 * (following / half) * (v.times(now) - middle * now) - sigma * following * before
        sigma = following
    return now


@dataclass
class Whitening:
    """Eigenvalues (falling) and unit eigenvectors as columns; `residual` is the certificate, relative to the largest."""

    found: Moments
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.found.centred(x) @ self.vectors / np.sqrt(self.values)


def leading(v: Covariance, k: int, degree: int = DEGREE, seed: int = 5) -> Whitening:
    """The k leading eigenpairs of V, certified."""
    rng = np.random.default_rng(seed)
    d = v.dims
    size = min(d, max(2 * k, k + 8))
    k = min(k, d)
    low, top = spectrum_ends(v, LANCZOS, rng)
    q, _ = np.linalg.qr(rng.standard_normal((d, size)))
    goal, best, stuck = 8 * np.finfo(float).eps * np.sqrt(d), np.inf, 0
    for _ in range(MOST_TURNS):
        image = v.times(q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        top = max(top, float(values[0]))
        wanted = slice(0, k)
        residual = float(np.linalg.norm(image[:, wanted] - q[:, wanted] * values[wanted], axis=0).max()) / max(float(values[0]), 1e-300)
        # rounding may keep it just above the goal
        stuck = stuck + 1 if residual > best / 2 else 0
        best = min(best, residual)
        if residual <= goal or values[0] <= 0 or (stuck >= 2 and residual <= 100 * goal):
            kept = int((values[wanted] > 1e-12 * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
            vectors = q[:, :kept]
            signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)]) if kept else np.zeros(0)
            return Whitening(v.found, values[:kept], vectors * signs, v.trace, residual, v.passes)
        high = float(values[-1])
        if size < d and top > high > 0:
            q = filtered(v, q, min(low, high / 2 if low >= high else low), high, top, degree)
        else:
            q = image
        q, _ = np.linalg.qr(q)
        # once more: columns of very different length lose orthogonality
        q, _ = np.linalg.qr(q)
    raise ArithmeticError(f"eigenvectors not certified after {MOST_TURNS} turns: residual {best:.1e}")


def fit(fit_list: DataFrame, k: int = COMPONENTS, degree: int = DEGREE, block: int = BLOCK) -> tuple[DataFrame, Whitening | None]:
    """(packed fit list, model) of distinct vectors in column `x`; no model without vectors."""
    ship_package(fit_list.sparkSession, "millrace")
    blocks = _packed(fit_list.select("x"), block)
    one = blocks.select((F.octet_length("data") / (F.col("n") * F.col("width"))).cast("int").alias("dims")).first()
    if one is None:
        return blocks, None
    found = moments(blocks, one["dims"])
    return blocks, leading(Covariance(blocks, found), k, degree)


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, from one more pass."""
    k = len(model.values)
    if not k:
        return 0.0

    def part(x: np.ndarray) -> np.ndarray:
        y = model.apply(x)
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

    total = _summed(blocks, part, "<f8", k * k + k) / model.found.n
    mean = total[k * k:]
    return float(np.abs(total[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def deviations(found: Moments, x: np.ndarray) -> list[int | None]:
    """Per row the sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    n, whole, left = found.n, found.whole, found.left
    near = x - whole
    rough = ((near.astype(np.float64) * n - left) ** 2).sum(axis=1)
    # far inside 64 bits nothing can overflow on the way
    fits = rough < float(1 << 61)
    out: list[int | None] = [None] * len(x)
    inside = np.flatnonzero(fits)
    exact = ((near[inside] * n - left) ** 2).sum(axis=1).tolist()
    for i, value in zip(inside.tolist(), exact, strict=True):
        out[i] = value
    for i in np.flatnonzero(~fits).tolist():
        value = sum((int(a) * n - int(b)) ** 2 for a, b in zip(near[i], left, strict=True))
        out[i] = value if value < 1 << 63 else None
    return out


def whiten(rows: DataFrame, model: Whitening, error: float) -> DataFrame:
    """Per row of (`id`, `x`) and component: `id`, `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error`."""
    ship_package(rows.sparkSession, "millrace")
    k = len(model.values)
    share = model.values / model.trace if model.trace else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = matrix(batch.column(1))
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.found.n)),
                    pa.array(deviations(model.found, x), pa.int64()).take(pa.array(each)), pa.array(model.apply(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    out = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.select("id", "x").mapInArrow(run, out)


def whitened_rows(vectors: DataFrame, id_col: str, vec_col: str, k: int = COMPONENTS) -> DataFrame:
    """Fit on the distinct grid vectors and return every row's whitened components."""
    rows = materialize(on_grid(vectors, id_col, vec_col), "grid")
    blocks, model = fit(rows.select("x").distinct(), k)
    if model is None:
        model = Whitening(Moments(0, []), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0, 0)
    return whiten(rows, model, identity_error(blocks, model)).withColumnRenamed("id", id_col)
