"""Embedding whitening by Chebyshev-filtered subspace iteration over distributed passes.

A vector's entries become integers, ``floor(256 * c)``, and every distinct integer vector is fitted
once. Only one product ever touches the vectors: ``X'(XQ) / n`` with centred rows X and a thin block
Q, which each task sums over its rows. A polynomial of that product, by its three-term recurrence,
is small on the unwanted part of the spectrum and large on the wanted one. QR and a Rayleigh-Ritz
step follow, until the residuals of the wanted pairs certify them. The covariance itself is never
formed: the driver holds blocks of as many numbers as a vector has, times ``components + GUARD``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake.llm.tables import staged

COMPONENTS = 4
SCALE = 256
#: Columns of the block beyond the wanted ones: the filter damps what lies below them.
GUARD = 12
#: Residuals, as a share of the largest eigenvalue, at which the wanted pairs are certified.
CERTIFIED = 1e-13
#: Residuals that rounding alone may leave when they no longer fall.
ROUNDING = 1e-10
#: Longest polynomial, and the most that one polynomial may tell the first pair from the last.
DEGREE = 24
SPREAD = 1e8
ROUNDS = 200
#: A direction whose variance is a smaller share of the whole has none: it cannot be scaled.
FLAT = 1e-13
#: Tasks whose sums one task adds up, so that the driver gets few.
FAN = 128

OUT = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double"
)


@dataclass
class Whitening:
    """Counts, sums and leading pairs of the vectors of one length."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def alive(self) -> np.ndarray:
        """Which components have variance."""
        return self.values > FLAT * max(self.trace, np.finfo(float).tiny)

    @property
    def projection(self) -> np.ndarray:
        root = np.sqrt(np.where(self.alive, self.values, 1.0))
        return np.where(self.alive, self.vectors / root, np.nan)


def fixed_point(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the vectors without null and non-finite entries; entries beyond a long saturate."""
    odd = F.exists(
        "embedding",
        lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")),
    )
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    kept = vectors.select("vec_id", "embedding").where(F.col("embedding").isNotNull() & ~odd)
    return kept.select("vec_id", x.alias("x"))


def _rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sum_over(fits: DataFrame, shape: tuple, term: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``term`` over all batches: by task, then by groups of tasks, then here.

    Tasks are added in their order, so that a rerun on the same partitions gives the same bits.
    """
    dim = shape[0]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += term(_rows(batch, dim))
        part = TaskContext.get().partitionId()
        columns = [[part // FAN], [part], [total.tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["of", "part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for of, raw in zip(batch.column("of").to_pylist(), batch.column("sums").to_pylist()):
                held[of] = held.get(of, 0) + np.frombuffer(raw)
        columns = [list(held), [t.tobytes() for t in held.values()]]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["of", "sums"])

    parts = fits.mapInArrow(partial, "of long, part long, sums binary")
    parts = parts.repartition("of").sortWithinPartitions("of", "part")
    rows = parts.mapInArrow(add, "of long, sums binary").collect()
    total = np.zeros(shape)
    for row in sorted(rows):
        total += np.frombuffer(row["sums"]).reshape(shape)
    return total


def count_and_sums(fits: DataFrame, dim: int) -> tuple[int, list[int]]:
    """The number of vectors and their exact sum per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch, dim)
            # Halves of 32 bits cannot overflow within a batch.
            columns = [
                np.arange(dim, dtype=np.int32),
                np.full(dim, len(x), np.int64),
                (x >> 32).sum(0),
                (x & 0xFFFFFFFF).sum(0),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["at", "n", "high", "low"]
            )

    halves = fits.mapInArrow(run, "at int, n long, high long, low long").groupBy("at")
    exact = {c: F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")}
    rows = halves.agg(F.sum("n").alias("n"), *exact.values()).collect()
    sums = {r["at"]: (int(r["high"]) << 32) + int(r["low"]) for r in rows}
    return rows[0]["n"], [sums[i] for i in range(dim)]


def chebyshev(apply: Callable, block: np.ndarray, image: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """A polynomial of the operator on a block: at most 1 on [0, cut], and 1 at ``top``.

    ``image`` is the operator on the block, which the step before has already computed.
    """
    half = cut / 2
    ratio = half / (top - half)
    low, high, scale = block, (image - half * block) * (ratio / half), ratio
    for _ in range(degree - 1):
        after = 1 / (2 / ratio - scale)
        low, high = high, 2 * (after / half) * (apply(high) - half * high) - scale * after * low
        scale = after
    return high


def leading_pairs(
    apply: Callable[[np.ndarray], np.ndarray], dim: int, count: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``count`` largest eigenvalues of a positive semidefinite operator, falling, their unit
    eigenvectors, and the largest residual as a share of the first eigenvalue.

    Ends once the residuals are certified, or once rounding keeps them from falling further.
    """
    block = np.linalg.qr(np.random.default_rng(0).standard_normal((dim, min(dim, count + GUARD))))[0]
    best, since = np.inf, 0
    for _ in range(ROUNDS):
        image = apply(block)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residual = np.linalg.norm(image - block * values, axis=0)[:count].max()
        residual /= max(values[0], np.finfo(float).tiny)
        if residual < best / 2:
            best, since = residual, 0
        else:
            since += 1
        if residual <= CERTIFIED or (residual <= ROUNDING and since > 1):
            return values[:count], block[:, :count], float(residual)
        cut = values[-1]
        half = cut / 2
        wanted, first = (np.arccosh(max(v / half - 1, 1)) if half > 0 else 0 for v in values[[count - 1, 0]])
        if wanted <= 0 or cut <= FLAT * values[0]:
            block = np.linalg.qr(image)[0]
            continue
        degree = 1 + np.log(residual / CERTIFIED) / wanted
        if first > wanted:
            degree = min(degree, np.log(SPREAD) / (first - wanted))
        degree = int(np.clip(np.ceil(degree), 2, DEGREE))
        block = np.linalg.qr(chebyshev(apply, block, image, cut, values[0], degree))[0]
    raise RuntimeError(f"not certified after {ROUNDS} rounds: residual {residual:.1e}")


def fit(fits: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """Leading pairs of the covariance of distinct vectors (x) that all have ``dim`` entries."""
    n, sums = count_and_sums(fits, dim)
    mean = np.array([s / n for s in sums])
    trace = float(_sum_over(fits, (dim,), lambda x: ((x - mean) ** 2).sum(0)).sum()) / n

    def apply(block: np.ndarray) -> np.ndarray:
        def term(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ block)

        return _sum_over(fits, block.shape, term) / n

    count = min(components, dim)
    if trace > 0:
        values, vectors, residual = leading_pairs(apply, dim, count)
    else:
        values, vectors, residual = np.zeros(count), np.eye(dim)[:, :count], 0.0
    # Either sign would do: the largest entry is positive.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(count)])
    model = Whitening(n, sums, trace, values, vectors, residual)
    model.identity_error = _identity_error(fits, model)
    return model


def _identity_error(fits: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, by passes over them."""
    mean, projection = model.mean, model.projection[:, model.alive]
    dim, count = projection.shape
    if not count:
        return 0.0
    # Rows of the sum beyond the number of components stay zero.
    first = np.zeros((dim, 1))
    first[:count, 0] = _sum_over(
        fits, (dim, 1), lambda x: _padded(((x - mean) @ projection).sum(0)[:, None], dim)
    )[:count, 0]
    centre = first[:count, 0] / model.n

    def term(x: np.ndarray) -> np.ndarray:
        white = (x - mean) @ projection - centre
        return _padded(white.T @ white, dim)

    covariance = _sum_over(fits, (dim, count), term)[:count] / model.n
    return float(np.abs(covariance - np.eye(count)).max())


def _padded(matrix: np.ndarray, rows: int) -> np.ndarray:
    return np.pad(matrix, ((0, rows - len(matrix)), (0, 0)))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums over dimensions of ``(n * x - S) ** 2``; None where a long cannot hold it."""
    reach = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums))
    if reach**2 * len(sums) < 1 << 63:
        return ((n * x - np.array(sums)) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def _project(rows: DataFrame, dim: int, model: Whitening) -> DataFrame:
    schema = T.StructType([rows.schema["vec_id"], *T.StructType.fromDDL(OUT)])
    mean, projection = model.mean, model.projection
    count = len(model.values)
    share = model.values / model.trace if model.trace > 0 else np.full(count, np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch, dim)
            size = len(x)
            white = ((x - mean) @ projection).ravel()
            # A component without variance has no whitened value, a share of no variance none either.
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(size), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * count, model.n)),
                    pa.array([v for v in deviations(x, model.n, model.sums) for _ in range(count)], pa.int64()),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(np.tile(share, size), mask=np.isnan(np.tile(share, size))),
                    pa.array(np.full(size * count, model.identity_error)),
                ],
                names=schema.fieldNames(),
            )

    return rows.mapInArrow(run, schema)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable vector.

    Vectors that are null or hold null or non-finite entries give no rows, and neither do empty
    ones, which have no components. Vectors of one length are whitened together: each length is a
    table of its own. Rows that repeat an id or a vector all appear; a repeated vector is fitted
    once. There are as many components as entries if those are fewer. A component without variance
    (all vectors equal, or too few of them) has a null ``whitened``, and its share is null when
    there is no variance at all. A deviation beyond 64 bits is null.
    """
    rows = fixed_point(vectors)
    fits = staged(rows.select("x").distinct(), "whitening")
    sizes = fits.groupBy(F.size("x").alias("dim")).count().where("dim > 0").collect()
    found = []
    for dim in sorted(r["dim"] for r in sizes):
        own = F.size("x") == dim
        found.append(_project(rows.where(own), dim, fit(fits.where(own).select("x"), dim, components)))
    if not found:
        schema = T.StructType([rows.schema["vec_id"], *T.StructType.fromDDL(OUT)])
        return vectors.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.union, found)
