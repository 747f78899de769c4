"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found from products of the centred data only: a
pass multiplies a block Q of some fifty columns by XᵀX, slice by slice in the tasks, and the
partial products are added up.  A polynomial recurrence over such passes damps the spectrum
below the block, then QR and Rayleigh-Ritz turn the block into approximate eigenvectors.  This is repeated until
every wanted residual |Vq - eq| is below ``TOLERANCE`` times the largest eigenvalue.  Where the
spectrum is so flat that this would take very many passes, the block grows; a block of all
dimensions is exact after one pass.

Entries are used as whole numbers floor(64 c) + 1,000,000, so sums, the mean and ``deviation``
are exact; a vector is centred before anything is multiplied.

Defined results: vectors that are null, empty, hold null or non-finite entries, or an entry of
2^45 or more are left out, as are those of another length than the most frequent one (of equally
frequent lengths the longest).  Rows are independent: repeated rows and ids (null ids too) each
count and come back.  Directions without variance (eigenvalue below 1e-9 of the largest) have no whitened
value and no component; so one row, or equal rows only, give no component, and neither does
an empty table.  ``deviation`` is null where it exceeds a long.  Only the id and the vector column are read,
so other columns may have any name.

What reaches the driver is a block's product from at most ``PARTIALS`` groups of tasks:
its size depends on the number of dimensions, not on the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.operators.sizing import cut_lineage

SCALE, SHIFT = 64, 1_000_000
# 64 c stays a whole number that a double holds exactly.
LARGEST = float(1 << 45)
TOLERANCE = 1e-13
# Eigenvalues below this share of the largest count as none.
RANK = 1e-9
# Steps of the recurrence between two Rayleigh-Ritz steps.
FEWEST_STEPS, MOST_STEPS = 4, 16
# The block grows if the present one would need more passes than this.
PATIENCE = 40
# Groups of tasks whose products reach the driver.
PARTIALS = 32
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Whitening:
    """Mean (``base`` + ``rest`` / ``n``), eigenvectors by falling eigenvalue, and the certificate."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    identity_error: float
    passes: int

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """The rows with a vector of finite entries of the most frequent length."""
    fine = F.forall(column, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < LARGEST))
    kept = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0) & fine)
    lengths = kept.groupBy(F.size(column).alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return kept.where(F.size(column) == (most["length"] if most else 0))


def _whole(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return (np.floor(flat * SCALE).astype(np.int64) + SHIFT).reshape(len(column), -1)


def _packed(rows: DataFrame, column: str) -> DataFrame:
    """The whole numbers of some thousand vectors a row, materialised for the passes."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _whole(batch.column(0))
            step = max(1, SLICE_BYTES // (8 * x.shape[1]))
            for begin in range(0, len(x), step):
                part = x[begin : begin + step]
                width = 4 if np.abs(part).max() < 1 << 31 else 8
                data = part.astype(f"i{width}").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(part)], pa.int32()), pa.array([width], pa.int32()), pa.array([data], pa.binary())],
                    ["n", "width", "x"],
                )

    return cut_lineage(rows.select(column).mapInArrow(pack, "n int, width int, x binary"))


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for n, width, data in zip(*(column.to_pylist() for column in batch.columns)):
            yield np.frombuffer(data, dtype=f"i{width}").reshape(n, -1)


def _total(packed: DataFrame, product: Callable[[np.ndarray], np.ndarray], kind: type) -> np.ndarray | None:
    """The sum over all slices of an array computed from each; None without slices."""

    def one(array: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if array is not None:
            place = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([place], pa.int32()), pa.array([array.tobytes()], pa.binary())], ["place", "data"]
            )

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _unpacked(batches):
            part = product(x)
            total = part if total is None else total + part
        yield from one(total)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column(1).to_pylist():
                part = np.frombuffer(data, dtype=kind)
                total = part if total is None else total + part
        yield from one(total)

    schema = "place int, data binary"
    partial = packed.mapInArrow(multiply, schema)
    if packed.rdd.getNumPartitions() > PARTIALS:
        partial = partial.repartition(PARTIALS, "place").mapInArrow(add, schema)
    found = sorted((row["place"], bytes(row["data"])) for row in partial.collect())
    return sum(np.frombuffer(data, dtype=kind) for _, data in found) if found else None


def _sums(x: np.ndarray) -> np.ndarray:
    """Count and sums, in halves that no long overflows: upper parts, then lower 20 bits."""
    x = x.astype(np.int64)
    return np.concatenate(([len(x)], (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0)))


def _centred(x: np.ndarray, n: int, base: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - base).astype(np.float64) - rest / n


def _steps(residual: float, wanted: float, edge: float, top: float) -> float:
    """Passes until the residual is small enough, by the growth of Chebyshev polynomials."""
    x = max(2 * wanted / edge - 1, 1 + 1e-12)
    growth = math.log(x + math.sqrt(x * x - 1))
    return math.log(max(residual / (TOLERANCE * top), 2)) / max(growth, 1e-9)


def _filtered(times: Callable, block: np.ndarray, image: np.ndarray, edge: float, top: float, steps: int) -> np.ndarray:
    """The block under the scaled Chebyshev polynomial that is small from 0 to ``edge``.

    ``image`` is V times the block, known from the Rayleigh-Ritz step, so ``steps`` - 1 passes are made.
    """
    half = edge / 2
    first = half / (top - half)
    scale, before, now = first, block, (image - half * block) * (first / half)
    for _ in range(1, steps):
        following = 1 / (2 / first - scale)
        now, before = 2 * following / half * (times(now) - half * now) - scale * following * before, now
        scale = following
    return now


def fit(vectors: DataFrame, column: str, components: int = 32) -> Whitening:
    """Mean, leading components and the certificate of a table of vectors."""
    packed = _packed(usable(vectors, column), column)
    sums = _total(packed, _sums, np.int64)
    if sums is None:
        nothing = np.zeros(0)
        return Whitening(0, nothing, nothing, np.zeros((0, 0)), nothing, 0.0, 0.0, 0.0, 1)
    n, d = int(sums[0]), len(sums) // 2
    totals = [(int(high) << 20) + int(low) for high, low in zip(sums[1 : d + 1], sums[d + 1 :])]
    base = np.array([total // n for total in totals], dtype=np.int64)
    rest = np.array([total % n for total in totals], dtype=np.int64)
    passes = 1

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, base, rest)
            return (c.T @ (c @ block)).ravel()

        return _total(packed, product, np.float64).reshape(block.shape) / n

    trace = float(_total(packed, lambda x: np.square(_centred(x, n, base, rest)).sum(axis=0), np.float64).sum()) / n
    passes += 1
    wanted = min(components, d)
    guard = max(8, wanted // 2)
    draw = np.random.default_rng(7)
    block = np.linalg.qr(draw.standard_normal((d, min(d, wanted + guard))))[0]
    image = times(block)
    best, rounds = math.inf, 0
    while True:
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = max(float(values[0]), 0.0)
        residual = float(np.linalg.norm(image - block * values, axis=0)[:wanted].max())
        stuck = residual > best / 2 and residual <= 1e3 * TOLERANCE * top
        if residual <= TOLERANCE * top or stuck or block.shape[1] == d:
            break
        best, rounds = min(best, residual), rounds + 1
        edge = max(float(values[-1]), RANK * top)
        need = _steps(residual, max(float(values[wanted - 1]), edge), edge, top)
        if rounds > 2 and need > PATIENCE:
            more = draw.standard_normal((d, min(guard, d - block.shape[1])))
            block = np.linalg.qr(np.hstack([block, more]))[0]
            image, best = times(block), math.inf
            continue
        steps = int(min(max(math.ceil(need) + 1, FEWEST_STEPS), MOST_STEPS))
        block = _filtered(times, block, image, edge, top, steps)
        block = np.linalg.qr(block / np.maximum(np.linalg.norm(block, axis=0), 1e-300))[0]
        image = times(block)
    kept = int((values[:wanted] > RANK * top).sum()) if top > 0 else 0
    axes, values = block[:, :kept], values[:kept]
    error = 0.0
    if kept:
        scaled = axes / np.sqrt(values)

        def squares(x: np.ndarray) -> np.ndarray:
            z = _centred(x, n, base, rest) @ scaled
            return (z.T @ z).ravel()

        covariance = _total(packed, squares, np.float64).reshape(kept, kept) / n
        error = float(np.abs(covariance - np.eye(kept)).max())
        passes += 1
    return Whitening(n, base, rest, axes, values, trace, residual, error, passes)


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, in Python's whole numbers where a long is too short."""
    y = x - model.base
    largest = model.n * (int(np.abs(y).max()) + 1)
    if largest * largest * y.shape[1] < 1 << 63:
        return np.square(model.n * y - model.rest).sum(axis=1).tolist()
    wide = model.n * y.astype(object) - model.rest.astype(object)
    return [v if v < 1 << 63 else None for v in (wide * wide).sum(axis=1)]


def whiten(vectors: DataFrame, model: Whitening, key: str, column: str) -> DataFrame:
    """(key, deviation, whitened) of every usable row; ``whitened`` has one entry per component."""
    schema = T.StructType(
        [
            vectors.schema[key],
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    scaled = model.vectors / np.sqrt(model.values) if len(model.values) else model.vectors
    wide = scaled.shape[1] if model.n else 0

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not model.n:
                continue
            x = _whole(batch.column(1))
            z = _centred(x, model.n, model.base, model.rest) @ scaled
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * wide)
            lists = pa.ListArray.from_arrays(ends, pa.array(z.ravel()))
            columns = [batch.column(0), pa.array(_deviations(x, model), pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, [key, "deviation", "whitened"])

    rows = vectors.select(key, column)
    fine = F.forall(column, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < LARGEST))
    rows = rows.where(F.col(column).isNotNull() & (F.size(column) == len(model.base)) & (F.size(column) > 0) & fine)
    return rows.mapInArrow(project, schema)
