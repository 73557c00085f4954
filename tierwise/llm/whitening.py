"""Embedding whitening from polarised variances.

The covariance of two variables follows from variances alone: cov(a, b) = (var(a + b) - var(a) - var(b)) / 2.
So the jobs sum one kind of number, the exact square of a centred value, for every dimension and for the sum
of every pair of dimensions; the cross-covariances are differences of those sums.

1. Every entry c becomes the integer x = floor(64 c) + 1000000. One pass counts rows and sums the x.
2. A second pass centres on the integer part of each mean, y = x - floor(S / n), and adds y^2 and (y_i + y_j)^2.
   Tasks send one row per pair; Spark adds the rows of all tasks as decimals. The part of the mean left over
   (below one unit) is then taken off exactly: n^2 var = n sum(y^2) - (sum y)^2, all in whole numbers.
3. The matrix of covariances (as large as the dimension squares, not the rows) is assembled on the driver,
   each entry one correctly rounded quotient of whole numbers, and goes to ``eigh``.
4. A third pass measures the covariance of what comes out; the last writes the result.

Sums of a task are 64-bit where the largest entry proves that they fit; rows with larger entries are added as
Python's whole numbers, so nothing wraps.

Defined cases: a null vector, or one with a null or non-finite entry, is dropped; the dimension is the commonest
length of the others (ties: the greater) and vectors of any other length, empty ones included, are dropped, too.
Entries outside the range of a long count as the nearest end of +-2^62. Components whose eigenvalue is not above
1e-12 of the largest cannot be whitened and are left out, so equal vectors only (or one, or none) give no rows.
Repeated rows and null ids count and are returned each. A ``deviation`` beyond a long is null;
``deviation_exact`` holds it as a decimal (null beyond 38 digits). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import read_table, stage

#: Units of one, and the offset that makes usual entries positive.
SCALE, OFFSET = 64, 1_000_000
#: Bound of an integer entry.
FAR = 1 << 62
#: Bytes of integer entries worked on at a time.
SLICE_BYTES = 4 << 20
#: A sum travels as high * SPLIT + low, both decimals.
SPLIT = 10**18
DECIMAL = pa.decimal128(38, 0)
OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_exact decimal(38,0)"
)


def integers(values: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000 of finite entries, within +-2^62."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values.astype(np.float64) * SCALE)
    return np.clip(scaled, -float(FAR), float(FAR)).astype(np.int64) + OFFSET


def _valid(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, ids, flat entries by row) of the usable vectors, for each length in the batch."""
    ids, vectors = batch.column(0), batch.column(1)
    flat = vectors.flatten()  # entries of null vectors are left out
    sizes = np.where(
        vectors.is_valid().to_numpy(zero_copy_only=False),
        vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0,
    ).astype(np.int64)
    entries = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null: not a number
    good = np.isfinite(entries)
    ends = np.cumsum(sizes)
    bad = np.concatenate(([0], np.cumsum(~good)))
    usable = (bad[ends] == bad[ends - sizes]) & (sizes > 0)
    for size in np.unique(sizes[usable]).tolist():
        rows = np.flatnonzero(usable & (sizes == size))
        at = (ends[rows] - size)[:, None] + np.arange(size)
        yield size, ids.take(pa.array(rows)), entries[at]


def _whole(rows: np.ndarray, bound: int) -> int | np.ndarray:
    """Column sums of integers whose absolute values are at most ``bound``, as Python's whole numbers."""
    if bound * max(1, len(rows)) < FAR:
        return rows.sum(axis=0).astype(object)
    return rows.astype(object).sum(axis=0)


def _square_sums(y: np.ndarray) -> list:
    """Exact sums over the rows of y_i^2 and (y_i + y_j)^2, i <= j ordered by i, then j (i = j: the square)."""
    total = np.zeros(y.shape[1] * (y.shape[1] + 1) // 2, dtype=object)
    far = np.abs(y).max(axis=1, initial=0) >= 1 << 24  # squares of sums below 2^50: thousands of them fit
    for part, exact in ((y[~far], False), (y[far], True)):
        for top in range(0, len(part), 4096 if not exact else 64):
            rows = part[top : top + (4096 if not exact else 64)]
            rows = rows.astype(object) if exact else rows
            at = 0
            for i in range(y.shape[1]):
                sums = rows[:, i : i + 1] + rows[:, i:]
                sums[:, 0] = rows[:, i]
                total[at : at + sums.shape[1]] += (sums * sums).sum(axis=0).astype(object)
                at += sums.shape[1]
    return total.tolist()


def _decimals(values: list) -> tuple[pa.Array, pa.Array]:
    parts = [divmod(int(v), SPLIT) for v in values]
    return tuple(pa.array([Decimal(p[k]) for p in parts], DECIMAL) for k in (0, 1))


def _value(high, low) -> int:
    return int(high) * SPLIT + int(low)


def _sums(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.groupBy(*keys).agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n"))


@dataclass
class Whitener:
    """What every task needs: the whole part of the means, the rest of the sums, and the projection."""

    n: int
    whole: np.ndarray  # floor(S / n)
    rest: np.ndarray  # S - n floor(S / n)
    projection: np.ndarray  # dimension x components, over the root of the eigenvalue
    explained: np.ndarray
    covariance: np.ndarray

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return (y - self.rest.astype(np.float64) / self.n) @ self.projection

    def deviations(self, y: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2 = n^2 sum(y^2) - 2 n sum(rest y) + sum(rest^2), exactly."""
        bound = int(np.abs(y).max(initial=0))
        if bound * max(bound, self.n) * y.shape[1] >= FAR:
            y = y.astype(object)
        squares, products = (y * y).sum(axis=1), (y * self.rest.astype(y.dtype)).sum(axis=1)
        fixed = sum(int(r) ** 2 for r in self.rest)
        return [
            self.n**2 * int(a) - 2 * self.n * int(b) + fixed for a, b in zip(squares.tolist(), products.tolist(), strict=True)
        ]


def _entries(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    return vectors.select(F.col(vec_id).cast("long").alias("i"), F.col(embedding).cast("array<double>").alias("v"))


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, integer entries) of the vectors of the chosen length, a bounded number at a time."""
    step = max(1, SLICE_BYTES // (8 * size))
    for batch in batches:
        for length, ids, entries in _valid(batch):
            if length == size:
                for top in range(0, len(entries), step):
                    yield ids.slice(top, step), integers(entries[top : top + step])


def fit(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 32) -> Whitener | None:
    """The whitening of all usable vectors; None if there are none."""
    rows = _entries(vectors, vec_id, embedding)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for size, _, entries in _valid(batch):
                held = total.setdefault(size, [0, np.zeros(size, dtype=object)])
                held[0] += len(entries)
                step = max(1, SLICE_BYTES // (8 * size))
                for top in range(0, len(entries), step):
                    x = integers(entries[top : top + step])
                    held[1] += _whole(x, int(np.abs(x).max(initial=0)))
        for size, (n, sums) in total.items():
            high, low = _decimals(sums.tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), high, low, pa.array([n] * size, pa.int64())],
                ["size", "dim", "high", "low", "n"],
            )

    means = stage(
        _sums(rows.mapInArrow(first, "size int, dim int, high decimal(38,0), low decimal(38,0), n long"), "size", "dim"),
        "whitening-means",
    )
    chosen = means.where("dim = 0").orderBy(F.desc("n"), F.desc("size")).select("size", "n").first()
    if chosen is None:
        return None
    size, n = chosen
    sums = {r["dim"]: _value(r["high"], r["low"]) for r in means.where(F.col("size") == size).collect()}
    parts = [divmod(sums[i], n) for i in range(size)]
    whole, rest = (np.array([p[k] for p in parts], np.int64) for k in (0, 1))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * (size + 1) // 2, dtype=object)
        seen = False
        for _, x in _slices(batches, size):
            total += np.array(_square_sums(x - whole), dtype=object)
            seen = True
        if seen:
            high, low = _decimals(total.tolist())
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), high, low, pa.array(np.ones(len(i), np.int64))],
                ["i", "j", "high", "low", "n"],
            )

    squares = _sums(rows.mapInArrow(second, "i int, j int, high decimal(38,0), low decimal(38,0), n long"), "i", "j")
    return _solve(n, whole, rest, {(r["i"], r["j"]): _value(r["high"], r["low"]) for r in squares.collect()}, components)


def _solve(n: int, whole: np.ndarray, rest: np.ndarray, squares: dict, components: int) -> Whitener:
    size = len(whole)
    left = [int(r) for r in rest]  # the sums of the y
    variance = {
        (i, j): n * q - ((left[i] + left[j]) if i != j else left[i]) ** 2 for (i, j), q in squares.items()
    }  # n^2 times the variance of a dimension (i = j) or of the sum of two
    covariance = np.empty((size, size))
    for (i, j), q in variance.items():
        cross = Fraction(q, n * n) if i == j else Fraction(q - variance[i, i] - variance[j, j], 2 * n * n)
        covariance[i, j] = covariance[j, i] = float(cross)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(sum(Fraction(variance[i, i], n * n) for i in range(size)))
    keep = np.flatnonzero((values > 1e-12 * max(values[0], 0.0)) & (values > 0))[:components]
    vectors = vectors[:, keep]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))]) if len(keep) else np.ones(0)
    return Whitener(n, whole, rest, vectors * sign / np.sqrt(values[keep]), values[keep] / trace if trace else values[keep], covariance)


def identity_error(vectors: DataFrame, model: Whitener, vec_id: str = "vec_id", embedding: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened vectors, less the identity; measured on all of them."""
    size, width = model.projection.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for _, x in _slices(batches, size):
            w = model.whitened(x - model.whole)
            total[:width] += w.T @ w
            total[width] += w.sum(axis=0)
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "s"])

    if not width:
        return 0.0
    rows = _entries(vectors, vec_id, embedding).mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    total = np.zeros((width + 1, width))
    for r in rows.collect():
        total[r["i"], r["j"]] = r["s"]
    mean = total[width] / model.n
    return float(np.abs(total[:width] / model.n - np.outer(mean, mean) - np.eye(width)).max())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 32) -> DataFrame:
    """One row for each usable vector and component; the columns are ``OUT``."""
    model = fit(vectors, vec_id, embedding, components)
    rows = _entries(vectors, vec_id, embedding)
    if model is None or not model.projection.shape[1]:
        return vectors.sparkSession.createDataFrame([], OUT)
    error = identity_error(vectors, model, vec_id, embedding)
    size, width = model.projection.shape
    names = [c.split()[0] for c in OUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with localcontext() as context:
            context.prec = 60
            for ids, x in _slices(batches, size):
                y = x - model.whole
                far = model.deviations(y)
                each = np.repeat(np.arange(len(far)), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(far))),
                        pa.array(np.full(len(each), model.n, np.int64)),
                        pa.array([d if d < 1 << 63 else None for d in far], pa.int64()).take(pa.array(each)),
                        pa.array(model.whitened(y).ravel()),
                        pa.array(np.tile(model.explained, len(far))),
                        pa.array(np.full(len(each), error)),
                        pa.array([Decimal(d) if d < 10**38 else None for d in far], DECIMAL).take(pa.array(each)),
                    ],
                    names,
                )

    return rows.mapInArrow(run, OUT)


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
