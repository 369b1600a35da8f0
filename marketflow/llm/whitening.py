"""Embedding whitening: float32 eigenvectors of a distributed covariance, refined to more than double.

Integer vectors are summed in one pass, which gives their mean and range, and multiplied in a
second one, each centred on its rounded mean first: products of small integers add up exactly,
and what rounding the mean left over is taken off in whole numbers on the driver, where the
covariance is one matrix of ``dimensions ** 2`` numbers. No digit is lost to a large mean.

Its eigenvectors are first found in float32 and then corrected by the iteration of Ogita and
Aishima, which is made of matrix products and doubles the number of right digits each time:
in double precision while that helps, then in extended precision. Where eigenvalues lie too close
together for it, their invariant subspace is corrected as a whole and a small eigenproblem,
shifted by the cluster's mean, turns its basis.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import finite_vector, materialize, tidy

#: Entries that doubles and their sums hold exactly.
EXACT = 2**53
#: Rows of a batch that are multiplied at a time.
ROWS_AT_ONCE = 8192
MOST_ITERATIONS = 12


def matrix_of(column: pa.ListArray, dimensions: int, fill: np.ndarray) -> np.ndarray:
    """Lists of longs as rows; what a shorter list lacks comes from ``fill``."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dimensions).all():
        return values.reshape(len(lengths), dimensions)
    out = np.repeat(fill[None, :], len(lengths), axis=0)
    out[np.arange(dimensions) < lengths[:, None]] = values
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(a, ROWS_AT_ONCE)


# --- Eigenvectors ------------------------------------------------------------------------------


def _clusters(values: np.ndarray, width: float) -> Iterator[np.ndarray]:
    """Indexes of rising values, in groups whose neighbours lie within ``width``."""
    order = np.argsort(values, kind="stable")
    cut = np.flatnonzero(np.diff(values[order]) > width) + 1
    yield from np.split(order, cut)


def _orthonormal(basis: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns made so by two Newton steps, in their own precision."""
    for _ in range(2):
        basis = basis - basis @ ((basis.T @ basis - np.eye(basis.shape[1], dtype=basis.dtype)) / 2)
    return basis


def _corrected(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, float]:
    """One iteration: better eigenvectors, and the size of the correction."""
    one = np.eye(len(matrix), dtype=matrix.dtype)
    off = one - basis.T @ basis
    inner = basis.T @ (matrix @ basis)
    values = np.diag(inner) / (1 - np.diag(off))
    # Eigenvalues nearer than this cannot be told apart from what is known so far.
    size = float(np.abs(values).max())
    apart = np.abs(inner - np.diag(values)).max() + size * np.abs(off).max()
    width = 2 * float(apart) * len(matrix) ** 0.5 + 4 * float(np.finfo(matrix.dtype).eps) * size
    gaps = values[None, :] - values[:, None]
    far = np.abs(gaps) > width
    step = np.where(far, (inner + values[None, :] * off) / np.where(far, gaps, 1), off / 2)
    np.fill_diagonal(step, np.diag(off) / 2)
    better = basis + basis @ step
    for group in _clusters(values, width):
        if len(group) == 1:
            continue
        # The subspace is right to the second order by now; a small problem finds its axes.
        part = _orthonormal(better[:, group])
        small = part.T @ (matrix @ part)
        middle = np.trace(small) / len(group)
        small = (small + small.T) / 2 - middle * np.eye(len(group), dtype=matrix.dtype)
        scale = np.abs(small).max()
        if scale > 4 * np.finfo(matrix.dtype).eps * size:
            _, turn = np.linalg.eigh((small / scale).astype(np.float64))
            part = part @ _orthonormal(turn.astype(matrix.dtype))
        better[:, group] = part
    # Directions within a cluster that no digit tells apart do not count as corrections.
    return better, float(np.abs(np.where(far, step, off / 2)).max())


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and their unit eigenvectors (columns) of a symmetric matrix, in its precision.

    An eigenvector is as right as the gap to the next eigenvalue allows; of equal eigenvalues
    any orthonormal basis is returned. The largest entry of each vector is positive.
    """
    count, exact = len(matrix), matrix.dtype
    scale = np.abs(matrix).max() if count else 0
    if not scale:
        return np.zeros(count, dtype=exact), np.eye(count, dtype=exact)
    scaled = (matrix + matrix.T) / (2 * scale)
    _, basis = np.linalg.eigh(scaled.astype(np.float32))
    for kind in (np.float64, exact):
        work, basis, last, stalls = scaled.astype(kind), basis.astype(kind), np.inf, 0
        for _ in range(MOST_ITERATIONS):
            better, moved = _corrected(work, basis)
            # A subspace that is turned may make one step worse before the next ones.
            stalls += moved > last / 2
            if not np.isfinite(moved) or stalls > 2:
                break
            basis, last = better, moved
            if moved <= 2 * float(np.finfo(kind).eps):
                break
    basis = _orthonormal(basis / np.sqrt((basis * basis).sum(axis=0)))
    values = (basis * (scaled @ basis)).sum(axis=0) * scale
    order = np.argsort(-values, kind="stable")
    basis = basis[:, order]
    largest = np.abs(basis).argmax(axis=0)
    return values[order], basis * np.sign(basis[largest, np.arange(count)])


# --- Covariance --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fit: exact sums, and the components by falling eigenvalue.

    ``center`` is the rounded mean, ``rest`` the sum of the vectors less their centers, both in
    whole numbers; ``reach`` is the largest distance of an entry from its center.
    """

    rows: int
    center: tuple[int, ...]
    rest: tuple[int, ...]
    reach: int
    fill: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def sums(self) -> list[int]:
        return [self.rows * c + r for c, r in zip(self.center, self.rest)]

    def explained(self) -> list[float | None]:
        """Share of the trace of every eigenvalue; null if all vectors are equal."""
        return [float(v / self.trace) if self.trace > 0 else None for v in self.values]

    def scales(self, components: int) -> np.ndarray:
        """One over the root of each of the first eigenvalues; not a number where it is as good as zero."""
        values = self.values[:components].astype(np.float64)
        least = float(self.trace) * max(1, len(self.values)) * np.finfo(np.float64).eps
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(values > least, 1 / np.sqrt(values), np.nan)


def _extended(number: int, divisor: int) -> np.longdouble:
    """``number / divisor`` of whole numbers of any size, rounded once to extended precision."""
    shift = max(0, 80 - number.bit_length() + divisor.bit_length())
    quotient = (number << shift) // divisor
    high = float(quotient)
    return np.ldexp(np.longdouble(high) + np.longdouble(float(quotient - int(high))), -shift)


def _range_of(vectors: DataFrame) -> DataFrame:
    """Per dimension how many entries there are, their sum, smallest and largest."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(0, np.int64), np.zeros(0, object)
        low, high = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in _slices(batches):
            lists = batch.column(0)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            width = int(sizes.max()) if len(sizes) else 0
            if width > len(count):
                more = width - len(count)
                count, total = np.append(count, np.zeros(more, np.int64)), np.append(total, np.zeros(more, object))
                low, high = np.append(low, np.full(more, EXACT)), np.append(high, np.full(more, -EXACT))
            there = np.arange(width) < sizes[:, None]
            rows = matrix_of(lists, width, np.zeros(width, np.int64))
            count[:width] += there.sum(axis=0)
            total[:width] += rows.sum(axis=0).astype(object)
            low[:width] = np.minimum(low[:width], np.where(there, rows, EXACT).min(axis=0))
            high[:width] = np.maximum(high[:width], np.where(there, rows, -EXACT).max(axis=0))
        numbers = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))
        yield pa.record_batch(
            [pa.array(np.arange(len(count)), pa.int32()), pa.array(count), numbers, pa.array(low), pa.array(high)],
            names=["dimension", "entries", "total", "low", "high"],
        )

    each = vectors.select("x").mapInArrow(
        tidy(summed), "dimension int, entries long, total decimal(38,0), low long, high long"
    )
    return each.groupBy("dimension").agg(
        F.sum("entries").alias("entries"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def _products(vectors: DataFrame, center: np.ndarray, fill: int, reach: int) -> DataFrame:
    """``i, j, total``: sums of products of centred entries, for ``j >= i``."""
    dimensions = len(center)
    i, j = np.triu_indices(dimensions)
    # So many rows add up exactly in doubles; wider entries are rounded to 53 bits a chunk.
    rows_at_once = int(min(ROWS_AT_ONCE, max(64, (EXACT - 1) // max(1, reach * reach))))

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(i), dtype=object)
        for batch in _slices(batches):
            rows = matrix_of(batch.column(0), dimensions, np.full(dimensions, fill)) - center
            for a in range(0, len(rows), rows_at_once):
                part = rows[a : a + rows_at_once].astype(np.float64)
                total += np.array([int(v) for v in (part.T @ part)[i, j].tolist()], dtype=object)
        yield pa.record_batch(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))],
            names=["i", "j", "total"],
        )

    each = vectors.select("x").mapInArrow(tidy(multiplied), "i int, j int, total decimal(38,0)")
    return each.groupBy("i", "j").agg(F.sum("total").alias("total"))


def fit_whitening(vectors: DataFrame, fill: int = 0) -> Whitening | None:
    """Fit over all rows of ``vectors`` (``x``: arrays of longs); null without rows.

    A shorter vector counts as ending in ``fill``. The driver holds one row per dimension and one
    number per pair of dimensions, however many rows there are; tasks send as much each, and the
    sums of the tasks are added up by pair of dimensions in a shuffle. Entries have to be
    below 2 ** 52 in size.
    """
    ranges = sorted(_range_of(vectors).collect(), key=lambda r: r["dimension"])
    rows = vectors.count()
    if not ranges:
        return None if not rows else Whitening(rows, (), (), 0, fill, np.zeros(0), np.zeros((0, 0)), 0.0)
    totals = [int(r["total"]) + (rows - r["entries"]) * fill for r in ranges]
    lows = [min(r["low"], fill) if r["entries"] < rows else r["low"] for r in ranges]
    highs = [max(r["high"], fill) if r["entries"] < rows else r["high"] for r in ranges]
    if min(lows) <= -EXACT // 2 or max(highs) >= EXACT // 2:
        raise ValueError("entries of vectors have to be below 2 ** 52 in size")
    center = [(2 * t + rows) // (2 * rows) for t in totals]
    rest = [t - rows * c for t, c in zip(totals, center)]
    reach = max(max(h - c, c - a) for a, h, c in zip(lows, highs, center))
    covariance = np.zeros((len(center), len(center)), dtype=np.longdouble)
    for row in _products(vectors, np.array(center, dtype=np.int64), fill, reach).collect():
        a, b = row["i"], row["j"]
        covariance[a, b] = covariance[b, a] = _extended(rows * int(row["total"]) - rest[a] * rest[b], rows * rows)
    values, axes = eigen(covariance)
    return Whitening(rows, tuple(center), tuple(rest), reach, fill, values, axes, np.trace(covariance))


def whitened(vectors: DataFrame, fit: Whitening, components: int) -> DataFrame:
    """``vectors`` (``x`` and any others) with ``whitened``: an array of doubles, one per component.

    Every vector less the mean, projected on the first components and divided by the root of
    their eigenvalues; null where an eigenvalue is as good as zero. A column ``whitened`` that
    was there is replaced.
    """
    kept = vectors.select(*(F.col(f"`{c}`") for c in vectors.columns if c.lower() != "whitened"))
    place, names = kept.columns.index("x"), [*kept.columns, "whitened"]
    dimensions, count = len(fit.center), min(components, len(fit.center))
    center, fill = np.array(fit.center, dtype=np.int64), np.full(dimensions, fit.fill)
    rest = np.array([float(_extended(r, fit.rows)) for r in fit.rest])
    axes = (fit.vectors[:, :count].astype(np.float64)) * np.nan_to_num(fit.scales(count))
    missing = np.isnan(fit.scales(count))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = matrix_of(batch.column(place), dimensions, fill) - center
            out = (rows - rest) @ axes
            offsets = pa.array(np.arange(len(out) + 1) * count, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(out.ravel(), mask=np.tile(missing, len(out))))
            yield pa.record_batch([*batch.columns, lists], names=names)

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(tidy(projected), f"{columns}, whitened array<double>")


def identity_error(rows: DataFrame) -> float | None:
    """Largest entry of the covariance of ``whitened`` less the identity; components without a scale do not count.

    Measured over the rows themselves, centred on their own mean; null without a component.
    """
    known = rows.select(F.filter("whitened", lambda v: v.isNotNull()).alias("w"))
    means = known.select(F.posexplode("w").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("mean"))
    mean = [r["mean"] for r in sorted(means.collect(), key=lambda r: r["i"])]
    if not mean:
        return None

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(mean), len(mean))), 0
        for batch in _slices(batches):
            part = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(mean)) - np.array(mean)
            total, count = total + part.T @ part, count + len(part)
        i, j = np.indices(total.shape)
        names = ["i", "j", "total", "n"]
        yield pa.record_batch([pa.array(c) for c in (i.ravel(), j.ravel(), total.ravel(), np.full(total.size, count))], names=names)

    each = known.mapInArrow(tidy(multiplied), "i long, j long, total double, n long")
    found = each.groupBy("i", "j").agg((F.sum("total") / F.sum("n")).alias("v")).collect()
    return max(abs(r["v"] - (r["i"] == r["j"])) for r in found)


def scaled_vectors(
    rows: DataFrame, scale: float, shift: int, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id, x``: ``floor(scale * c) + shift`` of every component of the vectors that are there and finite.

    A component beyond 2 ** 52 after scaling is an error: doubles would not hold it exactly.
    """
    def whole(c: Column) -> Column:
        value = F.floor(c.cast("double") * scale)
        far = F.abs(c.cast("double") * scale) >= F.lit(float(EXACT // 2))
        return F.when(far, F.raise_error(F.lit("a component is too large to be whitened exactly"))).otherwise(value.cast("long") + shift)

    return rows.filter(finite_vector(vector_column)).select(
        F.col(id_column).cast("long").alias("vec_id"), F.transform(vector_column, whole).alias("x")
    )


def whitening(
    rows: DataFrame,
    components: int = 8,
    *,
    scale: float = 1024.0,
    shift: int = 100_000,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[DataFrame, Whitening | None, float | None]:
    """Written rows ``vec_id, x, whitened``, the fit over all of them, and the error of the identity.

    Rows whose vector is null or holds null or non-finite components take no part; rows with a
    null id do. Repeated rows all count. A vector that is shorter than the longest one ends in
    components 0. An empty table gives no rows and no fit; if all vectors are equal, or have
    fewer independent dimensions than ``components``, the rest of ``whitened`` is null. Other
    columns, whatever their names, are not looked at.
    """
    vectors = materialize(scaled_vectors(rows, scale, shift, id_column, vector_column))
    fit = fit_whitening(vectors, shift)
    if fit is None:
        return vectors.withColumn("whitened", F.lit(None).cast("array<double>")), None, None
    done = materialize(whitened(vectors, fit, components))
    return done, fit, identity_error(done)
