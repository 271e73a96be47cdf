"""Whitening of embeddings by the eigenvectors of their covariance, found by cyclic Jacobi rotations.

A vector's entries become whole numbers first, so that counts, sums and
deviations are exact whatever way the rows are dealt. Tasks add up the scatter of
centred vectors; the driver gets one matrix of dimensions squared, rotates it
until every off-diagonal vanishes beside its two diagonals, and sends the
whitening matrix back. As that limit is relative, small eigenvalues are as
accurate as large ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole number of an entry c: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries of this size or more have no whole number that a double tells from its neighbours; they count as not finite.
LARGEST = float(1 << 46)
SWEEPS = 64
_EPS = float(np.finfo(np.float64).eps)
_LONG = 1 << 63


def usable(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers below LARGEST."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def fit_list(table: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, v) of the usable rows of table (vec_id, embedding), and their number of dimensions.

    Rows of another length than most rows have (of equally many, the longest) share no
    space with them and are left out. No usable row: no dimensions.
    """
    v = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(usable(F.col("v")))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (rows.filter(F.size("v") == most["d"]), most["d"]) if most else (rows, 0)


def whole(column: pa.Array, d: int) -> np.ndarray:
    """The rows of a list column as whole numbers."""
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)).astype(np.int64) + SHIFT


def _summed(parts: DataFrame) -> list[np.ndarray]:
    """The sums of parts (i, v) by i, in order of i; rows of one i meet in a task, one from each task before it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = v.values.to_numpy(zero_copy_only=False)
                sums[i] = sums[i] + own if i in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), kind)], names=["i", "v"])

    kind = pa.list_(pa.int64() if dict(parts.dtypes)["v"] == "array<bigint>" else pa.float64())
    found = parts.repartition("i").mapInArrow(rows, parts.schema).toArrow().sort_by("i")
    return [v.values.to_numpy(zero_copy_only=False) for v in found.column("v")]


def totals(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Number of rows, and the sum of their whole numbers by dimension."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d + 1, np.int64)
        for batch in batches:
            total[0] += batch.num_rows
            total[1:] += whole(batch.column(0), d).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total], pa.list_(pa.int64()))], names=["i", "v"])

    (found,) = _summed(rows.select("v").mapInArrow(parts, "i int, v array<long>"))
    return int(found[0]), found[1:]


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less its mean: a difference of whole numbers, divided once."""
    return (n * x - sums) / float(n)


def scatter(rows: DataFrame, width: int, values) -> np.ndarray:
    """Sum of each row's outer product with itself; values makes a matrix of width columns from a batch's first column."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = values(batch.column(0))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    return np.array(_summed(rows.select("v").mapInArrow(parts, "i int, v array<double>")))


def rounds(d: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of d places once, in rounds of pairs that share no place: one stays, the others go round."""
    places, out = list(range(d + d % 2)), []
    half = len(places) // 2
    for _ in range(max(len(places) - 1, 0)):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(places[:half], places[: half - 1 : -1], strict=True) if max(a, b) < d]
        if pairs:
            out.append(tuple(np.array(x) for x in zip(*pairs, strict=True)))
        places = [places[0], places[-1], *places[1:-1]]
    return out


def jacobi(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors in columns) of a symmetric matrix, falling.

    Cyclic sweeps rotate all pairs, a round of disjoint pairs at once, until every
    off-diagonal is below the rounding of its two diagonals' geometric mean.
    """
    a, vectors = (matrix + matrix.T) / 2, np.eye(len(matrix))
    least = 1e-290 * float(np.abs(np.diag(a)).max(initial=0.0))
    for _ in range(SWEEPS):
        turned = False
        for p, q in rounds(len(a)):
            off = a[p, q]
            on = np.abs(off) > np.maximum(_EPS * np.sqrt(np.abs(a[p, p] * a[q, q])), least)
            if not on.any():
                continue
            turned, p, q, off = True, p[on], q[on], off[on]
            theta = (a[q, q] - a[p, p]) / (2 * off)
            t = np.where(theta < 0, -1.0, 1.0) / (np.abs(theta) + np.hypot(theta, 1.0))
            c = 1 / np.hypot(t, 1.0)
            s = t * c
            high, low = a[p, p] - t * off, a[q, q] + t * off
            for m in (a.T, a, vectors.T):  # columns, rows, and the vectors' columns
                first, second = m[p].copy(), m[q].copy()
                m[p], m[q] = c[:, None] * first - s[:, None] * second, s[:, None] * first + c[:, None] * second
            a[p, p], a[q, q], a[p, q], a[q, p] = high, low, 0.0, 0.0
        if not turned:
            break
    values = np.diag(a).copy()
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: np.ndarray
    #: A column for each component: its eigenvector over the root of its eigenvalue.
    matrix: np.ndarray
    explained: np.ndarray


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of rows (v) of d dimensions. Components without variance, to the rounding of the largest, are none."""
    n, sums = totals(rows, d)
    covariance = scatter(rows, d, lambda column: centred(whole(column, d), n, sums)) / n
    values, vectors = jacobi(covariance)
    kept = min(components, int((values > d * _EPS * values[0]).sum())) if values[0] > 0 else 0
    return Whitening(n, sums, vectors[:, :kept] / np.sqrt(values[:kept]), values[:kept] / np.trace(covariance))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - sums) squared, exact; null where a long can't hold it."""
    apart = n * x - sums
    if apart.size and float(np.abs(apart).max()) ** 2 * apart.shape[1] >= _LONG:
        return [total if (total := sum(int(y) ** 2 for y in row)) < _LONG else None for row in apart]
    return (apart * apart).sum(axis=1).tolist()


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each usable row and component.

    table: vec_id and embedding; other columns are ignored. Rows whose vector is null,
    empty, of another length than most, or holds null or non-finite entries are in
    neither the fit nor the result. Repeated rows and vectors count as often as they
    stand. A table without usable rows, or without any variance, gives no rows.
    """
    spark = table.sparkSession
    rows, d = fit_list(table)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, d, components) if d else None
    if model is None or not model.matrix.shape[1]:
        return spark.createDataFrame([], schema)
    n, sums, matrix = model.n, model.sums, model.matrix
    r = matrix.shape[1]
    project = lambda column: centred(whole(column, d), n, sums) @ matrix
    # Whitened values are centred by what remains of their mean too, which is rounding.
    mean = _mean(rows, r, project) / n
    error = float(np.abs(scatter(rows, r, lambda column: project(column) - mean) / n - np.eye(r)).max())

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(batch.column(1), d)
            w = pa.array(list(centred(x, n, sums) @ matrix), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviations(x, n, sums), pa.int64()), w], names=["vec_id", "deviation", "w"])

    told = F.array(*[F.lit(float(e)) for e in model.explained])
    found = rows.select("vec_id", "v").mapInArrow(out, "vec_id long, deviation long, w array<double>").select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
    return found.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.element_at(told, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"))


def _mean(rows: DataFrame, r: int, project) -> np.ndarray:
    """Sum of the projected rows."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(r)
        for batch in batches:
            total += project(batch.column(0)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total], pa.list_(pa.float64()))], names=["i", "v"])

    return _summed(rows.select("v").mapInArrow(parts, "i int, v array<double>"))[0]
