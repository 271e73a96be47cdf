"""Exact nearest neighbours and local outlier factors of all of a table's points, by a metric partition.

Equal points are one, with the number of rows that have it. Points go to the nearest
of some pivots and, in the order of their distance to it, into blocks. A block
knows its pivot, the least and greatest distance to it, and how far its points have to
look at most, from neighbours inside the block. By the triangle inequality two blocks
whose rings stand farther apart than that have nothing for each other, so they never
meet; a block takes the others nearest first, and looks ever less far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import checkpointed

#: Bounds: pivots, points of a block, and blocks; beyond BLOCK_POINTS * MOST_BLOCKS points, blocks grow.
MOST_PIVOTS, BLOCK_POINTS, LEAST_POINTS, MOST_BLOCKS = 2048, 1024, 32, 65536
SALTS, SEED = 8, 42
#: A bound is held to be this much lower than computed, for rounding.
_SLACK = 1 - 1e-9
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Between all rows of x and y, by differences: a row's distance to itself is exactly 0, and order doesn't matter."""
    out = np.zeros((len(x), len(y)))
    for a, b in zip(x.T, y.T, strict=True):
        out += (a[:, None] - b[None, :]) ** 2
    return np.sqrt(out)


def distinct_points(points: DataFrame, k: int) -> DataFrame:
    """(point, x, n, ids) of points (row, x): n rows have x, ids are the least k + 1 of them, point is the first."""
    least = points.withColumn("at", F.row_number().over(Window.partitionBy("x").orderBy("row"))).filter(F.col("at") <= k + 1)
    ids = least.groupBy("x").agg(F.sort_array(F.collect_list("row")).alias("ids"))
    counts = points.groupBy("x").agg(F.count("*").alias("n"))
    return counts.join(ids, "x").select(F.col("ids")[0].alias("point"), "x", "n", "ids")


def reach_of(dist: np.ndarray, rows: np.ndarray, need: np.ndarray) -> np.ndarray:
    """For each line of distances, ascending, and the rows there: the distance within which there are need rows; inf if there aren't, -1 if none is needed."""
    far = np.cumsum(rows, axis=1) >= need[:, None]
    at = far.argmax(axis=1)
    out = np.where(far.any(axis=1), dist[np.arange(len(dist)), at] if dist.shape[1] else np.inf, np.inf)
    return np.where(need <= 0, -1.0, out)


class Nearest:
    """The k nearest other points so far of each of some points, equally near ones by their number."""

    def __init__(self, point: np.ndarray, x: np.ndarray, n: np.ndarray, k: int):
        self.point, self.x, self.k, self.need = point, x, k, k - (n - 1)
        self.dist, self.other, self.rows = np.zeros((len(x), 0)), np.zeros((len(x), 0), np.int64), np.zeros((len(x), 0), np.int64)
        self.reach = np.where(self.need <= 0, -1.0, np.inf)

    def meet(self, point: np.ndarray, x: np.ndarray, n: np.ndarray, low: np.ndarray | None = None) -> int:
        """Take in a block of points; low: a lower bound of its distances for each own point. Returns how many distances were computed."""
        on = np.flatnonzero(self.reach >= (0.0 if low is None else np.maximum(low * _SLACK, 0.0)))
        if not len(on) or not len(point):
            return 0
        new = distances(self.x[on], x)
        new[self.point[on][:, None] == point[None, :]] = np.inf
        dist = np.concatenate([self.dist[on], new], axis=1)
        other = np.concatenate([self.other[on], np.broadcast_to(point, new.shape)], axis=1)
        rows = np.concatenate([self.rows[on], np.broadcast_to(n, new.shape)], axis=1)
        width = min(self.k, dist.shape[1])
        line, column = np.nonzero(dist <= np.partition(dist, width - 1, axis=1)[:, width - 1 : width])
        order = np.lexsort((other[line, column], dist[line, column], line))
        line, column = line[order], column[order]
        place = np.arange(len(line)) - np.searchsorted(line, line)
        line, column, place = (v[place < width] for v in (line, column, place))
        for name, values, empty in (("dist", dist, np.inf), ("other", other, -1), ("rows", rows, 0)):
            own = getattr(self, name)
            if own.shape[1] < width:
                own = np.concatenate([own, np.full((len(own), width - own.shape[1]), empty, own.dtype)], axis=1)
            kept = np.full((len(on), own.shape[1]), empty, own.dtype)
            kept[line, place] = values[line, column]
            own[on] = kept
            setattr(self, name, own)
        self.rows[~np.isfinite(self.dist)] = 0
        self.reach[on] = reach_of(self.dist[on], self.rows[on], self.need[on])
        return new.size

    def links(self) -> pa.RecordBatch:
        """(point, other, dist) of all neighbours that some own row may need."""
        line, column = np.nonzero(np.isfinite(self.dist) & (self.dist <= self.reach[:, None]))
        return pa.RecordBatch.from_arrays([pa.array(self.point[line]), pa.array(self.other[line, column]), pa.array(self.dist[line, column])], names=["point", "other", "dist"])


def _matrix(batch: pa.RecordBatch, name: str, at: int, d: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name))[at].values.to_numpy(zero_copy_only=False).reshape(-1, d)


def _longs(batch: pa.RecordBatch, name: str, at: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name))[at].values.to_numpy(zero_copy_only=False)


def with_pivot(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """points (point, x, n) with the number of the nearest pivot and the distance to it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_POINTS):
                part = batch.slice(at, BLOCK_POINTS)
                d = distances(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1), pivots)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], names=["point", "x", "n", "pivot", "dist"])

    return points.select("point", "x", "n").mapInArrow(rows, "point long, x array<double>, n long, pivot int, dist double")


def blocks(assigned: DataFrame, size: int, d: int, k: int) -> DataFrame:
    """(block, pivot, low, high, bound, points, n, x): at most size points of one pivot, next to each other by distance to it; x is flat."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held = TaskContext.get().partitionId(), 0, []

        def cut() -> pa.RecordBatch:
            nonlocal number
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            point, n, dist = (whole.column(c).to_numpy(zero_copy_only=False) for c in (0, 2, 4))
            x = whole.column(1).flatten().to_numpy(zero_copy_only=False)
            own = Nearest(point, x.reshape(-1, d), n, k)
            own.meet(point, x.reshape(-1, d), n)
            number += 1
            values = [[(task << 32) + number], [whole.column(3)[0].as_py()], [dist[0]], [dist[-1]], [own.reach.max()], [point], [n], [x]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            pivot = batch.column(3).to_numpy(zero_copy_only=False)
            start = 0
            while start < len(pivot):
                if held and (sum(b.num_rows for b in held) >= size or held[-1].column(3)[-1].as_py() != pivot[start]):
                    yield cut()
                    held = []
                room = size - sum(b.num_rows for b in held)
                end = min(start + room, int(np.searchsorted(pivot, pivot[start], side="right")))
                held.append(batch.slice(start, end - start))
                start = end
        if held:
            yield cut()

    names = ["block", "pivot", "low", "high", "bound", "points", "n", "x"]
    kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
    ordered = assigned.repartitionByRange("pivot", "dist", "point").sortWithinPartitions("pivot", "dist", "point")
    return ordered.mapInArrow(rows, "block long, pivot int, low double, high double, bound double, points array<long>, n array<long>, x array<double>")


def meetings(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(a, b, apart) of the other blocks b that points of block a may have neighbours in; apart is a lower bound of their distance. Every block is told of all blocks' rings, of which there are MOST_BLOCKS at most."""
    ring = table.select("block", "pivot", "low", "high").toArrow()
    block, pivot, low, high = (ring.column(c).to_numpy() for c in ("block", "pivot", "low", "high"))
    between = distances(pivots, pivots)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, p, lo, hi, bound in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                d = between[p][pivot]
                apart = np.maximum.reduce([np.zeros(len(d)), d - hi - high, low - d - hi, lo - d - high])
                near = np.flatnonzero((apart * _SLACK <= bound) & (block != a))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), a, np.int64)), pa.array(block[near]), pa.array(apart[near])], names=["a", "b", "apart"])

    return table.select("block", "pivot", "low", "high", "bound").mapInArrow(rows, "a long, b long, apart double")


def nearest(points: DataFrame, total: int, k: int) -> DataFrame:
    """(point, other, dist): for each of points (point, x, n), written, all points among which its rows' k nearest other rows are, of total points in all."""
    d = len(points.select("x").first()["x"])
    size = max(int(min(max(4 * total**0.5, LEAST_POINTS), BLOCK_POINTS)), -(-total // MOST_BLOCKS))
    chosen = points.orderBy(F.xxhash64("point", F.lit(SEED)), "point").limit(max(1, min(MOST_PIVOTS, -(-total // size)))).select("x").toArrow()
    pivots = chosen.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    table = checkpointed(blocks(with_pivot(points, pivots), size, d, k))
    payload = table.select(F.col("block").alias("b"), "pivot", "low", "high", "points", "n", "x")
    own = table.select(F.col("block").alias("a"), F.col("block").alias("b"), F.lit(-1.0).alias("apart"))
    tours = meetings(table, pivots).unionByName(own).join(payload, "b").repartition("a").sortWithinPartitions("a", "apart", "b")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for at in range(batch.num_rows):
                a, b, pivot, low, high = (batch.column(c)[at].as_py() for c in ("a", "b", "pivot", "low", "high"))
                point, n, x = _longs(batch, "points", at), _longs(batch, "n", at), _matrix(batch, "x", at, d)
                if a == b:
                    if now:
                        yield now.links()
                    now = Nearest(point, x, n, k)
                    now.meet(point, x, n)
                else:
                    there = distances(now.x, pivots[pivot : pivot + 1])[:, 0]
                    now.meet(point, x, n, np.maximum(there - high, low - there))
        if now:
            yield now.links()

    conf = points.sparkSession.conf
    old = conf.get(_BATCH, None)
    conf.set(_BATCH, "16")  # a row is a whole block
    try:
        return checkpointed(tours.select("a", "b", "pivot", "low", "high", "points", "n", "x").mapInArrow(rows, "point long, other long, dist double"))
    finally:
        conf.unset(_BATCH) if old is None else conf.set(_BATCH, old)


def outlier_factors(table: DataFrame, k: int) -> DataFrame:
    """(row, lof) of each of table (row: a unique long, x: an array of doubles), against all of them.

    A row's neighbours are the k nearest other rows, equally near ones by their number.
    One row alone has no factor.
    """
    rows = table.count()
    k = max(1, min(k, rows - 1))
    points = checkpointed(distinct_points(table, k))
    links = nearest(points.select("point", "x", "n"), points.count(), k) if rows > 1 else None
    if links is None:
        return table.select("row", F.lit(None).cast("double").alias("lof"))
    sizes = points.select("point", (F.lit(k) - (F.col("n") - 1)).alias("need"))
    near = links.join(points.select(F.col("point").alias("other"), F.explode("ids").alias("id")), "other").join(sizes.filter("need > 0"), "point")
    near = near.withColumn("at", F.row_number().over(Window.partitionBy("point").orderBy("dist", "id"))).filter(F.col("at") <= F.col("need"))
    near = near.groupBy("point", "other", "dist").agg(F.count("*").alias("times"))
    own = points.filter("n > 1").select("point", F.col("point").alias("other"), F.lit(0.0).alias("dist"), F.least(F.col("n") - 1, F.lit(k)).alias("times"))
    near = checkpointed(near.unionByName(own))
    reach = near.groupBy("point").agg(F.max("dist").alias("reach")).toDF("other", "reach")
    mean = lambda c: F.sum(F.col("times") * c) / F.sum("times")
    density = checkpointed(near.join(reach, "other").groupBy("point").agg((1.0 / (mean(F.greatest("dist", "reach")) + 1e-10)).alias("density")))
    around = near.join(density.toDF("other", "theirs"), "other").groupBy("point").agg(mean(F.col("theirs")).alias("theirs"))
    factor = around.join(density, "point").join(points.select("point", "x"), "point").select("x", (F.col("theirs") / F.col("density")).alias("lof"))
    # Many rows may have one x: they meet its factor in parts.
    factor = factor.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return table.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(factor, ["x", "salt"]).select("row", "lof")
