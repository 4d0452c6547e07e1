"""Cluster statistics and the assignment of points to them.

Points stay on the executors. The statistics of all clusters are small (clusters x dimensions),
are gathered once and sent to the tasks as a broadcast variable below ``MODEL_BYTES``. Beyond
that the clusters are taken in blocks, one pass over the points per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import squares, vector_sum
from ..session import written

MODEL_BYTES = 64 * 1024 * 1024
SUMS_SCHEMA = "cluster bigint, n bigint, sum array<double>, sumsq array<double>"


@dataclass(frozen=True)
class ClusterStats:
    """Per cluster: key, number of points, mean and mean square per dimension."""

    key: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    mean_square: np.ndarray

    def __len__(self) -> int:
        return len(self.key)

    @property
    def dimensions(self) -> int:
        return self.mean.shape[1] if self.mean.ndim == 2 else 0

    @property
    def deviation(self) -> np.ndarray:
        return np.sqrt(np.maximum(self.mean_square - self.mean**2, 0.0))

    @property
    def points(self) -> int:
        return int(self.n.sum())

    def take(self, rows: np.ndarray | slice) -> ClusterStats:
        return ClusterStats(self.key[rows], self.n[rows], self.mean[rows], self.mean_square[rows])

    def append(self, other: ClusterStats) -> ClusterStats:
        if not len(self):
            return other
        if not len(other):
            return self
        return ClusterStats(
            np.concatenate([self.key, other.key]),
            np.concatenate([self.n, other.n]),
            np.concatenate([self.mean, other.mean]),
            np.concatenate([self.mean_square, other.mean_square]),
        )

    def blocks(self) -> list[ClusterStats]:
        rows = max(1, MODEL_BYTES // max(1, 16 * self.dimensions))
        return [self.take(slice(i, i + rows)) for i in range(0, len(self), rows)]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = zip(
            self.key.tolist(), self.n.tolist(), self.mean.tolist(), self.mean_square.tolist()
        )
        schema = "cluster bigint, n bigint, mean array<double>, mean_square array<double>"
        return spark.createDataFrame(list(rows), schema)


def no_clusters(dimensions: int = 0) -> ClusterStats:
    empty = np.zeros((0, dimensions))
    return ClusterStats(np.zeros(0, np.int64), np.zeros(0, np.int64), empty, empty)


def stats_from_arrow(rows: pa.Table) -> ClusterStats:
    """Statistics from gathered rows ``(cluster, n, mean, mean_square)``, in key order."""
    if not rows.num_rows:
        return no_clusters()
    rows = rows.sort_by("cluster").combine_chunks()
    vectors = [rows.column(name).combine_chunks() for name in ("mean", "mean_square")]
    dimensions = len(vectors[0][0])
    return ClusterStats(
        rows.column("cluster").to_numpy().astype(np.int64),
        rows.column("n").to_numpy().astype(np.int64),
        *[matrix(column, dimensions) for column in vectors],
    )


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """A list column as one row per point, without a copy per row.

    A null list, or one of another length, is a row without numbers: its distances are no numbers
    either, so it is assigned to no cluster, whatever else is in the batch.
    """
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), dimensions), False)
    if pc.all(fits, min_count=0).as_py():
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)
    rows = np.full((len(column), dimensions), np.nan)
    kept = column.filter(fits)
    numbers = kept.flatten().to_numpy(zero_copy_only=False)
    rows[fits.to_numpy(zero_copy_only=False)] = numbers.reshape(len(kept), dimensions)
    return rows


def distances(points: np.ndarray, centre: np.ndarray, deviation: np.ndarray | None) -> np.ndarray:
    """Distance of each point to one centre: Euclidean, or scaled by ``deviation``.

    Where the deviation is zero an equal coordinate counts 0 and any other infinity.
    """
    gap = points - centre
    if deviation is not None:
        flat = deviation == 0
        gap = np.where(
            flat, np.where(gap == 0, 0.0, np.inf), gap / np.where(flat, 1.0, deviation)
        )
    return np.sqrt((gap * gap).sum(axis=1))


# Distances that are bounded, or computed exactly, at a time.
TILE_NUMBERS = 2_000_000
# Close pairs are computed so many at a time, which stay in a core's cache.
CACHED_PAIRS = 2_000


def tile_rows(stats: ClusterStats) -> int:
    """Points that are compared with all of ``stats`` at a time."""
    return max(1, TILE_NUMBERS // max(len(stats), stats.dimensions))


def nearest_rows(
    points: np.ndarray, stats: ClusterStats, threshold: float | None, pick: str = "nearest"
) -> tuple[np.ndarray, np.ndarray]:
    """Row of the nearest cluster (-1 for none) and its distance; the first wins a tie.

    With a threshold distances are scaled, and only those strictly below it count; ``pick="first"``
    then takes the first such cluster instead of the nearest.

    Matrix products of a block of points with all clusters give every squared distance up to a rounding
    error that is bounded; only clusters that may be the answer within that bound are computed by
    :func:`distances`, so the result is that of computing all.
    """
    if pick not in ("first", "nearest") or (pick == "first" and threshold is None):
        raise ValueError("match must be 'first' or 'nearest', and 'first' needs a threshold")
    best = np.full(len(points), np.inf)
    row = np.full(len(points), -1, np.int64)
    if not len(stats) or not len(points):
        return row, best
    bounds = _Bounds(stats, threshold)
    tile = tile_rows(stats)
    for low in range(0, len(points), tile):
        part = points[low : low + tile]
        for at, cluster in bounds.candidates(part, pick):
            if not len(at):
                continue
            d = bounds.exact(part[at], cluster)
            fits = ~np.isnan(d) if threshold is None else d < threshold
            at, cluster, d = at[fits & (d < np.inf)], cluster[fits & (d < np.inf)], d[fits & (d < np.inf)]
            if not len(at):
                continue
            # Pairs come by point, then by cluster: the first, or the first of the least, is the answer.
            starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            if pick == "nearest":
                least = np.repeat(np.minimum.reduceat(d, starts), np.diff(np.append(starts, len(at))))
                kept = np.flatnonzero(d == least)
                at, cluster, d = at[kept], cluster[kept], d[kept]
                starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            row[low + at[starts]] = cluster[starts]
            best[low + at[starts]] = d[starts]
    return row, best


def close_rows(points: np.ndarray, stats: ClusterStats, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of all points and clusters whose scaled distance is below the threshold, and that distance.

    Found as by :func:`nearest_rows`; a batch has about ``TILE_NUMBERS`` coordinates at most.
    """
    if not len(stats) or not len(points):
        return
    bounds = _Bounds(stats, threshold)
    tile = tile_rows(stats)
    for low in range(0, len(points), tile):
        part = points[low : low + tile]
        for at, cluster in bounds.candidates(part, "all"):
            cuts = [slice(i, i + CACHED_PAIRS) for i in range(0, len(at), CACHED_PAIRS)]
            d = np.concatenate([bounds.exact(part[at[cut]], cluster[cut]) for cut in cuts]) if cuts else np.zeros(0)
            close = np.flatnonzero(d < threshold)
            if len(close):
                yield low + at[close], cluster[close], d[close]


class _Bounds:
    """Least and greatest squared distances of points to all clusters, up to rounding, by matrix products."""

    def __init__(self, stats: ClusterStats, threshold: float | None) -> None:
        self.mean, self.threshold = stats.mean, threshold
        self.spread = stats.deviation if threshold is not None else None
        if self.spread is None:
            self.flat = np.zeros(len(stats), bool)
            weight = np.ones_like(self.mean)
        else:
            # A flat dimension adds nothing or infinity, so without it the bound from below holds.
            self.flat = (self.spread == 0).any(axis=1)
            with np.errstate(divide="ignore", over="ignore"):
                weight = np.where(self.spread == 0, 0.0, 1.0 / self.spread**2)
        with np.errstate(over="ignore", invalid="ignore"):
            self.weight, self.weighted = weight.T, (self.mean * weight).T
            self.own = (self.mean**2 * weight).sum(axis=1)
        # Twice what sums of so many rounded products can be wrong by, relative to their terms.
        self.rounding = 8.0 * (stats.dimensions + 8) * np.finfo(np.float64).eps

    def candidates(self, points: np.ndarray, pick: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a point's and a cluster's row that have to be computed, by point and cluster.

        ``pick`` is "nearest" or "first", or "all" for every cluster within the threshold.
        """
        with np.errstate(over="ignore", invalid="ignore"):
            squares = (points**2) @ self.weight
            middle = squares - 2.0 * (points @ self.weighted) + self.own
            # 2 |x m| is at most x x + m m, so this bounds the size of all terms.
            error = self.rounding * (squares + self.own)
            lower, upper = middle - error, np.where(self.flat, np.inf, middle + error)
        # Rows with anything that is no number are computed against all clusters.
        odd = ~np.isfinite(middle).all(axis=1)
        if self.threshold is None:
            limit = upper.min(axis=1, initial=np.inf)
        else:
            limit = np.full(len(points), self.threshold**2 * (1 + 1e-12))
            if pick == "nearest":
                limit = np.minimum(limit, upper.min(axis=1, initial=np.inf))
        possible = lower <= limit[:, None]
        if pick == "first":
            sure = upper < self.threshold**2 * (1 - 1e-12)
            first = np.where(sure.any(axis=1), sure.argmax(axis=1), len(self.mean))
            possible &= np.arange(len(self.mean)) <= first[:, None]
        possible[odd] = True
        at, cluster = np.nonzero(possible)
        # Whole points at a time, about as many pairs as fit.
        most = max(1, TILE_NUMBERS // self.mean.shape[1])
        begin = 0
        while begin < len(at):
            end = min(begin + most, len(at))
            if end < len(at):
                end = int(np.searchsorted(at, at[end]))
                if end <= begin:
                    end = int(np.searchsorted(at, at[begin], "right"))
            yield at[begin:end], cluster[begin:end]
            begin = end

    def exact(self, points: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """Distance of each point to its own cluster."""
        with np.errstate(over="ignore", invalid="ignore"):
            return distances(points, self.mean[cluster], None if self.spread is None else self.spread[cluster])


NEAREST_TYPE = "struct<cluster: bigint, distance: double>"


def _assign_block(
    spark: SparkSession, stats: ClusterStats, threshold: float | None, pick: str
) -> Callable:
    shared = spark.sparkContext.broadcast(stats)

    @F.arrow_udf(NEAREST_TYPE)
    def nearest(vec: pa.Array) -> pa.Array:
        block = shared.value
        row, distance = nearest_rows(matrix(vec, block.dimensions), block, threshold, pick)
        missing = row < 0
        keys = pa.array(block.key[np.where(missing, 0, row)], pa.int64(), mask=missing)
        found = pa.array(distance, pa.float64(), mask=missing)
        return pa.StructArray.from_arrays([keys, found], ["cluster", "distance"])

    return nearest


def assign(
    points: DataFrame,
    stats: ClusterStats,
    threshold: float | None = None,
    vec: str = "vec",
    pick: str = "nearest",
) -> DataFrame:
    """Add ``cluster`` and ``distance`` of the nearest (or first) cluster, null if none qualifies.

    Without a threshold the distance is Euclidean; with one it is scaled by the deviation of
    the cluster and must lie strictly below the threshold. Rows are not shuffled.
    """
    if not len(stats):
        return points.withColumns(
            {"cluster": F.lit(None).cast("bigint"), "distance": F.lit(None).cast("double")}
        )
    spark = points.sparkSession
    blocks = stats.blocks()
    best = points.withColumn("_near", _assign_block(spark, blocks[0], threshold, pick)(F.col(vec)))
    for block in blocks[1:]:
        # One block of statistics at a time in the tasks; ties stay with the earlier block.
        tried = written(best, "assign").withColumn(
            "_other", _assign_block(spark, block, threshold, pick)(F.col(vec))
        )
        keep = F.col("_other.distance").isNull() | (
            F.col("_near.distance").isNotNull()
            if pick == "first"
            else F.col("_near.distance") <= F.col("_other.distance")
        )
        better = F.when(keep, F.col("_near")).otherwise(F.col("_other"))
        best = tried.withColumn("_near", better).drop("_other")
    return best.select(
        *points.columns,
        F.col("_near.cluster").alias("cluster"),
        F.col("_near.distance").alias("distance"),
    )


def combine_sums(parts: DataFrame) -> DataFrame:
    """Add up partial rows of ``SUMS_SCHEMA`` per cluster."""
    return parts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        vector_sum(F.col("sum")).alias("sum"),
        vector_sum(F.col("sumsq")).alias("sumsq"),
    )


class TaskSums:
    """Number, sum and sum of squares per cluster over the batches of one task."""

    def __init__(self, stats: ClusterStats):
        self.key = stats.key
        self.n = np.zeros(len(stats), np.int64)
        self.total = np.zeros_like(stats.mean)
        self.squares = np.zeros_like(stats.mean)

    def add(self, points: np.ndarray, row: np.ndarray) -> None:
        for i in np.unique(row[row >= 0]):
            members = points[row == i]
            self.n[i] += len(members)
            self.total[i] += members.sum(axis=0)
            self.squares[i] += (members * members).sum(axis=0)

    def arrays(self) -> list[pa.Array]:
        used = self.n > 0
        lists = pa.list_(pa.float64())
        return [
            pa.array(self.key[used], pa.int64()),
            pa.array(self.n[used], pa.int64()),
            pa.array(list(self.total[used]), lists),
            pa.array(list(self.squares[used]), lists),
        ]


def assigned_sums(
    points: DataFrame,
    stats: ClusterStats,
    threshold: float | None = None,
    vec: str = "vec",
    shared: Broadcast | None = None,
) -> DataFrame:
    """``(cluster, n, sum, sumsq)`` over the points assigned to each cluster.

    ``shared`` is a broadcast of ``stats`` that the caller destroys when the rows are there.

    Assignment and partial sums happen in one pass; a task hands one row per cluster to the
    shuffle, however many points it read and however uneven the clusters are.
    """
    if len(stats.blocks()) > 1:
        found = assign(points, stats, threshold, vec).filter(F.col("cluster").isNotNull())
        return found.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n"),
            vector_sum(F.col(vec)).alias("sum"),
            vector_sum(squares(F.col(vec))).alias("sumsq"),
        )
    if shared is None:
        shared = points.sparkSession.sparkContext.broadcast(stats)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = TaskSums(shared.value)
        for batch in batches:
            block = matrix(batch.column(0), shared.value.dimensions)
            sums.add(block, nearest_rows(block, shared.value, threshold)[0])
        yield pa.RecordBatch.from_arrays(sums.arrays(), ["cluster", "n", "sum", "sumsq"])

    return combine_sums(points.select(vec).mapInArrow(fold, SUMS_SCHEMA))
