"""Cluster summaries as tables, and matches between clusters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import moments
from .matching import greedy_pairs
from .nearest import ClusterStats, assign, close_rows, distances, matrix, nearest_rows, stats_from_arrow

PAIRS = "first bigint, second bigint, distance double"
# Most clusters whose statistics are gathered.
MAX_CLUSTERS = 1_000_000
# More clusters than this are compared with each other on the executors.
DRIVER_CLUSTERS = 2_000
# Earlier clusters that a task compares with later ones at a time, and comparisons of a task.
EARLIER_CLUSTERS = 2_000
TASK_PAIRS = 10_000_000


def cluster_moments(points: DataFrame, cluster: str, vec: str = "vec") -> DataFrame:
    """``(cluster, n, mean, mean_square, deviation)`` with a map-side combine."""
    return moments(points, cluster, vec).withColumnRenamed(cluster, "cluster")


def gather(summary: DataFrame, most: int = MAX_CLUSTERS) -> ClusterStats:
    """Statistics of a summary table, one row per cluster, of which there are at most ``most``."""
    rows = summary.select("cluster", "n", "mean", "mean_square").limit(most + 1).toArrow()
    if rows.num_rows > most:
        raise ValueError(f"more than {most} clusters")
    return stats_from_arrow(rows)


def point_count(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("n").alias("n_points"), F.count(F.lit(1)).alias("n_clusters"))


def _means(summary: DataFrame) -> DataFrame:
    return summary.select(F.col("cluster").cast("bigint").alias("cluster"), "mean")


def merge_candidates(summary: DataFrame, threshold: float) -> DataFrame:
    """Pairs of clusters ``(first, second, distance)`` closer than the threshold.

    The distance is scaled by the deviation of the first. Only pairs that match become rows, and each
    cluster is compared with the earlier ones only, block by block of their statistics. The comparisons
    are dealt over tasks by the later cluster; those that rounding bounds rule out are not computed.
    """
    means = _means(summary)
    stats = gather(summary)
    if not len(stats):
        return means.sparkSession.createDataFrame([], PAIRS)
    tasks = len(stats) ** 2 // (2 * TASK_PAIRS)
    if tasks > 1:
        means = means.repartition(tasks, "cluster")
    found = [means.mapInArrow(_earlier(means, block, threshold), PAIRS) for block in stats.blocks()]
    return reduce(DataFrame.unionByName, found)


def _earlier(means: DataFrame, stats: ClusterStats, threshold: float):
    # A distance from or to what is no finite number is never below the threshold.
    stats = stats.take(np.isfinite(stats.mean).all(axis=1) & ~np.isnan(stats.deviation).any(axis=1))
    shared = means.sparkSession.sparkContext.broadcast(stats)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        parts = [block.take(slice(i, i + EARLIER_CLUSTERS)) for i in range(0, len(block), EARLIER_CLUSTERS)]
        for batch in batches:
            second = batch.column(0).to_numpy()
            points = matrix(batch.column(1), block.dimensions)
            finite = np.isfinite(points).all(axis=1)
            for part in parts:
                later = np.flatnonzero(finite & (second > part.key[0]))
                for at, i, distance in close_rows(points[later], part, threshold):
                    found = part.key[i], second[later[at]], distance
                    rises = found[0] < found[1]
                    if rises.any():
                        yield pa.RecordBatch.from_arrays([pa.array(each[rises]) for each in found], ["first", "second", "distance"])

    return pairs


def match_clusters(
    summary: DataFrame, target: DataFrame, threshold: float, match: str = "first"
) -> DataFrame:
    """``(cluster, target, distance)``: first or nearest target cluster within the threshold.

    The distance is scaled by the deviation of the target. One cluster a row leaves a task.
    """
    if match not in ("first", "nearest"):
        raise ValueError("match must be 'first' or 'nearest'")
    own = _means(summary).withColumnRenamed("cluster", "_own")
    found = assign(own, gather(target), threshold, "mean", match)
    return found.filter(F.col("cluster").isNotNull()).select(
        F.col("_own").alias("cluster"), F.col("cluster").alias("target"), "distance"
    )


def close_pairs(
    stats: ClusterStats, threshold: float, spark: SparkSession | None = None
) -> Iterator[tuple[int, int]]:
    """Greedy one-to-one pairs of rows of ``stats``, whose keys rise.

    In key order each free cluster takes the first later free one within the threshold, scaled
    by the deviation of the earlier. With a session, statistics beyond ``DRIVER_CLUSTERS`` are
    compared and matched on the executors, and only the accepted pairs come back.
    """
    if spark is not None and len(stats) > DRIVER_CLUSTERS:
        found = greedy_pairs(merge_candidates(stats.frame(spark), threshold)).orderBy("first").toArrow()
        rows = (np.searchsorted(stats.key, found.column(name).to_numpy()).tolist() for name in ("first", "second"))
        yield from zip(*rows)
        return
    free = np.ones(len(stats), bool)
    for i, j in _close(stats, threshold):
        if free[i] and free[j]:
            free[i] = free[j] = False
            yield i, j


def _close(stats: ClusterStats, threshold: float) -> Iterator[tuple[int, int]]:
    spread = stats.deviation
    for i in range(len(stats)):
        later = distances(stats.mean[i + 1 :], stats.mean[i], spread[i])
        for j in np.flatnonzero(later < threshold):
            yield i, i + 1 + int(j)


def first_targets(
    stats: ClusterStats, target: ClusterStats, threshold: float, match: str = "first", spark: SparkSession | None = None
) -> Iterator[tuple[int, int]]:
    """For each row of ``stats`` the first or nearest row of ``target`` within the threshold.

    With a session, statistics beyond ``DRIVER_CLUSTERS`` are compared on the executors, and only the
    matches come back.
    """
    if spark is not None and len(stats) > DRIVER_CLUSTERS:
        found = match_clusters(stats.frame(spark), target.frame(spark), threshold, match).orderBy("cluster").toArrow()
        own, other = ((each.key, found.column(name).to_numpy()) for each, name in ((stats, "cluster"), (target, "target")))
        yield from zip(np.searchsorted(*own).tolist(), np.searchsorted(*other).tolist())
        return
    rows = nearest_rows(stats.mean, target, threshold, match)[0]
    for i in np.flatnonzero(rows >= 0).tolist():
        yield i, int(rows[i])
