"""Bounded k-means over a distributed set of points."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .nearest import ClusterStats, assign, assigned_sums, no_clusters
from .sampling import in_draw_order


@dataclass(frozen=True)
class KMeansResult:
    """``stats`` of the members found in the last round, ``start`` the centroids they were
    assigned to, ``rounds`` the number of rounds."""

    stats: ClusterStats
    start: ClusterStats
    rounds: int

    def assign(self, points: DataFrame) -> DataFrame:
        """Members of the last round: ``points`` with ``cluster`` and ``distance``."""
        return assign(points, self.start)


def start_points(points: DataFrame, k: int, seed: int = 666) -> DataFrame:
    """``k`` points drawn by seed, or all of them if there are fewer; those without an id like the others."""
    return points.orderBy(*in_draw_order(points, "id", seed, ["id", "vec"])).limit(k)


def start_stats(
    points: DataFrame, k: int, seed: int = 666, start_ids: Sequence[int] | None = None
) -> ClusterStats:
    """Start centroids, numbered from 0 in draw order (or in the order of ``start_ids``)."""
    if start_ids is None:
        drawn = start_points(points, k, seed).select("id", "vec").collect()
    else:
        drawn = points.filter(F.col("id").isin(list(start_ids))).select("id", "vec").collect()
        drawn.sort(key=lambda row: list(start_ids).index(row["id"]))
    if not drawn:
        return no_clusters()
    mean = np.array([row["vec"] for row in drawn], np.float64)
    count = len(drawn)
    return ClusterStats(np.arange(count), np.zeros(count, np.int64), mean, mean**2)


def kmeans_step(
    points: DataFrame, current: ClusterStats, include_previous: bool = False
) -> ClusterStats:
    """One round: assign, then move each centroid to the mean of its members.

    ``include_previous`` counts the old centroid as one more member of the mean. A cluster
    without members keeps its centroid.
    """
    mean, mean_square = current.mean.copy(), current.mean**2
    n = np.zeros(len(current), np.int64)
    row_of = {int(key): row for row, key in enumerate(current.key)}
    extra = 1 if include_previous else 0
    shared = points.sparkSession.sparkContext.broadcast(current)
    try:
        moved = assigned_sums(points, current, shared=shared).collect()
    finally:
        shared.destroy()
    for sums in moved:
        row = row_of[sums["cluster"]]
        n[row] = sums["n"]
        weight = sums["n"] + extra
        mean[row] = (np.array(sums["sum"]) + extra * current.mean[row]) / weight
        mean_square[row] = (np.array(sums["sumsq"]) + extra * current.mean[row] ** 2) / weight
    return ClusterStats(current.key, n, mean, mean_square)


def kmeans(
    points: DataFrame,
    k: int,
    max_iter: int,
    seed: int = 666,
    tol: float = 1e-4,
    include_previous: bool = False,
    start_ids: Sequence[int] | None = None,
    persist: bool = True,
) -> KMeansResult:
    """At most ``max_iter`` rounds over ``points (id, vec)``; stops when no coordinate of a
    centroid moves by ``tol``.

    Only the centroids travel between rounds, so the lineage of ``points`` never grows. Pass
    ``persist=False`` when the points are read from a written table anyway.
    """
    held = points.select("id", "vec")
    if persist:
        held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        current = start_stats(held, k, seed, start_ids)
        before, rounds = current, 0
        while len(current) and rounds < max_iter:
            before, current = current, kmeans_step(held, current, include_previous)
            rounds += 1
            if np.abs(current.mean - before.mean).max() < tol:
                break
    finally:
        if persist:
            held.unpersist()
    return KMeansResult(current, before, rounds)
