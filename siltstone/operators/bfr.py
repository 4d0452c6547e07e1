"""Bradley-Fayyad-Reina clustering of a large point set, chunk by chunk.

Three sets are kept: discard clusters (DS), compression clusters (CS) and retained points (RS).
Points and their cluster numbers stay in written tables. Between rounds the driver holds the
cluster statistics only. Every chunk is scanned once, against statistics frozen for the round.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import squares, vector_sum
from ..session import BROADCAST_MAX_ROWS, new_folder, remove
from .clusters import close_pairs, first_targets
from .kmeans import KMeansResult, kmeans
from .positions import with_place
from .nearest import (
    ClusterStats,
    TaskSums,
    assign,
    combine_sums,
    matrix,
    nearest_rows,
    no_clusters,
)



@dataclass(frozen=True)
class Limits:
    """Sample of the first chunk and rounds of the inner k-means runs.

    The sample are the points of the first chunk with an id below ``sample_points``, or in a chunk
    of no more points below ``sample_share`` of their number. ``cluster_factor`` times k clusters
    are looked for among the points that no cluster took.
    """

    # The defaults.
    sample_points: int = 10_000
    sample_share: float = 0.1
    discard_rounds: int = 5
    first_rest_rounds: int = 3
    retained_rounds: int = 5
    cluster_factor: int = 3


MEMBER, LEFT, SUMS = "member", "left", "sums"
TABLE_SCHEMA = (
    "kind string, id bigint, vec array<double>, "
    "cluster bigint, n bigint, sum array<double>, sumsq array<double>"
)
# The column names of the rounds.
ROUND_SCHEMA = (
    "round_id int, nof_cluster_discard int, nof_point_discard bigint, "
    "nof_cluster_compression int, nof_point_compression bigint, nof_point_retained bigint"
)


@dataclass
class BfrResult:
    """``labels (id, cluster)`` with -1 for no cluster, ``rounds``, and the cluster
    ``summaries (set, cluster, n, mean, mean_square)``."""

    labels: DataFrame
    rounds: DataFrame
    summaries: DataFrame
    folder: str

    def release(self) -> None:
        """Delete the written tables; ``labels`` can't be read afterwards."""
        remove(self.labels.sparkSession, self.folder)


@dataclass
class Sets:
    """What is known between two chunks: statistics of both kinds of clusters, and where the points are."""

    spark: SparkSession
    folder: str
    k: int
    seed: int
    limits: Limits
    discard: ClusterStats = field(default_factory=no_clusters)
    compression: ClusterStats = field(default_factory=no_clusters)
    retained: DataFrame | None = None
    n_retained: int = 0
    next_key: int = 0
    joined: dict[int, int] = field(default_factory=dict)
    tables: list[str] = field(default_factory=list)
    pools: int = 0
    records: list[tuple] = field(default_factory=list)

    def write(self, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.tables):06d}"
        rows.write.mode("overwrite").parquet(path)
        self.tables.append(path)
        return self.spark.read.schema(TABLE_SCHEMA).parquet(path)

    def pool(self, points: DataFrame) -> DataFrame:
        """Points that several passes read, written once."""
        path = f"{self.folder}/pool-{self.pools:06d}"
        self.pools += 1
        points.select("id", "vec").write.mode("overwrite").parquet(path)
        return self.spark.read.schema("id bigint, vec array<double>").parquet(path)

    def new_keys(self, count: int) -> np.ndarray:
        keys = np.arange(self.next_key, self.next_key + count)
        self.next_key += count
        return keys


def bfr(
    points: DataFrame,
    k: int,
    alpha: float = 3.0,
    seed: int = 666,
    match: str = "first",
    assign_first: bool = False,
    include_previous: bool = False,
    chunks: Sequence | None = None,
    limits: Limits = Limits(),
) -> BfrResult:
    """Cluster ``points (id, vec, chunk)`` with unique ids into ``k`` clusters.

    ``chunks`` lists the chunk values in order, for files ``point_files``; by default they are looked
    up by a scan, and sorted. Points whose vector is null or of another length than the first
    clusters' belong to no cluster. Without points all tables are empty. A point joins
    the nearest cluster closer than ``alpha * sqrt(dimensions)`` deviations. ``match`` chooses
    the first or the nearest discard cluster in the last merge. ``assign_first`` tries the rest
    of the first chunk against the discard set before it is clustered.
    """
    if match not in ("first", "nearest"):
        raise ValueError("match must be 'first' or 'nearest'")
    spark = points.sparkSession
    if chunks is None:
        chunks = [r.chunk for r in points.select("chunk").distinct().orderBy("chunk").collect()]
    sets = Sets(spark, new_folder(spark, "bfr"), k, seed, limits)
    for chunk in chunks:
        part = points.filter(F.col("chunk") == chunk).select("id", "vec")
        fold_chunk(sets, part, alpha, assign_first, include_previous)
    return finished(sets, alpha, match)


def fold_chunk(sets: Sets, part: DataFrame, alpha: float, assign_first: bool = False, include_previous: bool = False) -> None:
    """One round: take the points ``(id, vec)`` of a chunk into the sets."""
    number = len(sets.records)
    if number == 0:
        rest = _start(sets, part, include_previous)
        rounds = sets.limits.first_rest_rounds
    else:
        rest, rounds = part, sets.limits.retained_rounds
    if number > 0 or assign_first:
        rest = _absorb(sets, rest, alpha)
    _compress(sets, rest, rounds, include_previous)
    if number > 0:
        _merge_compression(sets, alpha)
    _record(sets, number + 1)


def finished(sets: Sets, alpha: float, match: str = "first") -> BfrResult:
    """The result after the last chunk: CS clusters close to a DS cluster join it, which the last round's record shows."""
    if sets.records:
        _merge_into_discard(sets, alpha, match)
        _record(sets, sets.records.pop()[0])
    return BfrResult(
        _labels(sets),
        sets.spark.createDataFrame(sets.records, ROUND_SCHEMA),
        _summaries(sets),
        sets.folder,
    )


def _threshold(stats: ClusterStats, alpha: float) -> float:
    return alpha * float(np.sqrt(stats.dimensions))


def _start(sets: Sets, chunk: DataFrame, include_previous: bool) -> DataFrame:
    """Discard clusters from the first points; returns the rest of the chunk."""
    total = chunk.count()
    limits = sets.limits
    first = limits.sample_points if total > limits.sample_points else int(total * limits.sample_share)
    sample = sets.pool(chunk.filter(F.col("id") < first))
    found = kmeans(
        sample,
        sets.k,
        limits.discard_rounds,
        sets.seed,
        include_previous=include_previous,
        persist=False,
    )
    sets.discard = found.stats
    sets.new_keys(len(found.stats))
    sets.write(_as_table(found.assign(sample).withColumn("kind", F.lit(MEMBER))))
    return chunk.filter(F.col("id") >= first)


def _as_table(rows: DataFrame) -> DataFrame:
    """Bring ``(kind, id, vec, cluster)`` into the table layout; members drop their vector."""
    keep = F.when(F.col("kind") == LEFT, F.col("vec"))
    return rows.select(
        "kind",
        "id",
        keep.alias("vec"),
        F.col("cluster").cast("bigint").alias("cluster"),
        *[
            F.lit(None).cast(kind).alias(name)
            for name, kind in (
                ("n", "bigint"), ("sum", "array<double>"), ("sumsq", "array<double>")
            )
        ],
    )


def _absorb(sets: Sets, chunk: DataFrame, alpha: float) -> DataFrame:
    """Assign the chunk to DS, else CS, update both; returns the points left over."""
    both = sets.discard.append(sets.compression)
    if not len(both):
        return chunk
    threshold = _threshold(both, alpha)
    if len(both.blocks()) == 1:
        shared = sets.spark.sparkContext.broadcast((sets.discard, sets.compression))
        table = sets.write(_routed(chunk, shared, threshold))
        shared.destroy()
        sums = combine_sums(table.filter(F.col("kind") == SUMS))
    else:
        found = assign(chunk, sets.discard, threshold).withColumnRenamed("cluster", "_discard")
        found = assign(found.drop("distance"), sets.compression, threshold)
        found = found.withColumn("cluster", F.coalesce("_discard", "cluster"))
        marked = found.withColumn(
            "kind", F.when(F.col("cluster").isNull(), F.lit(LEFT)).otherwise(F.lit(MEMBER))
        )
        sums = (
            found.filter(F.col("cluster").isNotNull())
            .groupBy("cluster")
            .agg(
                F.count(F.lit(1)).alias("n"),
                vector_sum(F.col("vec")).alias("sum"),
                vector_sum(squares(F.col("vec"))).alias("sumsq"),
            )
        )
        table = sets.write(_as_table(marked))
    updates = {row["cluster"]: row for row in sums.collect()}
    sets.discard = _updated(sets.discard, updates)
    sets.compression = _updated(sets.compression, updates)
    return table.filter(F.col("kind") == LEFT).select("id", "vec")


def _routed(chunk: DataFrame, shared: Broadcast, threshold: float) -> DataFrame:
    """One pass: member rows, left-over rows with their vector, and sums of each task."""
    vectors = pa.list_(pa.float64())
    columns = ["kind", "id", "vec", "cluster", "n", "sum", "sumsq"]

    def rows(kind: str, ids: pa.Array, vec: pa.Array, cluster: pa.Array) -> pa.RecordBatch:
        size = len(ids)
        blank = [pa.nulls(size, pa.int64()), pa.nulls(size, vectors), pa.nulls(size, vectors)]
        kinds = pa.array([kind] * size, pa.string())
        return pa.RecordBatch.from_arrays([kinds, ids, vec, cluster, *blank], columns)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ds, cs = shared.value
        both = ds.append(cs)
        sums = TaskSums(both)
        for batch in batches:
            ids, vec = batch.column(0), batch.column(1)
            block = matrix(vec, both.dimensions)
            row = nearest_rows(block, ds, threshold)[0]
            open_rows = np.flatnonzero(row < 0)
            in_cs = nearest_rows(block[open_rows], cs, threshold)[0]
            row[open_rows] = np.where(in_cs < 0, -1, in_cs + len(ds))
            sums.add(block, row)
            placed, open_rows = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
            yield rows(
                MEMBER,
                ids.take(pa.array(placed)),
                pa.nulls(len(placed), vectors),
                pa.array(both.key[row[placed]], pa.int64()),
            )
            left = pa.array(open_rows)
            yield rows(LEFT, ids.take(left), vec.take(left), pa.nulls(len(left), pa.int64()))
        key, n, total, total_squares = sums.arrays()
        size = len(key)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([SUMS] * size, pa.string()),
                pa.nulls(size, pa.int64()),
                pa.nulls(size, vectors),
                key, n, total, total_squares,
            ],
            columns,
        )

    return chunk.mapInArrow(route, TABLE_SCHEMA)


def _updated(stats: ClusterStats, updates: dict) -> ClusterStats:
    n, mean, mean_square = stats.n.copy(), stats.mean.copy(), stats.mean_square.copy()
    for i, key in enumerate(stats.key.tolist()):
        if key in updates:
            new = updates[key]
            total = n[i] + new["n"]
            mean[i] = (mean[i] * n[i] + np.array(new["sum"])) / total
            mean_square[i] = (mean_square[i] * n[i] + np.array(new["sumsq"])) / total
            n[i] = total
    return ClusterStats(stats.key, n, mean, mean_square)


def _compress(sets: Sets, rest: DataFrame, rounds: int, include_previous: bool) -> None:
    """Cluster the rest with RS: clusters of several points join CS, the others become RS."""
    pool = sets.pool(rest if sets.retained is None else rest.unionByName(sets.retained))
    found = kmeans(
        pool,
        sets.k * sets.limits.cluster_factor,
        rounds,
        sets.seed,
        include_previous=include_previous,
        persist=False,
    )
    several = found.stats.n > 1
    keys = np.full(len(found.stats), -1, np.int64)
    keys[several] = sets.new_keys(int(several.sum()))
    fresh = found.stats.take(several)
    sets.compression = sets.compression.append(
        ClusterStats(keys[several], fresh.n, fresh.mean, fresh.mean_square)
    )
    table = sets.write(_as_table(_renumbered(found, pool, keys)))
    sets.retained = table.filter(F.col("kind") == LEFT).select("id", "vec")
    sets.n_retained = int((found.stats.n == 1).sum())


def _renumbered(found: KMeansResult, pool: DataFrame, keys: np.ndarray) -> DataFrame:
    """Members of the k-means run under their cluster keys; single ones as left over."""
    renumbered = found.start
    numbered = ClusterStats(
        np.where(keys < 0, -1 - np.arange(len(keys)), keys),
        renumbered.n,
        renumbered.mean,
        renumbered.mean_square,
    )
    placed = assign(pool, numbered)
    alone = F.col("cluster") < 0
    return placed.select(
        F.when(alone, F.lit(LEFT)).otherwise(F.lit(MEMBER)).alias("kind"),
        "id",
        "vec",
        F.when(~alone, F.col("cluster")).alias("cluster"),
    )


def _combined(a: ClusterStats, i: int, b: ClusterStats, j: int) -> tuple:
    total = a.n[i] + b.n[j]
    mean = (a.mean[i] * a.n[i] + b.mean[j] * b.n[j]) / total
    mean_square = (a.mean_square[i] * a.n[i] + b.mean_square[j] * b.n[j]) / total
    return total, mean, mean_square


def _merge_compression(sets: Sets, alpha: float) -> None:
    """Merge close CS pairs, weighted by their points, under new keys."""
    cs = sets.compression
    if len(cs) < 2:
        return
    pairs = list(close_pairs(cs, _threshold(cs, alpha), sets.spark))
    if not pairs:
        return
    merged = [_combined(cs, i, cs, j) for i, j in pairs]
    keys = sets.new_keys(len(pairs))
    for (i, j), key in zip(pairs, keys.tolist()):
        sets.joined[int(cs.key[i])] = sets.joined[int(cs.key[j])] = key
    gone = np.zeros(len(cs), bool)
    gone[[row for pair in pairs for row in pair]] = True
    n, mean, mean_square = (np.array(part) for part in zip(*merged))
    sets.compression = cs.take(~gone).append(ClusterStats(keys, n, mean, mean_square))


def _merge_into_discard(sets: Sets, alpha: float, match: str) -> None:
    """After the last chunk: CS clusters close to a DS cluster join it."""
    ds, cs = sets.discard, sets.compression
    if not len(ds) or not len(cs):
        return
    pairs = list(first_targets(cs, ds, _threshold(ds, alpha), match, sets.spark))
    grown = ClusterStats(ds.key, ds.n.copy(), ds.mean.copy(), ds.mean_square.copy())
    gone = np.zeros(len(cs), bool)
    for i, j in pairs:
        grown.n[j], grown.mean[j], grown.mean_square[j] = _combined(grown, j, cs, i)
        sets.joined[int(cs.key[i])] = int(ds.key[j])
        gone[i] = True
    sets.discard, sets.compression = grown, cs.take(~gone)


def _record(sets: Sets, round_id: int) -> None:
    ds, cs = sets.discard, sets.compression
    sets.records.append((round_id, len(ds), ds.points, len(cs), cs.points, sets.n_retained))


def _labels(sets: Sets) -> DataFrame:
    """Discard cluster of each point, -1 for points of CS and RS."""

    def final(key: int) -> int:
        while key in sets.joined:
            key = sets.joined[key]
        return key

    n_discard = len(sets.discard)
    moved = [(key, final(key)) for key in sets.joined if final(key) < n_discard]
    moved_to = sets.spark.createDataFrame(moved, "cluster bigint, label bigint")
    if len(moved) <= BROADCAST_MAX_ROWS:
        moved_to = F.broadcast(moved_to)
    if not sets.tables:
        return sets.spark.createDataFrame([], "id bigint, cluster int")
    tables = sets.spark.read.schema(TABLE_SCHEMA).parquet(*sets.tables)
    members = tables.filter(F.col("kind") == MEMBER).select("id", "cluster")
    own = F.when(F.col("cluster") < n_discard, F.col("cluster")).otherwise(F.lit(-1))
    labelled = members.join(moved_to, "cluster", "left").select(
        "id", F.coalesce("label", own).cast("int").alias("cluster")
    )
    alone = sets.retained.select("id", F.lit(-1).alias("cluster"))
    return labelled.unionByName(alone)


def _summaries(sets: Sets) -> DataFrame:
    ds = sets.discard.frame(sets.spark).withColumn("set", F.lit("DS"))
    cs = sets.compression.frame(sets.spark).withColumn("set", F.lit("CS"))
    return ds.unionByName(cs).select("set", "cluster", "n", "mean", "mean_square")


def sorted_members(labels: DataFrame) -> DataFrame:
    """Members of each cluster in id order, as rows; ranges include the id, so a large cluster
    spreads over several tasks."""
    return labels.orderBy("cluster", "id")


def placed_members(labels: DataFrame) -> DataFrame:
    """Members with their ``place`` in the sorted list of their cluster, from 0, without an order of rows."""
    return with_place(labels, ["cluster"], [F.asc_nulls_first("id")])
