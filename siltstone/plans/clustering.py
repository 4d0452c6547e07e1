"""Moments, k-means, assignments, cluster matches and BFR rounds on the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clusters as ops
from ..operators import matching
from ..operators.bfr import BfrResult, bfr
from ..operators.kmeans import kmeans, kmeans_step, start_stats
from ..operators.nearest import assign
from ..session import new_folder
from ..streaming.bfr import ChunkedBfr, stream_points
from .bfr_sql import bfr_tables, statement
from .registry import Query, rounded, table

K = 10
SEED = 666
FIT_ROUNDS = 3
DIMENSIONS = 64
ASSIGN_ALPHA = 1.0
PAIR_ALPHA = 0.2
DISCARD_LABELS = 5
BFR_K = 5
BFR_ALPHA = 1.2
BFR_CHUNKS = 3


def points(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label"
    )


def _by_position(summary: DataFrame, *columns: str) -> DataFrame:
    """One row per cluster and dimension."""
    zipped = summary.select("cluster", "n", F.posexplode(F.arrays_zip(*columns)))
    values = [rounded(F.col(f"col.{c}")).alias(c) for c in columns]
    return zipped.select("cluster", "n", "pos", *values)


def cluster_moments(spark: SparkSession, folder: str) -> DataFrame:
    summary = ops.cluster_moments(points(spark, folder), "label")
    return _by_position(summary, "mean", "mean_square", "deviation")


def kmeans_one_step(spark: SparkSession, folder: str) -> DataFrame:
    vectors = points(spark, folder).select("id", "vec")
    moved = kmeans_step(vectors, start_stats(vectors, K, SEED))
    return _by_position(moved.frame(spark), "mean")


def kmeans_fit(spark: SparkSession, folder: str) -> DataFrame:
    found = kmeans(points(spark, folder), K, FIT_ROUNDS, SEED, tol=0.0)
    return _by_position(found.stats.frame(spark), "mean", "mean_square")


def kmeans_members(spark: SparkSession, folder: str) -> DataFrame:
    vectors = points(spark, folder).select("id", "vec")
    found = kmeans(vectors, K, FIT_ROUNDS, SEED, tol=0.0)
    return found.assign(vectors).select("id", "cluster", rounded("distance").alias("distance"))


def mahalanobis_assign(spark: SparkSession, folder: str) -> DataFrame:
    vectors = points(spark, folder)
    stats = ops.gather(ops.cluster_moments(vectors, "label"))
    placed = assign(vectors.select("id", "vec"), stats, ASSIGN_ALPHA * DIMENSIONS**0.5)
    return placed.select("id", "cluster", rounded("distance").alias("distance"))


def cs_merge_candidates(spark: SparkSession, folder: str) -> DataFrame:
    summary = ops.cluster_moments(points(spark, folder), "label")
    pairs = ops.merge_candidates(summary, PAIR_ALPHA * DIMENSIONS**0.5)
    return pairs.withColumn("distance", rounded("distance"))


def _cs_to_ds(spark: SparkSession, folder: str, match: str) -> DataFrame:
    summary = ops.cluster_moments(points(spark, folder), "label")
    discard = F.col("cluster") < DISCARD_LABELS
    found = ops.match_clusters(
        summary.filter(~discard), summary.filter(discard), PAIR_ALPHA * DIMENSIONS**0.5, match
    )
    return found.withColumn("distance", rounded("distance"))


def cs_to_ds_first_match(spark: SparkSession, folder: str) -> DataFrame:
    return _cs_to_ds(spark, folder, "first")


def cs_to_ds_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return _cs_to_ds(spark, folder, "nearest")


def _bfr(spark: SparkSession, folder: str) -> BfrResult:
    """Chunks are the partitions of a written table, so a pass reads its own files only."""
    vectors = points(spark, folder)
    rows = vectors.agg(F.max("id") + 1).first()[0]
    chunk = F.floor(F.col("id") * BFR_CHUNKS / rows).cast("int")
    path = new_folder(spark, "bfr-chunks")
    vectors.select("id", "vec", chunk.alias("chunk")).write.partitionBy("chunk").parquet(path)
    chunked = spark.read.schema("id bigint, vec array<double>, chunk int").parquet(path)
    return bfr(chunked, BFR_K, BFR_ALPHA, SEED, chunks=range(BFR_CHUNKS))


def bfr_rounds(spark: SparkSession, folder: str) -> DataFrame:
    return _bfr(spark, folder).rounds


def bfr_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _bfr(spark, folder).labels


# Vectors that follow each other by id form a cluster; close ones are matched one to one.
BLOCK = 10
GREEDY_THRESHOLD = 3.5


def greedy_pairs(spark: SparkSession, folder: str) -> DataFrame:
    blocks = points(spark, folder).withColumn("block", F.floor(F.col("id") / BLOCK))
    summary = ops.cluster_moments(blocks, "block")
    return matching.greedy_pairs(ops.merge_candidates(summary, GREEDY_THRESHOLD), LAST_EDGES)


# Edges that are finished without a round, low enough that the query has rounds.
LAST_EDGES = 100


def _bfr_stream(spark: SparkSession, folder: str) -> BfrResult:
    """Chunks as folders of CSV files, delivered one after the other; the stream is stopped between them."""
    vectors = points(spark, folder)
    rows = vectors.agg(F.max("id") + 1).first()[0]
    numbers = F.concat_ws(",", F.transform("vec", lambda x: x.cast("string")))
    lines = vectors.select(
        F.floor(F.col("id") * BFR_CHUNKS / rows).alias("chunk"), F.concat(F.col("id").cast("string"), F.lit(","), numbers).alias("value")
    )
    path = new_folder(spark, "bfr-stream")
    found = ChunkedBfr(f"{path}/state", BFR_K, BFR_ALPHA, SEED)
    for chunk in range(BFR_CHUNKS):
        lines.where(F.col("chunk") == chunk).select("value").write.text(f"{path}/in/{chunk:03d}")
        stream = stream_points(spark, f"{path}/in/*", DIMENSIONS, by_folder=True)
        query = found.writer(stream, f"{path}/checkpoint", interval=None).start()
        query.awaitTermination()
    return found.result(spark)


def bfr_stream_rounds(spark: SparkSession, folder: str) -> DataFrame:
    return _bfr_stream(spark, folder).rounds


def bfr_stream_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _bfr_stream(spark, folder).labels


_POINTS = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings"
_LONG = f"""
  SELECT id, label, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM ({_POINTS})
"""
_MOMENTS = f"""
  SELECT CAST(label AS BIGINT) AS cluster, pos, count(*) AS n, avg(x) AS mean,
         avg(x * x) AS mean_square,
         sqrt(greatest(avg(x * x) - avg(x) * avg(x), 0)) AS deviation
  FROM ({_LONG}) GROUP BY 1, 2
"""


def _kmeans_sql(rounds: int) -> str:
    """Common tables ``s0`` (start), then ``a<i>`` (assignment) and ``s<i>`` (centroids)."""
    parts = [
        f"points AS MATERIALIZED ({_POINTS})",
        f"""s0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY md5('{SEED}:' || id), id) - 1 AS cluster, vec AS mean
          FROM points ORDER BY md5('{SEED}:' || id), id LIMIT {K})""",
    ]
    for i in range(1, rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
          SELECT id, vec, arg_min(cluster, list_distance(vec, mean)) AS cluster,
                 min(list_distance(vec, mean)) AS distance
          FROM points, s{i - 1} GROUP BY id, vec)""")
        parts.append(f"""l{i} AS MATERIALIZED (
          SELECT cluster, pos, count(*) AS n, avg(x) AS m, avg(x * x) AS q
          FROM (SELECT cluster, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM a{i})
          GROUP BY cluster, pos)""")
        parts.append(f"""s{i} AS MATERIALIZED (
          SELECT s.cluster, coalesce(m.n, 0) AS n, coalesce(m.mean, s.mean) AS mean,
                 coalesce(m.mean_square, list_transform(s.mean, lambda v: v * v)) AS mean_square
          FROM s{i - 1} s LEFT JOIN (
            SELECT cluster, any_value(n) AS n, list(m ORDER BY pos) AS mean,
                   list(q ORDER BY pos) AS mean_square
            FROM l{i} GROUP BY cluster) m USING (cluster))""")
    return "WITH " + ", ".join(parts)


_BLOCK_MOMENTS = f"""
  SELECT CAST(id // {BLOCK} AS BIGINT) AS cluster, pos, avg(x) AS mean,
         sqrt(greatest(avg(x * x) - avg(x) * avg(x), 0)) AS deviation
  FROM ({_LONG}) GROUP BY 1, 2
"""
# One edge after the other, with the clusters that are taken so far.
_GREEDY = f"""
  WITH RECURSIVE s AS MATERIALIZED ({_BLOCK_MOMENTS}), near AS (
    SELECT s.cluster AS a, p.cluster AS b, sqrt(sum(CASE
             WHEN s.deviation = 0 THEN CASE WHEN p.mean = s.mean THEN 0 ELSE 'Infinity'::DOUBLE END
             ELSE pow((p.mean - s.mean) / s.deviation, 2) END)) AS distance
    FROM s JOIN s p ON s.pos = p.pos AND s.cluster < p.cluster GROUP BY 1, 2
  ), edges AS MATERIALIZED (
    SELECT a, b, row_number() OVER (ORDER BY a, b) AS i FROM near WHERE distance < {GREEDY_THRESHOLD}
  ), walk(i, taken, a, b) AS (
    SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT
    UNION ALL
    SELECT e.i,
           CASE WHEN list_has_any(w.taken, [e.a, e.b]) THEN w.taken ELSE list_concat(w.taken, [e.a, e.b]) END,
           CASE WHEN NOT list_has_any(w.taken, [e.a, e.b]) THEN e.a END,
           CASE WHEN NOT list_has_any(w.taken, [e.a, e.b]) THEN e.b END
    FROM walk w JOIN edges e ON e.i = w.i + 1
  )
  SELECT a AS first, b AS second FROM walk WHERE a IS NOT NULL
"""

_SCALED = """
  CASE WHEN s.deviation = 0
       THEN CASE WHEN p.x = s.mean THEN 0 ELSE 'Infinity'::DOUBLE END
       ELSE pow((p.x - s.mean) / s.deviation, 2) END
"""
_PAIRS = f"""
  WITH s AS MATERIALIZED ({_MOMENTS})
  SELECT s.cluster AS a, p.cluster AS b,
         sqrt(sum({_SCALED.replace('p.x', 'p.mean')})) AS distance
  FROM s JOIN s p ON s.pos = p.pos AND s.cluster <> p.cluster GROUP BY 1, 2
"""
_PAIR_LIMIT = PAIR_ALPHA * DIMENSIONS**0.5


def _cs_to_ds_sql(order: str) -> str:
    return f"""
      SELECT cluster, target, round(distance, 6) AS distance FROM (
        SELECT b AS cluster, a AS target, distance,
               row_number() OVER (PARTITION BY b ORDER BY {order}) AS place
        FROM ({_PAIRS})
        WHERE b >= {DISCARD_LABELS} AND a < {DISCARD_LABELS} AND distance < {_PAIR_LIMIT}
      ) WHERE place = 1
    """


_BFR = bfr_tables(
    "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings",
    BFR_K, BFR_ALPHA, DIMENSIONS, BFR_CHUNKS, SEED,
)

QUERIES = {
    "cluster_moments": Query(
        cluster_moments,
        f"""
        SELECT CAST(cluster AS INTEGER) AS cluster, n, CAST(pos AS INTEGER) AS pos,
               round(mean, 6) AS mean, round(mean_square, 6) AS mean_square,
               round(deviation, 6) AS deviation
        FROM ({_MOMENTS})
        """,
    ),
    "kmeans_step": Query(
        kmeans_one_step,
        f"""
        {_kmeans_sql(1)}
        SELECT cluster, n, CAST(pos AS INTEGER) AS pos, round(m, 6) AS mean
        FROM (SELECT cluster, n, unnest(mean) AS m, unnest(range(len(mean))) AS pos FROM s1)
        """,
    ),
    "kmeans_fit": Query(
        kmeans_fit,
        f"""
        {_kmeans_sql(FIT_ROUNDS)}
        SELECT cluster, n, CAST(pos AS INTEGER) AS pos, round(m, 6) AS mean,
               round(q, 6) AS mean_square
        FROM (SELECT cluster, n, unnest(mean) AS m, unnest(mean_square) AS q,
                     unnest(range(len(mean))) AS pos FROM s{FIT_ROUNDS})
        """,
    ),
    "kmeans_members": Query(
        kmeans_members,
        f"""
        {_kmeans_sql(FIT_ROUNDS)}
        SELECT id, cluster, round(distance, 6) AS distance FROM a{FIT_ROUNDS}
        """,
    ),
    "mahalanobis_assign": Query(
        mahalanobis_assign,
        f"""
        WITH s AS MATERIALIZED ({_MOMENTS}), near AS (
          SELECT p.id, s.cluster, sqrt(sum({_SCALED})) AS distance
          FROM ({_LONG}) p JOIN s USING (pos) GROUP BY 1, 2
        ), best AS (
          SELECT id, arg_min(cluster, distance) AS cluster, min(distance) AS distance
          FROM near WHERE distance < {ASSIGN_ALPHA * DIMENSIONS**0.5} GROUP BY id
        )
        SELECT p.id, best.cluster, round(best.distance, 6) AS distance
        FROM ({_POINTS}) p LEFT JOIN best USING (id)
        """,
    ),
    "cs_merge_candidates": Query(
        cs_merge_candidates,
        f"""
        SELECT a AS first, b AS second, round(distance, 6) AS distance FROM ({_PAIRS})
        WHERE a < b AND distance < {_PAIR_LIMIT}
        """,
    ),
    "cs_to_ds_first_match": Query(cs_to_ds_first_match, _cs_to_ds_sql("a")),
    "cs_to_ds_nearest": Query(cs_to_ds_nearest, _cs_to_ds_sql("distance, a")),
    "bfr_rounds": Query(bfr_rounds, statement(_BFR, "rounds")),
    "bfr_labels": Query(bfr_labels, statement(_BFR, "labels")),
    "bfr_stream_rounds": Query(bfr_stream_rounds, statement(_BFR, "rounds")),
    "bfr_stream_labels": Query(bfr_stream_labels, statement(_BFR, "labels")),
    "greedy_pairs": Query(greedy_pairs, _GREEDY),
}
