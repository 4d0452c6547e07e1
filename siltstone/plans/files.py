"""Readers, writers and small operators over whole tables.

Each query writes a given table in the source's format below the shared folder, reads it back and
runs the operator on what it has read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import FM_A, FM_B, FM_P, binary_text, text_mod
from ..functions.text import in_year
from ..operators import clusters, exploration, partitions, sampling
from ..operators.bfr import placed_members
from ..session import new_folder
from ..sources import readers, writers
from ..streaming import distinct as stream_distinct
from ..streaming import sampling as stream_sampling
from . import clustering, membership, samples, streams, windows
from .exploration import QUERIES as exploration_queries
from .exploration import STOP_WORDS
from .registry import Query, rounded, table

YEAR = 1997
PARTITIONS = 7


def json_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as reviews in JSON lines, each followed by a line that is cut short; those of a year."""
    path = new_folder(spark, "reviews")
    orders = table(spark, folder, "orders")
    line = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("review_id"),
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("o_orderdate").cast("string").alias("date"),
            F.col("o_totalprice").alias("stars"),
            F.col("o_orderpriority").alias("text"),
        )
    )
    orders.select(F.explode(F.array(line, F.substring(line, 1, 40)))).write.text(path)
    reviews = readers.read_reviews(spark, path)
    return reviews.filter(in_year(F.col("date"), "string", YEAR)).select("review_id", "user_id", "stars", "text")


def json_bad_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Parts written as JSON, each followed by a broken line; both are counted."""
    path = new_folder(spark, "businesses")
    part = table(spark, folder, "part")
    line = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("business_id"), F.col("p_name").alias("city")))
    part.select(F.explode(F.array(line, F.substring(line, 1, 12)))).write.text(path)
    kept = readers.read_businesses(spark, path).agg(F.count(F.lit(1)).alias("n_rows"), F.count("city").alias("n_cities"))
    bad = readers.count_bad_json(spark, path).agg(F.sum("n_bad").alias("n_bad"))
    return kept.withColumn("n_bad", bad.scalar())


def _csv_points(spark: SparkSession, folder: str) -> str:
    """Embeddings as lines ``id,x1,...``, each followed by a line with one number too many."""
    path = new_folder(spark, "points")
    rows = table(spark, folder, "embeddings")
    numbers = F.concat_ws(",", F.transform("embedding", lambda x: x.cast("double").cast("string")))
    line = F.concat(F.col("vec_id").cast("string"), F.lit(","), numbers)
    rows.select(F.explode(F.array(line, F.concat(line, F.lit(",1.0"))))).write.text(path)
    return path


def csv_points(spark: SparkSession, folder: str) -> DataFrame:
    """Points of the right length: number and sum of their coordinates."""
    points = readers.read_points(spark, _csv_points(spark, folder), clustering.DIMENSIONS)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return points.select("id", F.size("vec").alias("n"), rounded(total).alias("total"))


def csv_bad_points(spark: SparkSession, folder: str) -> DataFrame:
    bad = readers.count_bad_points(spark, _csv_points(spark, folder), clustering.DIMENSIONS)
    return bad.agg(F.sum("n_bad").alias("n_bad"))


def unique_points(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings in their label's chunk, with earlier ones of the same id in the chunk before; the given ones stay."""
    given = clustering.points(spark, folder).select("id", "vec", F.col("label").alias("chunk"))
    earlier = given.select("id", F.transform("vec", lambda x: -x).alias("vec"), (F.col("chunk") - 1).alias("chunk"))
    kept = readers.unique_points(given.unionByName(earlier))
    return kept.select("id", "chunk", rounded(F.element_at("vec", 1)).alias("first"))


def stop_word_file(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the documents without the words of a file, which has blank lines and spaces."""
    path = new_folder(spark, "stop-words")
    words = spark.createDataFrame([(f" {word}\t",) for word in STOP_WORDS] + [("",)], "word string")
    words.coalesce(1).write.text(path)
    return exploration.word_counts(table(spark, folder, "documents"), "text", readers.read_stop_words(spark, path))


def written_rounds(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "rounds")
    rounds = clustering.bfr_rounds(spark, folder)
    writers.write_rounds(rounds, path)
    return spark.read.schema(rounds.schema).csv(path, header=True)


def written_labels(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "labels")
    writers.write_labels(clustering.bfr_labels(spark, folder), path)
    return spark.read.schema("id string, cluster int").json(path)


def written_predictions(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "predictions")
    writers.write_predictions(membership.bloom_probe(spark, folder), path)
    return spark.read.schema("c_custkey bigint, prediction int").csv(path, sep=" ")


def stream_window_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The CSV rows that the stream has written, the last of each window."""
    state = new_folder(spark, "stream-window-csv")
    writer = stream_distinct.stream_windows(
        streams.source(spark, folder, "events"), "ts", "user_id", windows.LENGTH, windows.SLIDE,
        state, f"{state}/checkpoint", csv=f"{state}/csv",
    )
    streams.finish(writer)
    return stream_distinct.read_csv(spark, f"{state}/csv")


def stream_report(spark: SparkSession, folder: str) -> DataFrame:
    """Last report of the streaming sample: tagged records so far, popular tags."""
    events = sampling.tagged(samples.with_tags(streams.source(spark, folder, "events")), "tags")
    state = new_folder(spark, "stream-report")
    streams.finish(stream_sampling.stream_reservoir(events, "event_id", "tags", state, samples.SIZE, samples.SEED))
    report = stream_sampling.read_report(spark, state)
    last = report.agg(F.max("batch")).first()[0]
    return report.filter(F.col("batch") == last).select("seen", "tag", "count")


def tag_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Tags of the events, read as the texts of nested tag records of JSON lines."""
    path = new_folder(spark, "tweets")
    events = samples.with_tags(table(spark, folder, "events"))
    nested = F.struct(F.transform("tags", lambda tag: F.struct(tag.alias("text"))).alias("hashtags"))
    events.select(F.col("event_id").alias("id"), nested.alias("entities")).write.json(path)
    tweets = readers.read_json(spark, path, "id bigint, entities struct<hashtags: array<struct<text: string>>>")
    texts = tweets.select("id", sampling.tag_texts(F.col("entities.hashtags")).alias("tags"))
    return texts.select("id", F.concat_ws(",", "tags").alias("tags"))


def point_count(spark: SparkSession, folder: str) -> DataFrame:
    summary = clusters.cluster_moments(clustering.points(spark, folder), "label")
    return clusters.point_count(summary).select("n_points", "n_clusters")


def members_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Place of each point among the members of its cluster, sorted by id."""
    return placed_members(clustering.bfr_labels(spark, folder))


def census_unmoved(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all partitions as they are, and of partitions that nothing was moved to."""
    events = table(spark, folder, "events")
    same = partitions.repartition_by_key(events, "event_type", PARTITIONS, None)
    counted = partitions.physical_census(same)
    return counted.agg(
        F.sum("n_items").alias("n_items"), (F.count(F.lit(1)) == partitions.partition_count(events)).alias("all_counted")
    )


def census_document(spark: SparkSession, folder: str) -> DataFrame:
    census = partitions.partition_census(table(spark, folder, "events"), "event_type", PARTITIONS, "ascii")
    return partitions.census_document(census)


def hash_digits(spark: SparkSession, folder: str) -> DataFrame:
    """Binary digits of the first hash of every user."""
    users = membership.users(spark, folder).distinct().withColumn("x", text_mod("user", FM_P))
    return users.select("user", binary_text(F.expr(f"(x * {FM_A[0]}L + {FM_B[0]}L) % {FM_P}L")).alias("digits"))


_UNIQUE_SQL = "SELECT vec_id AS id, label AS chunk, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM embeddings"
_POINTS_SQL = """
  SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS n,
         round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total
  FROM embeddings
"""

QUERIES = {
    "json_reviews": Query(
        json_reviews,
        """
        SELECT CAST(o_orderkey AS VARCHAR) AS review_id, CAST(o_custkey AS VARCHAR) AS user_id,
               o_totalprice AS stars, o_orderpriority AS text
        FROM orders WHERE year(o_orderdate) = 1997
        """,
    ),
    "json_bad_lines": Query(
        json_bad_lines,
        "SELECT count(*) AS n_rows, count(p_name) AS n_cities, count(*) AS n_bad FROM part",
    ),
    "csv_points": Query(csv_points, _POINTS_SQL),
    "csv_bad_points": Query(csv_bad_points, "SELECT count(*) AS n_bad FROM embeddings"),
    "unique_points": Query(unique_points, _UNIQUE_SQL),
    "stop_word_file": Query(stop_word_file, exploration_queries["word_counts"].sql),
    "written_rounds": Query(written_rounds, clustering.QUERIES["bfr_rounds"].sql),
    "written_labels": Query(
        written_labels, f"SELECT CAST(id AS VARCHAR) AS id, cluster FROM ({clustering.QUERIES['bfr_labels'].sql})"
    ),
    "written_predictions": Query(written_predictions, membership.QUERIES["bloom_probe"].sql),
    "stream_window_csv": Query(stream_window_csv, windows.QUERIES["fm_window_kmeans"].sql),
    "stream_report": Query(
        stream_report,
        f"""
        SELECT (SELECT count(*) FROM events) AS seen, tag, count
        FROM ({samples.QUERIES["popular_tags"].sql})
        """,
    ),
    "tag_texts": Query(
        tag_texts,
        "SELECT event_id AS id, concat_ws(',', event_type, json_extract_string(props, '$.k')) AS tags FROM events",
    ),
    "point_count": Query(
        point_count, "SELECT count(*) AS n_points, count(DISTINCT label) AS n_clusters FROM embeddings"
    ),
    "members_in_order": Query(
        members_in_order,
        f"""
        SELECT id, cluster, row_number() OVER (PARTITION BY cluster ORDER BY id) - 1 AS place
        FROM ({clustering.QUERIES["bfr_labels"].sql})
        """,
    ),
    "census_unmoved": Query(census_unmoved, "SELECT count(*) AS n_items, true AS all_counted FROM events"),
    "census_document": Query(
        census_document,
        """
        SELECT CAST(to_json({'n_partitions': 7, 'n_items': list(n_items ORDER BY p)}) AS VARCHAR) AS document
        FROM (SELECT n.range AS p, count(e.event_type) AS n_items
              FROM range(7) n LEFT JOIN events e ON ascii(event_type) % 7 = n.range GROUP BY 1)
        """,
    ),
    "hash_digits": Query(
        hash_digits,
        f"""
        SELECT u AS user, CASE WHEN length(b) < 20 THEN lpad(b, 20, '0') ELSE b END AS digits
        FROM (SELECT u, bin(({membership.mod_sql('u', 233333333)} * 92293349 + 110622591) % 233333333) AS b
              FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS u FROM events))
        """,
    ),
}
