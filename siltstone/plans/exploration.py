"""Counts, top users, words, category averages, frequent keys, partition census."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import exploration as ops
from ..operators import heavy, partitions
from .registry import Query, rounded, table

YEAR = 1997
TOP_USERS = 10
TOP_WORDS = 50
TOP_CATEGORIES = 10
FREQUENT = 590
PARTITIONS = 7
STOP_WORDS = (
    "a", "an", "and", "as", "at", "by", "for", "from", "he", "in", "is", "it", "of", "on",
    "or", "that", "the", "to", "was", "with", "de", "der", "die", "el", "en", "et", "la",
    "le", "un", "une",
)


def review_summary(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return ops.review_summary(orders, "o_orderkey", "o_custkey", "o_orderdate", YEAR)


def top_users(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_users(table(spark, folder, "orders"), "o_custkey", TOP_USERS)


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("text")


def top_words(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_words(_texts(spark, folder), "text", STOP_WORDS, TOP_WORDS)


def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ops.word_counts(_texts(spark, folder), "text", STOP_WORDS)


def _scored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, str, str, str]:
    reviews = table(spark, folder, "lineitem").withColumnRenamed("l_partkey", "business_id")
    business = table(spark, folder, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.concat("p_brand", F.lit(", "), "p_type").alias("categories"),
    )
    return reviews, business, "business_id", "l_quantity", "categories"


def category_totals(spark: SparkSession, folder: str) -> DataFrame:
    totals = ops.category_totals(*_scored(spark, folder))
    return totals.withColumn("star_sum", rounded("star_sum"))


def category_avg(spark: SparkSession, folder: str) -> DataFrame:
    best = ops.category_avg(*_scored(spark, folder), TOP_CATEGORIES)
    return best.withColumn("avg", rounded("avg"))


def frequent_keys(spark: SparkSession, folder: str) -> DataFrame:
    return ops.frequent_keys(table(spark, folder, "lineitem"), "l_suppkey", FREQUENT)


def review_report(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return ops.review_report(
        orders, "o_orderkey", "o_custkey", "o_orderdate", YEAR, TOP_USERS, top_words(spark, folder)
    )


def partition_census_ascii(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return partitions.partition_census(events, "event_type", PARTITIONS, "ascii")


def partition_census_crc(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return partitions.partition_census(events, "event_type", PARTITIONS, "crc")


def partition_census_moved(spark: SparkSession, folder: str) -> DataFrame:
    """Rows are moved, each hot partition over four, and counted where they arrive."""
    events = table(spark, folder, "events").select("event_id", "event_type")
    moved = partitions.repartition_by_key(events, "event_type", PARTITIONS, "ascii", splits=4)
    arrived = moved.groupBy(
        F.floor(F.spark_partition_id() / 4).cast("int").alias("partition"), "event_type"
    ).agg(F.count(F.lit(1)).alias("n_items"))
    return arrived.groupBy("partition", "event_type").agg(F.sum("n_items").alias("n_items"))


_STOP = ", ".join(f"('{w}')" for w in STOP_WORDS)

_WORDS_SQL = f"""
  SELECT translate(token, '()[],.!?:;', '') AS word, count(*) AS count
  FROM (SELECT unnest(string_split(lower(text), ' ')) AS token FROM documents)
  WHERE token NOT IN (SELECT * FROM (VALUES {_STOP}))
    AND translate(token, '()[],.!?:;', '') <> ''
  GROUP BY 1
"""

_CATEGORY_SQL = """
  WITH scores AS (
    SELECT l_partkey AS business_id, sum(l_quantity) AS score, count(l_quantity) AS votes
    FROM lineitem GROUP BY 1
  ), listed AS (
    SELECT p_partkey AS business_id,
           trim(unnest(string_split(p_brand || ', ' || p_type, ','))) AS category
    FROM part
  )
  SELECT category, sum(score) AS star_sum, CAST(sum(votes) AS BIGINT) AS star_count
  FROM listed JOIN scores USING (business_id) GROUP BY category
"""

_USERS_SQL = f"""
  SELECT o_custkey, count(*) AS count FROM orders
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {TOP_USERS}
"""

_TOP_WORDS_SQL = f"{_WORDS_SQL} ORDER BY 2 DESC, 1 LIMIT {TOP_WORDS}"

# CRC-32 of the first letters that occur: c e p s v.
_CRC_SQL = """CASE substr(event_type, 1, 1)
  WHEN 'c' THEN 112844655 WHEN 'e' THEN 4024072794 WHEN 'p' THEN 2181537457
  WHEN 's' THEN 453955339 WHEN 'v' THEN 1801730948 END"""


def _census_sql(code: str) -> str:
    return f"""
      SELECT CAST(n.range AS INTEGER) AS partition, count(e.event_type) AS n_items
      FROM range({PARTITIONS}) n
      LEFT JOIN events e ON ({code}) % {PARTITIONS} = n.range
      GROUP BY 1
    """


def review_summary_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return ops.review_summary_bitmaps(orders, "o_orderkey", "o_custkey", "o_orderdate", YEAR)


def heavy_words(spark: SparkSession, folder: str) -> DataFrame:
    return heavy.heavy_words(_texts(spark, folder), "text", STOP_WORDS, TOP_WORDS).rows


def heavy_users(spark: SparkSession, folder: str) -> DataFrame:
    return heavy.heavy_top(table(spark, folder, "orders"), "o_custkey", TOP_USERS).rows


def heavy_keys(spark: SparkSession, folder: str) -> DataFrame:
    return heavy.heavy_keys(table(spark, folder, "lineitem"), "l_suppkey", FREQUENT).rows


QUERIES = {
    "review_summary_bitmaps": Query(
        review_summary_bitmaps,
        f"""
        SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_reviews,
               count(*) FILTER (year(o_orderdate) = {YEAR}) AS n_in_year,
               count(DISTINCT o_custkey) AS n_users
        FROM orders
        """,
    ),
    "heavy_words": Query(heavy_words, _TOP_WORDS_SQL),
    "heavy_users": Query(heavy_users, _USERS_SQL),
    "heavy_keys": Query(
        heavy_keys,
        f"SELECT l_suppkey, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) > {FREQUENT}",
    ),
    "review_summary": Query(
        review_summary,
        f"""
        SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_reviews,
               count(*) FILTER (year(o_orderdate) = {YEAR}) AS n_in_year,
               count(DISTINCT o_custkey) AS n_users
        FROM orders
        """,
    ),
    "top_users": Query(top_users, _USERS_SQL),
    "top_words": Query(top_words, _TOP_WORDS_SQL),
    "word_counts": Query(word_counts, _WORDS_SQL),
    "category_totals": Query(
        category_totals,
        f"SELECT category, round(star_sum, 6) AS star_sum, star_count FROM ({_CATEGORY_SQL})",
    ),
    "category_avg": Query(
        category_avg,
        f"""
        SELECT category, round(star_sum / star_count, 6) AS avg FROM ({_CATEGORY_SQL})
        ORDER BY star_sum / star_count DESC, category LIMIT {TOP_CATEGORIES}
        """,
    ),
    "frequent_keys": Query(
        frequent_keys,
        f"""
        SELECT l_suppkey, count(*) AS count FROM lineitem
        GROUP BY 1 HAVING count(*) > {FREQUENT}
        """,
    ),
    "review_report": Query(
        review_report,
        f"""
        SELECT CAST(to_json({{
          'A': (SELECT count(DISTINCT o_orderkey) FROM orders),
          'B': (SELECT count(*) FROM orders WHERE year(o_orderdate) = {YEAR}),
          'C': (SELECT count(DISTINCT o_custkey) FROM orders),
          'D': (SELECT list({{'user_id': o_custkey, 'count': count}}
                            ORDER BY count DESC, o_custkey) FROM ({_USERS_SQL})),
          'E': (SELECT list(word ORDER BY count DESC, word) FROM ({_TOP_WORDS_SQL}))
        }}) AS VARCHAR) AS document
        """,
    ),
    "partition_census_ascii": Query(
        partition_census_ascii, _census_sql("ascii(event_type)")
    ),
    "partition_census_crc": Query(partition_census_crc, _census_sql(_CRC_SQL)),
    "partition_census_moved": Query(
        partition_census_moved,
        f"""
        SELECT CAST(ascii(event_type) % {PARTITIONS} AS INTEGER) AS partition, event_type,
               count(*) AS n_items
        FROM events GROUP BY 1, 2
        """,
    ),
}
