"""Uniform sample of events, its popular tags, and the topic filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sampling as ops
from .registry import Query, table

SIZE = 100
SEED = 666
TOPICS = ("the", "tion", "and", "ing")


def with_tags(events: DataFrame) -> DataFrame:
    """``(event_id, tags)``: the event type and the number in its properties."""
    tags = F.array("event_type", F.get_json_object("props", "$.k"))
    return events.select("event_id", tags.alias("tags"))


def tagged_events(spark: SparkSession, folder: str) -> DataFrame:
    return ops.tagged(with_tags(table(spark, folder, "events")), "tags")


def reservoir_sample(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return ops.reservoir(events, "event_id", SIZE, SEED)


def popular_tags(spark: SparkSession, folder: str) -> DataFrame:
    sample = ops.reservoir(tagged_events(spark, folder), "event_id", SIZE, SEED)
    return ops.popular_tags(sample, "tags")


def tag_counts(spark: SparkSession, folder: str) -> DataFrame:
    sample = ops.reservoir(tagged_events(spark, folder), "event_id", SIZE, SEED)
    return ops.tag_counts(sample, "tags")


def topic_filter(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return ops.topic_filter(documents, "text", TOPICS, "lang").select("doc_id", "source")


_SAMPLE_SQL = f"""
  SELECT event_id, user_id, event_type, props FROM events
  ORDER BY md5('{SEED}:' || event_id), event_id LIMIT {SIZE}
"""
_TAGS_SQL = f"""
  SELECT unnest([event_type, json_extract_string(props, '$.k')]) AS tag
  FROM ({_SAMPLE_SQL})
"""
_COUNTS_SQL = f"SELECT tag, count(*) AS count FROM ({_TAGS_SQL}) GROUP BY tag"
_ANY_TOPIC = " OR ".join(f"contains(lower(text), '{t}')" for t in TOPICS)

QUERIES = {
    "reservoir_sample": Query(
        reservoir_sample, f"SELECT event_id, user_id, event_type FROM ({_SAMPLE_SQL})"
    ),
    "tag_counts": Query(tag_counts, _COUNTS_SQL),
    "popular_tags": Query(
        popular_tags,
        f"""
        SELECT tag, count FROM (
          SELECT tag, count, dense_rank() OVER (ORDER BY count DESC) AS place
          FROM ({_COUNTS_SQL})
        ) WHERE place <= 3
        """,
    ),
    "topic_filter": Query(
        topic_filter,
        f"SELECT doc_id, source FROM documents WHERE lang = 'en' AND ({_ANY_TOPIC})",
    ),
}
