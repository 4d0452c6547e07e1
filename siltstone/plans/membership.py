"""Bloom filter of the users seen in the events, and its probe with all customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import BLOOM_P, text_mod
from ..operators import bloom as ops
from .registry import Query, table


LARGE_BUCKETS = 10_000_019
LARGE_HASHES = 7


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(F.col("user_id").cast("string").alias("user"))


def bloom_build(spark: SparkSession, folder: str) -> DataFrame:
    return ops.bloom_positions(ops.bloom_build(users(spark, folder), "user"))


def bloom_probe(spark: SparkSession, folder: str) -> DataFrame:
    bloom = ops.bloom_build(users(spark, folder), "user")
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("user")
    )
    return ops.bloom_probe(customers, "user", bloom).select("c_custkey", "prediction")


def bloom_probe_large(spark: SparkSession, folder: str) -> DataFrame:
    """A filter of 1.25 MB, which is probed like a small one."""
    bloom = ops.bloom_build(users(spark, folder), "user", LARGE_BUCKETS, LARGE_HASHES)
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("user")
    )
    found = ops.bloom_probe(customers, "user", bloom, LARGE_BUCKETS, LARGE_HASHES)
    return found.select("c_custkey", "prediction")


def bloom_probe_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same filter, probed as one that is too large to broadcast."""
    bloom = ops.bloom_build(users(spark, folder), "user", LARGE_BUCKETS, LARGE_HASHES)
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("user"))
    found = ops.bloom_probe(customers, "user", bloom, LARGE_BUCKETS, LARGE_HASHES, broadcast_words=0)
    return found.select("c_custkey", "prediction")


def document_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Remainder of every whole text."""
    return table(spark, folder, "documents").select("doc_id", text_mod("text", BLOOM_P).alias("remainder"))


def mod_sql(text: str, p: int) -> str:
    """The bytes of ``text`` as one integer modulo ``p``, folded byte by byte."""
    return f"""list_reduce(
      list_prepend(0::BIGINT,
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda acc, byte: (acc * 256 + byte) % {p})"""


def _signature_sql(text: str, buckets: int = 5000) -> str:
    return f"""list_transform([83, 96, 44, 82, 25, 5, 101]::BIGINT[],
      lambda a: ((a * ({mod_sql(text, 233333333333)}) + 83) % 233333333333) % {buckets})"""


def _seen_sql(buckets: int = 5000) -> str:
    return f"""
      SELECT DISTINCT unnest(signature) AS position FROM (
        SELECT {_signature_sql('u', buckets)} AS signature
        FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS u FROM events)
      )
    """


def _probe_sql(buckets: int = 5000) -> str:
    return f"""
      WITH seen AS ({_seen_sql(buckets)}), bits AS (SELECT list(position) AS bits FROM seen)
      SELECT c_custkey, CAST(list_has_all(bits, {_signature_sql('u', buckets)}) AS INTEGER) AS prediction
      FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS u FROM customer), bits
    """


QUERIES = {
    "bloom_build": Query(bloom_build, _seen_sql()),
    "bloom_probe": Query(bloom_probe, _probe_sql()),
    "bloom_probe_large": Query(bloom_probe_large, _probe_sql(10_000_019)),
    "bloom_probe_shuffled": Query(bloom_probe_shuffled, _probe_sql(10_000_019)),
    "document_hashes": Query(
        document_hashes, f"SELECT doc_id, {mod_sql('text', 233333333333)} AS remainder FROM documents"
    ),
}
