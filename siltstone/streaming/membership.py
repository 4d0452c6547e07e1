"""Membership of streaming records in a filter built from an earlier dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..functions.hashing import BLOOM_BUCKETS, BLOOM_HASHES
from ..operators.bloom import bloom_build, bloom_probe


def save_bloom(
    df: DataFrame, col: str, path: str, buckets: int = BLOOM_BUCKETS, hashes: int = BLOOM_HASHES
) -> None:
    """Build once and keep the words, so that micro-batches do not rebuild the filter."""
    bloom_build(df, col, buckets, hashes).write.mode("overwrite").parquet(path)


def load_bloom(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word bigint, bits bigint").parquet(path)


def stream_predictions(
    stream: DataFrame,
    col: str,
    bloom_path: str,
    buckets: int = BLOOM_BUCKETS,
    hashes: int = BLOOM_HASHES,
) -> DataFrame:
    bloom = load_bloom(stream.sparkSession, bloom_path)
    return bloom_probe(stream, col, bloom, buckets, hashes)


def write_predictions(predictions: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Space-separated rows, appended."""
    return (
        predictions.writeStream.outputMode("append")
        .format("csv")
        .option("sep", " ")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
