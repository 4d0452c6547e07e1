"""Uniform sample of fixed size over a stream, and the popular-tag report.

The sample after micro-batch i is written as version i, from version i - 1 and the batch. A
repeated batch reads the same version and writes the same one again, so a restart changes
nothing. The newest versions share a fixed number of slots, so the folder does not grow with
the stream. A batch is reduced to k rows before it meets the sample.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.sampling import popular_tags, reservoir, tagged


# A version is overwritten when it is this many batches old; only the last one is read.
KEPT_VERSIONS = 3


def sample_path(folder: str, batch_id: int) -> str:
    return f"{folder}/sample/slot={batch_id % KEPT_VERSIONS}"


def seen_path(folder: str, batch_id: int) -> str:
    return f"{folder}/seen/slot={batch_id % KEPT_VERSIONS}"


def read_sample(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    """Version ``batch_id``, one of the newest."""
    return spark.read.parquet(sample_path(folder, batch_id)).drop("_new")


def last_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The newest finished version; its count is written after its sample."""
    newest = spark.read.parquet(f"{folder}/seen").agg(F.max("version")).first()[0]
    return read_sample(spark, folder, newest)


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """All reports: ``(batch, seen, tag, count)``."""
    return spark.read.schema("seen bigint, tag string, count bigint, batch bigint").json(
        f"{folder}/report"
    )


def fold_batch(
    folder: str, row_id: str, tags: str, k: int, seed: int = 666, top: int = 3
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``.

    Untagged records are dropped first. A report is written for every batch that changed the
    sample: tagged records so far, and the popular tags of the sample.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Counted in the pass that draws the sample, so the batch isn't kept.
        arrived = Observation()
        records = tagged(batch, tags).observe(arrived, F.count(F.lit(1)).alias("n"))
        candidates = reservoir(records, row_id, k, seed, batch.columns).withColumn("_new", F.lit(True))
        seen = 0
        if batch_id > 0:
            seen = spark.read.parquet(seen_path(folder, batch_id - 1)).first()["seen"]
            kept = read_sample(spark, folder, batch_id - 1)
            candidates = candidates.unionByName(kept.withColumn("_new", F.lit(False)))
        path = sample_path(folder, batch_id)
        reservoir(candidates, row_id, k, seed, batch.columns).write.mode("overwrite").parquet(path)
        seen += arrived.get["n"]
        if not spark.read.parquet(path).filter("_new").isEmpty():
            report = popular_tags(read_sample(spark, folder, batch_id), tags, top).select(
                F.lit(seen).cast("bigint").alias("seen"), "tag", "count"
            )
            report.write.mode("overwrite").json(f"{folder}/report/batch={batch_id}")
        totals = spark.range(1).select(
            F.lit(seen).cast("bigint").alias("seen"),
            F.lit(batch_id).cast("bigint").alias("version"),
        )
        totals.write.mode("overwrite").parquet(seen_path(folder, batch_id))

    return fold


def stream_reservoir(
    stream: DataFrame,
    row_id: str,
    tags: str,
    folder: str,
    k: int = 100,
    seed: int = 666,
    top: int = 3,
) -> DataStreamWriter:
    """Writer that keeps sample, count and report below ``folder``."""
    return stream.writeStream.foreachBatch(fold_batch(folder, row_id, tags, k, seed, top)).option(
        "checkpointLocation", f"{folder}/checkpoint"
    )
