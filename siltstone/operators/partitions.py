"""Partitioning by a function of the key, and the census of the partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import code_of_first, crc_of_first

KEY_FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "crc": crc_of_first,
    "ascii": code_of_first,
}


def partition_id(key: Column, n: int, fn: str | Callable[[Column], Column] = "crc") -> Column:
    """Partition number below ``n``; a null key goes to partition 0."""
    code = KEY_FUNCTIONS[fn](key) if isinstance(fn, str) else fn(key)
    return F.coalesce(F.pmod(code, F.lit(n).cast("bigint")), F.lit(0)).cast("int")


def repartition_by_key(
    df: DataFrame,
    key: str,
    n: int,
    fn: str | Callable[[Column], Column] | None = "crc",
    splits: int = 1,
) -> DataFrame:
    """Move each row to the partition its key function names; ``fn=None`` moves nothing.

    The function may send most rows to one partition. With ``splits`` above 1 partition ``i``
    is spread over the physical partitions ``i * splits`` to ``i * splits + splits - 1`` by the
    hash of the whole row.
    """
    if fn is None:
        return df
    target = partition_id(F.col(key), n, fn)
    if splits > 1:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(splits)).cast("int")
        target = target * splits + part
    return df.repartitionById(n * splits, target)


def partition_census(
    df: DataFrame, key: str, n: int, fn: str | Callable[[Column], Column] = "crc"
) -> DataFrame:
    """Rows that each of the ``n`` partitions would hold, empty ones included.

    Counted from the key with a map-side combine, so no row moves and no partition gathers.
    """
    counts = df.groupBy(partition_id(F.col(key), n, fn).alias("partition")).agg(
        F.count(F.lit(1)).alias("n_items")
    )
    return _with_empty(df, counts, n)


def physical_census(df: DataFrame) -> DataFrame:
    """Rows in each partition ``df`` has now, empty ones included."""
    counts = df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n_items")
    )
    return _with_empty(df, counts, partition_count(df))


def partition_count(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def _with_empty(df: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    numbers = df.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"))
    return numbers.join(counts, "partition", "left").select(
        "partition", F.coalesce("n_items", F.lit(0)).alias("n_items")
    )


def census_document(census: DataFrame) -> DataFrame:
    """One JSON document: number of partitions, and the rows of each in order.

    The frequent keys are a result of their own, since their number has no bound.
    """
    items = F.transform(
        F.array_sort(F.collect_list(F.struct("partition", "n_items"))), lambda e: e["n_items"]
    )
    sizes = census.agg(F.count(F.lit(1)).alias("n_partitions"), items.alias("n_items"))
    return sizes.select(F.to_json(F.struct("n_partitions", "n_items")).alias("document"))
