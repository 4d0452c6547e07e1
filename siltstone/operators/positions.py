"""Places of rows in an order, without one task that sees them all.

Rows are dealt into ranges of the order and sorted in them; a row's place is its place in the range and
the rows of the ranges before, which are one number each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_ROWS, written

_OWN = ("_row", "_part", "_at", "_before", "_first")


def with_place(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], place: str = "place") -> DataFrame:
    """Add the place of each row, from 0, among the rows with equal ``by`` in the given order.

    Without ``by`` it is the place among all rows. Nulls are equal to each other; rows that are equal in
    the order follow each other as they stand. A group, and rows that are equal in the order, are spread
    over as many ranges as their number asks for. The rows are written once.
    """
    if set(_OWN) & {name.lower() for name in df.columns}:
        raise ValueError(f"columns {_OWN} are used here")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{name}`") for name in by]
    whole = [*keys, *order, "_row"]
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, *whole).sortWithinPartitions(*whole)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_rows = written(ranged.withColumns({"_part": F.spark_partition_id(), "_at": at}).drop("_row"), "sorted")
    ranges = sorted_rows.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    if not by:
        # One row a range: few, whatever the number of rows.
        ranges = ranges.withColumn("_all", F.lit(0))
    earlier = Window.partitionBy(*(keys or ["_all"])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    starts = ranges.select(
        *[key.alias(f"_by{i}") for i, key in enumerate(keys)], F.col("_part").alias("_of"), (before - F.col("_first")).alias("_before")
    )
    if ranges.count() <= BROADCAST_MAX_ROWS:
        starts = F.broadcast(starts)
    same = F.col("_part") == F.col("_of")
    for i, key in enumerate(keys):
        same &= key.eqNullSafe(F.col(f"_by{i}"))
    placed = sorted_rows.join(starts, same)
    return placed.select(*[F.col(f"`{name}`") for name in df.columns], (F.col("_before") + F.col("_at")).alias(place))
