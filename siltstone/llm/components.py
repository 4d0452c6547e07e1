"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_folder, remove


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node of ``edges`` (columns a, b): root is its smallest node.

    Alternates two steps until nothing changes: each node hangs its larger neighbours below its
    smallest one, then each node hangs its smaller neighbours below the smallest. Every step is an
    aggregation and a join over the edges, whose number never grows beyond nodes and edges; rounds grow
    with the logarithm of the size of a component. Edges are written after each round, and those of
    the round before are deleted.
    """
    spark = edges.sparkSession
    ordered = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))

    def kept(rows: DataFrame) -> tuple[str, DataFrame]:
        path = new_folder(spark, "links")
        rows.write.parquet(path)
        return path, spark.read.schema(rows.schema).parquet(path)

    path, links = kept(ordered.where("low < high").distinct())
    before = None
    while before != (state := _state(links)):
        before, old = state, path
        path, links = kept(_small_star(_large_star(links)))
        remove(spark, old)
    tops = links.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
    return tops.unionByName(tops.select(F.col("root").alias("node"), "root").distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("low", "high")), F.sum(F.xxhash64("high", "low") % (1 << 40))).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("low").alias("node"), F.col("high").alias("other")).unionByName(
        links.select(F.col("high").alias("node"), F.col("low").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    hung = both.where("other > node").join(least, "node")
    return hung.select(F.least("node", "least").alias("low"), F.col("other").alias("high")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    hung = links.join(least, "high").select(F.col("least").alias("low"), F.col("low").alias("high"))
    own = least.select(F.col("least").alias("low"), "high")
    return hung.where("low < high").unionByName(own).distinct()
