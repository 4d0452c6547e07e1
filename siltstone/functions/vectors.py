"""Distances and moments of array<double> columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, value: acc + value)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def mahalanobis(a: Column, b: Column, deviation: Column) -> Column:
    """Distance scaled per dimension; a zero deviation gives 0 when equal, else infinity."""
    gap = F.zip_with(a, b, lambda x, y: x - y)

    def scaled(delta: Column, sd: Column) -> Column:
        by_zero = F.when(delta == 0, F.lit(0.0)).otherwise(F.lit(float("inf")))
        ratio = F.try_divide(delta, sd)
        return F.when(sd == 0, by_zero).otherwise(ratio * ratio)

    return F.sqrt(_sum(F.zip_with(gap, deviation, scaled)))


def scale(vector: Column, factor: Column) -> Column:
    return F.transform(vector, lambda x: x * factor)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def squares(vector: Column) -> Column:
    return F.transform(vector, lambda x: x * x)


def deviation(mean: Column, mean_square: Column) -> Column:
    """Standard deviation per dimension from the first two moments."""
    return F.zip_with(
        mean_square, mean, lambda sq, m: F.sqrt(F.greatest(sq - m * m, F.lit(0.0)))
    )


def vector_sum(vector: Column) -> Column:
    """Aggregate: sum per dimension, combined on the map side."""
    return vector_to_array(Summarizer.sum(array_to_vector(vector)))


def moments(points: DataFrame, by: str, vec: str) -> DataFrame:
    """Per group: ``n``, ``mean``, ``mean_square`` and ``deviation`` (arrays per dimension)."""
    sums = points.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        vector_sum(F.col(vec)).alias("_sum"),
        vector_sum(squares(F.col(vec))).alias("_sumsq"),
    )
    per_point = F.lit(1.0) / F.col("n")
    return (
        sums.withColumn("mean", scale(F.col("_sum"), per_point))
        .withColumn("mean_square", scale(F.col("_sumsq"), per_point))
        .withColumn("deviation", deviation(F.col("mean"), F.col("mean_square")))
        .drop("_sum", "_sumsq")
    )
