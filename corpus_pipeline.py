"""Pipeline over `documents`: from raw rows to packed sequences.

Each stage gets the rows that its predecessor kept, written and read again, and returns rows with the
columns of `documents`; the last one returns the packing. Decisions take effect: rejected rows don't
reach the next stage. Rows travel with their decision, or go by a number of their own in the stage of
the join, so repeated or null identifiers can't mix rows up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import byte_bpe, packing, quality, token_counts, toxicity
from siltstone.llm.exact_dedup import without_copies
from siltstone.llm.jaccard_join import jaccard_components
from siltstone.session import written

TOXIC_FROM = 0.3


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base counts and the classifier, which learns from labelled documents.

    Null and empty texts have too few words and go. Rows are judged by their text alone, so null and
    repeated identifiers and equal rows don't matter; an empty table stays empty. Without usable labels
    the base counts decide.
    """
    model = quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), _labels(spark, sf_dir))
    return docs.where(quality.judge(spark, model, F.col("text"))["kept"])


def no_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a score below the threshold; the classifier learns from labelled documents.

    Null texts count as empty ones. Without any usable label nothing scores as toxic, and all rows stay.
    """
    weights = toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), _labels(spark, sf_dir))
    return docs.where(toxicity.score(spark, weights, F.col("text")) < TOXIC_FROM)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that with the smallest identifier; nulls come last, and equal rows leave one.

    A null text counts as an empty one; an empty table stays empty.
    """
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that with the smallest identifier; nulls come last.

    Rows go by a number of their own, so repeated or null identifiers can't mix them up: of near copies
    without any identifier one stays, too.
    """
    number = "row_number"
    while number in [name.lower() for name in docs.columns]:
        number += "_"
    docs = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = jaccard_components(docs, id_column=number).select(F.col("doc_id").alias("number"), "component_id")
    known = found.join(docs.select(F.col(number).alias("number"), F.col("doc_id").alias("known")), "number")
    first = F.min_by("number", F.struct(F.col("known").isNull(), "known", "number"))
    heads = known.groupBy("component_id").agg(first.alias(number)).select(number)
    return docs.join(heads, number, "left_semi").select([F.col(f"`{name}`") for name in docs.columns if name != number])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place.

    The size of a document are the tokens of its whole text and one for its end, 1 for a null or empty
    text. Equal sizes go by identifier, nulls first, then by row; an empty table has no pieces.
    """
    return packing.best_fit(docs, token_counts.tokens_and_end(spark, byte_bpe.load()))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", no_toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Classifiers, links of similar sets and best-fit packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
