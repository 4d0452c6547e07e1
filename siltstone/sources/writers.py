"""Writers for results; every one writes from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_document(document: DataFrame, path: str) -> None:
    """A frame with one ``document`` column of JSON text, as a text file."""
    document.select("document").write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_rounds(rounds: DataFrame, path: str) -> None:
    """Round records as CSV with a header, in round order."""
    rounds.orderBy("round_id").coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """One space-separated row per record, key first."""
    predictions.write.mode("overwrite").csv(path, sep=" ")


def write_labels(labels: DataFrame, path: str) -> None:
    """Point id and cluster number as JSON lines; -1 stands for no cluster."""
    labels.select(labels["id"].cast("string").alias("id"), "cluster").write.mode(
        "overwrite"
    ).json(path)
