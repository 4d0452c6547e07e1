"""Distinct count and its estimate per sliding window of a stream.

Each micro-batch reduces its rows to panes and writes them below a folder of its own, so a batch that
is repeated writes the same again. Windows are computed from the panes of all batches: no row is too
late, and a window can be read at any time, open or closed. No watermark is needed, and no state is
kept by the stream itself. Windows go by a time column, or by arrival.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators import distinct as batch_windows

PAIRS, BITS = "pairs", "bits"
_SCHEMAS = {
    PAIRS: "pane bigint, value string, batch bigint",
    BITS: "pane bigint, " + ", ".join(f"{z} int" for z in batch_windows.ZERO_COLUMNS) + ", batch bigint",
}


def panes_path(folder: str, exact: bool) -> str:
    return f"{folder}/{PAIRS if exact else BITS}"


def _stored(spark: SparkSession, folder: str, exact: bool) -> DataFrame:
    kind = PAIRS if exact else BITS
    return spark.read.schema(_SCHEMAS[kind]).parquet(panes_path(folder, exact))


def _windows(panes: DataFrame, length: int, slide: int, exact: bool, combine: str) -> DataFrame:
    if exact:
        counted = batch_windows.counts_by_window(panes.select("pane", "value").distinct(), length, slide)
        return batch_windows.with_estimate(counted, combine)
    return batch_windows.with_estimate(batch_windows.bits_by_window(panes, length, slide), combine)


def window_rows(
    spark: SparkSession, folder: str, length: int, slide: int, exact: bool = True, combine: str = "kmeans"
) -> DataFrame:
    """All windows from the panes stored so far: ``time``, ``estimation``, and ``ground_truth`` if exact."""
    return _windows(_stored(spark, folder, exact), length, slide, exact, combine)


def fold_panes(
    folder: str,
    ts: str | None,
    value: str,
    length: int,
    slide: int,
    exact: bool = True,
    combine: str = "kmeans",
    csv: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """What a micro-batch does; see :func:`stream_windows`."""

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        at = ts
        if at is None:
            at, batch = "_arrived", batch.withColumn("_arrived", F.current_timestamp())
        reduce = batch_windows.pane_values if exact else batch_windows.pane_bits
        path = f"{panes_path(folder, exact)}/batch={number}"
        reduce(batch, at, value, length, slide).write.mode("overwrite").parquet(path)
        if csv is not None:
            # Windows that this batch has touched lie within its panes and a length on either side.
            low, high = spark.read.parquet(path).agg(F.min("pane"), F.max("pane")).first()
            if low is None:
                return
            stored = _stored(spark, folder, exact).where(
                (F.col("batch") <= number) & F.col("pane").between(low - length, high + length)
            )
            ends = spark.read.parquet(path).select("pane").distinct()
            touched = batch_windows.window_times(ends, length, slide)
            rows = _windows(stored, length, slide, exact, combine).join(touched, "time", "left_semi")
            rows.write.mode("overwrite").csv(f"{csv}/batch={number}", header=True)

    return fold


def stream_windows(
    stream: DataFrame,
    ts: str | None,
    value: str,
    length: int,
    slide: int,
    folder: str,
    checkpoint: str,
    exact: bool = True,
    combine: str = "kmeans",
    csv: str | None = None,
    interval: str | None = "5 seconds",
) -> DataStreamWriter:
    """Keep the panes of a stream below ``folder``; ``ts`` names its time, None stands for arrival.

    With ``exact`` the distinct (pane, value) are kept, else 12 numbers per pane. ``csv`` also gets a
    folder of rows for each batch, with every window that the batch has touched, open ones too:
    :func:`read_csv` gives the last row of each window. ``interval=None`` reads what is there and stops.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        fold_panes(folder, ts, value, length, slide, exact, combine, csv)
    )
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def read_csv(spark: SparkSession, path: str, exact: bool = True) -> DataFrame:
    """The last row that was written for each window."""
    truth = "ground_truth bigint, " if exact else ""
    rows = spark.read.schema(f"time string, {truth}estimation bigint, batch bigint").csv(path, header=True)
    columns = [c for c in rows.columns if c not in ("time", "batch")]
    last = rows.groupBy("time").agg(F.max_by(F.struct(*columns), "batch").alias("last"))
    return last.select("time", "last.*")
