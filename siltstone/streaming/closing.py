"""Sliding windows of a stream that close: each comes out once, and what comes too late is kept apart.

The watermark is the latest time seen so far less a delay. A window closes with the first micro-batch
after which the watermark has reached its end, and its row is written then, once. A value whose window
had closed before its micro-batch goes to a table of late values, by which results can be corrected.

The state are the panes of windows that can still change: those of the last compaction, and what every
micro-batch since has added. Compaction puts them together and drops panes whose last window has
closed, so the state is bounded by the panes between the watermark and the latest time and by
``compact_every`` micro-batches, however long the stream runs. With ``archive`` dropped panes go to a
table that is read only when late values ask for it; without, exact counts can't be corrected.

All folders carry the number of their micro-batch, and a micro-batch reads only what those before it
have written, so one that is run again writes the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.hashing import FM_P, text_mod
from ..operators import distinct as batch_windows
from ..operators.distinct import ZERO_COLUMNS
from ..session import delete

_ZEROS = ", ".join(f"{z} int" for z in ZERO_COLUMNS)
_PROGRESS = "batch bigint, watermark bigint, base bigint"
# Of the progress, so many versions are kept; the one before the last is read by a repeated batch.
KEPT_VERSIONS = 3


@dataclass(frozen=True)
class Progress:
    """After a micro-batch: the watermark (None before any time) and the last compaction (-1 for none)."""

    batch: int = -1
    watermark: int | None = None
    base: int = -1


@dataclass(frozen=True)
class ClosingWindows:
    """Windows of ``length`` seconds every ``slide`` seconds over ``value``, with state below ``folder``.

    ``ts`` names the time, None stands for arrival. ``exact`` counts distinct values and estimates them;
    without it only 12 numbers a pane are kept, and only the estimate is given. Rows without a time or a
    value count nowhere and don't move the watermark. A time without zone counts as UTC.
    """

    folder: str
    ts: str | None
    value: str
    length: int
    slide: int
    delay: int = 0
    exact: bool = True
    archive: bool = True
    compact_every: int = 16

    # what a pane has

    @property
    def _pane_schema(self) -> str:
        return "pane bigint, value string" if self.exact else f"pane bigint, {_ZEROS}"

    def _together(self, panes: DataFrame) -> DataFrame:
        if self.exact:
            return panes.select("pane", "value").distinct()
        return panes.groupBy("pane").agg(*[F.max(z).alias(z) for z in ZERO_COLUMNS])

    def _first_end(self) -> Column:
        """End of the earliest window over a pane."""
        start = F.col("pane") - self.length + 1
        return start + F.pmod(-start, F.lit(self.slide)) + self.length

    def _last_end(self) -> Column:
        return F.col("pane") - F.pmod(F.col("pane"), F.lit(self.slide)) + self.length

    def _rows(self, panes: DataFrame, ends: Column | None = None) -> DataFrame:
        """``end``, ``ground_truth`` if exact, and the runs, of the windows that ``ends`` chooses."""
        count = batch_windows.counts_by_end if self.exact else batch_windows.bits_by_end
        found = count(panes, self.length, self.slide)
        return found if ends is None else found.where(ends)

    def _reduced(self, batch: DataFrame, at: str) -> DataFrame:
        """Panes of a micro-batch, each with the latest second in it."""
        rows = batch_windows.timed_panes(batch, at, self.value, self.length, self.slide)
        last = F.max("second").alias("last")
        if self.exact:
            return rows.groupBy("pane", "value").agg(last)
        hashed = rows.withColumn("x", text_mod("value", FM_P))
        return hashed.groupBy("pane").agg(*batch_windows.zero_runs("x"), last)

    # folders

    def _read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        return spark.read.schema(f"{schema}, batch bigint").parquet(f"{self.folder}/{name}")

    def _write(self, rows: DataFrame, name: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={number}")

    def _make(self, spark: SparkSession) -> None:
        """All folders exist, so that each can be read before anything is in it."""
        empty = {
            "delta": self._pane_schema, "base": self._pane_schema, "archive": self._pane_schema,
            "closed": self._closed_schema, "late": f"end bigint, {self._pane_schema}",
        }
        for name, schema in empty.items():
            self._write(spark.createDataFrame([], schema), name, -1)

    @property
    def _closed_schema(self) -> str:
        return "end bigint, " + ("ground_truth bigint, " if self.exact else "") + _ZEROS

    def progress(self, spark: SparkSession, number: int | None = None) -> Progress:
        """After micro-batch ``number``, one of the newest, or after the last."""
        rows = spark.read.schema(_PROGRESS).parquet(f"{self.folder}/progress/*").collect()
        found = [Progress(*row) for row in rows if number in (None, row.batch)]
        return max(found, key=lambda each: each.batch)

    def _panes(self, spark: SparkSession, base: int, number: int) -> DataFrame:
        """What is stored after micro-batch ``number``, the last compaction being ``base``."""
        whole = self._read(spark, "base", self._pane_schema).where(F.col("batch") == base)
        since = self._read(spark, "delta", self._pane_schema).where(F.col("batch").between(base + 1, number))
        return whole.unionByName(since).drop("batch")

    # micro-batches

    def fold(self, batch: DataFrame, number: int) -> None:
        """What a micro-batch does."""
        spark = batch.sparkSession
        before = Progress() if number == 0 else self.progress(spark, number - 1)
        if number == 0:
            self._make(spark)
        elif before.base == number - 1:
            self._clear(spark, before.base)
        at = self.ts
        if at is None:
            at, batch = "_arrived", batch.withColumn("_arrived", F.current_timestamp())
        self._write(self._reduced(batch, at), "delta", number)
        added = self._read(spark, "delta", f"{self._pane_schema}, last bigint").where(F.col("batch") == number)
        last = added.agg(F.max("last")).first()[0]
        watermark = before.watermark if last is None else max(last - self.delay, before.watermark or last - self.delay)
        if before.watermark is not None:
            self._keep_late(spark, number, before.watermark)
        if watermark is not None:
            self._close(spark, before, watermark, number)
        base = before.base
        if number - base >= self.compact_every:
            self._compact(spark, base, watermark, number)
            base = number
        progress = spark.createDataFrame([(number, watermark, base)], _PROGRESS)
        progress.write.mode("overwrite").parquet(f"{self.folder}/progress/slot={number % KEPT_VERSIONS}")

    def _keep_late(self, spark: SparkSession, number: int, watermark: int) -> None:
        added = self._read(spark, "delta", self._pane_schema).where(F.col("batch") == number).drop("batch")
        late = added.where(self._first_end() <= watermark)
        if not late.isEmpty():
            ends = batch_windows.window_ends(self.length, self.slide)
            self._write(late.select(ends, *late.columns).where(F.col("end") <= watermark), "late", number)

    def _close(self, spark: SparkSession, before: Progress, watermark: int, number: int) -> None:
        panes = self._panes(spark, before.base, number).where(F.col("pane") < watermark)
        ends = F.col("end") <= watermark
        if before.watermark is not None:
            last_closed, now_closed = ((w - self.length) // self.slide for w in (before.watermark, watermark))
            if last_closed == now_closed:
                return
            panes = panes.where(self._last_end() > before.watermark)
            ends &= F.col("end") > before.watermark
        self._write(self._rows(panes, ends), "closed", number)

    def _compact(self, spark: SparkSession, base: int, watermark: int | None, number: int) -> None:
        panes = self._panes(spark, base, number)
        gone = F.lit(False) if watermark is None else self._last_end() <= watermark
        self._write(self._together(panes.where(~gone)), "base", number)
        if self.archive:
            self._write(self._together(panes.where(gone)), "archive", number)

    def _clear(self, spark: SparkSession, base: int) -> None:
        """Delete what the compaction ``base`` has replaced; no micro-batch reads it any more."""
        delete(spark, f"{self.folder}/base/batch={base - self.compact_every}")
        for number in range(base - self.compact_every + 1, base + 1):
            delete(spark, f"{self.folder}/delta/batch={number}")

    def writer(self, stream: DataFrame, checkpoint: str, interval: str | None = "5 seconds") -> DataStreamWriter:
        """Writer of a stream; ``interval=None`` reads what is there and stops."""
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.fold)
        return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)

    # results

    def _labelled(self, rows: DataFrame, combine: str) -> DataFrame:
        label = batch_windows.window_label(F.col("end")).alias("time")
        kept = ["ground_truth"] if self.exact else []
        return batch_windows.with_estimate(rows.select(label, *kept, *ZERO_COLUMNS), combine)

    def closed(self, spark: SparkSession, combine: str = "kmeans") -> DataFrame:
        """Windows as they came out: ``time``, ``ground_truth`` if exact, ``estimation``."""
        return self._labelled(self._read(spark, "closed", self._closed_schema), combine)

    def late(self, spark: SparkSession) -> DataFrame:
        """``time`` of a closed window and what came for it too late: distinct values, or the runs."""
        rows = self._read(spark, "late", f"end bigint, {self._pane_schema}")
        label = batch_windows.window_label(F.col("end")).alias("time")
        if self.exact:
            return rows.select("end", "value").distinct().select(label, "value")
        longest = rows.groupBy("end").agg(*[F.max(z).alias(z) for z in ZERO_COLUMNS])
        return longest.select(label, *ZERO_COLUMNS)

    def open(self, spark: SparkSession, combine: str = "kmeans") -> DataFrame:
        """Windows that haven't closed, from the state."""
        now = self.progress(spark)
        panes = self._panes(spark, now.base, now.batch)
        return self._labelled(self._rows(panes, None if now.watermark is None else F.col("end") > now.watermark), combine)

    def corrected(self, spark: SparkSession, combine: str = "kmeans") -> DataFrame:
        """Closed windows with their late values. Only windows that have some are computed again."""
        closed = self._read(spark, "closed", self._closed_schema).drop("batch")
        late = self._read(spark, "late", f"end bigint, {self._pane_schema}").drop("batch")
        if not self.exact:
            both = closed.unionByName(late.drop("pane"))
            return self._labelled(both.groupBy("end").agg(*[F.max(z).alias(z) for z in ZERO_COLUMNS]), combine)
        if not self.archive:
            raise ValueError("exact counts are corrected from the archive")
        touched = late.select("end").distinct()
        low, high = late.agg(F.min("end"), F.max("end")).first()
        if low is None:
            return self._labelled(closed, combine)
        now = self.progress(spark)
        panes = self._panes(spark, now.base, now.batch).unionByName(self._read(spark, "archive", self._pane_schema).drop("batch"))
        near = panes.where(F.col("pane").between(low - self.length, high))
        again = self._rows(self._together(near)).join(touched, "end", "left_semi")
        return self._labelled(closed.join(touched, "end", "left_anti").unionByName(again), combine)

    def rows(self, spark: SparkSession, combine: str = "kmeans") -> DataFrame:
        """All windows with everything that has come: those closed, corrected, and those still open."""
        return self.corrected(spark, combine).unionByName(self.open(spark, combine))
