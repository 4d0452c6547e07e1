"""Uniform sample of a stream in the state store, with tag counts that follow what enters and leaves it.

Two stateful operators keep it. Records are dealt over ``shards`` by the hash that draws them; a shard
keeps its ``k`` smallest draws and passes on a record only when it enters them, and how many records it
has seen. One more operator keeps the ``k`` smallest of all shards. Since a record enters a shard's
sample of n records with a chance of k / n, few records reach it, however long the stream runs. The
counts of tags are state too: a record that enters adds its tags, one that leaves takes them back.

The state is the sample, (shards + 1) x k records, and one count a tag; no table is written anew. It is
kept by Spark's state store and checkpoint, so a restart goes on from it. Draws are those of
``operators.sampling``, so any cut into micro-batches gives the sample of the batch form.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.sampling import priority, row_text, tagged

SHARDS = 16
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_KEPT = "draw string, payload string, tags array<string>"
_ENTERED = f"seen bigint, {_KEPT}"
CHANGES = "change string, seen bigint, draw string, payload string, tag string, count bigint"


def _records(frame: pd.DataFrame) -> list[tuple]:
    return [(draw, payload, [str(tag) for tag in tags if tag is not None]) for draw, payload, tags in zip(frame.draw, frame.payload, frame.tags)]


class Shard(StatefulProcessor):
    """The ``k`` smallest draws of a shard; passes on those that enter, and the number of records."""

    def __init__(self, k: int) -> None:
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", _KEPT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # What was kept before stands first among equals, so only records that enter are new.
        kept = [(draw, payload, list(tags), False) for draw, payload, tags in self.kept.get()]
        seen = 0
        for frame in rows:
            seen += len(frame)
            if len(kept) == self.k:
                frame = frame[frame.draw <= kept[-1][0]]
            kept += [(*record, True) for record in _records(frame)]
            kept = sorted(kept, key=lambda record: (record[0], record[1], record[3]))[: self.k]
        entered = [record[:3] for record in kept if record[3]]
        if entered:
            self.kept.put([record[:3] for record in kept])
        out = [(seen, None, None, None), *[(0, *record) for record in entered]]
        yield pd.DataFrame(out, columns=["seen", "draw", "payload", "tags"]).astype({"seen": "int64"})

    def close(self) -> None:
        pass


class Sample(StatefulProcessor):
    """The ``k`` smallest draws of all shards, and the counts of their tags.

    Puts out what enters (``in``) and leaves (``out``), and after a change the popular tags (``tag``):
    those with one of the ``top`` largest counts.
    """

    def __init__(self, k: int, top: int) -> None:
        self.k, self.top = k, top

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("sample", _KEPT)
        self.counts = handle.getMapState("counts", "tag string", "count bigint")
        self.seen = handle.getValueState("seen", "seen bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.seen.get()
        seen = before[0] if before else 0
        kept = [(draw, payload, list(tags), False) for draw, payload, tags in self.kept.get()]
        whole = list(kept)
        for frame in rows:
            seen += int(frame.seen.sum())
            whole += [(*record, True) for record in _records(frame[frame.draw.notna()])]
        self.seen.update((seen,))
        whole.sort(key=lambda record: (record[0], record[1], record[3]))
        left = [record for record in whole[self.k :] if not record[3]]
        entered = [record for record in whole[: self.k] if record[3]]
        out = []
        if entered:
            self.kept.put([record[:3] for record in whole[: self.k]])
            moved: Counter[str] = Counter()
            for change, records, sign in (("in", entered, 1), ("out", left, -1)):
                for draw, payload, tags, _ in records:
                    out.append((change, seen, draw, payload, None, None))
                    for tag in tags:
                        moved[tag] += sign
            for tag, difference in moved.items():
                had = self.counts.getValue((tag,)) if self.counts.containsKey((tag,)) else (0,)
                count = had[0] + difference
                if count:
                    self.counts.updateValue((tag,), (count,))
                elif had[0]:
                    self.counts.removeKey((tag,))
            now = {tag: count for (tag,), (count,) in self.counts.iterator()}
            largest = sorted(set(now.values()), reverse=True)[: self.top]
            out += [("tag", seen, None, None, tag, count) for tag, count in now.items() if count >= largest[-1]]
        frame = pd.DataFrame(out, columns=["change", "seen", "draw", "payload", "tag", "count"])
        yield frame.astype({"seen": "int64", "count": "Int64"})

    def close(self) -> None:
        pass


def sample_changes(stream: DataFrame, row_id: str, tags: str, k: int = 100, seed: int = 666, top: int = 3, shards: int = SHARDS) -> DataFrame:
    """The stream of changes of the sample; see :class:`Sample`. Records without tags are dropped first."""
    columns = stream.columns
    drawn = tagged(stream, tags).select(
        priority(F.col(row_id), seed, columns).alias("draw"), row_text(columns).alias("payload"), F.col(tags).cast("array<string>").alias("tags")
    )
    dealt = drawn.withColumn("shard", F.pmod(F.xxhash64("draw", "payload"), F.lit(shards)))
    entered = dealt.groupBy("shard").transformWithStateInPandas(Shard(k), _ENTERED, "Append", "None")
    return entered.withColumn("all", F.lit(0)).groupBy("all").transformWithStateInPandas(Sample(k, top), CHANGES, "Append", "None")


def start_reservoir(
    stream: DataFrame, row_id: str, tags: str, folder: str, k: int = 100, seed: int = 666, top: int = 3,
    shards: int = SHARDS, interval: str | None = "5 seconds",
) -> StreamingQuery:
    """Start the query that keeps the sample; changes go below ``folder``, a folder for each micro-batch.

    These operators need the RocksDB state store, which the query is started with; the session's own
    setting stays. ``interval=None`` reads what is there and stops.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    writer = sample_changes(stream, row_id, tags, k, seed, top, shards).writeStream.foreachBatch(write)
    writer = writer.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return writer.start()
    finally:
        spark.conf.set(_PROVIDER, before)


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{CHANGES}, batch bigint").parquet(f"{folder}/changes")


def sample_now(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The sample, as rows of ``schema``: what has entered and not left."""
    sign = F.when(F.col("change") == "in", 1).otherwise(-1)
    held = _changes(spark, folder).where(F.col("change").isin("in", "out")).groupBy("draw", "payload").agg(F.sum(sign).alias("n"))
    copies = held.where("n > 0").select("payload", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return copies.select(F.from_json("payload", schema).alias("row")).select("row.*")


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """``(batch, seen, tag, count)`` after every micro-batch that changed the sample."""
    return _changes(spark, folder).where(F.col("change") == "tag").select("batch", "seen", "tag", "count")
