"""Exact counts of the most frequent keys without a shuffle of every key.

A task reads its rows into a Misra-Gries summary of at most ``capacity`` counters: where there are more,
the largest count that doesn't fit is taken off all of them, and what falls to zero goes. A counter is
then too low by at most the sum of what was taken off, which is also the most that a key without a
counter can have, and is at most rows / (capacity + 1). Summaries are added up, and so are their errors.

A second pass counts the candidates exactly: the keys that can reach the answer within the error. The
error proves that no other key can. Where it is too large to prove that, the summaries are made
anew with more counters, and at last all keys are counted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_ROWS, written
from .exploration import key_counts, words

CAPACITY = 4_096
#: Each attempt has so many times the counters of the one before.
GROWTH = 8
ATTEMPTS = 3


@dataclass(frozen=True)
class Heavy:
    """``rows`` are exact counts (key, count) of the answer; ``error`` is what proved them, None where all keys were counted."""

    rows: DataFrame
    error: int | None
    candidates: int


class Summary:
    """Counters of one task."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.error = 0
        self.parts: list[pa.Table] = []
        self.held = 0

    def add(self, keys: pa.Array) -> None:
        found = keys.value_counts()
        self.parts.append(pa.table({"key": found.field("values"), "n": found.field("counts")}))
        self.held += len(found)
        if self.held > 8 * self.capacity:
            self.reduce()

    def reduce(self) -> pa.Table:
        """Add the parts up and take off what doesn't fit."""
        whole = pa.concat_tables(self.parts).group_by("key").aggregate([("n", "sum")]).rename_columns(["key", "n"])
        if whole.num_rows > self.capacity:
            counts = whole.column("n").to_numpy()
            least = int(np.partition(counts, -self.capacity - 1)[-self.capacity - 1])
            self.error += least
            kept = np.flatnonzero(counts > least)
            whole = pa.table({"key": whole.column("key").take(pa.array(kept)), "n": pa.array(counts[kept] - least)})
        self.parts, self.held = [whole], whole.num_rows
        return whole


def summaries(df: DataFrame, key: str, capacity: int) -> DataFrame:
    """``key``, ``n`` of the counters of each task, and a row with its ``error``; a null key is a key."""
    kind = dict(df.dtypes)[key]

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Summary(capacity)
        for batch in batches:
            own.add(batch.column(0))
        if own.parts:
            found = own.reduce().combine_chunks()
            error = pa.array([None] * found.num_rows + [own.error], pa.int64())
            keys = pa.concat_arrays([*found.column("key").chunks, pa.nulls(1, found.schema.field("key").type)])
            counts = pa.concat_arrays([*found.column("n").cast(pa.int64()).chunks, pa.nulls(1, pa.int64())])
            yield pa.RecordBatch.from_arrays([keys, counts, error], names=["key", "n", "error"])

    return df.select(F.col(key).alias("key")).mapInArrow(counted, f"key {kind}, n bigint, error bigint")


def _added(df: DataFrame, key: str, capacity: int) -> tuple[DataFrame, int]:
    """Least counts of the keys with a counter, and the error of all tasks."""
    made = written(summaries(df, key, capacity), "summaries")
    lower = made.where(F.col("error").isNull()).groupBy("key").agg(F.sum("n").alias("lower"))
    return written(lower, "least-counts"), made.agg(F.sum("error")).first()[0] or 0


def _counted(df: DataFrame, key: str, candidates: DataFrame, error: int) -> Heavy:
    n = candidates.count()
    chosen = candidates.select(F.col("key").alias("_chosen"))
    if n <= BROADCAST_MAX_ROWS:
        chosen = F.broadcast(chosen)
    rows = df.select(key).join(chosen, F.col(key).eqNullSafe(F.col("_chosen")), "left_semi")
    return Heavy(key_counts(rows, key), error, n)


def heavy_top(df: DataFrame, key: str, n: int, capacity: int = CAPACITY, attempts: int = ATTEMPTS) -> Heavy:
    """The ``n`` most frequent keys with their counts, in order; ties by key, a null key first.

    The n largest least counts bound the answer's counts from below: a key whose least count and the
    error stay under the smallest of them can't be in it.
    """
    for _ in range(attempts):
        lower, error = _added(df, key, capacity)
        least = lower.orderBy(F.desc("lower")).limit(n).agg(F.min("lower"), F.count("*")).first()
        bound = least[0] if least[1] == n else 0
        if error == 0 or error < bound:
            found = _counted(df, key, lower.where(F.col("lower") + error >= bound), error)
            return Heavy(_first(found.rows, key, n), error, found.candidates)
        capacity *= GROWTH
    return Heavy(_first(key_counts(df, key), key, n), None, lower.count())


def _first(counts: DataFrame, key: str, n: int) -> DataFrame:
    return counts.orderBy(F.desc("count"), F.asc(key)).limit(n)


def heavy_keys(df: DataFrame, key: str, n: int, capacity: int = CAPACITY, attempts: int = ATTEMPTS) -> Heavy:
    """Keys with more than ``n`` rows; an error of at most n proves that no key without a counter has them."""
    for _ in range(attempts):
        lower, error = _added(df, key, capacity)
        if error <= n:
            found = _counted(df, key, lower.where(F.col("lower") + error > n), error)
            return Heavy(found.rows.where(F.col("count") > n), error, found.candidates)
        capacity *= GROWTH
    return Heavy(key_counts(df, key).where(F.col("count") > n), None, lower.count())


def heavy_words(df: DataFrame, text: str, stop_words, n: int, capacity: int = CAPACITY) -> Heavy:
    """The ``n`` most frequent words of texts, as ``exploration.top_words`` counts them."""
    return heavy_top(words(df, text, stop_words), "word", n, capacity)
