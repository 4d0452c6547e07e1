"""Labelled rows for the classifiers: folds by identifier and a bounded sample."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_ROWS, written


def fold(id_column: str | Column, folds: int) -> Column:
    """CRC-32 of the identifier's text, modulo ``folds``; a null identifier counts as empty text."""
    key = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.pmod(F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")), F.lit(folds))


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``y`` and ``text`` of at most ``max_rows`` labelled documents, in one partition ordered by a hash.

    Chosen are the identifiers with the smallest hashes among those that have a label and a document.
    Labels are looked up in the documents by rising shares of the hashes, so only as many are tried as
    needed; the chosen identifiers, at most ``max_rows``, are broadcast, and texts that weren't chosen
    never move. Rows with a null label or identifier aren't used. An identifier with several labels
    counts with the smallest, one with several texts with that of the smallest hash (null texts last),
    so an identifier that many rows share is one row.
    """
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    known = written(
        labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.min(F.col(label).cast("double")).alias("y"))
        .withColumn("draw", draw),
        "labels",
    )
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).where(F.col("id").isNotNull())
    share = 1.1 * max_rows / max(1, known.count())
    while True:
        tried = known.where(F.col("draw") < share) if share < 1 else known
        if tried.count() <= BROADCAST_MAX_ROWS:
            tried = F.broadcast(tried)
        present = rows.select("id").join(tried, "id").groupBy("id").agg(F.min("y").alias("y"), F.min("draw").alias("draw"))
        chosen = written(present.orderBy("draw", "id").limit(max_rows), "sample")
        if share >= 1 or chosen.count() >= max_rows:
            break
        share *= 4
    text = F.min(F.struct(F.col("text").isNull().alias("missing"), F.xxhash64("text").alias("hash"), "text"))["text"]
    return (
        rows.join(F.broadcast(chosen), "id")
        .groupBy("id")
        .agg(F.min("draw").alias("draw"), F.min("y").alias("y"), text.alias("text"))
        .repartition(1)
        .sortWithinPartitions("draw", "id")
        .select("y", "text")
    )


class Held:
    """Tuples of arrays to read again and again, in their order.

    Up to ``most`` numbers stay in memory; what doesn't fit is in a temporary file that ends with the task.
    """

    def __init__(self, most: int) -> None:
        self.room = most
        self.parts: list[tuple[np.ndarray, ...] | list[tuple[int, int, np.dtype]]] = []
        self.file = None
        self.end = 0

    def __len__(self) -> int:
        return len(self.parts)

    def add(self, *arrays: np.ndarray) -> None:
        size = sum(map(len, arrays))
        if size <= self.room:
            self.room -= size
            self.parts.append(arrays)
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile(buffering=0)
        places = []
        for array in arrays:
            self.file.seek(self.end)
            left = memoryview(array.tobytes())
            places.append((self.end, len(left), array.dtype))
            self.end += len(left)
            while left:
                left = left[self.file.write(left) :]
        self.parts.append(places)

    def _read(self, start: int, size: int, kind: np.dtype) -> np.ndarray:
        found = bytearray()
        while len(found) < size:
            found += os.pread(self.file.fileno(), size - len(found), start + len(found))
        return np.frombuffer(found, kind)

    def __iter__(self) -> Iterator[tuple[np.ndarray, ...]]:
        for part in self.parts:
            yield part if isinstance(part, tuple) else tuple(self._read(*place) for place in part)
