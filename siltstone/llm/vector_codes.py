"""Vector code compression: a code of one byte for each part of a vector, by small codebooks.

Components become integers, vectors are cut into equal consecutive parts, and each part position has a
codebook of at most ``ENTRIES`` entries. Rounds assign every part to its nearest entry and replace each
entry by the mean of its parts, all in integers, so the result doesn't depend on the order of rows.

The nearest entry is found through memoised grid cells. A part's coarse cell is its components divided
by the cell's width; it spans a box. An entry whose least distance to the box is above another entry's
greatest distance can't be nearest anywhere in it, so the cell remembers the entries that remain, and
only those are evaluated exactly. A worker remembers a bounded number of cells and forgets them all
when there are more, which costs time and no result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_ROWS, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Components are integers floor(SCALE * x).
SCALE = 256
#: Width of a cell in every direction, in those integers.
CELL = 16
#: Cells that a worker remembers for one part position.
REMEMBERED = 20_000
#: Rows that a worker handles at a time.
SLICE_ROWS = 4_096
#: Greatest magnitude of an integer component: sums of squares and of rows then fit in 64 bits.
LIMIT = 1 << 25
#: Copies of a label's sum that its rows are dealt over, where the sums are too many to broadcast.
SALTS = 16


def _keys(cells: np.ndarray) -> np.ndarray:
    """One value for each different row: a number in mixed radix where 62 bits are enough, else its bytes."""
    low = cells.min(axis=0)
    spans = (cells.max(axis=0) - low + 1).tolist()
    if math.prod(spans) >= 1 << 62:
        return cells.view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
    keys = np.zeros(len(cells), np.int64)
    for place, span in enumerate(spans):
        keys = keys * span + (cells[:, place] - low[place])
    return keys


class Cells:
    """Entries of one codebook that remain in each cell seen so far."""

    def __init__(self, entries: np.ndarray, cell: int = CELL, remembered: int = REMEMBERED) -> None:
        self.entries, self.cell, self.remembered = entries, cell, remembered
        self.evaluated = 0
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.remaining = np.zeros((0, len(self.entries)), np.int16)
        self.sizes = np.zeros(0, np.int64)

    def _bounded(self, cells: np.ndarray) -> np.ndarray:
        """For each cell and entry, whether the entry remains in the cell's box."""
        low = (cells * self.cell)[:, None, :]
        high = low + self.cell - 1
        below, above = low - self.entries, self.entries - high
        nearest = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
        farthest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
        return nearest <= farthest.min(axis=1, keepdims=True)

    def _slots(self, parts: np.ndarray) -> np.ndarray:
        cells = np.ascontiguousarray(parts // self.cell)
        _, first, inverse = np.unique(_keys(cells), return_index=True, return_inverse=True)
        names = [cell.tobytes() for cell in cells[first]]
        if len(self.place) + len(names) > max(self.remembered, len(names)):
            self._forget()
        new = [i for i, name in enumerate(names) if name not in self.place]
        if new:
            keep = self._bounded(cells[first[new]])
            # Remaining entries first, each in its order: ties go to the lower index.
            order = np.argsort(~keep, axis=1, kind="stable").astype(np.int16)
            for slot, i in enumerate(new, len(self.sizes)):
                self.place[names[i]] = slot
            self.remaining = np.concatenate([self.remaining, order])
            self.sizes = np.concatenate([self.sizes, keep.sum(axis=1)])
        return np.array([self.place[name] for name in names])[inverse.ravel()]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each part, the lowest on ties, and the squared distance."""
        code, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        slots = self._slots(parts)
        sizes = self.sizes[slots]
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            candidates = self.remaining[slots[rows], :size]
            distance = ((parts[rows, None, :] - self.entries[candidates]) ** 2).sum(axis=2)
            best = distance.argmin(axis=1)
            code[rows] = candidates[np.arange(len(rows)), best]
            error[rows] = distance[np.arange(len(rows)), best]
            self.evaluated += distance.size
        return code, error


@dataclass
class Codes:
    """Result of ``compress``: rows vec_id, label, code, error, label_error, and the final codebooks."""

    rows: DataFrame
    books: list[list[list[int]]]

    @property
    def digest(self) -> str:
        """Hash of all components by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for book in self.books for entry in book for x in entry).encode()).hexdigest()


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, parts: int) -> DataFrame:
    """``vec_id``, ``label`` and integer ``vector`` of rows whose components are all present and finite.

    Vectors have the commonest length that ``parts`` divides (the greater on ties); rows of another
    length have no such parts and are left out like null vectors.
    """
    component = F.col("given")
    whole = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = written(
        vectors.select(
            F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("given")
        )
        .where(component.isNotNull() & (F.size(component) > 0) & (F.size(component) % parts == 0) & whole)
        .select("vec_id", "label", F.transform(component, lambda x: F.floor(x * SCALE)).alias("vector")),
        "vectors",
    )
    sizes = kept.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("vector", F.abs))).alias("most"))
    best = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return kept
    if best.most > LIMIT:
        raise ValueError(f"components beyond {LIMIT // SCALE} have no exact code")
    return kept.where(F.size("vector") == best.size)


def first_books(kept: DataFrame, parts: int, entries: int) -> list[list[list[int]]]:
    """The parts of the vectors with the smallest identifiers; null identifiers come last, ties go by the vector."""
    rows = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    if not rows:
        return [[] for _ in range(parts)]
    width = len(rows[0].vector) // parts
    return [[row.vector[p * width : (p + 1) * width] for row in rows] for p in range(parts)]


def _batches(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of rows with their vectors as rows x parts x width."""
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            piece = batch.slice(first, SLICE_ROWS)
            values = piece.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield piece, values.reshape(piece.num_rows, parts, -1)


def improved(kept: DataFrame, books: list[list[list[int]]], cell: int = CELL) -> list[list[list[int]]]:
    """One round: each entry becomes the floored mean of its parts; an entry without parts stays.

    A task sends one row for each entry that it used, so rows never move.
    """
    parts = len(books)
    shared = kept.sparkSession.sparkContext.broadcast(np.array(books, np.int64))

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book, cell) for book in shared.value]
        sums, counts = np.zeros_like(shared.value), np.zeros(shared.value.shape[:2], np.int64)
        for _, vectors in _batches(batches, parts):
            for p in range(parts):
                code, _ = cells[p].nearest(vectors[:, p])
                counts[p] += np.bincount(code, minlength=counts.shape[1])
                np.add.at(sums[p], code, vectors[:, p])
        part, entry = np.nonzero(counts)
        place = np.tile(np.arange(sums.shape[2]), len(part))
        each = np.repeat(np.arange(len(part)), sums.shape[2])
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(part[each].astype(np.int32)),
                "entry": pa.array(entry[each].astype(np.int32)),
                "place": pa.array(place.astype(np.int32)),
                "total": pa.array(sums[part, entry].ravel()),
                "n": pa.array(counts[part, entry][each]),
            }
        )

    made = kept.select("vector").mapInArrow(summed, "part int, entry int, place int, total bigint, n bigint")
    totals = made.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    after = [[list(entry) for entry in book] for book in books]
    for row in totals.collect():
        after[row.part][row.entry][row.place] = row.total // row.n
    shared.unpersist()
    return after


def coded(kept: DataFrame, books: list[list[list[int]]], cell: int = CELL) -> DataFrame:
    """vec_id, label, code and error of every row."""
    parts = len(books)
    shared = kept.sparkSession.sparkContext.broadcast(np.array(books, np.int64))

    def assigned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book, cell) for book in shared.value]
        for batch, vectors in _batches(batches, parts):
            codes, error = np.zeros((len(vectors), parts), np.uint8), np.zeros(len(vectors), np.int64)
            for p in range(parts):
                code, distance = cells[p].nearest(vectors[:, p])
                codes[:, p] = code
                error += distance
            text = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([text[i * 2 * parts : (i + 1) * 2 * parts] for i in range(len(vectors))], pa.string()),
                    pa.array(error),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = dict(kept.dtypes)
    return kept.mapInArrow(assigned, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def with_label_error(rows: DataFrame) -> DataFrame:
    """Add the errors summed over equal labels, nulls together.

    The sums are one row a label, combined before the shuffle. They are broadcast up to
    ``BROADCAST_MAX_ROWS`` labels; beyond, a label's rows are dealt over ``SALTS`` tasks.
    """
    sums = written(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    if sums.count() <= BROADCAST_MAX_ROWS:
        small = F.broadcast(sums.withColumnRenamed("label", "of"))
        return rows.join(small, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    salted = sums.withColumnRenamed("label", "of").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    same = F.col("label").eqNullSafe(F.col("of")) & (F.col("own") == F.col("salt"))
    return dealt.join(salted, same).drop("of", "salt", "own")


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    cell: int = CELL,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> Codes:
    """Codebooks and codes of all vectors.

    Null vectors, and vectors with a null or non-finite component, are dropped; see ``usable`` for
    other lengths. Repeated rows and null or repeated identifiers are coded each for themselves, equal
    distances go to the lower entry. Fewer than ``entries`` rows make smaller codebooks. Other columns
    are ignored. An empty table has an empty result and empty codebooks. Integer components beyond
    ``LIMIT`` are refused, because their squares don't add up in 64 bits.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte")
    kept = usable(vectors, id_column, vector_column, label_column, parts)
    books = first_books(kept, parts, entries)
    if books[0]:
        for _ in range(rounds):
            books = improved(kept, books, cell)
    return Codes(with_label_error(written(coded(kept, books, cell), "codes")), books)
