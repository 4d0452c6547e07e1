"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct words, the first bytes of longer words as their stems, pairs of
neighbours, and pairs with one or two words between them, hashed to 2**24 places. Words are runs of letters and digits, lower-cased; a text with
none has the bias alone. Training reads a bounded sample once per pass, row by row, with a learning
rate per coordinate; the L1 term leaves a few thousand weights, which are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .labelled import Held, sample
from .spans import NOT_ALNUM, array_slices, mix, spans, texts

BITS = 24
GAPS = (1, 2, 3)
#: Bytes of the stems of longer words.
STEMS = (4, 6)
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
#: Most labelled rows that are used for training.
MAX_ROWS = 12_000
#: Most features of the training rows that are held in memory; the rest is in a temporary file.
HELD_FEATURES = 60_000_000
#: Bias of a model that learnt from no row: its scores are next to 0.
NOTHING_LEARNT = -35.0
#: Bytes of text that a worker handles at a time.
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 1.5
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0
    passes: int = 4


@dataclass
class Weights:
    """Places with a weight, in order, and the bias."""

    places: np.ndarray
    values: np.ndarray
    bias: float


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Place and text number of every feature, repeats included."""
    data, offsets = texts(column)
    words = spans(data, offsets, NOT_ALNUM, lower=True)
    owners, hashes = words.owners(), words.hashes
    shift = np.uint64(64 - BITS)
    places, owner = [hashes >> shift], [owners]
    for length in STEMS:
        long = np.flatnonzero(words.ends - words.starts > length)
        stem = np.full(len(long), length, np.uint64)
        for k in range(length):
            stem = stem * np.uint64(0x100000001B3) + _LOWER[data[words.starts[long] + k]]
        places.append(mix(stem) >> shift)
        owner.append(owners[long])
    for gap in GAPS:
        same = np.flatnonzero(owners[gap:] == owners[:-gap]) if len(owners) > gap else np.zeros(0, np.int64)
        pair = hashes[same] * np.uint64(0x9E3779B97F4A7C15) + hashes[same + gap] * np.uint64(2 * gap + 0xC2B2AE3D27D4EB4F)
        places.append(mix(pair) >> shift)
        owner.append(owners[same])
    return np.concatenate(places).astype(np.int64), np.concatenate(owner)


def _distinct(column: pa.Array) -> Iterable[np.ndarray]:
    """Distinct places of each text."""
    places, owners = features(column)
    order = np.argsort(owners, kind="stable")
    places, cuts = places[order], np.searchsorted(owners[order], np.arange(len(column) + 1))
    for text in range(len(column)):
        yield np.unique(places[cuts[text] : cuts[text + 1]]).astype(np.int32)


def _sigmoid(margin: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35.0, 35.0)))


def _fit(marks: list[float], rows: Held, how: Ftrl) -> Weights:
    z, n = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)
    bias_z = bias_n = 0.0

    def weight(z, n, l1):
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2), 0.0)

    for _ in range(how.passes):
        for y, (places,) in zip(marks, rows):
            own_z, own_n = z[places], n[places]
            w, b = weight(own_z, own_n, how.l1), float(weight(bias_z, bias_n, 0.0))
            g = float(_sigmoid(w.sum() + b)) - y
            sigma = (np.sqrt(own_n + g * g) - np.sqrt(own_n)) / how.alpha
            z[places] = own_z + g - sigma * w
            n[places] = own_n + g * g
            bias_sigma = (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / how.alpha
            bias_z, bias_n = bias_z + g - bias_sigma * b, bias_n + g * g
    places = np.flatnonzero(np.abs(z) > how.l1)
    values = weight(z[places], n[places], how.l1)
    return Weights(places.astype(np.int32), values.astype(np.float32), float(weight(bias_z, bias_n, 0.0)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    max_rows: int = MAX_ROWS,
    how: Ftrl = Ftrl(),
    held_features: int = HELD_FEATURES,
) -> Weights:
    """Train on at most ``max_rows`` labelled documents; one task trains, no text reaches the driver.

    Every row of the sample is used, however long: features beyond ``held_features`` are in a temporary
    file of the task. Null texts count as empty; for null and repeated identifiers, labels without a
    document and documents with several texts see ``sample``. Other columns are ignored. Without any
    usable labelled row there are no weights, and every text scores next to 0.
    """

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, rows = [], Held(held_features)
        for batch in batches:
            marks += batch.column("y").to_pylist()
            for piece in array_slices(batch.column("text"), SLICE_BYTES):
                for places in _distinct(piece):
                    rows.add(places)
        if marks:
            found = _fit(marks, rows, how)
            yield pa.RecordBatch.from_pydict({"places": [found.places.tobytes()], "weights": [found.values.tobytes()], "bias": [found.bias]})

    rows = sample(docs, labels, label, max_rows).mapInArrow(train, "places binary, weights binary, bias double").collect()
    if not rows:
        return Weights(np.zeros(0, np.int32), np.zeros(0, np.float32), NOTHING_LEARNT)
    row = rows[0]
    return Weights(np.frombuffer(row.places, np.int32), np.frombuffer(row.weights, np.float32), row.bias)


def _scores(column: pa.Array, weights: Weights, used: np.ndarray) -> np.ndarray:
    places, owners = features(column)
    hit = used[places]
    pairs = np.unique(owners[hit] * (1 << BITS) + places[hit])
    values = weights.values[np.searchsorted(weights.places, pairs & ((1 << BITS) - 1))]
    margins = np.bincount(pairs >> BITS, weights=values, minlength=len(column)) + weights.bias
    return _sigmoid(margins)


def score(spark: SparkSession, weights: Weights, text: Column) -> Column:
    """Score from 0 to 1 of a text, read whole; null counts as empty, and an empty text has the bias alone."""
    shared: Broadcast[Weights] = spark.sparkContext.broadcast(weights)

    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        used = np.zeros(1 << BITS, bool)
        used[shared.value.places] = True
        for column in columns:
            parts = [_scores(piece, shared.value, used) for piece in array_slices(column, SLICE_BYTES)]
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    scores.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scores, "double")(text)
