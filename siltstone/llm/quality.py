"""Quality rules: counts of a text, and a calibrated classifier with fixed thresholds.

The classifier is a logistic regression over the frequencies of hashed words, pairs and triples of
neighbouring words, and runs of three characters, trained on labelled rows; its scores become probabilities by a logistic curve fitted to
labelled rows that the regression didn't see. Counts and scores are made together, in Arrow batches.
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
from .spans import NEWLINE, SPACES, Spans, array_slices, byte_set, mix, spans, sums, texts, windows

BITS = 14
PLACES = 1 << BITS
#: Neighbouring words in an n-gram, and characters in a run.
ORDERS = (1, 2, 3)
RUN = 3
#: Added to the number of n-grams of words and of runs: frequencies of short texts shrink towards 0.
SMOOTH = 20, 100
#: Tables of the model, in the order of ``_places``.
TABLES = len(ORDERS) + 1
#: Most labelled rows that are used for training and calibration.
MAX_ROWS = 8_000
#: Most numbers of their features that are held in memory, two a feature; the rest is in a temporary file.
HELD_NUMBERS = 60_000_000
#: Every fourth row of the sample calibrates.
CALIBRATION = 4
#: Rows whose features are handled at a time, and about as many features at most.
CHUNK_ROWS = 500
CHUNK_FEATURES = 4_000_000
#: Bytes of text that a worker handles at a time.
SLICE_BYTES = 4 << 20

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: Fixed on the side of keeping: clean text of a few words can look odd.
MIN_PROBABILITY = 0.1
SYMBOLS = byte_set(b"#*$%&|<>")
WINDOW = 5

RESULT = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "base_failed:boolean,probability:double,kept:boolean>"
)


@dataclass
class Model:
    """Weights of the n-grams of words by order, weights of the runs, bias; slope and shift of the calibration."""

    words: np.ndarray
    runs: np.ndarray
    bias: float
    slope: float
    shift: float


def _owners(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _joined(values: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` neighbours within a text, and offsets of each text's runs."""
    made = np.maximum(np.diff(offsets) - width + 1, 0)
    cuts = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(offsets[:-1] - cuts[:-1], made) + np.arange(cuts[-1])
    runs = values[at]
    for k in range(1, width):
        runs = mix(runs) + values[at + k]
    return mix(runs), cuts


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every character as one number, and offsets of each text's characters."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    codes = data[starts].astype(np.uint64)
    wide = np.flatnonzero(codes >= 0xC0)
    ends = np.append(starts[1:], len(data))[wide]
    for k in range(1, 4):
        inside = wide[starts[wide] + k < ends]
        codes[inside] |= data[starts[inside] + k].astype(np.uint64) << np.uint64(8 * k)
    return codes, np.searchsorted(starts, offsets)


def _places(data: np.ndarray, offsets: np.ndarray, words: Spans) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Places of the n-grams of words by order, then of the runs of characters; each with offsets and smoothing."""
    shift = np.uint64(64 - BITS)
    for order in ORDERS:
        hashes, cuts = (words.hashes, words.offsets) if order == 1 else _joined(words.hashes, words.offsets, order)
        yield (hashes >> shift).astype(np.int64), cuts, SMOOTH[0]
    runs, cuts = _joined(*_characters(data, offsets), RUN)
    yield (runs >> shift).astype(np.int64), cuts, SMOOTH[1]


def counts(data: np.ndarray, offsets: np.ndarray, words: Spans) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n_words = np.diff(words.offsets)
    characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    per_word = characters[words.ends] - characters[words.starts]

    lines = spans(data, offsets, NEWLINE)
    begun = np.searchsorted(words.starts, lines.starts), np.searchsorted(words.starts, lines.ends)
    with_word = np.flatnonzero(begun[1] > begun[0])
    line_owner = lines.owners()[with_word]
    distinct = _unique_pairs(line_owner, lines.hashes[with_word])[0]
    n_lines = np.bincount(line_owner, minlength=len(n_words))

    runs, run_offsets = windows(words, WINDOW)
    owner = _owners(run_offsets)
    _, inverse, times = _unique_pairs(owner, runs, inverse=True)
    # A window found twice covers its words: +1 where it begins, -1 behind it.
    at = np.arange(len(runs)) - run_offsets[owner] + words.offsets[owner]
    again = at[(times[inverse] > 1) & (n_words[owner] >= WINDOW)]
    edges = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.subtract.at(edges, again + WINDOW, 1)
    covered = np.cumsum(edges)[:-1] > 0
    return {
        "n_words": n_words,
        "word_chars": sums(per_word, words.offsets),
        "n_symbols": sums(SYMBOLS[data], offsets),
        "n_dup_lines": n_lines - np.bincount(distinct, minlength=len(n_words)),
        "n_repeat_words": sums(covered, words.offsets),
    }


def _unique_pairs(owner: np.ndarray, hashes: np.ndarray, inverse: bool = False) -> tuple:
    """Owner of each distinct (owner, hash); with ``inverse`` also which one each row is, and counts."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    if not inverse:
        return (owner[new],)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return owner[new], which, np.bincount(which) if len(which) else np.zeros(0, np.int64)


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35.0, 35.0)))


def _frequencies(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places with their frequency for each text, table after table."""
    data, offsets = texts(column)
    tables = list(_places(data, offsets, spans(data, offsets, SPACES)))
    found = []
    for text in range(len(column)):
        places, values = [], []
        for number, (all_places, cuts, smooth) in enumerate(tables):
            own, times = np.unique(all_places[cuts[text] : cuts[text + 1]], return_counts=True)
            places.append(own + number * PLACES)
            values.append(times / (cuts[text + 1] - cuts[text] + smooth))
        found.append((np.concatenate(places).astype(np.int32), np.concatenate(values).astype(np.float32)))
    return found


class _Chunks:
    """Features of the training rows, in chunks of neighbouring rows."""

    def __init__(self, held_numbers: int) -> None:
        self.parts = Held(held_numbers)
        self.rows: list[tuple[np.ndarray, np.ndarray]] = []
        self.features = 0

    def add(self, row: tuple[np.ndarray, np.ndarray]) -> None:
        self.rows.append(row)
        self.features += len(row[0])
        if len(self.rows) >= CHUNK_ROWS or self.features >= CHUNK_FEATURES:
            self.close()

    def close(self) -> None:
        if self.rows:
            lengths = np.array([len(places) for places, _ in self.rows])
            self.parts.add(lengths, np.concatenate([p for p, _ in self.rows]), np.concatenate([v for _, v in self.rows]))
        self.rows, self.features = [], 0

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        start = 0
        for lengths, places, values in self.parts:
            yield start, lengths, places, values
            start += len(lengths)


def _fit(y: np.ndarray, rows: _Chunks | list[tuple[np.ndarray, np.ndarray]], steps: int = 120, ridge: float = 1e-3) -> Model:
    """Regression by Adam over all rows at a time, on features scaled to unit deviation."""
    held = np.arange(len(y)) % CALIBRATION == CALIBRATION - 1
    if held.all() or not held.any():
        held[:] = False
    chunks = rows
    if not isinstance(rows, _Chunks):
        chunks = _Chunks(HELD_NUMBERS)
        for row in rows:
            chunks.add(row)
        chunks.close()
    size = TABLES * PLACES
    mean = sum(np.bincount(places, values, size) for _, _, places, values in chunks) / len(y)
    square = sum(np.bincount(places, values * values, size) for _, _, places, values in chunks) / len(y)
    scale = 1.0 / (np.sqrt(np.maximum(square - mean**2, 0)) + 1e-4)
    learn = np.where(held, 0.0, 1.0)
    w, bias = np.zeros(size), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)

    def step_over(w: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
        """Margins of all rows, and the slope of the loss."""
        scaled, margins, slope = w * scale, np.zeros(len(y)), np.zeros(size + 1)
        for start, lengths, places, values in chunks:
            own = slice(start, start + len(lengths))
            owner = np.repeat(np.arange(len(lengths)), lengths)
            margins[own] = np.bincount(owner, values * scaled[places], len(lengths)) + bias
            error = learn[own] * (_sigmoid(margins[own]) - y[own]) / max(1.0, learn.sum())
            slope[:-1] += np.bincount(places, values * error[owner], size)
            slope[-1] += error.sum()
        slope[:-1] = slope[:-1] * scale + ridge * w
        return margins, slope

    for step in range(1, steps + 1):
        _, slope = step_over(w, bias)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    margins, _ = step_over(w, bias)
    use = held if held.any() else ~held
    slope, shift = _calibrate(margins[use], y[use])
    w = (w * scale).astype(np.float32)
    return Model(w[:-PLACES], w[-PLACES:], float(bias), slope, shift)


def _calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of ``y`` over the margins, by Newton steps.

    Targets are drawn in by one row on either side, so that separable rows have a finite answer.
    """
    yes, no = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (yes + 1) / (yes + 2), 1 / (no + 2))
    x, at = np.stack([margins, np.ones(len(y))]), np.array([1.0, 0.0])
    for _ in range(30):
        p = _sigmoid(at @ x)
        curve = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        at = at - np.clip(np.linalg.solve(curve, x @ (p - target) + 1e-6 * at), -2, 2)
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS, held_numbers: int = HELD_NUMBERS) -> Model:
    """Train on at most ``max_rows`` labelled documents; one task trains, no text reaches the driver.

    Every row of the sample is used, however long: features beyond ``held_numbers`` are in a temporary
    file of the task. Without labelled rows every probability is 0.5, which keeps.
    """

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, y = _Chunks(held_numbers), []
        for batch in batches:
            y += batch.column("y").to_pylist()
            for piece in array_slices(batch.column("text"), SLICE_BYTES):
                for found in _frequencies(piece):
                    chunks.add(found)
        chunks.close()
        if y:
            model = _fit(np.array(y), chunks)
            yield pa.RecordBatch.from_pydict(
                {"words": [model.words.tobytes()], "runs": [model.runs.tobytes()], "rest": [[model.bias, model.slope, model.shift]]}
            )

    found = sample(docs, labels, label, max_rows).mapInArrow(train, "words binary, runs binary, rest array<double>").collect()
    if not found:
        return Model(np.zeros(len(ORDERS) * PLACES, np.float32), np.zeros(PLACES, np.float32), 0.0, 1.0, 0.0)
    row = found[0]
    return Model(np.frombuffer(row.words, np.float32), np.frombuffer(row.runs, np.float32), *row.rest)


def _judged(column: pa.Array, model: Model) -> pa.StructArray:
    data, offsets = texts(column)
    words = spans(data, offsets, SPACES)
    base = counts(data, offsets, words)
    margins = np.full(len(column), model.bias)
    weights = [*model.words.reshape(-1, PLACES), model.runs]
    for own, (places, cuts, smooth) in zip(weights, _places(data, offsets, words)):
        margins += sums(own[places].astype(np.float64), cuts) / (np.diff(cuts) + smooth)
    probability = _sigmoid(model.slope * margins + model.shift)
    failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEATED_PERCENT * base["n_words"])
    columns = {name: pa.array(values, pa.int64()) for name, values in base.items()}
    columns |= {"base_failed": pa.array(failed), "probability": pa.array(probability)}
    columns["kept"] = pa.array(~failed & (probability >= MIN_PROBABILITY))
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def judge(spark: SparkSession, model: Model, text: Column) -> Column:
    """Counts, probability of good quality and verdict of a text; null counts as no words."""
    shared: Broadcast[Model] = spark.sparkContext.broadcast(model)

    def judged(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [_judged(piece, shared.value) for piece in array_slices(column, SLICE_BYTES)]
            yield pa.concat_arrays(parts) if parts else _judged(column, shared.value)

    judged.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(judged, RESULT)(text)
