"""Words and lines of many texts at once, as numpy arrays over the bytes of an Arrow column.

A span is a longest run of bytes that are no separator and belong to one text. Its hash is a
polynomial over the bytes, modulo 2**64 and mixed afterwards: equal spans have equal hashes
wherever they stand, and different spans differ but for chance (2**-64 a pair). All separators used
here are ASCII, so cutting bytes equals cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = bytes([0x20, *range(0x09, 0x0E)])
PIECE_BYTES = 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _power(base: int, length: int) -> np.ndarray:
    key = str(base)
    known = _powers.get(key)
    if known is None or len(known) < length:
        steps = np.full(max(length, PIECE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if length > 8 * PIECE_BYTES:
            return known  # a span this long is rare: don't hold its table
        _powers[key] = known
    return known[:length]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACES = byte_set(SPACE)
NEWLINE = byte_set(b"\n")
#: All ASCII that is neither letter nor digit; bytes of longer characters count as letters.
NOT_ALNUM = byte_set(bytes(b for b in range(128) if not chr(b).isalnum()))


@dataclass
class Spans:
    """Spans of several texts: byte positions, hashes, and where each text's spans begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool = False) -> Spans:
    """All spans of the texts; ``lower`` hashes A-Z as a-z."""
    values = _BYTE.copy()
    if lower:
        values[65:91] = values[97:123]
    starts, ends, hashes = [], [], []
    first, edges = 0, offsets[1:-1]
    while first < len(data):
        last = _cut(data, first, separators)
        piece = data[first:last]
        inside = ~separators[piece]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:]
        here = edges[np.searchsorted(edges, first, "right") : np.searchsorted(edges, last)] - first
        begin[here] = inside[here]
        end[here - 1] = inside[here - 1]
        s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
        if len(s):
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(values[piece] * _power(_BASE, len(piece)), out=sums[1:])
            hashed = (sums[e] - sums[s]) * _power(_BASE_INVERSE, len(piece))[s]
            hashes.append(mix(hashed + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            starts.append(s + first)
            ends.append(e + first)
        first = last
    if not starts:
        none = np.zeros(0, np.int64)
        return Spans(none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64))
    start = np.concatenate(starts)
    return Spans(start, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(start, offsets))


def _cut(data: np.ndarray, first: int, separators: np.ndarray) -> int:
    """End of a piece of about PIECE_BYTES that no span crosses."""
    last = first + PIECE_BYTES
    while last < len(data):
        tail = separators[data[last : last + 4096]]
        if tail.any():
            return last + int(tail.argmax())
        last += 4096
    return len(data)


def windows(words: Spans, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and offsets of each text's runs.

    A text with fewer words, but at least one, has the one run of all its words.
    """
    counts = np.diff(words.offsets)
    total = len(words.hashes)
    padded = np.concatenate([words.hashes, np.zeros(width, np.uint64)])
    factors = [np.uint64((0xA24BAED4963EE407 * (2 * k + 1) ** 3) % 2**64) for k in range(width)]
    whole = np.zeros(total, np.uint64)
    for k, factor in enumerate(factors):
        whole += padded[k : k + total] * factor
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(words.offsets[:-1] - offsets[:-1], made) + np.arange(offsets[-1])
    runs = whole[at]
    for text in np.flatnonzero((counts > 0) & (counts < width)):
        own = words.hashes[words.offsets[text] : words.offsets[text + 1]]
        runs[offsets[text]] = (own * np.array(factors[: len(own)])).sum() ^ np.uint64(len(own))
    return mix(runs), offsets


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each text's values; 0 where there are none."""
    totals = np.concatenate([[0], np.cumsum(values)])
    return totals[offsets[1:]] - totals[offsets[:-1]]


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterable[pa.RecordBatch]:
    """Cut Arrow batches so that one holds about ``most`` bytes of text, or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(first, last - first)
            first = last


def array_slices(column: pa.Array, most: int = 8 << 20) -> Iterable[pa.Array]:
    """The same for a single column."""
    for batch in slices([pa.RecordBatch.from_arrays([column], ["text"])], "text", most):
        yield batch.column(0)
