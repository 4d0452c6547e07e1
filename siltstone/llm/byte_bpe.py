"""Byte-level BPE through a sentencepiece model written straight from a vocabulary of ranks.

The model has one piece for each rank: its bytes, each mapped to a character of its own, with the
negative rank as score, so that sentencepiece merges the pair of the lowest rank first, the leftmost
on ties. It normalises nothing and adds nothing. A text is cut into pre-tokens by the vocabulary's
pattern, each is mapped to characters and encoded by itself, and ids become bytes again by the
inverse mapping. A pre-token that is in the vocabulary is that one id, as the ranks ask for.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .spans import array_slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Byte b is the character FIRST + b: 256 letters, none of them a space or sentencepiece's mark.
FIRST = 0x4E00
#: Pre-tokens whose ids a worker remembers; all are forgotten when there are more.
REMEMBERED = 400_000
#: Longer pre-tokens aren't remembered.
REMEMBERED_LENGTH = 64
RESULT = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"

_TO_CHARACTERS = {b: FIRST + b for b in range(256)}


def read_ranks(path: str = VOCABULARY) -> list[bytes]:
    """The byte strings of a rank file, in the order of their ranks, which have no gap."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError(f"{path}: the ranks have gaps")
    return [ranked[i] for i in range(len(ranked))]


def characters(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARACTERS)


# Protocol buffers: a field is its number and wire type, then a varint, four bytes, or a length and bytes.
def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def model_bytes(ranks: list[bytes]) -> bytes:
    """The serialised model; ids are ranks, and the unknown piece, which never occurs, comes last."""
    normal, unknown, bpe = 1, 2, 2
    parts = [
        _block(1, _block(1, characters(token).encode()) + _float(2, -float(rank)) + _number(3, normal))
        for rank, token in enumerate(ranks)
    ]
    parts.append(_block(1, _block(1, b"<unk>") + _float(2, 0.0) + _number(3, unknown)))
    # Trainer: model type, size, and the ids of the special pieces (begin, end and padding are absent).
    absent = (1 << 64) - 1
    trainer = _number(3, bpe) + _number(4, len(ranks) + 1) + _number(40, len(ranks))
    trainer += _number(41, absent) + _number(42, absent) + _number(43, absent)
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(parts) + _block(2, trainer) + _block(3, normalizer)


@dataclass
class Vocabulary:
    """What workers need: the byte strings by id, the serialised model and the pattern."""

    ranks: list[bytes]
    model: bytes
    pattern: str

    @cached_property
    def coder(self) -> Coder:
        """Made once in each worker process."""
        return Coder(self)


class Coder:
    """Encode and decode with a vocabulary; one for each worker process."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model)
        self.cut = regex.compile(vocabulary.pattern).findall
        self.tokens = vocabulary.ranks
        self.whole = {token: rank for rank, token in enumerate(vocabulary.ranks)}
        self.known: dict[str, list[int]] = {}

    def _ids(self, pre_token: str) -> list[int]:
        data = pre_token.encode()
        rank = self.whole.get(data)
        return [rank] if rank is not None else self.processor.encode(characters(data))

    def encode(self, text: str) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        ids: list[int] = []
        known = self.known
        for pre_token in self.cut(text):
            own = known.get(pre_token)
            if own is None:
                own = self._ids(pre_token)
                if len(pre_token) <= REMEMBERED_LENGTH:
                    known[pre_token] = own
            ids += own
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def load(path: str = VOCABULARY, pattern: str = PATTERN) -> Vocabulary:
    """Read a rank file on the driver, so that workers need no such file."""
    ranks = read_ranks(path)
    return Vocabulary(ranks, model_bytes(ranks), pattern)


def encode(spark: SparkSession, vocabulary: Vocabulary, text: Column) -> Column:
    """Ids of a text, an array of ints without special tokens; null counts as empty."""
    shared = spark.sparkContext.broadcast(vocabulary)

    def encoded(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value.coder
        for column in columns:
            yield pa.array([own.encode(text or "") for text in column.to_pylist()], pa.list_(pa.int32()))

    encoded.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encoded, "array<int>")(text)


def decode(spark: SparkSession, vocabulary: Vocabulary, ids: Column) -> Column:
    """Bytes of an array of ids; null counts as empty."""
    shared = spark.sparkContext.broadcast(vocabulary)

    def decoded(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value.coder
        for column in columns:
            yield pa.array([own.decode(row or []) for row in column.to_pylist()], pa.binary())

    decoded.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(decoded, "binary")(ids)


def round_trip(spark: SparkSession, vocabulary: Vocabulary, text: Column) -> Column:
    """Encode a text, decode the ids, and give their number and both digests."""
    shared = spark.sparkContext.broadcast(vocabulary)

    def digested(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value.coder
        names = [str(i) for i in range(len(own.tokens))]
        for column in columns:
            for piece in array_slices(column) if len(column) else [column]:
                rows = [own.encode(text or "") for text in piece.to_pylist()]
                sizes = pa.array(np.fromiter(map(len, rows), np.int64, len(rows)))
                ids = [hashlib.sha256(" ".join(map(names.__getitem__, row)).encode()).hexdigest() for row in rows]
                back = [hashlib.sha256(own.decode(row)).hexdigest() for row in rows]
                yield pa.StructArray.from_arrays(
                    [sizes, pa.array(ids, pa.string()), pa.array(back, pa.string())], names=["n_tokens", "ids_sha256", "decoded_sha256"]
                )

    digested.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(digested, RESULT)(text)
