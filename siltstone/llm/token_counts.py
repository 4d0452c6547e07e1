"""Token counts of the sections of a document, from one encoding of the whole document.

A section's tokens aren't those of its text alone, because a token may cross a boundary. The document
is encoded once, the spans of its tokens are joined with the spans of its sections, and a token that
crosses boundaries is allocated by one of three rules:

``first``  the section that holds its first byte (default)
``last``   the section that holds its last byte
``most``   the section that holds most of its bytes, the earlier one on ties

Sections partition the text, so the counts of a document add up to the tokens of its whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import Vocabulary
from .spans import array_slices, slices, texts

RULES = ("first", "last", "most")


def line_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the lines of a text's bytes; a newline belongs to the line that it ends."""
    ends = np.flatnonzero(data == 0x0A) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def allocated(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary; both ends count bytes from 0.

    Tokens and sections cover the same bytes without gaps; sections that are empty get nothing.
    """
    token_starts = np.concatenate([[0], token_ends])[:-1].astype(np.int64)
    first = np.searchsorted(section_ends, token_starts, "right")
    last = np.searchsorted(section_ends, token_ends - 1, "right")
    crossing = first != last
    if rule == "first":
        return first, crossing
    if rule == "last":
        return last, crossing
    section = first.copy()
    section_starts = np.concatenate([[0], section_ends[:-1]])
    for token in np.flatnonzero(crossing):
        over = slice(first[token], last[token] + 1)
        held = np.minimum(section_ends[over], token_ends[token]) - np.maximum(section_starts[over], token_starts[token])
        section[token] = first[token] + int(held.argmax())
    return section, crossing


def tokens_and_end(spark: SparkSession, vocabulary: Vocabulary, text_column: str = "text") -> Column:
    """Tokens of a whole text and one for its end, as a sequence holds it; null counts as empty."""
    shared = spark.sparkContext.broadcast(vocabulary)

    def counted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _coder(shared.value)
        for column in columns:
            sizes = [len(coder.encode_to_numpy(text or "")) + 1 for piece in array_slices(column) for text in piece.to_pylist()]
            yield pa.array(sizes, pa.int64())

    counted.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(counted, "bigint")(F.col(text_column).cast("string"))


def _coder(vocabulary: Vocabulary) -> tiktoken.Encoding:
    ranks = {token: rank for rank, token in enumerate(vocabulary.ranks)}
    return tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})


def section_counts(
    docs: DataFrame,
    vocabulary: Vocabulary,
    rule: str = "first",
    ends: Callable[[np.ndarray], np.ndarray] = line_ends,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per section: doc_id, section, char_start, char_end, n_tokens, n_crossing.

    ``ends`` gives the section ends of a text's bytes, in order, the last one its length; they lie
    between characters. ``n_crossing`` counts the tokens allocated to the section that reach beyond
    it. A null or empty text is one empty section without tokens. Repeated rows are counted each for
    themselves, other columns are ignored, and an empty table gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    id_type = dict(docs.dtypes)[id_column]

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        coder = _coder(vocabulary)
        lengths = np.array([len(token) for token in vocabulary.ranks])
        for batch in slices(batches, "text"):
            data, offsets = texts(batch.column("text"))
            found = []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = data[offsets[row] : offsets[row + 1]]
                section_ends = ends(own)
                token_ends = np.cumsum(lengths[coder.encode_to_numpy(text or "")])
                section, crossing = allocated(token_ends, section_ends, rule)
                characters = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])[section_ends]
                found.append((section_ends, characters, np.bincount(section, minlength=len(section_ends)), np.bincount(section[crossing], minlength=len(section_ends))))
            sizes = np.array([len(each[0]) for each in found])
            begins = np.cumsum(sizes) - sizes
            number = np.arange(sizes.sum()) - np.repeat(begins, sizes)
            char_ends = np.concatenate([each[1] for each in found])
            char_starts = np.concatenate([[0], char_ends[:-1]])
            char_starts[begins] = 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
                    pa.array(number.astype(np.int32)),
                    pa.array(char_starts.astype(np.int64)),
                    pa.array(char_ends.astype(np.int64)),
                    pa.array(np.concatenate([each[2] for each in found]).astype(np.int64)),
                    pa.array(np.concatenate([each[3] for each in found]).astype(np.int64)),
                ],
                names=["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing"],
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(
        counted, f"doc_id {id_type}, section int, char_start bigint, char_end bigint, n_tokens bigint, n_crossing bigint"
    )
