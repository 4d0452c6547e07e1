"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokens and bytes form incidence matrices: A has a row for each token of the first tokenizer and a one in
the column of each byte that it covers, B likewise for the second. The row products of A and B
transposed are the overlap links, their values the bytes shared. Where tokens of both end at the same
byte, a group ends; the products of the matrices of tokens and groups are the links of tokens that
share a group. Matrices of all texts of a batch are one, in blocks: a byte belongs to one text.

A pair of ids counts in how many documents it is linked. Texts are encoded once, and their ids are
written. Pairs are counted per task, then by a shuffle of one row for each pair and task. For the
lookup, the most frequent pairs, at most ``HEAD`` of them, are broadcast; the links of the others, few
in any document since they are rare, meet their counts in a join, where no pair is hot.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import written
from .spans import slices

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
#: Bytes of text that a worker encodes at a time.
SLICE_BYTES = 1 << 19
#: Tokens whose links a worker holds at a time; one document may have more.
SLICE_TOKENS = 1 << 16
#: Pairs that a task holds before it sends them.
HELD_PAIRS = 2_000_000
#: Pairs whose counts are broadcast, 20 bytes each.
HEAD = 1_000_000
#: A pair of ids is one number; an id of the second tokenizer is below this.
RADIX = 1 << 20
#: Texts of these characters are cut alike by both libraries that know the first vocabulary: their tables of
#: letters, digits and spaces agree on them. Other texts go to the slower one, which defines the result.
ALIKE = re.compile("[\x00-\u024f\u2010-\u2027\u20a0-\u20bf\u4e00-\u9fa5]*")


@dataclass
class Csr:
    """A sparse matrix: the entries of row i stand at ``starts[i]`` to ``starts[i + 1]``, columns in order."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of_runs(cls, ends: np.ndarray, width: int) -> Csr:
        """Row i has ones in the columns from the end of row i - 1 to its own."""
        return cls(np.concatenate([[0], ends]), np.arange(width), np.ones(width, np.int64), width)

    @classmethod
    def of_places(cls, places: np.ndarray, width: int) -> Csr:
        """Row i has a one in the column ``places[i]``."""
        return cls(np.arange(len(places) + 1), places, np.ones(len(places), np.int64), width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        counts = np.bincount(self.columns, minlength=self.width)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), self.rows()[order], self.values[order], len(self.starts) - 1)

    def sizes(self, other: Csr) -> np.ndarray:
        """Terms of each row of the product, from the sizes of the rows that it adds up."""
        terms = np.concatenate([[0], np.cumsum(np.diff(other.starts)[self.columns])])
        return terms[self.starts[1:]] - terms[self.starts[:-1]]

    def product(self, other: Csr) -> Csr:
        """Row by row: row i is the sum of the rows of ``other`` that row i's columns name, each times its value."""
        lengths = np.diff(other.starts)[self.columns]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(other.starts[self.columns] - (ends - lengths), lengths)
        rows, columns = np.repeat(self.rows(), lengths), other.columns[at]
        values = np.repeat(self.values, lengths) * other.values[at]
        if total and (np.diff(rows * other.width + columns) < 0).any():
            order = np.lexsort((columns, rows))
            rows, columns, values = rows[order], columns[order], values[order]
        new = np.ones(total, bool)
        new[1:] = (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])
        first = np.flatnonzero(new)
        counts = np.bincount(rows[first], minlength=len(self.starts) - 1)
        sums = np.add.reduceat(values, first) if total else values
        return Csr(np.concatenate([[0], np.cumsum(counts)]), columns[first], sums, other.width)


@dataclass
class Aligned:
    """Tokens of several texts: where each text's tokens and groups begin, and the group of each token.

    ``links`` has a row for each token of A, a column for each of B, and the bytes that they share.
    """

    a_starts: np.ndarray
    b_starts: np.ndarray
    group_starts: np.ndarray
    a_groups: np.ndarray
    b_groups: np.ndarray
    links: Csr

    def group_matrices(self) -> tuple[Csr, Csr]:
        """Tokens of A by groups, and groups by tokens of B."""
        width = int(self.group_starts[-1])
        return Csr.of_places(self.a_groups, width), Csr.of_places(self.b_groups, width).transposed()

    def shared_counts(self) -> np.ndarray:
        """For each token of A, the tokens of B in its group: the sizes of the rows of the product below."""
        a, b = self.group_matrices()
        return a.sizes(b)

    def shared(self, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of tokens that share a group, by products of as many rows at a time as give ``most`` pairs."""
        a, b = self.group_matrices()
        ends = np.cumsum(a.sizes(b))
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
            part = Csr.of_places(self.a_groups[first:last], a.width).product(b)
            yield part.rows() + first, part.columns
            first = last


def align(a_lengths: np.ndarray, a_counts: np.ndarray, b_lengths: np.ndarray, b_counts: np.ndarray) -> Aligned:
    """Align texts one after the other: bytes of each token, and tokens of each text.

    The tokens of A and of B in a text cover the same bytes; no token is empty.
    """
    a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
    n_bytes = int(a_ends[-1]) if len(a_ends) else 0
    links = Csr.of_runs(a_ends, n_bytes).product(Csr.of_runs(b_ends, n_bytes).transposed())
    # Both end where a text ends, so no group goes beyond its text.
    both = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_starts, b_starts = np.concatenate([[0], np.cumsum(a_counts)]), np.concatenate([[0], np.cumsum(b_counts)])
    text_ends = np.concatenate([[0], a_ends])[a_starts]
    return Aligned(
        a_starts, b_starts, np.searchsorted(both, text_ends, "right"), np.searchsorted(both, a_ends), np.searchsorted(both, b_ends), links
    )


class Coders:
    """Both tokenizers and the bytes of their tokens; made once in a worker process."""

    def __init__(self, first: str, second: bytes) -> None:
        self.given = first
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        letters = {char: value for value, char in byte_letters().items()}
        tokenizer = json.loads(first)
        special = {token["id"]: token["content"] for token in tokenizer["added_tokens"]}
        names = {i: name for name, i in tokenizer["model"]["vocab"].items()} | special
        self.a_bytes = [names[i].encode() if i in special else bytes(letters[c] for c in names[i]) for i in range(max(names) + 1)]
        self.ranks = {token: i for i, token in enumerate(self.a_bytes) if i not in special}
        self.b_bytes = [
            bytes([int(name[3:5], 16)]) if self.second.is_byte(i) else name.replace(MARK, " ").encode()
            for i, name in ((i, self.second.id_to_piece(i)) for i in range(self.second.get_piece_size()))
        ]

    @cached_property
    def first(self) -> Tokenizer:
        """The first tokenizer; strings of special tokens in a text are text."""
        # Spark runs the tasks; a task has one thread.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_str(self.given)
        tokenizer.encode_special_tokens = True
        return tokenizer

    @cached_property
    def fast(self) -> tiktoken.Encoding:
        """The first vocabulary by its ranks; ids are ranks."""
        return tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def first_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of the first tokenizer for a space and each text."""
        slow = [i for i, text in enumerate(texts) if not ALIKE.fullmatch(text)]
        rest = iter(self.first.encode_batch([" " + texts[i] for i in slow], add_special_tokens=False) if slow else ())
        slow = set(slow)
        return [next(rest).ids if i in slow else self.fast.encode_ordinary(" " + text) for i, text in enumerate(texts)]

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both for each text; none where a text is empty or the bytes of either aren't the text's after a space."""
        held = [text for text in texts if text]
        found = iter(zip(held, self.first_ids(held), self.second.encode(held, num_threads=1)))
        rows: list[tuple[list[int], list[int]]] = []
        for given in texts:
            a, b = [], []
            if given:
                text, a, b = next(found)
                data = b" " + text.encode()
                if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
                    a, b = [], []
            rows.append((a, b))
        return rows


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves; the other bytes, in order, for those from U+0100 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) if b in printable else chr(0x100 + others.index(b)) for b in range(256)}


@dataclass
class Models:
    """The files of both tokenizers, read on the driver, so that workers need none."""

    first: str
    second: bytes

    def __reduce__(self):
        # Workers make their own tokenizers: a copied one forgets that special tokens are text.
        return Models, (self.first, self.second)

    @cached_property
    def coders(self) -> Coders:
        return Coders(self.first, self.second)

    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(token) for token in tokens]) for tokens in (self.coders.a_bytes, self.coders.b_bytes))


def load(first: str = FIRST, second: str = SECOND) -> Models:
    with open(first, encoding="utf-8") as one, open(second, "rb") as other:
        return Models(one.read(), other.read())


#: Ids of a text, one after the other, as small unsigned numbers.
ENCODED = "a binary, b binary"
ID = np.dtype("<u2")


def encoded(docs: DataFrame, models: Models, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, row (a number of its own) and the ids of both tokenizers, written once.

    The ids of a text are one binary value, two bytes an id, so they pass through Spark as bytes.
    """
    if max(map(len, models.lengths())) > 1 << 16:
        raise ValueError("a vocabulary has more than 65,536 entries")
    shared = docs.sparkSession.sparkContext.broadcast(models)
    id_type = dict(docs.dtypes)[id_column]

    def both(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = shared.value.coders
        for batch in slices(batches, "text", SLICE_BYTES):
            rows = coders.encode(batch.column("text").to_pylist())
            ids = [pa.array([np.array(row[side], ID).tobytes() for row in rows], pa.binary()) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), *ids], names=["doc_id", "row", "a", "b"])

    rows = docs.select(
        F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_column).cast("string").alias("text")
    )
    return written(rows.mapInArrow(both, f"doc_id {id_type}, row bigint, {ENCODED}"), "tokens")


@dataclass
class Tokens:
    """A slice of encoded rows with their alignment."""

    batch: pa.RecordBatch
    a: np.ndarray
    b: np.ndarray
    aligned: Aligned

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Document of each link, and its pair of ids as one number."""
        links = self.aligned.links
        tokens = links.rows()
        owner = np.searchsorted(self.aligned.a_starts, tokens, "right") - 1
        return owner, self.a[tokens] * RADIX + self.b[links.columns]


def _tokens(batches: Iterable[pa.RecordBatch], a_lengths: np.ndarray, b_lengths: np.ndarray) -> Iterator[Tokens]:
    """Slices of about ``SLICE_TOKENS`` tokens, or of a single row."""
    for batch in batches:
        counts = [pc.binary_length(batch.column(side)).to_numpy().astype(np.int64) // ID.itemsize for side in ("a", "b")]
        ends = np.cumsum(counts[0] + counts[1])
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + SLICE_TOKENS, "right")))
            piece = batch.slice(first, last - first)
            a, b = (np.frombuffer(b"".join(piece.column(side).to_pylist()), ID).astype(np.int64) for side in ("a", "b"))
            yield Tokens(piece, a, b, align(a_lengths[a], counts[0][first:last], b_lengths[b], counts[1][first:last]))
            first = last


def _sorted_distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and counts of all parts, each pair once."""
    keys, counts = (np.concatenate(side) for side in zip(*parts))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def pair_counts(tokens: DataFrame, models: Models, held: int = HELD_PAIRS) -> DataFrame:
    """a, b, n: in how many documents each pair of ids is linked; ``best`` if no pair of that a has more."""
    lengths = tokens.sparkSession.sparkContext.broadcast(models.lengths())

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0
        for each in _tokens(batches, *lengths.value):
            owner, pair = each.pairs()
            # Pair and document in one number: each document counts once for a pair.
            once = _sorted_distinct(pair * each.batch.num_rows + owner)
            parts.append(np.unique(once // each.batch.num_rows, return_counts=True))
            total += len(parts[-1][0])
            if total > held:
                parts = [_added(parts)]
                total = len(parts[0][0])
            if total > held // 2 and len(parts) == 1:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts.pop()], names=["pair", "n"])
                total = 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _added(parts)], names=["pair", "n"])

    sums = tokens.select("a", "b").mapInArrow(counted, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    sums = written(sums.withColumn("a", F.floor(F.col("pair") / RADIX)), "pairs")
    most = sums.groupBy("a").agg(F.max("n").alias("most"))
    return written(sums.join(most, "a").select("pair", "a", "n", (F.col("n") == F.col("most")).alias("best")), "best-pairs")


def head(pairs: DataFrame, most: int = HEAD) -> tuple[int, DataFrame]:
    """The least count of a frequent pair, and those pairs: as many whole counts as give ``most`` pairs at most.

    Counts are taken in steps of a quarter of a power of two, so the driver sees a few hundred sums.
    """
    step = F.floor(F.log2("n") * 4)
    rows = pairs.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    least, total = np.iinfo(np.int64).max, 0
    for row in rows:
        total += row.rows
        if total > most:
            break
        least = row.least
    return int(least), pairs.where(F.col("n") >= least)


def _digest(a: np.ndarray, b: np.ndarray, a_groups: np.ndarray, b_groups: np.ndarray, names: list[str], shift: int) -> str:
    """Hash of the groups' text. ``names`` has, for A then B, each id before the sign that goes on, then before the one that ends."""
    a_last, b_last = np.ones(len(a), bool), np.ones(len(b), bool)
    a_last[:-1], b_last[:-1] = a_groups[1:] != a_groups[:-1], b_groups[1:] != b_groups[:-1]
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.searchsorted(b_groups, a_groups)] = 2 * a + a_last
    order[np.arange(len(b)) + np.searchsorted(a_groups, b_groups, "right")] = shift + 2 * b + b_last
    return hashlib.sha256("".join(map(names.__getitem__, order.tolist()))[:-1].encode()).hexdigest()


_DIGEST = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def alignments(
    docs: DataFrame, models: Models | None = None, most_broadcast: int = HEAD, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: tokens of both, groups, overlap links, links by shared groups, counts of linked pairs, digest.

    ``n_best`` are the links whose pair is in as many documents as any pair of its first id, ``count_sum``
    adds the documents of each link's pair. A text that is null or empty, or whose tokens don't spell a
    space and the text (a text with U+2581, for instance), has zeros and an empty digest; it counts for
    no pair. Repeated rows are documents of their own, null and repeated identifiers too; other columns
    are ignored and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    models = load() if models is None else models
    tokens = encoded(docs, models, id_column, text_column)
    pairs = pair_counts(tokens, models)
    least, frequent = head(pairs, most_broadcast)
    known = frequent.select("pair", "n", "best").toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(
        (
            known.column("pair").to_numpy(), known.column("n").to_numpy(), np.asarray(known.column("best").to_pylist(), bool),
            models.lengths(), len(models.coders.a_bytes), len(models.coders.b_bytes),
        )
    )

    def looked_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best, lengths, n_first, n_second = shared.value
        names = [f"{i}{end}" for i in range(n_first) for end in ",|"] + [f"{i}{end}" for i in range(n_second) for end in ",;"]
        for each in _tokens(batches, *lengths):
            own, rows = each.aligned, each.batch.num_rows
            owner, pair = each.pairs()
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            hit = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            sums, bests = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(sums, owner[hit], counts[at[hit]])
            np.add.at(bests, owner[hit], best[at[hit]])
            rare = np.lexsort((pair[~hit], owner[~hit]))
            starts = np.searchsorted(owner[~hit][rare], np.arange(rows + 1))
            links = np.diff(own.links.starts[own.a_starts])
            shared_counts = np.concatenate([[0], np.cumsum(own.shared_counts())])
            digests = []
            for i in range(rows):
                a, b = slice(*own.a_starts[i : i + 2]), slice(*own.b_starts[i : i + 2])
                digests.append(_digest(each.a[a], each.b[b], own.a_groups[a], own.b_groups[b], names, 2 * n_first) if a.stop > a.start else "")
            yield pa.RecordBatch.from_arrays(
                [
                    each.batch.column("doc_id"),
                    each.batch.column("row"),
                    pa.array(np.diff(own.a_starts)),
                    pa.array(np.diff(own.b_starts)),
                    pa.array(np.diff(own.group_starts)),
                    pa.array(links),
                    pa.array(np.diff(shared_counts[own.a_starts])),
                    pa.array(bests),
                    pa.array(sums),
                    pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(pair[~hit][rare])),
                ],
                names=["doc_id", "row", *[part.split()[0] for part in _DIGEST.split(", ")], "rare"],
            )

    id_type = dict(tokens.dtypes)["doc_id"]
    found = tokens.mapInArrow(looked_up, f"doc_id {id_type}, row bigint, {_DIGEST}, rare array<bigint>")
    if pairs.where(F.col("n") < least).isEmpty():
        return found.drop("row", "rare")
    found = written(found, "alignments")
    counted = (
        found.select("row", F.explode("rare").alias("pair"))
        .join(pairs.where(F.col("n") < least), "pair")
        .groupBy("row")
        .agg(F.sum("n").alias("rare_sum"), F.count_if("best").alias("rare_best"))
    )
    both = found.join(counted, "row", "left")
    columns = [c for c in found.columns if c not in ("row", "rare")]
    more = {"n_best": "rare_best", "count_sum": "rare_sum"}
    return both.select([(F.col(c) + F.coalesce(F.col(more[c]), F.lit(0))).alias(c) if c in more else F.col(c) for c in columns])
