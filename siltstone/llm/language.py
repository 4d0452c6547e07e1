"""Language identification as a mixture over the words of a text.

Each language has frequencies of hashed runs of three bytes within words, counted over all rows to
learn from. A text is a mixture of languages: expectation-maximisation over its words estimates the
proportions. The set of languages is chosen by penalised likelihood: each further language has to
raise the log-likelihood by ``PENALTY * log(words)``. The language of the largest proportion is the
prediction and its proportion the score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .spans import NOT_ALNUM, array_slices, spans, texts

BITS = 16
PLACES = 1 << BITS
#: Added to each place of a language, so that no run of bytes is impossible.
PRIOR = 0.1
PENALTY = 2.0
ROUNDS = 8
UNKNOWN = "und"
RESULT = "struct<lang_pred:string,score:double,languages:string>"

#: ASCII that is no letter separates words; bytes of longer characters count as letters.
_NO_LETTER = NOT_ALNUM.copy()
_NO_LETTER[list(b"0123456789")] = True


@dataclass
class Model:
    """Languages in order, and log-frequencies: a row for each language."""

    languages: list[str]
    logs: np.ndarray


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    table[_NO_LETTER] = 0
    return table


_LOWER = _lowered()


def _places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Place of the run of a byte and its two neighbours; what is no letter, and a text's end, counts as an edge."""
    lowered = _LOWER[data]
    before, behind = np.zeros_like(lowered), np.zeros_like(lowered)
    before[1:], behind[:-1] = lowered[:-1], lowered[1:]
    # No run reaches into the next text of the batch.
    full = np.flatnonzero(np.diff(offsets))
    before[offsets[full]] = 0
    behind[offsets[full + 1] - 1] = 0
    runs = before * np.uint32(0x9E3779B1) + lowered * np.uint32(0x85EBCA77) + behind * np.uint32(0xC2B2AE3D)
    return (runs * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS)


def fit(rows: DataFrame, text_column: str = "text", lang_column: str = "lang") -> Model:
    """Count over all rows with text and language.

    What comes to the driver, by column, is at most a count for each language and place; the model that
    is broadcast has 256 KB a language. Null texts and languages don't count, repeated rows count each
    for themselves, an empty table gives a model without languages.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang")
            for name in langs.unique().to_pylist():
                own = batch.filter(pc.equal(langs, name)).column("text")
                total = totals.setdefault(name, np.zeros(PLACES, np.int64))
                for piece in array_slices(own):
                    data, offsets = texts(piece)
                    total += np.bincount(_places(data, offsets)[~_NO_LETTER[data]], minlength=PLACES)
        for name, total in totals.items():
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(place), "place": place.astype(np.int32), "n": total[place]})

    known = rows.where(F.col(text_column).isNotNull() & F.col(lang_column).isNotNull()).select(
        F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang")
    )
    found = (
        known.mapInArrow(counted, "lang string, place int, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()
    )
    langs = found.column("lang").combine_chunks().dictionary_encode()
    given = langs.dictionary.to_pylist()
    names = sorted(given)
    row = np.array([names.index(name) for name in given], np.int64)[langs.indices.to_numpy()]
    place, n = found.column("place").to_numpy(), found.column("n").to_numpy()
    totals = np.bincount(row, weights=n, minlength=len(names)) + PRIOR * PLACES
    # Log-frequencies in 32 bits, one language's table at a time in full width.
    logs = np.empty((len(names), PLACES), np.float32)
    for k in range(len(names)):
        counts = np.full(PLACES, PRIOR)
        counts[place[row == k]] += n[row == k]
        logs[k] = np.log(counts / totals[k])
    return Model(names, logs)


def _mixed(likely: np.ndarray, offsets: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages in each text, and the log of the mixture's likelihood.

    ``likely`` has a row for each word, relative to its most likely language.
    """
    n = np.diff(offsets)
    owner = np.repeat(np.arange(len(n)), n)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        part = likely * share[owner]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
        share = np.add.reduceat(part, offsets[:-1], axis=0) / n[:, None]
    whole = np.log(np.maximum((likely * share[owner]).sum(axis=1), 1e-300))
    return share, np.add.reduceat(whole, offsets[:-1])


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _chosen(column: pa.Array, model: Model) -> pa.StructArray:
    data, offsets = texts(column)
    words = spans(data, offsets, _NO_LETTER)
    rows, size = len(column), len(model.languages)
    share = np.zeros((rows, size))
    full = np.flatnonzero(np.diff(words.offsets))
    if len(full) and size:
        places = _places(data, offsets)
        logs = np.empty((len(words.starts), size))
        total = np.zeros(len(data) + 1)
        for k in range(size):
            np.cumsum(model.logs[k][places], dtype=np.float64, out=total[1:])
            logs[:, k] = total[words.ends] - total[words.starts]
        best = logs.max(axis=1)
        # A floor for each word, so that a foreign or garbled word costs a bounded amount.
        likely = np.exp(np.maximum(logs - best[:, None], -30.0))
        cuts = words.offsets[np.append(full, rows)]
        n = np.diff(cuts)
        single = np.add.reduceat(np.log(likely), cuts[:-1], axis=0)
        cost = PENALTY * np.log(1 + n)
        pick = np.eye(size)[single.argmax(axis=1)]
        value = single.max(axis=1) - cost
        part, whole = _mixed(likely, cuts, np.ones((len(full), size)))
        rank = np.argsort(-part, axis=1, kind="stable")
        open_ = np.flatnonzero(whole - 2 * cost > value)
        for k in range(2, size + 1):
            if not len(open_):
                break
            allowed = np.zeros((len(open_), size))
            np.put_along_axis(allowed, rank[open_, :k], 1.0, axis=1)
            kept = np.concatenate([np.arange(cuts[i], cuts[i + 1]) for i in open_])
            own = np.concatenate([[0], np.cumsum(n[open_])])
            mixed, gained = _mixed(likely[kept], own, allowed)
            gained = gained - k * cost[open_]
            better = gained > value[open_]
            pick[open_[better]] = mixed[better]
            value[open_[better]] = gained[better]
            # No larger set can reach more than all languages do.
            open_ = open_[whole[open_] - (k + 1) * cost[open_] > value[open_]]
        share[full] = pick
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    first = np.where(share.any(axis=1), share.argmax(axis=1) if size else 0, size)
    for row in full:
        # Spans hold letters, or only marks and signs beyond ASCII: those rows are looked at whole.
        if first[row] < size and not _ascii_letter(data[offsets[row] : offsets[row + 1]]) and not _has_letter(column[row].as_py()):
            first[row], share[row] = size, 0
    named = [",".join(sorted(np.array(model.languages, object)[line > 0])) for line in share]
    score = share.max(axis=1) if size else np.zeros(rows)
    return pa.StructArray.from_arrays(
        [pa.array(names[first], pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(named, pa.string())], names=["lang_pred", "score", "languages"]
    )


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _ascii_letter(data: np.ndarray) -> bool:
    return bool(_LETTER[data[:4096]].any() or _LETTER[data].any())


def identify(spark: SparkSession, model: Model, text: Column) -> Column:
    """Predicted language, its proportion, and the chosen set of a text.

    Null texts and texts without a letter are ``und`` with score 0; so is every text if there was
    nothing to learn from. The result doesn't depend on how rows are batched.
    """
    shared: Broadcast[Model] = spark.sparkContext.broadcast(model)

    def identified(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [_chosen(piece, shared.value) for piece in array_slices(column, 2 << 20)]
            yield pa.concat_arrays(parts) if parts else _chosen(column, shared.value)

    identified.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(identified, RESULT)(text)
