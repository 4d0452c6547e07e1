"""Byte-level BPE and token counts."""

import hashlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from odd import empty_docs, odd_docs, odd_rows
from siltstone.llm import byte_bpe, token_counts

VOCABULARY = byte_bpe.load()
CODER = byte_bpe.Coder(VOCABULARY)
PLAIN = tiktoken.Encoding(
    "plain", pat_str=byte_bpe.PATTERN, mergeable_ranks={t: i for i, t in enumerate(VOCABULARY.ranks)}, special_tokens={}
)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="ab \n\t'#é漢▁🙂<|>1\u0000", max_size=80)))
def test_ids_equal_tiktoken_and_return(text):
    ids = CODER.encode(text)
    assert ids == PLAIN.encode_ordinary(text)
    assert CODER.decode(ids) == text.encode()


def test_every_rank_is_reached_by_merges():
    assert all(CODER.processor.encode(byte_bpe.characters(token)) == [rank] for rank, token in enumerate(VOCABULARY.ranks))


def test_model_is_the_one_that_is_read():
    processor = CODER.processor
    assert processor.get_piece_size() == len(VOCABULARY.ranks) + 1
    assert processor.unk_id() == len(VOCABULARY.ranks)
    assert (processor.bos_id(), processor.eos_id(), processor.pad_id()) == (-1, -1, -1)
    assert processor.get_score(17) == -17.0


def test_long_texts_and_forgetting(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    own = byte_bpe.Coder(VOCABULARY)
    for text in ["a" * 20_000 + " " * 3000 + "漢" * 4000, "one two three four five", "six seven"]:
        assert own.encode(text) == PLAIN.encode_ordinary(text)


def test_ranks_without_gaps(tmp_path):
    (tmp_path / "gap").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(tmp_path / "gap"))


def test_round_trip_of_odd_rows(spark):
    docs = odd_docs(spark)
    found = docs.select("text", byte_bpe.round_trip(spark, VOCABULARY, F.col("text")).alias("r")).collect()
    assert len(found) == len(odd_rows())
    for row in found:
        ids = PLAIN.encode_ordinary(row.text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (row.text or "").encode())]
        assert tuple(row.r) == (len(ids), *digests)
    back = docs.select("text", byte_bpe.encode(spark, VOCABULARY, F.col("text")).alias("ids"))
    back = back.select("text", byte_bpe.decode(spark, VOCABULARY, F.col("ids")).cast("string").alias("back"))
    assert all((r.text or "") == r.back for r in back.collect())
    assert empty_docs(spark).select(byte_bpe.round_trip(spark, VOCABULARY, F.col("text"))).collect() == []


# token counts


def plain_counts(text: str, rule: str) -> list[tuple]:
    """Sections of a text with their tokens, from the spans of another library."""
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    ids = other.encode(text, add_special_tokens=False).ids
    cuts = [0]
    for line in text.split("\n")[:-1]:
        cuts.append(cuts[-1] + len(line) + 1)
    if cuts[-1] < len(text) or not text:
        cuts.append(len(text))
    spans = list(zip(cuts[:-1], cuts[1:]))
    in_bytes = [(len(text[:a].encode()), len(text[:b].encode())) for a, b in spans]
    counts, over, at = [0] * len(spans), [0] * len(spans), 0
    for token in ids:
        size = len(VOCABULARY.ranks[token])
        held = [max(0, min(b, at + size) - max(a, at)) for a, b in in_bytes]
        touched = [i for i, n in enumerate(held) if n]
        own = {"first": touched[0], "last": touched[-1], "most": held.index(max(held))}[rule]
        counts[own] += 1
        over[own] += len(touched) > 1
        at += size
    return [(i, a, b, n, m) for i, ((a, b), n, m) in enumerate(zip(spans, counts, over))]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_equal_plain_counts(spark, rule):
    rows = [(i, t) for i, t in enumerate(["a\n\n\nb c\n", "\n\n\n\n", "", None, "é\n漢字\n\n x\n \n \ny", "no newline", "a \n\n b"])]
    found = token_counts.section_counts(odd_docs(spark, rows), VOCABULARY, rule).collect()
    for doc_id, text in rows:
        own = sorted(tuple(r)[1:] for r in found if r.doc_id == doc_id)
        assert own == plain_counts(text or "", rule)


def test_counts_add_up(spark):
    found = token_counts.section_counts(odd_docs(spark), VOCABULARY)
    totals = found.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("char_end").alias("end")).collect()
    expected = {i: (len(PLAIN.encode_ordinary(t or "")), len(t or "")) for i, t in odd_rows()}
    repeated = {None, 18}
    assert {r.doc_id: (r.n, r.end) for r in totals if r.doc_id not in repeated} == {
        i: v for i, v in expected.items() if i not in repeated
    }
    assert sum(r.n for r in totals) == sum(len(PLAIN.encode_ordinary(t or "")) for _, t in odd_rows())
    assert token_counts.section_counts(empty_docs(spark), VOCABULARY).collect() == []


def test_own_sections_and_rules():
    ends = np.array([2, 2, 5])
    section, crossing = token_counts.allocated(np.array([1, 4, 5]), ends, "first")
    assert section.tolist() == [0, 0, 2] and crossing.tolist() == [False, True, False]
    assert token_counts.allocated(np.array([1, 4, 5]), ends, "last")[0].tolist() == [0, 2, 2]
    assert token_counts.allocated(np.array([1, 4, 5]), ends, "most")[0].tolist() == [0, 2, 2]
    assert token_counts.line_ends(np.frombuffer(b"a\nb", np.uint8)).tolist() == [2, 3]


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        token_counts.section_counts(empty_docs(spark), VOCABULARY, "middle")
