import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from odd import as_set, odd_rows
from siltstone.llm import spans as S

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té漢 Z", max_size=40)), max_size=8)


def cut(column, separators=S.SPACES, lower=False):
    data, offsets = S.texts(column)
    found = S.spans(data, offsets, separators, lower)
    return [
        [data[a:b].tobytes() for a, b in zip(found.starts[x:y], found.ends[x:y])] for x, y in zip(found.offsets[:-1], found.offsets[1:])
    ], found


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([pa.string(), pa.large_string()]))
def test_words_equal_the_pattern(rows, kind):
    words, found = cut(pa.array(rows, kind))
    assert words == [re.findall(rb"[^\x20\x09-\x0D]+", (row or "").encode()) for row in rows]
    flat = [w for row in words for w in row]
    assert len(set(flat)) == len(set(found.hashes.tolist())) == len(set(zip(flat, found.hashes.tolist())))


def test_pieces_cut_no_word(monkeypatch):
    column = pa.array([text for _, text in odd_rows()])
    whole, a = cut(column)
    monkeypatch.setattr(S, "PIECE_BYTES", 1000)
    pieces, b = cut(column)
    assert whole == pieces
    assert np.array_equal(a.hashes, b.hashes)


def test_slice_of_a_column():
    column = pa.array(["a b", "c", None, "d e"]).slice(1)
    assert cut(column)[0] == [[b"c"], [], [b"d", b"e"]]


def test_lower_folds_ascii_only():
    _, found = cut(pa.array(["ABZ abz", "É é"]), lower=True)
    assert found.hashes[0] == found.hashes[1]
    assert found.hashes[2] != found.hashes[3]


@settings(max_examples=40, deadline=None)
@given(TEXTS)
def test_windows_are_distinct_as_the_tuples(rows):
    data, offsets = S.texts(pa.array(rows, pa.string()))
    grams, cuts = S.windows(S.spans(data, offsets, S.SPACES, lower=True), 5)
    assert [len(set(grams[a:b].tolist())) for a, b in zip(cuts[:-1], cuts[1:])] == [len(as_set(row)) for row in rows]


def test_short_windows_differ_from_long_ones():
    data, offsets = S.texts(pa.array(["a b c d e", "a b c d", "b c d e", "a b c d"]))
    grams, _ = S.windows(S.spans(data, offsets, S.SPACES), 5)
    assert grams[1] == grams[3]
    assert len(set(grams.tolist())) == 3


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_slices_keep_all_rows(most):
    batch = pa.RecordBatch.from_pydict({"text": ["abc", None, "", "x" * 50, "y"]})
    assert pa.Table.from_batches(list(S.slices([batch], "text", most))).to_pylist() == batch.to_pylist()
