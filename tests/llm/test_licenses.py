"""Licence scans against plain searches."""

import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from odd import empty_docs, odd_docs, odd_rows, prose
from siltstone.llm.licenses import PHRASES, TEMPLATES, Scanner, SuffixAutomaton, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCANNER = Scanner()
MIT = TEMPLATES[0][1]
APACHE = next(text for label, text in TEMPLATES if label == "apache")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_base(text):
    words = words_of(text)
    places = [
        (i, label) for phrase, label in PHRASES for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def plain_statistics(sequences, text):
    """The longest run that ends at each word and stands in a sequence, and all its places, by looking everywhere."""
    found = []
    for end in range(1, len(text) + 1):
        for length in range(end, -1, -1):
            run = text[end - length : end]
            places = {(n, e) for n, s in enumerate(sequences) for e in range(length, len(s) + 1) if s[e - length : e] == run}
            if places:
                found.append((length, places if length else None))
                break
    return found


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=12), min_size=1, max_size=5),
    st.lists(st.integers(0, 4), max_size=30),
)
def test_matching_statistics(sequences, text):
    automaton = SuffixAutomaton(sequences)
    got = [(length, automaton.ends[state] if length else None) for length, state in automaton.run(text)]
    assert got == plain_statistics(sequences, text)


def plain_chains(scanner, matches):
    """The best chain by trying every predecessor."""
    best = []
    for end, place, length in matches:
        own = length
        for (e, p, _), score in zip(matches, best):
            if e < end and p < place and p >= place - length - scanner.max_gap and e >= end - length - scanner.max_gap:
                own = max(own, score + min(length, end - e, place - p))
        best.append(own)
    return max(best)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(4, 80), st.integers(4, 60), st.integers(1, 4)), min_size=1, max_size=12, unique=True))
def test_best_chain(matches):
    matches = sorted(matches)
    found = SCANNER.chains(matches)
    assert max(covered for _, _, covered in found) == plain_chains(SCANNER, matches)
    assert all(first < end for first, end, _ in found)


def one(text):
    return SCANNER.scan(pa.array([text]))[0]


def test_every_template_is_found_whole():
    for number, (label, text) in enumerate(TEMPLATES):
        words = words_of(text)
        found = one("Before it, words. " + text.upper() + " And after it.")
        span = next(each for each in found[7] if each[1] == number)
        assert span == (label, number, 3, 2 + len(words), len(words), 1.0)
        assert label in found[5].split(",") and found[6] == 1.0
        assert found[:5] == plain_base("Before it, words. " + text.upper() + " And after it.")


def test_interrupted_template_is_chained():
    words = words_of(MIT)
    broken = " ".join(words[:30] + ["*", "#", "xx"] + words[30:50] + ["changed"] + words[51:])
    found = one(prose(3, 40) + " " + broken + " " + prose(4, 40))
    (label, _, first, last, covered, share), = [each for each in found[7] if each[1] == 0]
    assert (label, first, last) == ("mit", len(words_of(prose(3, 40))), len(words_of(prose(3, 40))) + len(words))
    assert covered == len(words) - 1 and share < 1
    assert found[4] == "" and found[5] == "mit"


def test_parts_far_apart_are_no_span():
    words = words_of(APACHE)
    third = len(words) // 3
    text = " ".join(words[:third]) + " " + prose(1, 200) + " " + " ".join(words[third : 2 * third])
    assert all(each[0] != "apache" or each[1] != TEMPLATES.index(("apache", APACHE)) for each in one(text)[7])


def test_prose_has_no_label():
    assert one(prose(9, 3000))[4:] == ("", "", 0.0, [])
    assert one("See the general public, license it. The MIT  licenses. apache\x00licence")[1:6] == (1, 2, 2, "gpl", "gpl")


def test_many_copies_in_one_text():
    rng = random.Random(2)
    text = "\n".join(rng.choice([MIT, APACHE, "the mit license", prose(k, 20)]) for k in range(400))
    found = one(text)
    assert found[:5] == plain_base(text)
    n = text.count(MIT)
    assert len([each for each in found[7] if each[1] == 0 and each[5] == 1.0]) == n


def test_random_words_equal_plain_base():
    rng = random.Random(7)
    vocabulary = "mit MIT license License, apache general public é license\n the-of 2.0 \x7f gnu".split(" ")
    rows = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for text, found in zip(rows, SCANNER.scan(pa.array(rows))):
        assert found[:5] == plain_base(text)


def test_a_phrase_crosses_no_text():
    first, second = SCANNER.scan(pa.array(["the mit", "license apache"]))
    assert first[:2] == (2, 0) and second[:2] == (2, 0)


def test_odd_rows(spark):
    rows = [*odd_rows(), (500, MIT), (500, MIT), (501, "Mit License")]
    found = scan(odd_docs(spark, rows))
    got = sorted((tuple(r)[:6] for r in found.collect()), key=repr)
    assert got == sorted(((i, *plain_base(text)) for i, text in rows), key=repr)
    assert [r.labels for r in found.collect() if r.doc_id == 500] == ["mit", "mit"]
    assert scan(empty_docs(spark)).collect() == []


def test_template_without_words():
    with pytest.raises(ValueError):
        Scanner(templates=(("x", "..."),))
