"""Licence scans: matching statistics of a text against a generalised suffix automaton of licence words.

The automaton accepts every run of words of every template. A text's words are streamed through it;
at each word it knows the longest run that ends there and stands in some template, and where in which
templates. Long runs that can't be prolonged are matches; those of one template that follow each other
in the text and in the template are chained, and a chain that covers enough of its template is a span
with the template's label. Phrases stand in the automaton, too: a phrase ends at a word where its state
is on the path of suffix links from the state reached there.

Words are cut from the bytes of many texts at once. Statistics of two words or more exist only where
neighbouring words are neighbours in a template, so only those runs are streamed word by word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import NOT_ALNUM, Spans, slices, spans, texts

# Phrases that the scan must find, with their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Wordings of common licences, notices and declarations, with their labels.
TEMPLATES = (
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software.""",
    ),
    (
        "mit",
        """The software is provided "as is", without warranty of any kind, express or implied, including but not limited to
        the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors
        or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or
        otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.""",
    ),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program.""",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "mpl",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    ),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)

#: Words of the shortest match that is chained.
MIN_MATCH = 4
#: Share of a template that a chain covers at least.
MIN_COVERED = 0.6
#: Words between two matches of a chain at most, in the text and in the template.
MAX_GAP = 40
#: Score of a text that has a phrase and no span.
PHRASE_SCORE = 0.5
RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "spans array<struct<label:string,template:int,first_word:bigint,last_word:bigint,covered:int,share:double>>"
)


class SuffixAutomaton:
    """States for all runs of several sequences: transitions, suffix links and greatest lengths.

    ``ends`` has, for a state, the (sequence, end) of all its occurrences.
    """

    def __init__(self, sequences: list[list[int]]) -> None:
        self.steps: list[dict[int, int]] = [{}]
        self.links = [-1]
        self.lengths = [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            state = 0
            for end, word in enumerate(sequence, 1):
                state = self._extended(state, word)
                self.ends[state].add((number, end))
        for state in sorted(range(1, len(self.lengths)), key=self.lengths.__getitem__, reverse=True):
            if self.links[state] > 0:
                self.ends[self.links[state]] |= self.ends[state]

    def _new(self, length: int, steps: dict[int, int], link: int) -> int:
        self.steps.append(steps)
        self.links.append(link)
        self.lengths.append(length)
        self.ends.append(set())
        return len(self.lengths) - 1

    def _split(self, state: int, word: int) -> int:
        """The state reached by ``word``, made anew where it also stands for longer runs."""
        target = self.steps[state][word]
        if self.lengths[target] == self.lengths[state] + 1:
            return target
        own = self._new(self.lengths[state] + 1, dict(self.steps[target]), self.links[target])
        self.links[target] = own
        while state >= 0 and self.steps[state].get(word) == target:
            self.steps[state][word] = own
            state = self.links[state]
        return own

    def _extended(self, last: int, word: int) -> int:
        """The state of the run of ``last`` prolonged by ``word``."""
        if word in self.steps[last]:
            return self._split(last, word)
        state = self._new(self.lengths[last] + 1, {}, 0)
        while last >= 0 and word not in self.steps[last]:
            self.steps[last][word] = state
            last = self.links[last]
        if last >= 0:
            self.links[state] = self._split(last, word)
        return state

    def run(self, words: Iterable[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: for each word, the length of the longest run that ends there, and its state."""
        state = length = 0
        for word in words:
            while state and word not in self.steps[state]:
                state = self.links[state]
                length = self.lengths[state]
            if word in self.steps[state]:
                state = self.steps[state][word]
                length += 1
            else:
                length = 0
            yield length, state

    def state_of(self, sequence: list[int]) -> int:
        state = 0
        for word in sequence:
            state = self.steps[state][word]
        return state


def cut(strings: list[str]) -> tuple[np.ndarray, Spans]:
    """Words of texts: runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    data, offsets = texts(pa.array(strings, pa.large_string()))
    return data, spans(data, offsets, NOT_ALNUM, lower=True)


@dataclass
class Scanner:
    """What workers need: the automaton, words of the templates by hash, and settings."""

    templates: tuple[tuple[str, str], ...] = TEMPLATES
    phrases: tuple[tuple[str, str], ...] = PHRASES
    min_match: int = MIN_MATCH
    min_covered: float = MIN_COVERED
    max_gap: int = MAX_GAP
    automaton: SuffixAutomaton = field(init=False)

    def __post_init__(self) -> None:
        given = [text for _, text in self.templates] + [text for text, _ in self.phrases]
        data, words = cut(given)
        own = [data[s:e].tobytes().lower() for s, e in zip(words.starts, words.ends)]
        self.hashes, first = np.unique(words.hashes, return_index=True)
        self.words = [own[i] for i in first]
        ids = np.searchsorted(self.hashes, words.hashes)
        sequences = [ids[a:b].tolist() for a, b in zip(words.offsets, words.offsets[1:])]
        if not all(sequences):
            raise ValueError("a template or phrase has no word")
        self.neighbours = np.zeros((len(self.words), len(self.words)), bool)
        for sequence in sequences:
            self.neighbours[sequence[:-1], sequence[1:]] = True
        self.sizes = [len(sequence) for sequence in sequences]
        self.automaton = SuffixAutomaton(sequences)
        # Phrases that are suffixes of a state's longest run, those of its suffix links included.
        n, automaton = len(self.templates), self.automaton
        self.phrase_sizes = self.sizes[n:]
        ending: list[set[int]] = [set() for _ in automaton.lengths]
        for number, sequence in enumerate(sequences[n:]):
            ending[automaton.state_of(sequence)].add(number)
        for state in sorted(range(1, len(ending)), key=automaton.lengths.__getitem__):
            ending[state] |= ending[automaton.links[state]]
        self.ending = [tuple(sorted(each)) for each in ending]
        self.places = [
            sorted(each for each in ends if each[0] < n) if length >= self.min_match else []
            for length, ends in zip(automaton.lengths, automaton.ends)
        ]

    def runs(self, data: np.ndarray, words: Spans) -> Iterator[tuple[int, int, list[int]]]:
        """Text, first word and words of each run whose neighbours are neighbours in a template."""
        if not len(words.hashes):
            return
        at = np.minimum(np.searchsorted(self.hashes, words.hashes), len(self.hashes) - 1)
        known = self.hashes[at] == words.hashes
        owners = words.owners()
        joined = known[:-1] & known[1:] & (owners[:-1] == owners[1:]) & self.neighbours[at[:-1], at[1:]]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            ids = at[first : last + 1].tolist()
            for k, word in enumerate(ids, first):
                if data[words.starts[k] : words.ends[k]].tobytes().lower() != self.words[word]:
                    ids[k - first] = -1
            text = int(owners[first])
            yield text, first - int(words.offsets[text]), ids

    def chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """First word, end and covered words of chains of one template's matches.

        A match is (end in the text, end in the template, length); matches come in the order of the text. Each is
        appended to the chain that it prolongs most; words that two matches share count once.
        """
        score, parent = [], []
        ends = [end for end, _, _ in matches]
        for k, (end, place, length) in enumerate(matches):
            best, before = length, -1
            for i in range(bisect_left(ends, end - length - self.max_gap), k):
                earlier, passed, _ = matches[i]
                if earlier < end and passed < place and passed >= place - length - self.max_gap:
                    gained = score[i] + min(length, end - earlier, place - passed)
                    if gained > best:
                        best, before = gained, i
            score.append(best)
            parent.append(before)
        used = [False] * len(matches)
        found = []
        for k in sorted(range(len(matches)), key=lambda k: (-score[k], matches[k][0])):
            if used[k]:
                continue
            first, at, rest = k, k, 0
            while at >= 0:
                if used[at]:
                    rest = score[at]
                    break
                used[at] = True
                first, at = at, parent[at]
            found.append((matches[first][0] - matches[first][2], matches[k][0], score[k] - rest))
        return found

    def scan(self, column: pa.Array) -> list[tuple]:
        """n_words, n_base, first and last place, both label texts, score and spans of each text."""
        data, offsets = texts(column)
        words = spans(data, offsets, NOT_ALNUM, lower=True)
        bases: dict[int, list[tuple[int, int]]] = {}
        matched: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
        for text, first, ids in self.runs(data, words):
            statistics = list(self.automaton.run(ids))
            for k, (length, state) in enumerate(statistics):
                for phrase in self.ending[state]:
                    if self.phrase_sizes[phrase] <= length:
                        bases.setdefault(text, []).append((first + k + 1 - self.phrase_sizes[phrase], phrase))
                if length >= self.min_match and (k + 1 == len(statistics) or statistics[k + 1][0] <= length):
                    for template, end in self.places[state]:
                        matched.setdefault(text, {}).setdefault(template, []).append((first + k + 1, end, length))
        found = []
        for text, n_words in enumerate(np.diff(words.offsets).tolist()):
            places = bases.get(text, ())
            base = {self.phrases[phrase][1] for _, phrase in places}
            held = []
            for template, matches in sorted(matched.get(text, {}).items()):
                for first, end, covered in self.chains(sorted(matches)):
                    share = min(1.0, covered / self.sizes[template])
                    if share >= self.min_covered:
                        held.append((self.templates[template][0], template, first, end - 1, covered, share))
            starts = [start for start, _ in places]
            score = max([each[5] for each in held] + [PHRASE_SCORE if places else 0.0])
            labels = base | {each[0] for each in held}
            found.append(
                (
                    n_words, len(places), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(base)), ",".join(sorted(labels)), score, held,
                )
            )
        return found


_SPAN = pa.struct(
    [
        ("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("covered", pa.int32()), ("share", pa.float64()),
    ]
)
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(_SPAN)]
_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def scan(docs: DataFrame, scanner: Scanner | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, counts and places of phrases, labels, score and the spans found.

    ``score`` is the greatest share of a template that a span covers, at least ``PHRASE_SCORE`` where a
    phrase stands, else 0. A null or empty text, or one without words, has zeros, no places, empty
    labels and no spans. Texts are read whole. Repeated rows are scanned each for themselves, other
    columns are ignored, and an empty table gives an empty result. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scanner or Scanner())
    id_type = dict(docs.dtypes)[id_column]

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, "text"):
            columns = list(zip(*own.scan(batch.column("text")))) or [[] for _ in _KINDS]
            columns[-1] = [[dict(zip(_SPAN.names, each)) for each in row] for row in columns[-1]]
            arrays = [pa.array(values, kind) for values, kind in zip(columns, _KINDS)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], names=["doc_id", *_NAMES])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(scanned, f"doc_id {id_type}, {RESULT}")
