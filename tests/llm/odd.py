"""Rows that operators have to get along with, and plain versions of what they compute."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

SPACE = r"[^\x20\x09-\x0D]+"
WORDS = "the of and to in is reason stone river cloud paper silver window garden mountain letter".split()
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, id long, row long, n long, part int, run long, keep string, rest string, size long, score double, node long, block long, key1 long, low long, group int, piece int"
CLASHING += ", row_number long, number long, known long, component_id long, kept boolean, verdict string, probability double, draw double, y double, at long, pair long, a long, b long, spans string, labels string, own string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(n))


def odd_rows() -> list[tuple[int | None, str | None]]:
    long_text = prose(1, 60_000)
    base = prose(2, 120)
    rows = [
        (1, None), (2, ""), (3, "  \n\t"), (4, "one"), (5, "two words"), (6, "ONE"), (7, "one"),
        (8, long_text), (9, long_text + " tail"), (10, base), (11, base), (12, base.upper()), (13, base + " more"),
        (14, "x" * 30_000), (15, "é à ü 漢字 🙂"), (16, "# $ % # $ %"), (17, "a\na\na\n\na"),
        (None, base), (None, "alone among the null rows here"), (None, None), (18, base), (18, base), (18, "same id other text"),
        (20, "  "), (21, "a b c d e a b c d e a b c d e"), (-5, "two words"),
    ]
    return rows + [(100 + i, "a hot text that many rows share") for i in range(300)]


def odd_docs(spark, rows=None):
    """The rows with other columns whose names clash with what operators use inside."""
    rows = odd_rows() if rows is None else rows
    full = [(i, t, "en" if k % 3 else None, "s", 0, -1, 7, 8, 9, 10, "k", "r", 1, 0.5, 2, 3, 4, 5, 6, 7, 8, 9, 1, 2, True, "v", 0.5, 0.1, 1.0, 3, 4, 5, 6, "s", "l", "o") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, CLASHING)


def empty_docs(spark):
    return odd_docs(spark, [])


def as_set(text: str | None, width: int = 5) -> set[tuple[str, ...]]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall(SPACE, lowered)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def linked(rows) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by comparing every pair that shares an n-gram."""
    sets = [as_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    has = defaultdict(list)
    for a, own in enumerate(sets):
        common = Counter(b for gram in own for b in has[gram])
        for b, both in common.items():
            if 100 * both >= 80 * (len(own) + len(sets[b]) - both):
                parent[root(a)] = root(b)
        for gram in own:
            has[gram].append(a)
    lowest: dict[int, int | None] = {}
    for a, (doc_id, _) in enumerate(rows):
        r = root(a)
        known = lowest.get(r)
        lowest[r] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return [(doc_id, len(own), lowest[root(a)]) for a, ((doc_id, _), own) in enumerate(zip(rows, sets))]


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = re.findall(SPACE, text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(SPACE, line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def rows_of(frame, *columns) -> list[tuple]:
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)
