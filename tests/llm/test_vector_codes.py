"""Vector codes against a plain computation with Python integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import vector_codes
from siltstone.llm.vector_codes import Cells, compress

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, code int, n long, of string, salt int, row long, given long"


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) of each usable row, and the digest of the codebooks."""
    sizes = [len(v) for _, v, _ in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    if not sizes:
        return [], None
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    kept = []
    for vec_id, v, label in rows:
        if v and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(256 * float(np.float32(x))) for x in v]
            kept.append((vec_id, [whole[p * size // parts : (p + 1) * size // parts] for p in range(parts)], label))
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[row[1][p] for row in first] for p in range(parts)]

    def nearest(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [(nearest(books[p], row[1][p])[1], row[1][p]) for row in kept]
            books[p] = [
                [sum(column) // len(column) for column in zip(*members)] if (members := [part for i, part in own if i == e]) else entry
                for e, entry in enumerate(books[p])
            ]
    found, by_label = [], {}
    for vec_id, split, label in kept:
        got = [nearest(books[p], split[p]) for p in range(parts)]
        error = sum(d for d, _ in got)
        by_label[label] = by_label.get(label, 0) + error
        found.append((vec_id, "".join(f"{i:02x}" for _, i in got), error, label))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return [(v, c, e, by_label[label]) for v, c, e, label in found], hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "v", 1, 2, "o", 3, 4, 5) for i, v, label in rows], SCHEMA)


def same(spark, rows, **how):
    got = compress(frame(spark, rows), **how)
    found = [(r.vec_id, r.code, r.error, r.label_error) for r in got.rows.collect()]
    expected, digest = plain(rows, **{k: v for k, v in how.items() if k in ("parts", "entries", "rounds")})
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    if digest:
        assert got.digest == digest
    return found


def odd_vectors(seed=0, n=150):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 32)], [0, 1, None][i % 3]) for i in range(n)]
    one = rows[5][1]
    return [
        *rows, (None, one, 1), (None, rows[6][1], None), (3, one, 2), (3, one, 2), (900, None, 0), (901, [], 0), (902, [1.0] * 16, 0),
        (903, [None, *one[1:]], 0), (904, [float("nan"), *one[1:]], 0), (905, [float("inf"), *one[1:]], 0), (906, [0.5] * 31, 0),
        (-7, [0.0] * 32, 3), (-8, [-0.0] * 32, 3), (907, [100.0] * 32, 3), (908, [-100.0] * 32, None), *[(2000 + i, one, 9) for i in range(200)],
    ]


def test_equals_plain_computation(spark):
    same(spark, odd_vectors())


@pytest.mark.parametrize("cell, entries, rounds", [(1, 5, 3), (4096, 64, 1), (16, 1, 2)])
def test_any_cell_gives_the_same(spark, cell, entries, rounds):
    same(spark, odd_vectors(1, 60), cell=cell, entries=entries, rounds=rounds)


def test_fewer_rows_than_entries_and_other_parts(spark):
    same(spark, odd_vectors(2, 20), parts=4)
    same(spark, [(1, [0.1, 0.2], None)], parts=2)


def test_no_usable_row(spark):
    assert same(spark, [(1, None, 0), (2, [float("nan")] * 16, 1), (3, [1.0], 2)]) == []
    assert same(spark, []) == []


def test_components_without_exact_code(spark):
    with pytest.raises(ValueError):
        compress(frame(spark, [(1, [1e30] * 16, 0)]))


def test_many_labels_are_joined_in_salted_parts(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_MAX_ROWS", 1)
    same(spark, odd_vectors(3, 90))


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.integers(-60, 60), min_size=2, max_size=2), min_size=1, max_size=9),
    st.lists(st.lists(st.integers(-90, 90), min_size=2, max_size=2), min_size=1, max_size=80),
    st.integers(1, 40),
)
def test_cells_lose_no_entry(entries, parts, cell):
    """Ties and repeated entries included, also when all cells are forgotten on the way."""
    book, points = np.array(entries, np.int64), np.array(parts, np.int64)
    cells = Cells(book, cell, remembered=3)
    distance = ((points[:, None, :] - book) ** 2).sum(axis=2)
    for _ in range(2):
        for k in range(0, len(points), 7):
            code, error = cells.nearest(points[k : k + 7])
            assert code.tolist() == distance[k : k + 7].argmin(axis=1).tolist()
            assert error.tolist() == distance[k : k + 7].min(axis=1).tolist()


def test_cells_spare_most_distances():
    rng = np.random.default_rng(5)
    book, points = rng.normal(0, 32, (64, 4)).astype(np.int64), rng.normal(0, 32, (8000, 4)).astype(np.int64)
    cells = Cells(book)
    cells.nearest(points)
    assert cells.evaluated < 0.25 * len(points) * len(book)


def test_cells_far_apart():
    """Cells whose range has no number in 62 bits go by their bytes."""
    points = np.array([[x * 2**24, -x * 2**23, x, -x * 2**24] for x in range(-1, 2)], np.int64)
    code, error = Cells(points[::-1].copy(), 1).nearest(points)
    assert code.tolist() == [2, 1, 0] and error.tolist() == [0, 0, 0]
