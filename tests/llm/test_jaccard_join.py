import random
from fractions import Fraction

import numpy as np
import pytest

from odd import empty_docs, linked, odd_docs, odd_rows, prose, rows_of
from siltstone.llm import jaccard_join as J

COLUMNS = ["doc_id", "n_shingles", "component_id"]


def sort(rows):
    return sorted(rows, key=repr)


def near_rows(seed, families, members, words):
    """Families of texts that differ from their origin by more and more words, in a random order."""
    rng = random.Random(seed)
    rows = []
    for family in range(families):
        origin = prose(1000 * seed + family, words).split()
        for member in range(members):
            text = list(origin)
            for _ in range(rng.randint(0, words // 20)):
                text[rng.randrange(len(text))] = f"new{rng.randint(0, 10**6)}"
            cut = rng.randint(0, words // 8)
            rows.append((len(rows), " ".join(text[cut:])))
    shared = prose(7, 60)
    rows += [(len(rows) + i, f"{prose(500 + i, 90)} {shared}") for i in range(30)]
    rng.shuffle(rows)
    return rows


def test_odd_rows(spark):
    assert rows_of(J.jaccard_components(odd_docs(spark)), *COLUMNS) == sort(linked(odd_rows()))


@pytest.mark.parametrize("seed", [1, 2])
def test_families_equal_brute_force(spark, seed):
    rows = near_rows(seed, 12, 15, 160)
    assert rows_of(J.jaccard_components(odd_docs(spark, rows).repartition(5)), *COLUMNS) == sort(linked(rows))


def test_buckets_by_the_bytes(spark, monkeypatch):
    """More buckets than partitions ask for: the same links."""
    rows = near_rows(3, 6, 10, 120)
    monkeypatch.setattr(J, "BUCKET_BYTES", 500)
    seen = []
    monkeypatch.setattr(J, "_send", lambda width, buckets, send=J._send: seen.append(buckets) or send(width, buckets))
    assert rows_of(J.jaccard_components(odd_docs(spark, rows).repartition(4)), *COLUMNS) == sort(linked(rows))
    assert seen == [-(-sum(len(text.encode()) for _, text in rows) // 500)] and seen[0] > 100


def test_large_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(J, "GROUP_ITEMS", 2500)
    rows = near_rows(3, 3, 60, 150)
    assert rows_of(J.jaccard_components(odd_docs(spark, rows)), *COLUMNS) == sort(linked(rows))


def test_split_groups_at_a_low_threshold(spark, monkeypatch):
    """Sets whose sizes differ by nearly 1 / t link in a group that is split, as in one that isn't."""
    rows = []
    for k in range(12):
        words = prose(300 + k, 164).split()
        rows += [(2 * k, " ".join(words[: 104 + 3 * k])), (2 * k + 1, " ".join(words))]
    expected = sort((i, len(text.split()) - 4, i // 2 * 2) for i, text in rows)
    docs = odd_docs(spark, rows)
    assert rows_of(J.jaccard_components(docs, Fraction(3, 5)), *COLUMNS) == expected
    monkeypatch.setattr(J, "GROUP_ITEMS", 50)
    assert rows_of(J.jaccard_components(docs, Fraction(3, 5)), *COLUMNS) == expected


@pytest.mark.parametrize("seed", range(12))
def test_group_equals_all_pairs(seed):
    rng = random.Random(seed)
    t = Fraction(4, 5)
    sets = []
    for _ in range(6):
        origin = set(rng.sample(range(4000), rng.randint(3, 90)))
        for _ in range(12):
            changed = set(x for x in origin if rng.random() > rng.choice([0.01, 0.06, 0.12]))
            changed |= set(rng.sample(range(4000, 9000), rng.randint(0, max(1, len(origin) // 10))))
            sets.append(changed or {1})
    count = {}
    for s in sets:
        for x in s:
            count[x] = count.get(x, 0) + 1
    kept = [np.array(sorted((x for x in s if count[x] > 1), key=lambda x: (count[x], x)), np.uint64) for s in sets]
    group = J._Group(np.array([len(s) for s in sets]), kept, t)
    group.join()
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    ours = [group.root(i) for i in range(len(sets))]
    plain = [root(i) for i in range(len(sets))]
    assert [[a == b for b in ours] for a in ours] == [[a == b for b in plain] for a in plain]


def test_followers_are_not_looked_up(monkeypatch):
    base = np.arange(200, dtype=np.uint64)
    sets = [np.delete(base, i) for i in range(50)]
    group = J._Group(np.array([len(s) for s in sets]), sets, Fraction(4, 5))
    group.join()
    assert len(group.followers) == 1 and len({group.root(i) for i in range(50)}) == 1


def test_empty_and_threshold(spark):
    assert J.jaccard_components(empty_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        J.jaccard_components(empty_docs(spark), Fraction(1, 2))
