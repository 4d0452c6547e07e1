import random

import pytest

from siltstone.llm.components import components


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)]
    parent = list(range(121))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted((x, root(x)) for x in nodes)


def test_path_and_empty(spark):
    path = [(i, i + 1) for i in range(64)]
    random.Random(3).shuffle(path)
    found = components(spark.createDataFrame(path, "a long, b long")).collect()
    assert len(found) == 65 and {r.root for r in found} == {0}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
