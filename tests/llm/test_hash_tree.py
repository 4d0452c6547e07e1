import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from odd import empty_docs, odd_docs, odd_rows
from siltstone.llm.hash_tree import EIGHT, grown, shard_of, shards


def test_rows_sizes_and_slots(spark):
    found = shards(odd_docs(spark), EIGHT, grown(EIGHT, 8)).collect()
    assert sorted((r.size, r.text_crc32) for r in found) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in odd_rows()
    )
    for shard in {r.shard for r in found}:
        own = sorted(((r.slot, r.doc_id if r.doc_id is not None else -(10**9)) for r in found if r.shard == shard))
        assert [slot for slot, _ in own] == list(range(len(own)))
        assert [i for _, i in own] == sorted(i for _, i in own)
    assert len({r.shard for r in found if r.doc_id is None}) == 1


def test_growth_moves_rows_into_the_new_shard_only(spark):
    keys = spark.range(20_000)
    moved = keys.select(shard_of(F.col("id"), EIGHT).alias("a"), shard_of(F.col("id"), grown(EIGHT, 8)).alias("b")).collect()
    assert all(a == b or b == 8 for a, b in moved)
    counts = Counter(b for _, b in moved)
    assert set(counts) == set(range(9))
    assert all(abs(n - 20_000 / 9) < 250 for n in counts.values())


def test_weights_and_confined_movement(spark):
    heavier = {**EIGHT, "region0": {**EIGHT["region0"], "rack0": {0: 3.0, 1: 1.0}}}
    rows = spark.range(20_000).select(shard_of(F.col("id"), EIGHT).alias("a"), shard_of(F.col("id"), heavier).alias("b")).collect()
    # Only keys that enter region0, or rack0 within it, move; the rest stays where it is.
    assert all(b in (0, 1, 2, 3) for a, b in rows if a != b)
    assert all(b in (0, 1) for a, b in rows if a != b and a in (0, 1, 2, 3))
    share = Counter(b for _, b in rows)
    assert abs(share[0] - 20_000 * 0.3) < 500


def test_no_weight_no_rows(spark):
    tree = {"r": {"k": {0: 0.0, 1: 1.0}}}
    assert {r[0] for r in spark.range(100).select(shard_of(F.col("id"), tree)).collect()} == {1}
    with pytest.raises(ValueError):
        shard_of(F.col("id"), {"r": {"k": {0: 0.0}}})
    with pytest.raises(ValueError):
        grown(EIGHT, 3)


def test_empty(spark):
    assert shards(empty_docs(spark), EIGHT, grown(EIGHT, 8)).collect() == []
