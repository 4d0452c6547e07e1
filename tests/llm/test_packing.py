import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odd import empty_docs, odd_docs, odd_rows
from siltstone.llm import byte_bpe
from siltstone.llm.token_counts import _coder, tokens_and_end
from siltstone.llm.packing import LENGTHS, best_fit, default_cost, pack


VOCABULARY = byte_bpe.load()
CODER = _coder(VOCABULARY)


def tokens(text):
    return len(CODER.encode_ordinary(text or "")) + 1


def packed(spark, docs, **how):
    return best_fit(docs, tokens_and_end(spark, VOCABULARY), **how)


def plain(sizes, lengths):
    """Contents of the bins of best fit, by looking at every open bin."""
    used, length = [], []
    left = sum(sizes)
    for size in sizes:
        fits = [(length[b] - used[b], b) for b in range(len(used)) if length[b] - used[b] >= size]
        if fits:
            b = min(fits)[1]
        else:
            b = len(used)
            used.append(0)
            length.append(min((n for n in lengths if n >= size), key=lambda n: (default_cost(n) / min(n, left), n)))
        left -= size
        used[b] += size
    return sorted(used)


@pytest.mark.parametrize("seed", range(6))
def test_pack_equals_best_fit(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, rng.choice([40, 500, 1000])) for _ in range(300)), reverse=True)
    lengths = (128, 512, 1000)
    bins, offsets, filled = pack(sizes, lengths)
    content = defaultdict(list)
    for size, b, offset in zip(sizes, bins, offsets):
        content[b].append((offset, size))
    for b, own in content.items():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        # Downsized: no shorter permitted length holds the content.
        assert filled[b] == min(n for n in lengths if n >= at)
    # Which of several bins with equal room is taken changes contents, but not how many are opened.
    assert len(content) == len(plain(sizes, lengths))


def test_least_cost_opens_small_bins_at_the_end():
    assert pack([10], (16, 1024))[2] == [16]
    assert pack([], (16,)) == ([], [], [])


def check(rows, found, lengths):
    sizes = sorted(tokens(text) for _, text in rows)
    whole = defaultdict(int)
    bins = defaultdict(list)
    for r in found:
        bins[r.bin_id].append(r)
        whole[r.doc_id] += r.size
    assert sum(whole.values()) == sum(sizes)
    assert sum(r.piece == 0 for r in found) == len(rows)
    for own in bins.values():
        own.sort(key=lambda r: r.bin_offset)
        ends = [r.bin_offset + r.size for r in own]
        assert [r.bin_offset for r in own] == [0, *ends[:-1]]
        assert {r.bin_length for r in own} == {min(n for n in lengths if n >= ends[-1])}
    return whole


def test_odd_rows_whole(spark):
    found = packed(spark, odd_docs(spark)).collect()
    whole = check(odd_rows(), found, LENGTHS)
    n = tokens(dict(odd_rows())[8])
    assert whole[8] == n > 60_000
    pieces = sorted((r.piece, r.piece_start, r.size) for r in found if r.doc_id == 8)
    assert [p for p, _, _ in pieces] == list(range(-(-n // 8192))) and all(start == p * 8192 for p, start, _ in pieces)


def test_long_texts_without_spaces_are_cut(spark):
    rows = [(1, "x" * 90_000), (2, "漢字" * 20_000), (3, "QUJD" * 20_000), (4, None), (5, "")]
    found = packed(spark, odd_docs(spark, rows)).collect()
    whole = check(rows, found, LENGTHS)
    assert whole == {i: tokens(text) for i, text in rows}
    assert all(sum(r.doc_id == i for r in found) > 1 for i in (1, 2, 3)) and whole[4] == whole[5] == 1


def test_sizes_are_the_tokens_of_the_encoder(spark):
    docs = odd_docs(spark)
    both = docs.select(tokens_and_end(spark, VOCABULARY).alias("n"), byte_bpe.round_trip(spark, VOCABULARY, F.col("text")).alias("r")).collect()
    assert len(both) == len(odd_rows()) and all(row.n == row.r.n_tokens + 1 for row in both)


def test_own_size_lengths_and_groups(spark):
    rows = [(i, "w " * (i % 50)) for i in range(900)]
    found = packed(spark, odd_docs(spark, rows), lengths=(64, 128), group_rows=100).collect()
    check(rows, found, (64, 128))
    assert len({r.bin_id >> 24 for r in found}) == 9
    fixed = best_fit(odd_docs(spark, rows), size=F.lit(None).cast("long"), lengths=(64,)).collect()
    assert {r.size for r in fixed} == {1}


def test_filled_well(spark):
    found = packed(spark, spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    used = found.agg(F.sum("size")).first()[0]
    room = found.select("bin_id", "bin_length").distinct().agg(F.sum("bin_length")).first()[0]
    assert used / room > 0.97


def test_empty(spark):
    assert packed(spark, empty_docs(spark)).collect() == []
