"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the longest length are cut into pieces of it and a rest. Pieces are dealt by a
hash into groups of about ``GROUP_ROWS``, each packed by itself: longest first, into the open
sequence with the least room that is enough. Where none has, a sequence is opened of the length whose
cost for each token that it can still receive is least. In the end each sequence shrinks to the
shortest permitted length that holds its content. Groups share no sequence, which costs part of one
sequence in a group; no group grows with the data.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

LENGTHS = (512, 1024, 2048, 4096, 8192)
GROUP_ROWS = 2_000


def default_cost(length: int) -> float:
    """A fixed part for each sequence, a linear part, and a part for attention."""
    return 64 + length + length**2 / 32_768


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = default_cost) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size, and the length of each bin; sizes come in falling order."""
    lengths = tuple(sorted(lengths))
    room: list[int] = []  # distinct amounts of room in open bins, in order
    with_room: dict[int, list[int]] = {}
    used: list[int] = []
    opened: list[int] = []
    bins, offsets = [], []
    left = sum(sizes)
    for size in sizes:
        at = bisect_left(room, size)
        if at < len(room):
            free = room[at]
            own = with_room[free].pop()
            if not with_room[free]:
                del with_room[free], room[at]
        else:
            fitting = [length for length in lengths if length >= size]
            free = min(fitting, key=lambda length: (cost(length) / min(length, left), length))
            own = len(used)
            used.append(0)
            opened.append(free)
        bins.append(own)
        offsets.append(used[own])
        used[own] += size
        left -= size
        rest = free - size
        if rest:
            if rest not in with_room:
                insort(room, rest)
                with_room[rest] = []
            with_room[rest].append(own)
    return bins, offsets, [lengths[bisect_left(lengths, filled)] for filled in used]


def best_fit(
    docs: DataFrame,
    size: Column,
    lengths: tuple[int, ...] = LENGTHS,
    cost: Callable[[int], float] = default_cost,
    group_rows: int = GROUP_ROWS,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per piece: doc_id, piece, piece_start, size, bin_id, bin_offset, bin_length.

    ``size`` is what a document takes of a sequence, its tokens for instance. Every row of ``docs`` is packed, repeated rows and null identifiers too; a null size or one below
    1 counts as 1. Equal sizes are taken in the order of identifier (nulls first), piece and row.
    Other columns are ignored, an empty table gives an empty result.
    """
    longest = max(lengths)
    sized = written(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.greatest(F.coalesce(size.cast("long"), F.lit(1)), F.lit(1)).alias("whole"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    n = sized.agg(F.sum(F.ceil(F.col("whole") / longest))).first()[0] or 0
    groups = max(1, math.ceil(n / group_rows))
    pieces = sized.select(
        "doc_id", "whole", "row", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("whole") / longest) - 1).cast("int"))).alias("piece")
    ).select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * longest).alias("piece_start"),
        F.least(F.col("whole") - F.col("piece").cast("long") * longest, F.lit(longest)).alias("size"),
        "row",
        F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("group"),
    )
    id_type = dict(docs.dtypes)[id_column]

    def packed(table: pa.Table) -> pa.Table:
        keys = [("size", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("row", "ascending")]
        order = pc.sort_indices(table, sort_keys=keys, null_placement="at_start")
        table = table.take(order)
        bins, offsets, filled = pack(table.column("size").to_pylist(), lengths, cost)
        group = table.column("group")[0].as_py()
        bins = np.array(bins, np.int64)
        return pa.table(
            {
                **{name: table.column(name) for name in ("doc_id", "piece", "piece_start", "size")},
                "bin_id": (np.int64(group) << np.int64(24)) + bins,
                "bin_offset": np.array(offsets, np.int64),
                "bin_length": np.array(filled, np.int32)[bins],
            }
        )

    return pieces.groupBy("group").applyInArrow(
        packed, f"doc_id {id_type}, piece int, piece_start bigint, size bigint, bin_id bigint, bin_offset bigint, bin_length int"
    )
