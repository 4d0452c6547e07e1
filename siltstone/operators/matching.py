"""Greedy one-to-one matching of a graph's nodes, in rounds on the executors.

Taken one after the other in the order of (first, second), an edge is accepted if both of its nodes are
still free. An edge that is the least of all edges of both its nodes is accepted whatever happens
elsewhere, so a round accepts all of those at once, drops the edges of their nodes, and goes on with the
rest. The result is that of the sequential order.

Where nodes have many edges, or edges form a chain in rising order, few edges are the least of both their
nodes. So a round also takes a window, which one task goes through in order: the edges whose second is
below a bound. If all edges rise (first < second), what decides on an edge are edges with a first below
its first or with its first and a second below its second; the seconds of all of those are no greater
than its own, so a window is decided without the other edges. Edges that fall may depend on any second;
if there are some, a window holds the edges whose first is below a bound, the beginning of the order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_ROWS, written

#: So many edges at most are finished without another round.
LAST_EDGES = 1_000_000
#: So many edges at most go through one task, 16 bytes each.
WINDOW_EDGES = 1_000_000
#: So many nodes at most bound a window.
WINDOW_NODES = 100_000
MATCHED = "first bigint, second bigint"


def _edges(pairs: DataFrame) -> DataFrame:
    """Edges between two different nodes, as (first, second); a repeated edge changes no decision."""
    given = pairs.select(F.col("first").cast("bigint").alias("first"), F.col("second").cast("bigint").alias("second"))
    return given.where("first <> second")


def _least_edges(edges: DataFrame) -> DataFrame:
    """Edges that are the least of all edges of both their nodes."""
    firsts = edges.groupBy("first").agg(F.min("second").alias("second"))
    seconds = edges.groupBy("second").agg(F.min("first").alias("first"))
    by_node = firsts.select(F.col("first").alias("node"), F.struct("first", "second").alias("edge")).unionByName(
        seconds.select(F.col("second").alias("node"), F.struct("first", "second").alias("edge"))
    )
    least = by_node.groupBy("node").agg(F.min("edge").alias("edge"))
    return least.groupBy("edge").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("edge.first", "edge.second")


def _window(edges: DataFrame, end: str, most: int) -> DataFrame | None:
    """Edges of the least nodes at ``end``, ``most`` edges at most; none if the least node alone has more."""
    sizes = edges.groupBy(end).agg(F.count(F.lit(1)).alias("n")).orderBy(end).limit(WINDOW_NODES).toArrow()
    nodes = int(np.searchsorted(np.cumsum(sizes.column("n").to_numpy()), most, "right"))
    return edges.where(F.col(end) <= sizes.column(end)[nodes - 1].as_py()) if nodes else None


def _without(edges: DataFrame, accepted: DataFrame, n_accepted: int) -> DataFrame:
    taken = accepted.select(F.explode(F.array("first", "second")).alias("node"))
    if 2 * n_accepted <= BROADCAST_MAX_ROWS:
        taken = F.broadcast(taken)
    for end in ("first", "second"):
        edges = edges.join(taken, edges[end] == taken["node"], "left_anti")
    return edges


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sequential rule over sorted edges."""
    taken: set[int] = set()
    for batch in batches:
        first, second = (batch.column(i).to_numpy() for i in (0, 1))
        starts = np.flatnonzero(np.append(True, first[1:] != first[:-1])[: len(first)])
        found = []
        for node, low, high in zip(first[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(first)]):
            # A node that is free at its first edge is so until one of them is accepted.
            other = None if node in taken else next((x for x in second[low:high].tolist() if x not in taken), None)
            if other is not None:
                taken |= {node, other}
                found.append((node, other))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*found)], names=["first", "second"])


def _finished(edges: DataFrame) -> DataFrame:
    """The sequential rule in one task."""
    return edges.repartition(1).sortWithinPartitions("first", "second").mapInArrow(_in_order, MATCHED)


def greedy_pairs(pairs: DataFrame, last_edges: int = LAST_EDGES, window_edges: int = WINDOW_EDGES) -> DataFrame:
    """``(first, second)`` of the accepted edges of ``pairs``; no node is in two of them.

    Repeated edges count once; edges with a null, or of a node with itself, don't count. Other columns
    are ignored. Every round's edges are written, so no plan grows with the rounds. Two rounds that
    follow each other drop more than ``window_edges`` edges, unless a node alone has as many or a window
    has ``WINDOW_NODES`` nodes.
    """
    spark = pairs.sparkSession
    edges = written(_edges(pairs), "edges")
    found, left = [], edges.count()
    end = "second" if left <= last_edges or edges.where("first > second").isEmpty() else "first"
    while left > last_edges:
        window = _window(edges, end, window_edges)
        if window is None:
            accepted = _least_edges(edges)
        elif left <= window_edges:
            accepted = _finished(window)
        else:
            accepted = _least_edges(edges).unionByName(_finished(window)).distinct()
        found.append(written(accepted, "matched"))
        edges = written(_without(edges, found[-1], found[-1].count()), "edges")
        left = edges.count()
    if left or not found:
        found.append(written(_finished(edges), "matched"))
    whole = found[0]
    for each in found[1:]:
        whole = whole.unionByName(each)
    return whole.select("first", "second") if found else spark.createDataFrame([], MATCHED)
