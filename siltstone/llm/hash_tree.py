"""Sharding by a weighted hash tree: regions hold racks, racks hold shards.

At each level every child draws ``-ln(u) / weight`` from a hash of its label and the key, and the
smallest draw wins, so a child receives keys in proportion to the weight of its subtree. The draw of
a child depends on nothing but its label, its weight and the key: raising a weight moves keys into
that child only, lowering it moves keys out of that child only, and the other subtrees keep what
they have among themselves.

A shard added as a region of its own (``grown``) therefore takes rows only into itself. A shard added
to a rack that exists raises the weight of its rack and region, so rows also move between the shards
of that subtree, and nowhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]

#: Eight shards of equal weight.
EIGHT: Tree = {
    "region0": {"rack0": {0: 1.0, 1: 1.0}, "rack1": {2: 1.0, 3: 1.0}},
    "region1": {"rack2": {4: 1.0, 5: 1.0}, "rack3": {6: 1.0, 7: 1.0}},
}


def grown(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region and rack of its own."""
    if any(shard in shards for racks in tree.values() for shards in racks.values()):
        raise ValueError(f"shard {shard} is in the tree already")
    return tree | {f"region-of-{shard}": {f"rack-of-{shard}": {shard: weight}}}


def _weight(node: dict | float) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else node


def _draw(key: Column, label: str, weight: float) -> Column:
    # 13 hexadecimal digits are 52 bits, which a double holds exactly.
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{label}/"), key)), 1, 13), 16, 10)
    return -F.log((digits.cast("double") + 0.5) / F.lit(float(2**52))) / F.lit(float(weight))


def _descend(key: Column, children: dict, path: str) -> Column:
    """The shard below ``children``."""
    live = [(label, child) for label, child in children.items() if _weight(child) > 0]
    if not live:
        raise ValueError(f"no weight below {path or 'the root'}")
    below = [
        _descend(key, child, f"{path}{label}/") if isinstance(child, dict) else F.lit(label)
        for label, child in live
    ]
    if len(live) == 1:
        return below[0]
    draws = [
        F.struct(_draw(key, f"{path}{label}", _weight(child)), F.lit(place))
        for place, (label, child) in enumerate(live)
    ]
    chosen = F.least(*draws)["col2"]
    shard = below[-1]
    for place in range(len(live) - 1):
        shard = F.when(chosen == place, below[place]) if place == 0 else shard.when(chosen == place, below[place])
    return shard.otherwise(below[-1])


def shard_of(key: Column, tree: Tree) -> Column:
    """Shard of a key by the draws of ``tree``; a null key counts as the empty text."""
    return _descend(F.coalesce(key.cast("string"), F.lit("")), tree, "").cast("int")


def shards(docs: DataFrame, tree: Tree, grown_tree: Tree, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Shard, slot and shard after growth of every row.

    ``slot`` counts the rows of a shard from 0 in the order of the id (nulls first, then checksum and
    size). No text is shuffled and no shard is sorted in one task: the narrow rows are range
    partitioned by shard, id and row, numbered within each partition, and the numbers of one row per
    partition and shard are added up before them. Equal ids, or null ids, go to one shard and are
    still split between tasks. A null text has size 1 and the checksum of the empty text. Other
    columns are ignored, an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = F.col(id_column)
    narrow = written(
        docs.select(
            key.alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            shard_of(key, tree).alias("shard"),
            shard_of(key, grown_tree).alias("grown_shard"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    order = ["shard", "doc_id", "text_crc32", "size", "row"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = written(
        narrow.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
        .drop("row"),
        "shard-order",
    )
    # At most one row per partition and one more per shard.
    counts = numbered.groupBy("shard", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first")
    )
    before = (
        counts.alias("a")
        .join(counts.alias("b"), (F.col("a.shard") == F.col("b.shard")) & (F.col("b.part") < F.col("a.part")), "left")
        .groupBy(F.col("a.shard").alias("shard"), F.col("a.part").alias("part"))
        .agg((F.coalesce(F.sum("b.n"), F.lit(0)) - F.first("a.first")).alias("shift"))
    )
    return numbered.join(F.broadcast(before), ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("at") + F.col("shift")).alias("slot"),
        "grown_shard",
    )
