"""Exact join of documents whose sets of word n-grams overlap, by skipping with set relations.

Two documents link if the Jaccard similarity of their n-gram sets reaches a threshold t; the result
gives the connected components of the links.

1. **Shared n-grams.** Sets are made in blocks of documents. Each block sends its n-grams once to the
   buckets of a hash; a bucket returns those found in two or more sets of the corpus. A document of
   n n-grams with fewer than t*n shared ones links with none, and leaves here. Only n-grams that are
   shared ever take part again, in the order of their frequency class, rarest first.
2. **Relation "equal".** Documents with equal sets form one class, represented by one set.
3. **Prefixes.** Linked sets share an n-gram among their first n - ceil(t*n) + 1 (unshared ones stand
   first and only shorten the prefix). Sets that meet in a prefix are chained, one edge a posting, and
   the components of this graph are the groups in which links can lie.
4. **Join within a group** (`_Group`): inverted lists are cut into blocks by position, and a block is
   skipped if position and size leave too little to come. A set very similar to an earlier one, its
   leader, is never looked up in the lists: what it shares with other sets follows from the answers
   computed for the leader, corrected by the few n-grams in which the two differ. Sets already in one
   component aren't compared.
5. The components of the links found are the result.

A group whose sets exceed ``GROUP_ITEMS`` n-grams is cut by size band and hash into parts, and every
pair of parts that sizes allow to link is a task of its own, so that memory stays bounded; no pair of
sets is left out.

n-grams are compared by hash: 48 bits, and the number of the bucket on top.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import components
from .spans import SPACES, mix, slices, spans, texts, windows

#: n-grams in a block, at about which it is sent; and documents, at most. With very many buckets a block
#: grows up to MOST_ITEMS, so that a row still carries some n-grams.
BLOCK_ITEMS = 1 << 20
MOST_ITEMS = 1 << 23
BLOCK_ROWS = 60_000
#: Bytes of text whose n-grams a bucket takes, at about which it is held by one task.
BUCKET_BYTES = 64 << 20
#: Ranges of a bucket that are sorted one after the other.
RANGES = 8
#: n-grams of a group that one task takes.
GROUP_ITEMS = 2_000_000
#: Positions in a block of an inverted list.
POSITIONS = 16
#: Sizes of a band differ by less than this factor over the threshold, so only sets of one size band and
#: of the next can link.
BAND = 1.008

_BINARY = [(name, pa.binary()) for name in ("items", "owners", "ids", "counts", "keys")]
_SENT_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), *_BINARY])
_BACK_SCHEMA = pa.schema([("block", pa.int64()), *_BINARY])
_SENT = "kind int, bucket bigint, block bigint, items binary, owners binary, ids binary, counts binary, keys binary"
_BACK = "block bigint, items binary, owners binary, ids binary, counts binary, keys binary"
_DOCUMENTS = "uid bigint, doc_id bigint, n bigint, key1 bigint, key2 bigint, items bigint, grams binary"
_LOW = np.uint64((1 << 48) - 1)


def need(t: Fraction, size: int | np.ndarray) -> int | np.ndarray:
    """ceil(t * size)."""
    return -((-t.numerator * size) // t.denominator)


# --- sets and shared n-grams ---------------------------------------------------------------------


def _sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The distinct n-grams of each text, in order."""
    data, offsets = texts(column)
    grams, cuts = windows(spans(data, offsets, SPACES, lower=True), width)
    return [np.unique(grams[cuts[i] : cuts[i + 1]]) for i in range(len(column))]


def _key(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that are equal for equal sets."""
    return int(mix(grams ^ np.uint64(0x6C62272E07BB0142)).sum()), int(mix(grams + np.uint64(0x27D4EB2F165667C5)).sum())


class _Block:
    """Sets gathered by a task until they are sent; equal sets of a block are sent once."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.ids: list[int | None] = []
        self.owners: list[int] = []
        self.classes: dict[tuple, int] = {}
        self.sets: list[np.ndarray] = []
        self.items = 0

    def add(self, doc_id: int | None, grams: np.ndarray) -> None:
        key = (len(grams), *_key(grams))
        place = self.classes.setdefault(key, len(self.classes))
        if place == len(self.sets):
            self.sets.append(grams)
            self.items += len(grams)
        self.ids.append(doc_id)
        self.owners.append(place)

    def rows(self, buckets: int) -> Iterator[dict]:
        grams = np.concatenate(self.sets)
        owner = np.repeat(np.arange(len(self.sets), dtype=np.uint16), [len(s) for s in self.sets])
        bucket = ((grams >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        low = (grams & _LOW).view(np.uint8).reshape(-1, 8)[:, :6][order]
        owner = owner[order]
        for b in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[b], cuts[b + 1])
            yield {"kind": 0, "bucket": int(b), "block": self.number, "items": low[part].tobytes(), "owners": owner[part].tobytes()}
        known = np.array([-1 if i is None else i for i in self.ids], np.int64)
        absent = np.array([i is None for i in self.ids])
        yield {
            "kind": 1,
            "bucket": (self.number * 0x9E3779B1 >> 7) % buckets,
            "block": self.number,
            "ids": known.tobytes() + absent.tobytes(),
            "owners": np.array(self.owners, np.uint16).tobytes(),
            "counts": np.array([n for n, _, _ in self.classes], np.int64).tobytes(),
            "keys": np.array([k for _, *k in self.classes], np.uint64).tobytes(),
        }


def _send(width: int, buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    full = min(max(BLOCK_ITEMS, 16 * buckets), MOST_ITEMS)

    def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        block = _Block(number)
        for batch in slices(batches, "text", 2 << 20):
            for doc_id, grams in zip(batch.column("id").to_pylist(), _sets(batch.column("text"), width)):
                block.add(doc_id, grams)
                if block.items >= full or len(block.ids) >= BLOCK_ROWS:
                    yield pa.RecordBatch.from_pylist(list(block.rows(buckets)), _SENT_SCHEMA)
                    number += 1
                    block = _Block(number)
        if block.ids:
            yield pa.RecordBatch.from_pylist(list(block.rows(buckets)), _SENT_SCHEMA)

    return sent


def _shared(table: pa.Table) -> pa.Table:
    """The n-grams of a bucket that two or more sets have, for each block, with their frequency class."""
    kind = np.array(table.column("kind"))
    sent, passed = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    back = [table.take(pa.array(passed)).select(_BACK_SCHEMA.names).cast(_BACK_SCHEMA)]
    if len(sent):
        rows = table.take(pa.array(sent))
        high = np.uint64(rows.column("bucket")[0].as_py()) << np.uint64(48)
        parts = [np.frombuffer(b, np.uint8).reshape(-1, 6) for b in rows.column("items").to_pylist()]
        owners = np.concatenate([np.frombuffer(b, np.uint16) for b in rows.column("owners").to_pylist()])
        wide = np.zeros((len(owners), 8), np.uint8)
        np.concatenate(parts, out=wide[:, :6])
        items = wide.view(np.uint64).ravel()
        frequency = np.zeros(len(items), np.uint8)
        for one in range(RANGES):
            here = np.flatnonzero(items % np.uint64(RANGES) == one)
            here = here[np.argsort(items[here])]
            sorted_items = items[here]
            begins = np.flatnonzero(np.append(True, sorted_items[1:] != sorted_items[:-1])[: len(here)])
            times = np.diff(np.append(begins, len(here)))
            frequency[here] = np.repeat(np.ceil(4 * np.log2(times)), times).astype(np.uint8)
        cuts = np.cumsum([0, *map(len, parts)])
        columns = {"block": [], "items": [], "owners": []}
        for block, a, b in zip(rows.column("block").to_pylist(), cuts[:-1], cuts[1:]):
            keep = np.flatnonzero(frequency[a:b]) + a
            if len(keep):
                columns["block"].append(block)
                columns["items"].append((items[keep] | high).tobytes() + frequency[keep].tobytes())
                columns["owners"].append(owners[keep].tobytes())
        none = pa.nulls(len(columns["block"]), pa.binary())
        back.append(
            pa.table(
                {
                    "block": pa.array(columns["block"], pa.int64()),
                    "items": pa.array(columns["items"], pa.binary()),
                    "owners": pa.array(columns["owners"], pa.binary()),
                    "ids": none,
                    "counts": none,
                    "keys": none,
                },
                schema=_BACK_SCHEMA,
            )
        )
    return pa.concat_tables(back)


def _documents(t: Fraction) -> Callable[[pa.Table], pa.Table]:
    """Put a block together again: a row per document, sets only where enough n-grams are shared."""

    def put(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        (head,) = [row for row in rows if row["ids"] is not None]
        owners = np.frombuffer(head["owners"], np.uint16)
        ids = pa.array(np.frombuffer(head["ids"], np.int64, len(owners)), mask=np.frombuffer(head["ids"], bool, offset=8 * len(owners)))
        counts, keys = np.frombuffer(head["counts"], np.int64), np.frombuffer(head["keys"], np.int64).reshape(-1, 2)
        parts = [row for row in rows if row["ids"] is None]
        owner = np.concatenate([np.zeros(0, np.uint16), *[np.frombuffer(row["owners"], np.uint16) for row in parts]])
        n = [len(row["owners"]) // 2 for row in parts]
        items = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(row["items"], np.uint64, k) for row, k in zip(parts, n)]])
        frequency = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(row["items"], np.uint8, offset=8 * k) for row, k in zip(parts, n)]])
        found = np.bincount(owner, minlength=len(counts))
        stays = (found >= need(t, counts)) & (counts > 0)
        use = stays[owner]
        owner, items, frequency = owner[use], items[use], frequency[use]
        order = np.lexsort((items, frequency, owner))
        items, cuts = items[order], np.searchsorted(owner[order], np.arange(len(counts) + 1))
        grams: list[bytes | None] = [None] * len(owners)
        _, first = np.unique(owners, return_index=True)
        for row in first:
            if stays[owners[row]]:
                grams[row] = items[cuts[owners[row]] : cuts[owners[row] + 1]].tobytes()
        return pa.table(
            {
                "uid": (np.int64(head["block"]) << np.int64(16)) + np.arange(len(owners)),
                "doc_id": ids,
                "n": counts[owners],
                "key1": keys[owners, 0],
                "key2": keys[owners, 1],
                "items": np.where(stays, found, 0)[owners],
                "grams": pa.array(grams, pa.binary()),
            }
        )

    return put


# --- the join within a group ---------------------------------------------------------------------


@dataclass
class _Member:
    """A set that follows a leader, and the n-grams that only one of the two has."""

    number: int
    added: np.ndarray
    removed: np.ndarray


class _Group:
    """Sets that may link, joined one after the other; those with the fewest unshared n-grams first.

    Leaders alone stand in the inverted lists. A follower f of leader p has J(f, p) >= (1 + t) / 2, so
    two followers can only link if their leaders reach the looser similarity 2 t - 1 (``near``): the
    Jaccard distance obeys the triangle inequality. Leaders that are near know each other's overlap,
    and the overlap of their followers differs from it by no more than the n-grams added.
    """

    def __init__(self, sizes: np.ndarray, sets: list[np.ndarray], t: Fraction) -> None:
        self.sizes, self.t = sizes, t
        _, codes = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True)
        cuts = np.cumsum([0, *map(len, sets)])
        #: The n-grams as small numbers, rarest first as they came.
        self.sets = [codes[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        self.marked = np.zeros(int(codes.max()) + 1 if len(codes) else 0, bool)
        self.leader = (1 + t) / 2
        self.near = 1 - (2 * (1 - self.leader) + (1 - t))
        self.parent = list(range(len(sets)))
        self.followers: dict[int, list[_Member]] = {}
        #: Pairs of leaders that are near, and their overlaps.
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        #: n-gram -> first position of a block -> leaders that have it there.
        self.lists: dict[int, dict[int, list[int]]] = {}
        #: The most n-grams that a leader of the block has from the position on.
        self.rests: dict[tuple[int, int], int] = {}

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def prefix(self, number: int, similarity: Fraction) -> int:
        """Shared n-grams in the prefix; the unshared ones stand before them."""
        size = int(self.sizes[number])
        return max(0, size - need(similarity, size) + 1 - (size - len(self.sets[number])))

    def candidates(self, number: int, similarity: Fraction) -> np.ndarray:
        """Leaders that meet the set in a prefix and can still reach the similarity by position and size."""
        size, own = int(self.sizes[number]), self.sets[number]
        least = need(similarity, size)
        # Sets of these sizes or larger share at least so many n-grams if they are similar.
        shared = need(similarity / (1 + similarity), size + least)
        found: set[int] = set()
        for place, gram in enumerate(own[: self.prefix(number, similarity)].tolist()):
            if len(own) - place < shared:
                break
            for position, block in self.lists.get(gram, {}).items():
                if self.rests[gram, position] >= shared:
                    found.update(block)
        close = np.sort(np.fromiter(found, np.int64, len(found)))
        sizes = self.sizes[close]
        return close[(sizes >= least) & (size >= need(similarity, sizes))]

    def overlaps(self, grams: np.ndarray, others: np.ndarray) -> np.ndarray:
        """How many of ``grams`` each of the other sets has."""
        if not len(others):
            return np.zeros(0, np.int64)
        self.marked[grams] = True
        joined = [self.sets[o] for o in others.tolist()]
        ends = np.cumsum([len(one) for one in joined])
        total = np.concatenate([[0], np.cumsum(self.marked[np.concatenate(joined)])])
        self.marked[grams] = False
        return np.diff(total[np.concatenate([[0], ends])])

    def similar(self, similarity: Fraction, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether sets of sizes ``a`` and ``b`` with this overlap reach the similarity."""
        return overlap * (similarity.numerator + similarity.denominator) >= similarity.numerator * (a + b)

    def join(self) -> None:
        unshared = self.sizes - np.array([len(own) for own in self.sets], np.int64)
        for number in np.lexsort((self.sizes, unshared)).tolist():
            self.place(number)
        if not self.pairs:
            return
        a, b, overlap = (np.concatenate(part) for part in zip(*self.pairs))
        alone = np.ones(len(self.sets), bool)
        most, least = np.zeros(len(self.sets), np.int64), self.sizes.copy()
        for leader, members in self.followers.items():
            if members:
                alone[leader] = False
                most[leader] = max(len(m.added) for m in members)
                least[leader] = min(int(self.sizes[m.number]) for m in members)
        least = np.minimum(least, self.sizes)
        can = ~(alone[a] & alone[b]) & self.similar(self.t, overlap + most[a] + most[b], least[a], least[b])
        for i in np.flatnonzero(can).tolist():
            self.derive(int(a[i]), int(b[i]), int(overlap[i]))

    def place(self, number: int) -> None:
        close = self.candidates(number, self.leader)
        overlap = self.overlaps(self.sets[number], close)
        able = np.flatnonzero(self.similar(self.leader, overlap, self.sizes[number], self.sizes[close]))
        if len(able):
            leader = int(close[able[0]])
            own, theirs = self.sets[number], self.sets[leader]
            self.link(number, leader)
            self.followers[leader].append(_Member(number, np.setdiff1d(own, theirs), np.setdiff1d(theirs, own)))
            return
        close = self.candidates(number, self.near)
        overlap = self.overlaps(self.sets[number], close)
        for other in close[self.similar(self.t, overlap, self.sizes[number], self.sizes[close])].tolist():
            self.link(number, other)
        near = self.similar(self.near, overlap, self.sizes[number], self.sizes[close])
        self.pairs.append((np.full(int(near.sum()), number), close[near], overlap[near]))
        self.followers[number] = []
        own, size = self.sets[number], int(self.sizes[number])
        for place, gram in enumerate(own[: self.prefix(number, self.near)].tolist()):
            position = (size - len(own) + place) // POSITIONS * POSITIONS
            self.lists.setdefault(gram, {}).setdefault(position, []).append(number)
            self.rests[gram, position] = max(self.rests.get((gram, position), 0), len(own) - place)

    def derive(self, a: int, b: int, overlap: int) -> None:
        """Compare leader a and its followers with leader b and its followers, until they are linked."""
        if self.root(a) == self.root(b):
            return
        none = np.zeros(0, np.int64)
        ours, theirs = [_Member(a, none, none), *self.followers[a]], [_Member(b, none, none), *self.followers[b]]
        sizes = self.sizes[[m.number for m in theirs]]
        most = np.array([len(m.added) for m in theirs])
        for member in ours:
            own = int(self.sizes[member.number])
            # What the two share can't be more than the leaders do, and what was added on either side.
            can = np.flatnonzero(self.similar(self.t, overlap + len(member.added) + most, own, sizes))
            if not len(can):
                continue
            self.marked[self.sets[b]] = True
            # From a to the member on one side, then from b to each of its followers on the other.
            with_b = overlap + int(self.marked[member.added].sum()) - int(self.marked[member.removed].sum())
            self.marked[self.sets[b]] = False
            self.marked[self.sets[member.number]] = True
            shared = np.array(
                [with_b + int(self.marked[theirs[i].added].sum()) - int(self.marked[theirs[i].removed].sum()) for i in can]
            )
            self.marked[self.sets[member.number]] = False
            linked = np.flatnonzero(self.similar(self.t, shared, own, sizes[can]))
            if len(linked):
                self.link(member.number, theirs[can[linked[0]]].number)
                return


def _joined(t: Fraction) -> Callable[[pa.Table], pa.Table]:
    """Links of one group, as edges from each set to the smallest set it is connected with."""

    def joined(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(grams, np.uint64) for grams in table.column("grams").to_pylist()]
        nodes = np.array(table.column("node"))
        group = _Group(np.array(table.column("n")), sets, t)
        group.join()
        roots = nodes[[group.root(i) for i in range(len(sets))]]
        apart = roots != nodes
        return pa.table({"a": roots[apart], "b": nodes[apart]})

    return joined


def _postings(t: Fraction) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def posted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            sets = [np.frombuffer(grams, np.int64) for grams in batch.column("grams").to_pylist()]
            kept = np.array([len(grams) for grams in sets], np.int64)
            long = np.maximum(0, sizes - need(t, sizes) + 1 - (sizes - kept))
            items = [grams[:k] for grams, k in zip(sets, long)]
            nodes = np.repeat(batch.column("node").to_numpy(), np.minimum(long, kept))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *items])), pa.array(nodes)], names=["item", "node"])

    return posted


def _tasks(members: DataFrame, t: Fraction) -> DataFrame:
    """Nodes with the tasks that they take part in: one, or for a group too large one per pair of parts.

    Needs ``node``, ``root``, ``n`` and ``items`` only, so no set moves until its tasks are known.
    """
    band = F.floor(F.log("n") / math.log(BAND / t)).cast("int")
    bands = members.groupBy("root", band.alias("band")).agg(F.sum("items").alias("items"))
    large = bands.groupBy("root").agg(F.sum("items").alias("all")).where(F.col("all") > GROUP_ITEMS).select("root")
    split = bands.join(large, "root").select("root", "band", F.ceil(F.col("items") * 2 / GROUP_ITEMS).cast("int").alias("parts"))
    beside = lambda step, name: split.select("root", (F.col("band") - step).alias("band"), F.col("parts").alias(name))
    plan = split.join(beside(1, "above"), ["root", "band"], "left").join(beside(-1, "below"), ["root", "band"], "left")
    # Only large groups have rows here, mostly none: written, its size decides how it is joined.
    plan = written(plan, "parts")
    placed = members.withColumn("band", band).join(plan, ["root", "band"], "left")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    key = lambda a, x, b, y: F.struct(a.alias("band1"), x.alias("part1"), b.alias("band2"), y.alias("part2"))
    up_to = lambda n: F.filter(F.sequence(F.lit(0), F.coalesce(n, F.lit(0))), lambda i: i < F.coalesce(n, F.lit(0)))
    here = F.col("band")
    tasks = F.when(F.col("parts").isNull(), F.array(key(F.lit(0), F.lit(0), F.lit(0), F.lit(0)))).otherwise(
        F.concat(
            F.transform(up_to(F.col("parts")), lambda i: key(here, F.least(own, i), here, F.greatest(own, i))),
            F.transform(up_to(F.col("above")), lambda i: key(here, own, here + 1, i)),
            F.transform(up_to(F.col("below")), lambda i: key(here - 1, i, here, own)),
        )
    )
    return placed.select("root", "node", tasks.alias("tasks"))


def jaccard_components(
    docs: DataFrame,
    threshold: Fraction = Fraction(4, 5),
    width: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are runs of bytes that are no ASCII white space, with A-Z lower-cased. A text with fewer
    than ``width`` words has one n-gram, all its words; null texts and texts without words have none
    and link with nothing. ``component_id`` is the smallest identifier that links reach, over equal and
    similar texts alike; rows with a null identifier take part, and only a component without any other
    has a null id. Repeated identifiers are rows of their own. Identifiers are integers; other columns
    are ignored; an empty table gives an empty result. ``docs`` should be read from files: a task that
    is run again has to see the rows in the same order.
    """
    t = Fraction(threshold).limit_denominator(10_000)
    if not Fraction(1, 2) < t <= 1:
        raise ValueError("the threshold lies above 1/2 and not above 1")
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    # As many as the texts ask for, whatever the number of partitions, so that a bucket doesn't grow with them.
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / BUCKET_BYTES))
    shared = rows.mapInArrow(_send(width, buckets), _SENT).groupBy("bucket").applyInArrow(_shared, _BACK)
    documents = written(shared.groupBy("block").applyInArrow(_documents(t), _DOCUMENTS), "sets")

    key = ["n", "key1", "key2"]
    classes = written(
        documents.where("n > 0")
        .groupBy(*key)
        .agg(F.min("doc_id").alias("low"), F.min(F.when(F.col("grams").isNotNull(), F.col("uid"))).alias("holder")),
        "classes",
    )
    holders = classes.where("holder is not null").select(F.col("holder").alias("node"))
    sets = documents.where("grams is not null").withColumnRenamed("uid", "node")
    postings = sets.select("node", "n", "grams").mapInArrow(_postings(t), "item bigint, node bigint").join(holders, "node")
    heads = postings.groupBy("item").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("times")).where("times > 1")
    edges = postings.join(heads, "item").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    members = components(edges).join(sets.select("node", "n", "items"), "node")
    tasks = written(_tasks(members, t), "tasks")
    groups = sets.select("node", "n", "grams").join(tasks, "node").select("root", F.explode("tasks").alias("task"), "node", "n", "grams")
    links = groups.select("root", "task.*", "node", "n", "grams")
    links = links.groupBy("root", "band1", "part1", "band2", "part2").applyInArrow(_joined(t), "a bigint, b bigint")
    linked = classes.join(components(links), F.col("holder") == F.col("node"))
    lowest = linked.groupBy("root").agg(F.min("low").alias("component"))
    named = linked.select(*key, "root").join(lowest, "root").select(*key, "component")
    # Written, so that the join with the documents is one that Spark can split at a hot class.
    together = written(classes.join(named, key, "left").select(*key, F.coalesce("component", "low").alias("component")), "named")
    return documents.join(together, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
