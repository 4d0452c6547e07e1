"""Exact deduplication by sorting the content.

Rows are range partitioned and sorted by their normalised bytes, so that equal texts are neighbours,
and neighbours are compared in full. The splitters that Spark samples hold no whole text, only its
first characters, a hash of 128 bits, the identifier and a number of the row; the rest of the order (the
text itself) is applied by the external sort within a partition. As identifier and number are part of
the order, a text that a third of all rows share is spread over as many partitions as its rows ask for,
also where they have one identifier or none: the runs at the ends of partitions are put together
afterwards, one row per end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import written
from .spans import slices

PREFIX_CHARACTERS = 16
#: Rows of a run that leave a task in one batch.
SLICE_ROWS = 200_000


def _runs(schema: pa.Schema, whole: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]]:
    """Number the runs of equal texts in a sorted partition; the first and the last run stay open.

    Of the run that still grows only the first row and the identifiers wait in memory. The first row
    of a run carries the text if the run is open, and with ``whole`` also otherwise.
    """

    def finished(part: int, run: int, ids: list, lengths: list[int], leads: pa.Array, rest: pa.Array | None, last: bool):
        own = pa.concat_arrays(ids)
        lengths = np.array(lengths)
        begins = np.cumsum(lengths) - lengths
        keep = own.take(pa.array(begins))
        first = np.zeros(len(own), bool)
        first[begins] = True
        edge = np.zeros(len(lengths), bool)
        edge[0] |= run == 0
        edge[-1] |= last
        shas = pa.array([hashlib.sha256(text.encode()).hexdigest() for text in leads.to_pylist()], pa.string())
        # In slices, as a run may have more rows than one batch can hold hashes for.
        for low in range(0, len(own), SLICE_ROWS):
            here = slice(low, min(low + SLICE_ROWS, len(own)))
            numbers = np.searchsorted(begins, np.arange(here.start, here.stop), "right") - 1
            run_of = pa.array(numbers)
            shown = pa.array(numbers, mask=~(first[here] & (edge[numbers] | whole)))
            columns = [
                own.slice(low, len(numbers)), pa.array(np.full(len(numbers), part, np.int32)), pa.array(numbers + run), pa.array(first[here]),
                keep.take(run_of), pa.array(lengths[numbers]), shas.take(run_of), pa.array(edge[numbers]), leads.take(shown),
            ]
            columns = [c.cast(f.type) for c, f in zip(columns, schema)]
            if rest is not None:
                columns.append(pa.StructArray.from_arrays(rest.take(shown).flatten(), fields=list(schema.field("rest").type)))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        part, run = TaskContext.get().partitionId(), 0
        ids, lead, lead_rest = [], None, None
        for batch in slices(batches, "text"):
            column, keys = batch.column("text"), batch.column("id")
            rest = batch.column("rest") if "rest" in batch.schema.names else None
            differ = np.ones(len(column), bool)
            if len(column) > 1:
                differ[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
            if lead is not None:
                differ[0] = lead[0].as_py() != column[0].as_py()
            starts = np.flatnonzero(differ)
            if not len(starts):
                ids.append(keys)
                continue
            lengths, leads = np.diff(starts).tolist(), column.take(pa.array(starts[:-1]))
            rests = rest.take(pa.array(starts[:-1])) if rest is not None else None
            if lead is not None:
                lengths = [sum(map(len, ids)) + int(starts[0]), *lengths]
                leads = pa.concat_arrays([lead, leads])
                rests = pa.concat_arrays([lead_rest, rests]) if rest is not None else None
            if lengths:
                yield from finished(part, run, [*ids, keys.slice(0, starts[-1])], lengths, leads, rests, False)
                run += len(lengths)
            # Copies, so that the batch can go.
            ids = [keys.take(pa.array(np.arange(starts[-1], len(keys))))]
            lead = column.take(pa.array(starts[-1:]))
            lead_rest = rest.take(pa.array(starts[-1:])) if rest is not None else None
        if lead is not None:
            yield from finished(part, run, ids, [sum(map(len, ids))], lead, lead_rest, True)

    return numbered


def _decided(
    docs: DataFrame, id_column: str, text_column: str, keep: str, normalise: Callable[[Column], Column] | None, rest: list[Column] | None
) -> DataFrame:
    """Rows of the runs with their decision; with ``rest`` kept rows carry the text and these columns."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"),
        (normalise(text) if normalise else text).alias("text"),
        F.monotonically_increasing_id().alias("row"),
        *([F.struct(*rest).alias("rest")] if rest else []),
    )
    by_id = F.asc_nulls_last("id") if keep == "smallest" else F.desc_nulls_last("id")
    # Two hashes, as different texts between which ids could alternate must not share a place.
    place = [F.substring("text", 1, PREFIX_CHARACTERS), F.xxhash64("text"), F.xxhash64(F.lit(PREFIX_CHARACTERS), "text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The row's own number comes last, so that equal texts under one identifier, or none, are spread as well.
    placed = rows.repartitionByRange(parts, *place, by_id, "row").sortWithinPartitions(*place, "text", by_id, "row").drop("row")
    fields = {f.name: f.dataType for f in rows.schema}
    schema = (
        T.StructType()
        .add("id", fields["id"]).add("part", T.IntegerType()).add("run", T.LongType()).add("first", T.BooleanType()).add("keep", fields["id"])
        .add("n", T.LongType()).add("sha", T.StringType()).add("open", T.BooleanType()).add("text", T.StringType())
    )
    if rest:
        inner = [T.StructField(f.name, f.dataType, True) for f in fields["rest"].fields]
        schema = schema.add("rest", T.StructType(inner))
    runs = written(placed.mapInArrow(_runs(to_arrow_schema(schema), bool(rest)), schema), "content-runs")

    # At most two open runs per partition, equal ones in neighbouring partitions.
    ends = runs.where("open and first")
    whole = ends.groupBy("text").agg(F.min(F.struct("part", "run", "keep")).alias("head"), F.sum("n").alias("total"))
    heads = ends.select("text", "part", "run").join(whole, "text").select(
        "part",
        "run",
        ((F.col("head.part") == F.col("part")) & (F.col("head.run") == F.col("run"))).alias("leads"),
        F.col("head.keep").alias("head_keep"),
        "total",
    )
    carried = ["text", "rest"] if rest else []
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", *carried]
    closed = runs.where("not open").select("id", "keep", "n", "first", "sha", *carried)
    opened = runs.where("open").join(F.broadcast(heads), ["part", "run"]).select(
        "id", "head_keep", "total", F.col("first") & F.col("leads"), "sha", *carried
    )
    return closed.toDF(*names).unionByName(opened.toDF(*names))


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` says whether the smallest or the largest identifier of equal texts stays.
    ``normalise`` is applied to the text before it is compared and hashed; a null text counts as
    empty. Exactly one row of a group is kept, also when identifiers repeat or are null: a null
    identifier stays only where its group has no other (``keep_id`` is then null). Other columns are
    ignored, an empty table gives an empty result.
    """
    return _decided(docs, id_column, text_column, keep, normalise, None)


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns.

    Columns travel with their text, so rows whose identifiers repeat aren't mixed up.
    """
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    own, own_id = at[text_column], at[id_column]
    rest = [F.col(c) for c in flat.columns if c != own] + [F.col(own).isNull().alias("no_text")]
    decided = _decided(flat, own_id, own, keep, None, rest).where("kept")
    text = F.when(~F.col("rest.no_text"), F.col("text"))
    return decided.select(*[(text if c == own else F.col(f"rest.{c}")).alias(name) for name, c in at.items()])
