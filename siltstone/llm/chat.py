"""Chat formatting by rotating the perspective over the participants of a conversation.

For every participant the whole dialogue is rendered with that speaker as the assistant and all
others as users with a name; system turns stay system turns. What the speaker says, up to the end
mark, is to be learnt; headers and the turns of others are masked.

The rendering is a table of segments, one for each turn and participant, with their place in the
rendered text, so that a conversation of any length is never gathered in one row: the segments in
the order of ``seq`` are the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

SYSTEM = "system"
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
#: Rows whose lengths are added up in one window; the sums of such blocks are added up after them.
BLOCK = 256


def _in_blocks(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """Adds ``at``, which rises in the order of ``order``, and ``block``, of ``BLOCK`` such rows at most.

    Rows are dealt into ranges of the order and numbered in them, so blocks go by rows: turns that
    repeat or are null, or a conversation that a third of all rows share, make more blocks, no larger ones.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = [*order, "row"]
    ranged = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, *whole).sortWithinPartitions(*whole)
    numbered = written(ranged.drop("row").withColumn("at", F.monotonically_increasing_id()), "turns")
    return numbered.withColumn("block", F.floor(F.col("at") / BLOCK))


def _before(rows: DataFrame, keys: list[str], order: list[Column], size: Column) -> DataFrame:
    """Adds ``seq`` and ``char_start``: rows and characters before each row within ``keys``."""
    local = Window.partitionBy(*keys, "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # By block, so that the rows of a long conversation are spread over tasks.
    rows = rows.withColumn("size", size).repartition(*keys, "block")
    own = rows.withColumns({"own_rows": F.count(F.lit(1)).over(local), "own_size": F.coalesce(F.sum("size").over(local), F.lit(0))})
    totals = rows.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys,
        "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("size_before"),
    )
    # On the keys of the window, so that the rows stay where they are.
    return own.join(starts, [*keys, "block"]).select(
        *rows.columns,
        (F.col("own_rows") + F.col("rows_before")).alias("seq"),
        (F.col("own_size") + F.col("size_before")).alias("char_start"),
    )


def perspectives(
    turns: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    system: str = SYSTEM,
) -> DataFrame:
    """One row per participant and turn: conv_id, participant, seq, role, segment, spans.

    Participants are the distinct roles of a conversation but ``system``. Turns stand in the order of
    their number (null first), then of role and text; equal rows are all rendered. ``learn_start`` and
    ``learn_end`` are the characters to learn, null where the segment is masked. A null role is
    rendered as a user without a name and is no participant; a null text counts as empty; rows with a
    null conversation belong to one conversation. A conversation without participants gives no rows.
    Other columns are ignored, an empty table gives an empty result. Rows out are participants times
    turns of each conversation, by the method.
    """
    rows = turns.select(
        F.col(conv_column).alias("conv_id"),
        # Two keys that are never null stand for the conversation.
        F.coalesce(F.col(conv_column).cast("string"), F.lit("")).alias("conv"),
        F.col(conv_column).isNull().alias("nowhere"),
        F.col(turn_column).cast("long").alias("turn"),
        F.col(role_column).alias("speaker"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    rows = _in_blocks(rows, ["nowhere", "conv", F.asc("turn"), F.asc("speaker"), F.asc("text")])
    speakers = rows.where(F.col("speaker").isNotNull() & (F.col("speaker") != system)).select(
        "conv", "nowhere", F.col("speaker").alias("participant")
    ).distinct()
    seen = rows.join(speakers, ["conv", "nowhere"])
    own = F.coalesce(F.col("speaker") == F.col("participant"), F.lit(False))
    role = F.when(own, "assistant").when(F.col("speaker") == system, "system").otherwise("user")
    named = ~own & F.col("speaker").isNotNull() & (F.col("speaker") != system)
    header = F.concat(F.lit(OPEN), role, F.when(named, F.concat(F.lit(" name="), F.col("speaker"))).otherwise(""), F.lit(CLOSE))
    seen = seen.withColumns({"own": own, "role": role, "head": F.length(header), "segment": F.concat(header, "text", F.lit(END))})
    placed = _before(seen, ["conv", "nowhere", "participant"], [F.asc("at")], F.length("segment"))
    learnt = lambda place: F.when(F.col("own"), place)
    return placed.select(
        "conv_id",
        "participant",
        "seq",
        "turn",
        "role",
        "segment",
        "char_start",
        (F.col("char_start") + F.col("size")).alias("char_end"),
        learnt(F.col("char_start") + F.col("head")).alias("learn_start"),
        learnt(F.col("char_start") + F.col("size")).alias("learn_end"),
    )
