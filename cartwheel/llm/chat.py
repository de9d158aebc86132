"""Chat formatting: every speaker of a dialogue in turn is the assistant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.plans.skew import number_in_group

NARRATORS = ("system",)
TURNS = 256
BLOCK = 1024


def perspectives(turns: DataFrame, narrators: tuple[str, ...] = NARRATORS) -> DataFrame:
    """One row per conversation, speaker and turn: conv_id, speaker, place, header, body, trained.

    For each speaker of a conversation the whole dialogue is rendered with that speaker as ``assistant`` and all others
    as ``user`` with their names; ``narrators`` keep their role and are nobody's perspective. ``trained`` is true on
    the speaker's own turns. ``place`` numbers the turns of a conversation 1..n by turn, speaker and text, a null turn
    first. A null role is the speaker "unknown", a null text is empty, turns without a conversation belong to one
    conversation without id; repeated rows are turns of their own. A conversation of narrators alone gives no rows,
    nor does an empty table; other columns are ignored.
    """
    clean = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    placed = number_in_group(clean, ["conv_id"], ["turn", "role", "text"]).withColumnRenamed("rn", "place")
    narrator = F.col("role").isin(*narrators)
    speakers = placed.where(~narrator).select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    own = F.col("role") == F.col("speaker")
    header = (
        F.when(narrator, F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n")))
        .when(own, F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), F.col("role"), F.lit("|>\n")))
    )
    return placed.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "speaker", "place", header.alias("header"), F.concat("text", F.lit("<|end|>\n")).alias("body"),
        own.alias("trained"),
    )


def _offsets(pieces: Column, first: Column) -> Column:
    """Spans (start, end) of the trained bodies in order, in code points; the pieces begin at ``first``."""
    begin = F.struct(first.cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state, piece):
        start = state["at"] + F.length(piece["header"])
        end = start + F.length(piece["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(piece["trained"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(pieces, begin, step, lambda state: state["spans"])


def _part_starts(lengths: DataFrame) -> DataFrame:
    """conv_id, speaker, part and ``start``, the characters of the dialogue before the part, from rows with ``n_chars``.

    Lengths are summed within blocks of ``BLOCK`` parts, and those sums over the blocks, so that the window over a whole
    dialogue has one small row for each ``BLOCK * TURNS`` turns.
    """
    keys = ["conv_id", "speaker"]
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lengths = lengths.withColumn("block", F.floor(F.col("part") / BLOCK))
    inside = lengths.withColumn("inside", F.coalesce(F.sum("n_chars").over(before.partitionBy(*keys, "block")), F.lit(0)))
    blocks = lengths.groupBy(*keys, "block").agg(F.sum("n_chars").alias("n_chars"))
    ahead = F.coalesce(F.sum("n_chars").over(before.partitionBy(*keys).orderBy("block")), F.lit(0))
    blocks = blocks.select(*[F.col(c).alias(f"_{c}") for c in (*keys, "block")], ahead.alias("ahead"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, "block")]
    return inside.join(blocks, same).select(*keys, "part", (F.col("ahead") + F.col("inside")).alias("start"))


def render(turns: DataFrame, narrators: tuple[str, ...] = NARRATORS, part_turns: int = TURNS) -> DataFrame:
    """conv_id, speaker, part, n_turns, start, text and spans (start, end of what is trained on, end exclusive).

    The text of a dialogue is stored in parts of ``part_turns`` turns, numbered from 0, so that one of any length stays
    out of a single task; joined in order they are the dialogue. ``start`` is the part's place in the dialogue. All
    offsets are code points of the whole dialogue, whatever the parts: a span's text is at ``span.start - start`` of
    its part.
    """
    rows = perspectives(turns, narrators).withColumn("part", F.floor((F.col("place") - 1) / part_turns).cast("int"))
    keys = ["conv_id", "speaker", "part"]
    size = F.length("header") + F.length("body")
    starts = _part_starts(rows.groupBy(*keys).agg(F.sum(size).alias("n_chars"))).select(
        *[F.col(c).alias(f"_{c}") for c in keys], "start"
    )
    gathered = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("place", "header", "body", "trained"))).alias("pieces")
    )
    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["header"], p["body"])), "")
    return gathered.join(starts, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]).select(
        *keys, F.size("pieces").cast("long").alias("n_turns"), "start", whole.alias("text"),
        _offsets(F.col("pieces"), F.col("start")).alias("spans"),
    )
