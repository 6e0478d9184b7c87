"""Chat formatting: one rendering of a dialogue for each of its participants.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and every other one as a named user; system turns are
nobody's and stay system turns.  A turn is rendered as

    <|assistant|>\\nTEXT<|end|>\\n      <|user:NAME|>\\nTEXT<|end|>\\n      <|system|>\\nTEXT<|end|>\\n

and the mask covers what the model is to learn: the text and the end mark of
the assistant's turns.

No text and no name can forge a marker: their ``<|`` is written ``<\\|`` (and a ``<\\``
of their own ``<\\\\``, so that texts stay apart), and ``|>`` in a name ``|\\>``.

A rendering is kept as its segments, one row for each turn, with their place
in the whole rendering (``start``, in code points), so that a conversation of any length is
spread over tasks: turns are ranked and added up in blocks of ``BLOCK`` turn
numbers, and blocks by a running sum over block totals.  :func:`joined`
puts the segments of a rendering together where one string is wanted.

Defined cases: a null text is empty; a null role is the speaker ``unknown``; a
null turn comes first; turns with equal numbers are ordered by role and text
and repeated rows stay; a null conversation id is a conversation of its own;
a conversation of system turns alone has no participant and no rendering; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlake.llm.common import settle, table

END = "<|end|>\n"
BLOCK = 64


def unmarked(text: Column) -> Column:
    """The text with its markers' openings escaped."""
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def named(speaker: Column) -> Column:
    """A speaker's name as a marker holds it."""
    return F.replace(unmarked(speaker), F.lit("|>"), F.lit("|\\>"))


def participants(turns: DataFrame) -> DataFrame:
    """(conv_id, perspective): the speakers of each conversation."""
    speakers = turns.select("conv_id", F.coalesce("role", F.lit("unknown")).alias("perspective"))
    return speakers.filter(F.col("perspective") != "system").distinct()


def perspectives(turns: DataFrame) -> DataFrame:
    """Segments: conv_id, perspective, turn, position, speaker_role, segment, start, mask_start, mask_stop.

    ``position`` counts the turns of a rendering from 0; the mask range is
    empty (equal ends) for turns that are not the assistant's.
    """
    rows = settle(
        turns.select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("unknown")).alias("speaker"),
            unmarked(F.coalesce("text", F.lit(""))).alias("text"),
            # null turns come first: a block of their own
            F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).cast("long").alias("block"),
        )
    )
    # lists of speakers per conversation, not of turns: joined as rows, one for each
    seen = participants(turns)
    views = rows.join(seen, rows.conv_id.eqNullSafe(seen.conv_id)).select(
        rows.conv_id, "perspective", "turn", "block", "speaker", "text"
    )
    role = F.when(F.col("speaker") == "system", "system").when(F.col("speaker") == F.col("perspective"), "assistant").otherwise("user")
    head = F.concat(
        F.lit("<|"), F.when(role == "user", F.concat(F.lit("user:"), named(F.col("speaker")))).otherwise(role), F.lit("|>\n")
    )
    made = (
        views.withColumn("speaker_role", role)
        .withColumn("head", head)
        .withColumn("segment", F.concat("head", "text", F.lit(END)))
        .withColumn("length", F.length("segment").cast("long"))
    )
    totals = made.groupBy("conv_id", "perspective", "block").agg(F.sum("length").alias("block_length"), F.count("*").alias("block_turns"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"),
        F.coalesce(F.sum("block_length").over(earlier), F.lit(0)).alias("base"),
        F.coalesce(F.sum("block_turns").over(earlier), F.lit(0)).alias("base_turns"),
    )
    order = [F.col("turn").asc_nulls_first(), "speaker", "text"]
    in_block = Window.partitionBy("conv_id", "perspective", "block").orderBy(*order)
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumn("inside", F.coalesce(F.sum("length").over(before), F.lit(0))).withColumn("at", F.row_number().over(in_block) - 1)
    start = F.col("base") + F.col("inside")
    text_at = start + F.length("head")
    mine = F.col("speaker_role") == "assistant"
    return placed.join(
        bases, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("block") == F.col("b"))
    ).select(
        "conv_id",
        "perspective",
        "turn",
        (F.col("base_turns") + F.col("at")).alias("position"),
        "speaker_role",
        "segment",
        start.alias("start"),
        text_at.alias("mask_start"),
        F.when(mine, start + F.col("length") - 1).otherwise(text_at).alias("mask_stop"),
    )


def joined(segments: DataFrame) -> DataFrame:
    """One string for each rendering (for dialogues that fit one row), with its mask ranges."""
    entry = F.struct("position", "segment", "mask_start", "mask_stop")
    return (
        segments.groupBy("conv_id", "perspective")
        .agg(F.array_sort(F.collect_list(entry)).alias("parts"))
        .select(
            "conv_id",
            "perspective",
            F.array_join("parts.segment", "").alias("rendering"),
            F.filter(
                F.transform("parts", lambda x: F.struct(x.mask_start.alias("start"), x.mask_stop.alias("stop"))),
                lambda x: x.start < x.stop,
            ).alias("masks"),
        )
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each of its participants."""
    return perspectives(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn::BIGINT AS turn, coalesce(role, 'unknown') AS speaker, replace(replace(coalesce(text, ''), '<\', '<\\'), '<|', '<\|') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
v AS (
  SELECT t.conv_id, perspective, turn, speaker, text,
         CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS speaker_role
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (
  SELECT *, '<|' || CASE WHEN speaker_role = 'user' THEN 'user:' || replace(replace(replace(speaker, '<\', '<\\'), '<|', '<\|'), '|>', '|\>') ELSE speaker_role END || '|>' || chr(10) AS head FROM v),
s AS (SELECT *, head || text || '<|end|>' || chr(10) AS segment FROM h),
o AS (
  SELECT *, row_number() OVER w - 1 AS position, (sum(length(segment)) OVER w - length(segment))::BIGINT AS start
  FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, turn, position::BIGINT AS position, speaker_role, segment, start,
       (start + length(head))::BIGINT AS mask_start,
       (CASE WHEN speaker_role = 'assistant' THEN start + length(segment) - 1 ELSE start + length(head) END)::BIGINT AS mask_stop
FROM o
"""
