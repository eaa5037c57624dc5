"""Chat formatting by multi-party perspective rotation (DataFrame functions only).

Every participant of a dialogue gets a rendering of their own: that speaker is the
assistant, everyone else a named user, system turns stay system turns.  The rendering is
kept as pieces, one row per (conversation, perspective, message), with the piece's place
in the whole rendering and the span that is trained on (the assistant's text and end mark).
Pieces concatenated by position are the rendering; no dialogue is ever held in one task:
messages are numbered over a range-partitioned sort, and a long dialogue is rendered in
blocks of that number, whatever its turns are.

Defined results: messages are ordered by turn (null first), role, text, and every row is a
message, also one that repeats another; a null role speaks as ``unknown``; a null text is empty; the
null conversation id is a conversation of its own; a dialogue with system turns only has
no perspective; an opening mark inside a text is broken up so that it cannot forge a turn;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.rank import row_number_by

from .common import materialise, prefixed, same, with_block_rank

SYSTEM = "system"
OPEN, SAFE_OPEN, END = "<|", "< |", "<|end|>\n"
MESSAGES_A_BLOCK = 4096


def _head(shown: Column, name: Column) -> Column:
    return F.when(shown == "user", F.concat(F.lit("<|user name="), name, F.lit("|>\n"))).otherwise(
        F.concat(F.lit("<|"), shown, F.lit("|>\n")))


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv, perspective, position, turn, speaker, shown_as, piece, start, mask_start, mask_end)."""
    clean = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(OPEN), F.lit(SAFE_OPEN))
    name = F.replace(F.coalesce(F.col(role_col), F.lit("unknown")), F.lit(OPEN), F.lit(SAFE_OPEN))
    rows = turns.select(F.col(conv_col).alias("_conv"), F.col(turn_col).alias("turn"), name.alias("speaker"),
                        clean.alias("_text"))
    # equal messages are alike, so any order among them gives the same rows; the last key lets a range cut fall between them
    order = [F.col("turn").asc_nulls_first(), "speaker", "_text", "_tie"]
    rows = row_number_by(rows.withColumn("_tie", F.monotonically_increasing_id()), order, group=["_conv"], out="position").drop("_tie")
    rows = rows.withColumn("position", F.col("position") - 1).withColumn("_part", F.floor(F.col("position") / MESSAGES_A_BLOCK))
    rows = materialise(rows)  # read for participants, blocks and messages
    # participants reach the messages through (conversation, block): a hot dialogue is spread over its blocks
    people = prefixed(rows.filter(F.col("speaker") != SYSTEM).select("_conv", F.col("speaker").alias("perspective")).distinct(),
                      ["_conv"])
    blocks = rows.select("_conv", "_part").distinct()
    seats = blocks.join(people, same(blocks, people, ["_conv"])).select(
        F.col("_conv").alias("_r__conv"), F.col("_part").alias("_r__part"), "perspective")
    shown = F.when(F.col("speaker") == SYSTEM, F.lit(SYSTEM)).when(F.col("speaker") == F.col("perspective"), F.lit("assistant")) \
        .otherwise(F.lit("user"))
    seen = rows.join(seats, same(rows, seats, ["_conv", "_part"])).withColumn("shown_as", shown)
    seen = seen.withColumn("_headed", _head(F.col("shown_as"), F.col("speaker")))
    seen = seen.select("_conv", "perspective", "position", "turn", "speaker", "shown_as", "_part", F.length("_headed").cast("long").alias("_lead"),
                       F.concat("_headed", "_text", F.lit(END)).alias("piece"))
    seen = seen.withColumn("_chars", F.length("piece").cast("long"))
    placed = with_block_rank(seen, ["_conv", "perspective"], F.col("_part"), ["position"], "start", weight=F.col("_chars"))
    mine = F.col("shown_as") == "assistant"
    return placed.select(
        F.col("_conv").alias(conv_col), "perspective", "position", F.col("turn").alias(turn_col), "speaker", "shown_as", "piece", "start",
        F.when(mine, F.col("start") + F.col("_lead")).alias("mask_start"),
        F.when(mine, F.col("start") + F.col("_chars")).alias("mask_end"))


ORACLE = """
WITH m AS (SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker,
                  replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'),
s AS (SELECT m.*, p.perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS shown_as
      FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, CASE WHEN shown_as = 'user' THEN '<|user name=' || speaker || '|>' || chr(10) ELSE '<|' || shown_as || '|>' || chr(10) END AS lead FROM s),
w AS (SELECT *, lead || body || '<|end|>' || chr(10) AS piece FROM h),
o AS (SELECT *, row_number() OVER v - 1 AS position,
             CAST(sum(length(piece)) OVER v - length(piece) AS BIGINT) AS start
      FROM w WINDOW v AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, body ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, position, turn, speaker, shown_as, piece, start,
       CASE WHEN shown_as = 'assistant' THEN start + length(lead) END AS mask_start,
       CASE WHEN shown_as = 'assistant' THEN start + length(piece) END AS mask_end
FROM o
"""
