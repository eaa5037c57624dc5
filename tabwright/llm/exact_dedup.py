"""Exact dedup through content-defined chunk recipes (DataFrame functions only).

1. A text is normalised (each run of ASCII white space becomes one space) and cut into
   chunks at content-defined places: a chunk ends behind sentence punctuation once it
   has ``min_chars`` characters, and at ``max_chars`` at the latest.  Equal texts are cut
   alike, and the chunks concatenate to the text.
2. Each distinct chunk crosses the network once per map task, keyed by its 64-bit hash;
   a hash with one content is a verified identifier.  The chunks of a hash that two
   contents share are kept verbatim beside the recipe instead.
3. Documents meet as recipes, ordered lists of identifiers (about 2 % of the text).
   Equal (recipe, verbatim chunks) means equal text; SHA-256 of the text is carried
   only as a result column.

Defined results: a null text counts as empty; empty texts are one group; of equal texts
the row with the smallest doc_id is kept (null ids come last), rows that repeat that id
with that text are the same record: ``exact_groups`` marks them all, ``exact_dedup`` leaves
one; an empty table gives an empty table; other columns pass through ``exact_dedup`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_one, materialise, prefixed, same, with_group_values

MIN_CHARS, MAX_CHARS = 256, 4096


def normalised(text: Column) -> Column:
    """Runs of white space to one space.  A lone space is left alone by the pattern: same result, fewer matches."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def chunks(text: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    """Content-defined chunks of ``text``; they concatenate to it."""
    pattern = rf"(?s).{{{min_chars},{max_chars}}}?(?:(?<=[.!?;,])\x20|\z)|.{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def clashing_ids(texts: DataFrame, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Chunk hashes that more than one chunk content has: (chunk_id)."""
    each = texts.select(F.explode(chunks(F.col("_norm"), min_chars, max_chars)).alias("chunk"))
    contents = each.select(F.xxhash64("chunk").alias("chunk_id"), "chunk").distinct()
    return contents.groupBy("chunk_id").count().filter("count > 1").select("chunk_id")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
            max_chars: int = MAX_CHARS) -> DataFrame:
    """(id, text_sha256, recipe, verbatim), one row per input row."""
    norm = docs.select(F.col(id_col), normalised(F.col(text_col)).alias("_norm"))
    out = norm.select(
        id_col, F.sha2("_norm", 256).alias("text_sha256"),
        F.transform(chunks(F.col("_norm"), min_chars, max_chars), lambda c: F.xxhash64(c)).alias("recipe"))
    clashes = materialise(clashing_ids(norm, min_chars, max_chars))
    if clashes.isEmpty():
        return out.withColumn("verbatim", F.array().cast("array<string>"))
    placed = norm.select(id_col, F.sha2("_norm", 256).alias("text_sha256"),
                         F.posexplode(chunks(F.col("_norm"), min_chars, max_chars)).alias("pos", "chunk"))
    placed = placed.withColumn("chunk_id", F.xxhash64("chunk")).join(clashes, "chunk_id", "left_semi")
    # one list per text that holds such a chunk: repeated rows of a text collapse first
    listed = (placed.select(id_col, "text_sha256", "pos", "chunk").distinct().groupBy(id_col, "text_sha256")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "chunk"))), lambda s: s["chunk"]).alias("verbatim")))
    keys = [id_col, "text_sha256"]
    listed = prefixed(listed, keys)
    return out.join(listed, same(out, listed, keys), "left").select(
        *out.columns, F.coalesce("verbatim", F.array().cast("array<string>")).alias("verbatim"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 max_chars: int = MAX_CHARS) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per input row."""
    table = materialise(recipes(docs, id_col, text_col, min_chars, max_chars))
    grouped = with_group_values(
        table, ["recipe", "verbatim"], [id_col],
        {"_keep": F.min(id_col), "_size": F.count(F.lit(1))},
        {"keep_id": F.min("_keep"), "group_size": F.sum("_size")})
    return grouped.select(id_col, "keep_id", F.col("group_size").cast("long"),
                          F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns.

    The keep decision comes back on (id, SHA-256 of the normalised text), so a table
    that uses one id for several texts is handled row by row."""
    groups = exact_groups(docs, id_col, text_col).filter("group_size > 1").groupBy(
        F.col(id_col).alias("_d_id"), F.col("text_sha256").alias("_d_sha")).agg(F.max("kept").alias("_stays"), F.count(F.lit(1)).alias("_n"))
    keys = {"_d_id": F.col(id_col), "_d_sha": F.sha2(normalised(F.col(text_col)), 256)}
    return keep_one(docs, keys, groups.filter("NOT _stays OR _n > 1").drop("_n"))


ORACLE = """
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
FROM t
"""
