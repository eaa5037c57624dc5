"""Text features in relational form.

Documents are exploded to ``(doc_id, term, tf)`` rows; document frequencies are a group-by
on ``term``; weights join back on ``term`` (AQE broadcasts the vocabulary when small and
keeps a shuffle join when it is not).  Per-document sums are grouped by ``doc_id`` — one
document's rows are bounded by its own length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators import blocks as BL


def term_counts(docs: DataFrame, key: str, tokens, stop_words=None) -> DataFrame:
    """``(key, term, tf)`` from an array-of-tokens column or expression.  Pass the tokenising
    *expression* (not a pre-projected column) so the explode consumes it directly; stop words are
    removed after the explode (a plain ``isin`` filter, cheaper than a lambda over every array).
    When ``docs`` is hash-partitioned by ``key`` the count needs no further shuffle."""
    t = docs.select(key, F.explode(tokens).alias("term"))
    if stop_words:
        t = t.where(~F.col("term").isin(list(stop_words)))
    return t.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_idf(tf: DataFrame, key: str, min_df: int = 1, max_df_ratio: float = 1.0, n_docs=None) -> DataFrame:
    """Vocabulary with smooth idf ``ln((1 + n) / (1 + df)) + 1``; ``min_df`` absolute, ``max_df`` a share;
    ``n`` = ``n_docs`` (the corpus size, documents without terms included) or, when not given, the
    number of keys in ``tf``."""
    n = n_docs if n_docs is not None else tf.select(key).distinct().agg(F.count(F.lit(1))).scalar()
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = df.where((F.col("df") >= min_df) & (F.col("df") <= n * max_df_ratio))
    return kept.select("term", "df", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf(tf: DataFrame, key: str, idf: DataFrame, sublinear: bool = True) -> DataFrame:
    """``(key, term, w)``, ``w = (1 + ln tf)·idf`` (or ``tf·idf``), L2-normalised per key."""
    t = F.log(F.col("tf")) + 1 if sublinear else F.col("tf").cast("double")
    w = tf.join(idf.select("term", "idf"), "term").select(key, "term", (t * F.col("idf")).alias("w"))
    # one document's terms per window partition: bounded by that document's length
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("w") / norm).alias("w"))


def _similar(batches):
    """Arrow batches of pairs with both sides' terms and weights -> the pair and its dot product and squared lengths."""
    for batch in batches:
        t = pa.Table.from_batches([batch])
        n = t.num_rows
        qsize, qterms = BL.lists(t, "_qt")
        size, terms = BL.lists(t, "_tt")
        wq, wt = (BL.lists(t, c)[1].to_numpy(zero_copy_only=False) for c in ("_qw", "_tw"))
        qrow, row = np.repeat(np.arange(n), qsize), np.repeat(np.arange(n), size)
        known = pc.unique(qterms)
        at = BL.codes(terms, known)
        # a pair's row and the term's place make one number; a row's terms differ
        have = qrow * max(len(known), 1) + BL.codes(qterms, known)
        order, want = np.argsort(have), row * max(len(known), 1) + at
        have = have[order]
        place = np.minimum(np.searchsorted(have, want), max(len(have) - 1, 0))
        hit = (at >= 0) & (have[place] == want) if len(have) else np.zeros(len(want), bool)
        parts = [np.bincount(row[hit], wt[hit] * wq[order[place[hit]]], n), np.bincount(qrow, wq * wq, n), np.bincount(row, wt * wt, n)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, parts)], names=[*batch.schema.names[:3], "dot", "qq", "tt"])


def pair_similarity(wq: DataFrame, wt: DataFrame, pairs: DataFrame, qkey: str, tkey: str) -> DataFrame:
    """For each (tkey, qkey) pair the dot product of the two weight vectors (cosine for
    L2-normalised vectors) and the quasi-Jaccard ``q·t / ‖q + t‖²``.

    wq, wt: (key, term, w) or packed, one row a key.  Packed rows meet their pair, so no (key, term) row is shuffled.
    A pair that comes m times counts m times in its dot product."""
    side = lambda w, key, names: BL.packed(w, key).select(key, *[F.col(c).alias(n) for c, n in zip(("terms", "ws"), names)])
    each = pairs.groupBy(tkey, qkey).agg(F.count(F.lit(1)).alias("_m"))
    both = each.join(side(wt, tkey, ("_tt", "_tw")), tkey, "left").join(side(wq, qkey, ("_qt", "_qw")), qkey, "left")
    full = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    rows = both.select(tkey, qkey, "_m", full("_qt", "string"), full("_qw", "double"), full("_tt", "string"), full("_tw", "double"))
    kinds = [f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in (tkey, qkey)]
    out = rows.mapInArrow(_similar, ", ".join([*kinds, "_m long, dot double, qq double, tt double"]))
    dot = F.col("dot") * F.col("_m")
    out = out.withColumn("_each", F.explode(F.array_repeat(F.lit(1), F.col("_m").cast("int"))))
    return out.select(tkey, qkey, dot.alias("cosine"),
                      F.coalesce(dot / F.nullif(F.col("qq") + F.col("tt") + 2 * dot, F.lit(0.0)), F.lit(0.0)).alias("qjaccard"))


def overlap_ratio(q_tokens, t_tokens, legacy_int: bool = False):
    """T8 (Z1): ``|set(q) ∩ set(t)| / |set(t)|``, 0 when ``t`` is empty; ``legacy_int`` floors it."""
    inter = F.size(F.array_intersect(q_tokens, t_tokens))  # without duplicates
    size_t = F.size(F.array_distinct(t_tokens))
    if legacy_int:
        return F.when(size_t > 0, F.floor(inter / size_t)).otherwise(F.lit(0)).cast("long")
    return F.when(size_t > 0, inter / size_t).otherwise(F.lit(0.0))


def coverage(q_terms: DataFrame, d_terms: DataFrame, pairs: DataFrame, qkey: str, dkey: str) -> DataFrame:
    """Share of each query's distinct tokens that occur in the paired document (relational:
    query tokens ⋈ document tokens on (document, token))."""
    qd = q_terms.select(qkey, "term").distinct()
    dd = d_terms.select(dkey, "term").distinct()
    per_pair = pairs.join(qd, qkey)
    hit = per_pair.join(dd, [dkey, "term"]).groupBy(dkey, qkey).agg(F.count(F.lit(1)).alias("_hit"))
    size = qd.groupBy(qkey).agg(F.count(F.lit(1)).alias("_size"))
    out = pairs.join(hit, [dkey, qkey], "left").join(size, qkey, "left").fillna(0, ["_hit", "_size"])
    return out.select(dkey, qkey, F.coalesce(F.col("_hit") / F.nullif(F.col("_size"), F.lit(0)),
                                             F.lit(0.0)).alias("coverage"))


def top_terms(tf: DataFrame, k: int = 200) -> DataFrame:
    """The ``k`` most frequent terms (ties → term); a distributed top-k."""
    tot = tf.groupBy("term").agg(F.sum("tf").alias("n"))
    return tot.orderBy(F.desc("n"), F.asc("term")).limit(k)
