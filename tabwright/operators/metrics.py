"""Evaluation metrics as distributed aggregates.

* Gini (M1) uses the closed form ``G = n/2 − Σ y·rank_asc / Σy`` (rank ascending in the sort
  order, ties broken by id, equal to the Lorenz-curve area), evaluated with
  :func:`rank_weighted_sum` — a range shuffle plus per-partition partial sums, no running
  window over one task.
* Quadratic weighted kappa (M2) needs five averages: the (N−1)² weight factor cancels.
* AUC (M6) is the rank-sum statistic with tie-averaged ranks; each row carries the positive
  share of its tie group as weight, so Σ weight·rank is one :func:`rank_weighted_sum`.
* Pairwise order accuracy (M8) counts concordant pairs without forming them: for every pair of
  label levels (a < b) the rows of both levels are ranked together and
  ``concordant = Σ_{i∈b} rank_{a∪b}(i) − n_b(n_b+1)/2``.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators import blocks as BL
from tabwright.operators.rank import rank_weighted_sum


def gini(df: DataFrame, y: str, pred: str, key: str, group: Sequence[str] = ()) -> DataFrame:
    """M1: normalised Gini per group: G(pred order) / G(true order).

    Prediction order is descending ``pred`` with the later key first on ties (Z4); in ascending
    terms that is ``(pred, key)``.  NULL where Σy or the true order's Gini is 0."""
    out, group = list(group), list(group) or ["_g"]
    base = df.select(*out, F.lit(0).alias("_g"), F.col(y).cast("double").alias("_y"), F.col(pred).alias("_p"),
                     F.col(key).alias("_k"))
    sp = rank_weighted_sum(base, ["_p", "_k"], "_y", group)
    st = rank_weighted_sum(base, ["_y", "_k"], "_y", group).select(*group, F.col("swr").alias("swr_t"))
    j = sp.join(st, group)
    g_pred = F.col("n") / 2 - F.try_divide(F.col("swr"), F.col("sw"))
    g_true = F.col("n") / 2 - F.try_divide(F.col("swr_t"), F.col("sw"))
    return j.select(*out, F.try_divide(g_pred, g_true).alias("gini"))


def kappa_quadratic(df: DataFrame, a: str, b: str, group: Sequence[str] = (), round_pred: bool = False) -> DataFrame:
    """M2: quadratic weighted kappa; ``round_pred`` rounds ``b`` half-even first.
    NULL when both ratings are the same constant (no disagreement is expected)."""
    bb = F.bround(F.col(b)) if round_pred else F.col(b)
    x = df.select(*group, F.col(a).cast("double").alias("_a"), bb.cast("double").alias("_b"))
    s = x.groupBy(*group).agg(F.avg((F.col("_a") - F.col("_b")) ** 2).alias("_o"), F.avg(F.col("_a") ** 2).alias("_aa"),
                              F.avg(F.col("_b") ** 2).alias("_bb"), F.avg("_a").alias("_ma"), F.avg("_b").alias("_mb"))
    e = F.col("_aa") + F.col("_bb") - 2 * F.col("_ma") * F.col("_mb")
    return s.select(*group, (1 - F.try_divide(F.col("_o"), e)).alias("kappa"))


def _level_grid(df: DataFrame, cols: Sequence[str]):
    mins, maxs = [F.min(c) for c in cols], [F.max(c) for c in cols]
    lo = df.agg(F.least(*mins) if len(cols) > 1 else mins[0]).scalar()
    hi = df.agg(F.greatest(*maxs) if len(cols) > 1 else maxs[0]).scalar()
    return F.sequence(lo.cast("int"), hi.cast("int"))


def confusion(df: DataFrame, a: str, b: str) -> DataFrame:
    """M3: counts per (a, b) over the dense grid min..max of both ratings."""
    counts = df.groupBy(F.col(a).cast("int").alias(a), F.col(b).cast("int").alias(b)).agg(
        F.count(F.lit(1)).alias("n"))
    levels = _level_grid(df, [a, b])
    grid = df.sparkSession.range(1).select(F.explode(levels).alias(a)).withColumn(b, F.explode(levels))
    return grid.join(counts, [a, b], "left").fillna(0, ["n"])


def histogram(df: DataFrame, r: str) -> DataFrame:
    """M4: dense rating histogram over min..max."""
    counts = df.groupBy(F.col(r).cast("int").alias(r)).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(1).select(F.explode(_level_grid(df, [r])).alias(r))
    return grid.join(counts, r, "left").fillna(0, ["n"])


def logloss_accuracy(df: DataFrame, probs: str, label: str, eps: float = 1e-15) -> DataFrame:
    """M5: multi-class log loss (probability of the true class clipped at ``eps``) and accuracy of the
    arg-max class (A16); ``label`` is the 0-based class index into the ``probs`` array."""
    p_true = F.element_at(F.col(probs), F.col(label) + 1)
    pred = F.array_position(F.col(probs), F.array_max(F.col(probs))) - 1
    return df.agg(F.avg(-F.log(F.greatest(p_true, F.lit(eps)))).alias("logloss"),
                  F.avg((pred == F.col(label)).cast("double")).alias("accuracy"))


def auc(df: DataFrame, label: str, score: str, key: str, group: Sequence[str] = ()) -> DataFrame:
    """M6: ROC AUC from tie-averaged ranks (Mann–Whitney U); NULL with one class only."""
    out, group = list(group), list(group) or ["_g"]
    base = df.select(*out, F.lit(0).alias("_g"), F.col(label).cast("double").alias("_l"), F.col(score).alias("_s"),
                     F.col(key).alias("_k"))
    ties = base.groupBy(*group, "_s").agg((F.sum("_l") / F.count(F.lit(1))).alias("_share"))
    weighted = base.join(ties, [*group, "_s"])
    s = rank_weighted_sum(weighted, ["_s", "_k"], "_share", group)
    npos = base.groupBy(*group).agg(F.sum("_l").alias("_np"), F.count(F.lit(1)).alias("_n"))
    j = s.join(npos, group)
    u = F.col("swr") - F.col("_np") * (F.col("_np") + 1) / 2
    return j.select(*out, F.try_divide(u, F.col("_np") * (F.col("_n") - F.col("_np"))).alias("auc"))


def rmse(df: DataFrame, y: str, pred: str, group: Sequence[str] = ()) -> DataFrame:
    """M9."""
    return df.groupBy(*group).agg(F.sqrt(F.avg((F.col(y) - F.col(pred)) ** 2)).alias("rmse"))


def pair_accuracy(df: DataFrame, y: str, pred: str, key: str, group: Sequence[str] = ()) -> DataFrame:
    """M8: share of pairs (same group, different ``y``) whose prediction order agrees with ``y``
    (a tie in ``pred`` counts as wrong), computed without materialising pairs.

    ``y`` is a label with few levels (ratings, classes): each row is copied once per other
    level — the level list is a scalar subquery over the distinct labels."""
    out, group = list(group), list(group) or ["_g"]
    base = df.select(*out, F.lit(0).alias("_g"), F.col(y).alias("_y"), F.col(pred).alias("_p"),
                     F.col(key).alias("_k"))
    levels = base.select(F.array_sort(F.collect_set("_y"))).scalar()
    u = base.withColumn("_lv", levels)  # projected first: no subquery inside the higher-order function
    u = u.withColumn("_o", F.explode(F.filter("_lv", lambda v: v != F.col("_y")))).drop("_lv")
    u = u.select("*", F.least("_y", "_o").alias("_ya"), F.greatest("_y", "_o").alias("_yb"),
                 (F.col("_y") > F.col("_o")).cast("double").alias("_hi"))
    # ties in pred: the higher level first, so an equal low-level prediction is not counted
    s = rank_weighted_sum(u, ["_p", F.desc("_hi"), "_k"], "_hi", [*group, "_ya", "_yb"])
    conc = s.select(*group, (F.col("swr") - F.col("sw") * (F.col("sw") + 1) / 2).alias("_c"),
                    (F.col("sw") * (F.col("n") - F.col("sw"))).alias("_pairs"))
    return conc.groupBy(*group).agg(F.try_divide(F.sum("_c"), F.sum("_pairs")).alias("pair_accuracy")).select(
        *out, "pair_accuracy")


def gini_shared_truth(df: DataFrame, y: str, pred: str, key: str, shared: Sequence[str],
                      variants: Sequence[str]) -> DataFrame:
    """M1 for many prediction variants of the same rows: the true-order term depends only on the
    ``shared`` keys (e.g. iter, fold) and is computed once, not once per variant (model, weight)."""
    shared, variants = list(shared), list(variants)
    base = df.select(*shared, *variants, F.col(y).cast("double").alias("_y"), F.col(pred).alias("_p"),
                     F.col(key).alias("_k"))
    sp = rank_weighted_sum(base, ["_p", "_k"], "_y", [*shared, *variants])
    truth_rows = df.select(*shared, F.col(y).cast("double").alias("_y"), F.col(key).alias("_k")).distinct()
    st = rank_weighted_sum(truth_rows, ["_y", "_k"], "_y", shared).select(*shared, F.col("swr").alias("swr_t"))
    j = sp.join(st, shared)
    g_pred = F.col("n") / 2 - F.try_divide(F.col("swr"), F.col("sw"))
    g_true = F.col("n") / 2 - F.try_divide(F.col("swr_t"), F.col("sw"))
    return j.select(*shared, *variants, (g_pred / g_true).alias("gini"))


def gini_by_variant(df: DataFrame, y: str, pred: str, key: str, shared: Sequence[str], variants: Sequence[str],
                    apart: Sequence = ()) -> DataFrame:
    """M1 per (shared, variants), as :func:`gini`, for variants (models) that mostly rate the same rows: variants of a
    ``shared`` group with the same (key, y) rows, by their number and two sums of 64-bit hashes, take their true-order term
    from one of them, and only that one's rows are sorted by ``y``.  A variant with other rows keeps its own.
    ``apart``: conditions that divide the variants; the rows of one after the other are then ranked, their sums stored."""
    shared, variants = list(shared), list(variants)
    group = [*shared, *variants]
    base = df.select(*group, F.col(y).cast("double").alias("_y"), F.col(pred).alias("_p"), F.col(key).alias("_k"))
    if apart:
        with BL.tidy(df.sparkSession):
            parts = [BL.stored(rank_weighted_sum(base.where(c), ["_p", "_k"], "_y", group)) for c in apart]
        sp = functools.reduce(DataFrame.unionByName, parts)
    else:
        sp = rank_weighted_sum(base, ["_p", "_k"], "_y", group)
    mark = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(20,0)"))
    rows = base.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), mark("_k", "_y").alias("_h"), mark("_y", "_k").alias("_i"))
    lead = rows.groupBy(*shared, "_n", "_h", "_i").agg(F.min(F.struct(*variants)).alias("_lead"))
    first = lead.select(*shared, *[F.col("_lead")[v].alias(v) for v in variants])
    # one row a group of rows (models by folds): bounded metadata
    st = rank_weighted_sum(base.join(F.broadcast(first), group, "left_semi"), ["_y", "_k"], "_y", group)
    st = st.select(*shared, F.struct(*variants).alias("_lead"), F.col("swr").alias("swr_t"))
    led = rows.join(lead, [*shared, "_n", "_h", "_i"]).select(*group, "_lead").join(st, [*shared, "_lead"]).select(*group, "swr_t")
    j = sp.join(led, group)
    g_pred = F.col("n") / 2 - F.try_divide(F.col("swr"), F.col("sw"))
    g_true = F.col("n") / 2 - F.try_divide(F.col("swr_t"), F.col("sw"))
    return j.select(*group, F.try_divide(g_pred, g_true).alias("gini"))
