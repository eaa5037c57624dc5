"""Exact k-nearest neighbours without a Cartesian product.

Rows of both sides lie around the nearest of a few pivots and are cut, in order of their distance to it, into blocks
(:func:`blocked`): a block is a shell of a ball.  The pivots' distances bound the distance of any row of one block to any row
of another from below, so whole block pairs can be left out:

1. every query block meets the nearest base blocks that hold k rows; that gives each of its queries k candidates and
   the block a bound, its largest k-th distance;
2. it meets the other base blocks whose lower bound is not above that; the rest never meet.

A query block meets its base blocks, up to ``MEET_ROWS`` base rows at a time, in a ``cogroup``, whose function computes the distance
matrix and keeps each query's ``k`` best base rows.  The first meeting returns only each query's k-th distance; the second
only rows that are not beyond it.  So ``k`` candidates per query and ``MEET_ROWS`` base rows leave the tasks, not ``k`` a base block
— pairs are never materialised as rows — and a final row number per query keeps the global ``k`` best.  Both sizes
bound every task's memory; the number of blocks grows with the data.  Distance ties go to the smaller base id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.rank import row_number_by

_OUT = "qid long, bid long, dist double, blabel double"
PIVOTS = 64
MEET_ROWS = 65536


def _matrix(column) -> np.ndarray:
    """Rows of an array column as doubles."""
    return np.stack(column.to_numpy()).astype(np.float64)


def _distances(q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by the product form; good to rounding, which callers allow for."""
    return (q * q).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (q @ b.T)


def nearest_rows(q: np.ndarray, b: np.ndarray, k: int, digits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row of q the (positions, distances) of its k nearest rows of b, ties by position.

    Candidates come from the product form with room for its rounding; their distances are then taken exactly."""
    k, out = min(k, len(b)), []
    rows = max(1, min(256, (1 << 22) // max(1, len(b))))  # a matrix of 32 MB, however many base rows meet
    for s in range(0, len(q), rows):
        part = q[s:s + rows]
        rough = _distances(part, b)
        room = 1e-9 * (1.0 + (part * part).sum(axis=1) + (b * b).sum(axis=1).max()) + 10.0 ** -digits
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
        # a rounded distance may tie with one that is 10 ** -digits larger
        reach = (np.sqrt(np.maximum(kth + room, 0.0)) + 2 * 10.0 ** -digits) ** 2 + room
        for row, near, far in zip(part, rough, reach):
            at = np.flatnonzero(near <= far)
            d = np.sqrt(((b[at] - row) ** 2).sum(axis=1)).round(digits)
            best = np.argsort(d, kind="stable")[:k]
            out.append((at[best], d[best]))
    return out


def blocked(rows: DataFrame, key: str, pivots: np.ndarray, block_rows: int) -> DataFrame:
    """``rows`` (with vec) and _piv, _dist (nearest pivot) and _blk (number of the shell around it), written once."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            x = np.asarray(b.column(names.index("vec")).flatten().to_numpy(), np.float64).reshape(b.num_rows, -1) if b.num_rows else pivots[:0]
            d = np.maximum(_distances(x, pivots), 0.0)
            piv = d.argmin(axis=1)
            # exact to the nearest pivot: the bounds rest on it
            dist = np.sqrt(((x - pivots[piv]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(piv.astype(np.int32)), pa.array(dist)], names=[*names, "_piv", "_dist"])

    names = rows.columns
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = row_number_by(rows.mapInArrow(run, f"{kind}, _piv int, _dist double"), ["_dist", key], group=["_piv"], out="_rn")
    return placed.withColumn("_blk", F.floor((F.col("_rn") - 1) / block_rows)).drop("_rn").checkpoint(eager=True)


def block_pairs(q: DataFrame, b: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(qp, qs, bp, bs, n, low) for blocks of both sides: rows of the base block and the least distance between their rows.

    Only blocks' figures are here, a row for ``block_rows`` rows of data."""
    shells = lambda x, p, s: x.groupBy(F.col("_piv").alias(p), F.col("_blk").alias(s)).agg(
        F.count(F.lit(1)).alias(f"{p}_n"), F.min("_dist").alias(f"{p}_lo"), F.max("_dist").alias(f"{p}_hi"))
    between = np.sqrt(np.maximum(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2), 0.0))
    table = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in between])
    qs = shells(q, "qp", "qs").withColumn("bp", F.explode(F.sequence(F.lit(0), F.lit(len(pivots) - 1))))
    pairs = qs.join(shells(b, "bp", "bs"), "bp")
    d = F.element_at(F.element_at(table, F.col("qp") + 1), F.col("bp") + 1)
    low = F.greatest(F.lit(0.0), d - F.col("qp_hi") - F.col("bp_hi"), F.col("qp_lo") - d - F.col("bp_hi"), F.col("bp_lo") - d - F.col("qp_hi"))
    return pairs.select("qp", "qs", "bp", "bs", F.col("bp_n").alias("n"), low.alias("low"))


def _met(q: DataFrame, b: DataFrame, pairs: DataFrame, k: int, digits: int, bounds: bool = False) -> DataFrame:
    """The k best of each query, not beyond its _most, in the base blocks of each (qp, qs, part) of the pairs; with ``bounds`` only
    (qid, worst, n): the distance of the last of them and their number."""
    def best(qdf: pd.DataFrame, bdf: pd.DataFrame) -> pd.DataFrame:
        if qdf.empty or bdf.empty:
            return pd.DataFrame({c: [] for c in (("qid", "worst", "n") if bounds else ("qid", "bid", "dist", "blabel"))})
        bdf = bdf.sort_values("bid")
        found = nearest_rows(_matrix(qdf["vec"]), _matrix(bdf["vec"]), k, digits)
        if bounds:
            some = [i for i, (x, _) in enumerate(found) if len(x)]
            return pd.DataFrame({"qid": qdf["qid"].to_numpy()[some], "worst": [found[i][1][-1] for i in some], "n": [len(found[i][0]) for i in some]})
        found = [(x[d <= most], d[d <= most]) for (x, d), most in zip(found, qdf["_most"].to_numpy())]
        at = np.concatenate([x for x, _ in found])
        return pd.DataFrame({"qid": np.repeat(qdf["qid"].to_numpy(), [len(x) for x, _ in found]), "bid": bdf["bid"].to_numpy()[at],
                             "dist": np.concatenate([d for _, d in found]), "blabel": bdf["blabel"].to_numpy()[at]})

    keys = ["qp", "qs", "part"]
    left = q.join(pairs.select(*keys).distinct(), (q["_piv"] == F.col("qp")) & (q["_blk"] == F.col("qs"))).select(*keys, "qid", "vec", "_most")
    own = pairs.select(*[F.col(c).alias(f"r_{c}") for c in [*keys, "bp", "bs"]])  # columns of its own: both sides come from one table of pairs
    right = b.join(own, (b["_piv"] == F.col("r_bp")) & (b["_blk"] == F.col("r_bs"))).select(*[f"r_{c}" for c in keys], "bid", "vec", "blabel")
    return left.groupBy(*keys).cogroup(right.groupBy(*[f"r_{c}" for c in keys])).applyInPandas(best, "qid long, worst double, n long" if bounds else _OUT)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy("dist", "bid")  # at most k rows a base block that the query met
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def pivots_of(base: DataFrame, n: int) -> np.ndarray:
    """Up to ``n`` base vectors, the same in every run; they shape the blocks, not the result."""
    rows = base.orderBy(F.xxhash64("bid"), "bid").limit(n).select("vec").collect()
    return np.unique(np.array([r[0] for r in rows], np.float64), axis=0) if rows else np.zeros((0, 0))


def knn(queries: DataFrame, base: DataFrame, k: int, qid: str, bid: str, vec: str, label: str,
        block_rows: int = 2048, digits: int = 9, seen: dict | None = None, meet_rows: int = MEET_ROWS) -> DataFrame:
    """``(qid, bid, dist, blabel, rank)`` for the ``k`` nearest base rows of every query row
    (Euclidean, rounded to ``digits`` decimals before ranking so engines agree on ties).

    ``seen`` (optional) receives ``pairs`` and ``met``: block pairs in all and those that met."""
    q = queries.select(F.col(qid).alias("qid"), F.col(vec).alias("vec"))
    b = base.select(F.col(bid).alias("bid"), F.col(vec).alias("vec"), F.col(label).cast("double").alias("blabel"))
    nb, free = b.count(), F.lit(float("inf"))
    if nb <= block_rows:  # one base block: nothing to skip, so nothing to lay out
        parts = max(1, math.ceil(q.count() / block_rows))
        pairs = q.sparkSession.range(parts).select(F.lit(0).alias("qp"), F.col("id").alias("qs"), F.lit(0).alias("bp"), F.lit(0).alias("bs"), F.lit(0).alias("part"))
        whole = b.withColumns({"_piv": F.lit(0), "_blk": F.lit(0)})
        return _ranked(_met(q.withColumns({"_piv": F.lit(0), "_blk": F.pmod(F.xxhash64("qid"), F.lit(parts)), "_most": free}), whole, pairs, k, digits), k)
    pivots = pivots_of(b, min(PIVOTS, math.ceil(nb / block_rows)))
    q, b = blocked(q, "qid", pivots, block_rows), blocked(b, "bid", pivots, block_rows)
    pairs = block_pairs(q, b, pivots)
    order = Window.partitionBy("qp", "qs").orderBy("low", "bp", "bs").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0))
    pairs = pairs.withColumn("near", before < k).withColumn("part", F.floor(before / meet_rows)).checkpoint(eager=True)
    near = _met(q.withColumn("_most", free), b, pairs.where("near"), k, digits, bounds=True)
    worst = near.groupBy("qid").agg(F.when(F.sum("n") >= k, F.max("worst")).otherwise(free).alias("_most")).checkpoint(eager=True)
    far = q.select("qid", "_piv", "_blk").join(worst, "qid").groupBy(F.col("_piv").alias("_p"), F.col("_blk").alias("_b")).agg(F.max("_most").alias("_far"))
    met = pairs.join(far, (F.col("qp") == F.col("_p")) & (F.col("qs") == F.col("_b")), "left").where(
        F.col("near") | (F.col("low") <= F.col("_far") * (1 + 1e-9) + 2 * 10.0 ** -digits))
    met = met.select("qp", "qs", "bp", "bs", "n", "low").withColumn("part", F.floor(before / meet_rows)).checkpoint(eager=True)
    if seen is not None:
        seen["pairs"], seen["met"] = pairs.count(), met.count()
    return _ranked(_met(q.join(worst, "qid", "left").withColumn("_most", F.coalesce("_most", free)), b, met, k, digits), k)


def neighbour_weight(weights: str, qid: str = "qid"):
    """``uniform``: 1; ``distance``: 1 / distance, or, where a neighbour lies at distance 0, 1 for those and 0 for the rest.

    Give a column of the query's least distance as _least for the latter."""
    if weights == "uniform":
        return F.lit(1.0)
    return F.when(F.col("_least") > 0, 1.0 / F.col("dist")).otherwise((F.col("dist") == 0).cast("double"))


def knn_weighted(nn: DataFrame, ks, weights: str = "distance") -> DataFrame:
    """L4: ``(qid, k, mean_label, vote)`` over the first ``k`` neighbours for each ``k`` in ``ks``: the weighted mean of their
    labels, and the label of most weight (ties: the smaller one)."""
    least = F.min("dist").over(Window.partitionBy("qid"))  # at most max(ks) rows a query
    kk = nn.withColumn("_least", least).withColumn("k", F.explode(F.array(*[F.lit(x) for x in ks]))).where(F.col("rank") <= F.col("k"))
    by = kk.withColumn("_w", neighbour_weight(weights)).groupBy("qid", "k", "blabel").agg(F.sum("_w").alias("_w"))
    vote = F.max_by("blabel", F.struct(F.round("_w", 9), -F.col("blabel")))
    return by.groupBy("qid", "k").agg((F.sum(F.col("_w") * F.col("blabel")) / F.sum("_w")).alias("mean_label"), vote.alias("vote"))


def knn_vote(nn: DataFrame) -> DataFrame:
    """L4 classification: majority label of the neighbours, ties → smallest label."""
    c = nn.groupBy("qid", "blabel").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("qid").orderBy(F.desc("_n"), F.asc("blabel"))
    return c.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("qid", F.col("blabel").alias("vote"))


def knn_mean(nn: DataFrame, ks) -> DataFrame:
    """L4 regression / E7: mean neighbour label over the first ``k`` neighbours for each ``k`` in ``ks``."""
    kk = nn.withColumn("k", F.explode(F.array(*[F.lit(x) for x in ks]))).where(F.col("rank") <= F.col("k"))
    return kk.groupBy("qid", "k").agg(F.avg("blabel").alias("mean_label"))
