"""Pairwise hinge ranking without pairs.

A pair of one group with labels y_i > y_j counts when s_i - s_j is under the margin.  In the order of
scores of a group, row i is the winner of as many such pairs as rows of lower labels score above
s_i - margin, and the loser of as many as rows of higher labels score below s_i + margin.  So
the subgradient of all pairs is a sum over rows of features times those two counts, and the counts
are prefix counts by label in one merged order of the scores and the two shifted copies:

* scores and shifted scores are range-partitioned by (group, value) and sorted, n log n for n rows;
* a pass over each sorted partition keeps counts by label, nothing else, and leaves one row a
  (partition, group) with sums of features, and of features times local counts;
* those rows, at most partitions + groups, meet by group, where counts of earlier partitions are added.

Features are integers, so the sums are exact and do not depend on where the range was cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.rank import _stage_sorted

_LOSER, _SCORE, _WINNER = 0, 1, 2  # at equal values: s + margin before scores (strictly below), s - margin behind them (strictly above)


def linear_score(features: str, weights: Sequence[float], unit: float = 1.0) -> Column:
    """Sum of weight * feature / unit, added in the order of the features."""
    out = F.lit(0.0)
    for k, w in enumerate(weights):
        out = out + F.element_at(features, k + 1) / F.lit(float(unit)) * F.lit(float(w))
    return out


def hinge_gradient(rows: DataFrame, group: str, label: str, score: str, features: str, levels: Sequence, margin: float = 1.0) -> DataFrame:
    """(group, gradient array<double>, pairs): over all pairs that count, the sum of (loser's - winner's) features, and their number.

    ``levels``: the different labels in order, few.  Rows without a label take no part."""
    levels = list(levels)
    event = lambda kind, at: F.struct(F.lit(kind).alias("kind"), at.alias("at"))
    s = F.col(score).cast("double")
    place = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(label)) - 1
    events = rows.where(F.col(label).isNotNull()).select(
        F.col(group).alias("_g"), place.cast("int").alias("_y"), F.transform(features, lambda x: x.cast("double")).alias("_x"),
        F.explode(F.array(event(_LOSER, s + margin), event(_SCORE, s), event(_WINNER, s - margin))).alias("_e"))
    events = events.select("_g", "_y", "_x", F.col("_e.kind").alias("_kind"), F.col("_e.at").alias("_at"))
    staged = _stage_sorted(events, ["_g"], ["_at", "_kind"], None).select("_pid", "_g", "_y", "_x", "_kind")
    n = len(levels)
    kind = staged.schema["_g"].dataType.simpleString()
    parts = staged.mapInArrow(_walk(n), f"_pid int, _g {kind}, _counts array<double>, _sums array<double>")
    return parts.groupBy("_g").applyInArrow(_combine(n), f"`_g` {kind}, gradient array<double>, pairs double").withColumnRenamed("_g", group)


def _walk(n: int):
    """Per (partition, group): label counts; then by kind and label the sums of x and of x * local count, and of the local counts."""
    def one(state: dict, y: np.ndarray, x: np.ndarray, kind: np.ndarray) -> None:
        scores = np.zeros((len(y), n))
        scores[np.flatnonzero(kind == _SCORE), y[kind == _SCORE]] = 1
        upto = state["counts"] + np.cumsum(scores, axis=0)
        lower = np.concatenate((np.zeros((len(y), 1)), np.cumsum(upto, axis=1)), axis=1)  # counts below each label
        local = {_WINNER: lower[np.arange(len(y)), y], _LOSER: lower[:, n] - lower[np.arange(len(y)), y + 1]}
        for side, name in ((_WINNER, 0), (_LOSER, 1)):
            at = kind == side
            row = np.column_stack((np.ones(at.sum()), x[at], local[side][at], x[at] * local[side][at][:, None]))
            np.add.at(state["sums"][name], y[at], row)
        state["counts"] = upto[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([state["pid"]], pa.int32()), pa.array([state["g"]], kind_of_group),
                                               pa.array([state["counts"].tolist()]), pa.array([state["sums"].ravel().tolist()])],
                                              names=["_pid", "_g", "_counts", "_sums"])

        for b in batches:
            if not b.num_rows:
                continue
            kind_of_group = b.column(1).type
            pids, groups, y, kinds = b.column(0).to_numpy(), b.column(1), b.column(2).to_numpy(), b.column(4).to_numpy()
            x = b.column(3).flatten().to_numpy().reshape(b.num_rows, -1)
            names = groups.to_pylist()
            edges = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1] or pids[i] != pids[i - 1]], len(names)]
            for lo, hi in zip(edges, edges[1:]):
                if state is not None and (state["g"], state["pid"]) != (names[lo], pids[lo]):
                    yield done()
                    state = None
                if state is None:
                    state = {"g": names[lo], "pid": pids[lo], "counts": np.zeros(n), "sums": np.zeros((2, n, 2 + 2 * x.shape[1]))}
                one(state, y[lo:hi], x[lo:hi], kinds[lo:hi])
        if state is not None:
            yield done()

    return run


def _combine(n: int):
    def combine(key, rows):
        order = np.argsort(rows.column("_pid").to_numpy())
        counts = np.array(rows.column("_counts").to_pylist())[order]
        sums = np.array(rows.column("_sums").to_pylist())[order]
        width = sums.shape[1] // (2 * n)
        sums, d = sums.reshape(len(order), 2, n, width), (width - 2) // 2
        before, total = np.cumsum(counts, axis=0) - counts, counts.sum(axis=0)
        gradient, pairs = np.zeros(d), 0.0
        for y in range(n):
            ones, x, local, xl = (sums[:, :, y, a:b] for a, b in ((0, 1), (1, 1 + d), (1 + d, 2 + d), (2 + d, width)))
            earlier = before[:, :y].sum(axis=1)[:, None]
            # as winner: lower labels in all, less those at or below s - margin
            gradient -= (x[:, 0] * total[:y].sum() - (xl[:, 0] + x[:, 0] * earlier)).sum(axis=0)
            pairs += float((ones[:, 0] * total[:y].sum() - (local[:, 0] + ones[:, 0] * earlier)).sum())
            earlier = before[:, y + 1:].sum(axis=1)[:, None]
            gradient += (xl[:, 1] + x[:, 1] * earlier).sum(axis=0)
        return pa.table({"_g": pa.array([key[0].as_py()], rows.schema.field("_g").type), "gradient": pa.array([gradient.tolist()]), "pairs": [pairs]})
    return combine


def fit_hinge_ranker(rows: DataFrame, group: str, label: str, features: str, unit: float = 1.0, steps: int = 10, rate: float = 0.5,
                     shrink: float = 0.01) -> list[float]:
    """Weights after ``steps`` full subgradient steps on the mean hinge loss of all pairs plus shrink / 2 * |w|^2.

    ``rows`` should be materialised: each step reads it once.  The driver holds the weights."""
    levels = [r[0] for r in rows.where(F.col(label).isNotNull()).select(label).distinct().orderBy(label).collect()]
    per = rows.where(F.col(label).isNotNull()).groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    sizes = per.groupBy(group).agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.col("n")).alias("q"))
    pairs = sizes.agg(F.sum((F.col("t") * F.col("t") - F.col("q")) / 2)).first()[0] or 0.0
    size = rows.agg(F.max(F.size(features))).first()[0] or 0
    w = [0.0] * size
    if not pairs:
        return w
    for _ in range(steps):
        found = hinge_gradient(rows.withColumn("_score", linear_score(features, w, unit)), group, label, "_score", features, levels)
        total = found.select(F.posexplode("gradient").alias("k", "g")).groupBy("k").agg(F.sum("g").alias("g")).collect()  # one row a feature
        g = {r.k: r.g for r in total}
        w = [x - rate * (shrink * x + g.get(k, 0.0) / unit / pairs) for k, x in enumerate(w)]
    return w
