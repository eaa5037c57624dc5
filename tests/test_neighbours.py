"""Pruned nearest neighbours and their weights against every pair."""

import math
from collections import defaultdict

import numpy as np
import pytest

from tabwright.operators import knn as K


def tables(spark, q, b, labels):
    qdf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "id long, v array<double>")
    bdf = spark.createDataFrame([(100 + i, [float(x) for x in v], float(y)) for i, (v, y) in enumerate(zip(b, labels))], "id long, v array<double>, label double")
    return qdf, bdf


def brute(q, b, k):
    out = {}
    for i, v in enumerate(q):
        d = np.sqrt(((b - v) ** 2).sum(axis=1)).round(9)
        out[i] = [(100 + int(j), float(d[j])) for j in np.lexsort((np.arange(len(b)), d))[:k]]
    return out


@pytest.mark.parametrize("k", [1, 5, 40, 1024])
def test_far_blocks_never_meet(spark, k):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 6)) * 40
    b = np.concatenate([c + rng.normal(size=(40, 6)) for c in centres])
    q = np.concatenate([c + rng.normal(size=(12, 6)) for c in centres])
    b[7], q[3] = b[6], b[6]  # ties and distance 0
    labels = rng.integers(0, 3, len(b))
    qdf, bdf = tables(spark, q, b, labels)
    seen = {}
    got = defaultdict(list)
    for r in sorted(K.knn(qdf, bdf, k, "id", "id", "v", "label", block_rows=20, seen=seen).collect(), key=lambda r: (r.qid, r.rank)):
        got[r.qid].append((r.bid, r.dist))
    want = brute(q, b, k)
    assert got.keys() == want.keys() and all([x for x, _ in got[i]] == [x for x, _ in want[i]] for i in want)
    assert all(math.isclose(x, y, abs_tol=2e-9) for i in want for (_, x), (_, y) in zip(got[i], want[i]))
    assert seen["met"] == seen["pairs"] if k == 1024 else seen["met"] < 0.5 * seen["pairs"]


def test_weights(spark):
    rng = np.random.default_rng(2)
    b, q = rng.integers(0, 4, (60, 2)).astype(float), rng.integers(0, 4, (9, 2)).astype(float)
    q[5:] += 0.3
    labels = rng.integers(0, 3, 60)
    qdf, bdf = tables(spark, q, b, labels)
    nn = K.knn(qdf, bdf, 30, "id", "id", "v", "label", block_rows=8).checkpoint()
    near = brute(q, b, 30)
    for weights in ("uniform", "distance"):
        for r in K.knn_weighted(nn, [1, 7, 30], weights).collect():
            first = near[r.qid][:r.k]
            zero = near[r.qid][0][1] == 0
            w = [1.0 if weights == "uniform" else (float(d == 0) if zero else 1 / d) for _, d in first]
            y = [labels[i - 100] for i, _ in first]
            assert math.isclose(r.mean_label, sum(a * c for a, c in zip(w, y)) / sum(w), abs_tol=1e-7)
            per = {c: round(sum(a for a, cc in zip(w, y) if cc == c), 9) for c in set(y)}
            assert r.vote == min(c for c in per if per[c] >= max(per.values()) - 1e-8)
    assert K.knn(qdf, bdf.limit(0), 3, "id", "id", "v", "label").count() == 0


def test_candidates_do_not_grow_with_the_number_of_base_blocks(spark):
    """With k of the size of a block every block used to send most of its rows; now k a meeting of many blocks leave the tasks."""
    rng = np.random.default_rng(3)
    b, q = rng.normal(size=(400, 4)), rng.normal(size=(50, 4))
    qdf, bdf = tables(spark, q, b, rng.integers(0, 3, 400))
    sent, whole = [], K._ranked
    try:
        K._ranked = lambda found, k: sent.append(found.count()) or whole(found, k)
        for meet in (64, 400):
            rows = K.knn(qdf, bdf, 20, "id", "id", "v", "label", block_rows=20, meet_rows=meet).collect()
            got = {i: [r.bid for r in sorted(rows, key=lambda r: r.rank) if r.qid == i] for i in range(50)}
            assert got == {i: [x for x, _ in v] for i, v in brute(q, b, 20).items()}
    finally:
        K._ranked = whole
    assert sent[1] <= 50 * 20 and sent[0] <= 50 * 20 * 8
