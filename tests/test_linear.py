"""Group classifiers, the boosted linear model, the feature union and the standardised block against plain Python."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tabwright.operators import linear as LN
from tabwright.operators import union as UN


def plain_hinge(docs, steps, rate, shrink):
    """docs: [(label, {term: w})] of one group."""
    w = {}
    for t in range(1, steps + 1):
        g = {}
        for y, x in docs:
            if t == 1 or y * sum(v * w.get(k, 0.0) for k, v in x.items()) < 1.0:
                for k, v in x.items():
                    g[k] = g.get(k, 0.0) + y * v
        eta = rate / t
        terms = {k for _, x in docs for k in x}
        w = {k: w.get(k, 0.0) * (1 - eta * shrink if t > 1 else 1) + eta * g.get(k, 0.0) / len(docs) for k in terms}
    return w


def test_group_hinge_equals_a_solver_a_group(spark):
    rng = random.Random(1)
    docs = {}
    for i in range(120):
        g = "hot" if i % 4 else rng.choice(["a", "b"])
        y = rng.choice([-1.0, 1.0])
        x = {f"t{rng.randrange(9)}": rng.random() for _ in range(5)} | ({"good": 0.7} if y > 0 and rng.random() < 0.8 else {})
        docs[i] = g, y, x
    docs[120] = "empty", 1.0, {}
    weights = spark.createDataFrame([(i, t, w) for i, (_, _, x) in docs.items() for t, w in x.items()], "id long, term string, w double")
    labels = spark.createDataFrame([(i, g, y) for i, (g, y, _) in docs.items()], "id long, g string, y double")
    x = LN.with_bias(weights, labels, "id")
    model = LN.fit_group_hinge(x, labels, "id", "g", "y", steps=6, rate=1.5, shrink=0.01).checkpoint()
    got = {}
    for r in model.collect():
        got.setdefault(r.g, {})[r.term] = r.weight
    for g in ("hot", "a", "b", "empty"):
        want = plain_hinge([(y, {**xs, LN.BIAS: 1.0}) for gg, y, xs in docs.values() if gg == g], 6, 1.5, 0.01)
        assert got[g].keys() == want.keys() and all(math.isclose(got[g][k], want[k], abs_tol=1e-9) for k in want)
    scores = {r.id: r.score for r in LN.group_scores(x, labels, "id", "g", model).collect()}
    assert all(math.isclose(scores[i], sum(w * got[g].get(t, 0.0) for t, w in {**xs, LN.BIAS: 1.0}.items()), abs_tol=1e-9) for i, (g, _, xs) in docs.items())


def plain_boost(x, y, lam, alpha, rounds, rate):
    w, b, h = np.zeros(x.shape[1]), 0.0, (x * x).mean(axis=0)
    for _ in range(rounds):
        rest = y - b - x @ w
        shift = rest.mean()
        g = -((rest - shift)[:, None] * x).mean(axis=0)
        b += shift
        raw = w * h - g
        w = w + rate * (np.sign(raw) * np.maximum(np.abs(raw) - alpha, 0) / (h + lam) - w)
    return b, w


def test_boosted_linear(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    x[:, 2] = 0.6 * x[:, 0] + 0.8 * x[:, 2]
    y = 3 + 2 * x[:, 0] - x[:, 1] + 0.1 * rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    grid = [{"lambda": 0.0, "alpha": 0.0}, {"lambda": 1.0, "alpha": 0.5}, {"lambda": 0.0, "alpha": 99.0}]
    for point, got in zip(grid, LN.boosted_linear(df, ["a", "b", "c"], "y", grid, 25, 0.4)):
        b, w = plain_boost(x, y, point["lambda"], point["alpha"], 25, 0.4)
        assert np.allclose([got["bias"], got["a"], got["b"], got["c"]], [b, *w], atol=1e-9)
    assert got["a"] == got["b"] == got["c"] == 0.0
    exact = np.linalg.lstsq(np.column_stack((np.ones(200), x)), y, rcond=None)[0]
    many = LN.boosted_linear(df, ["a", "b", "c"], "y", grid[:1], 120, 0.4)[0]
    assert np.allclose([many["bias"], many["a"], many["b"], many["c"]], exact, atol=1e-4)
    assert LN.boosted_linear(df.limit(0), ["a"], "y", grid[:1]) == [{"bias": 0.0, "a": 0.0}]


def test_union_shares_its_columns(spark):
    bag = lambda rows: spark.createDataFrame(rows, "id long, term string, tf long")
    train = {"left": UN.counted(bag([(1, "b", 2), (1, "a", 1), (2, "b", 1), (2, "z", 1)]), "id"), "right": UN.counted(bag([(1, "a", 5)]), "id"),
             "n": UN.single(spark.createDataFrame([(1, 0.5), (2, 0.0), (3, None)], "id long, v double"), "id", "v", F.col("v"))}
    union = UN.FeatureUnion(["left", "right", "n"], "id", {"left": 2}).fit(train)
    assert sorted((r.part, r.feature, r.column) for r in union.manifest.collect()) == [(0, "a", 0), (0, "b", 1), (1, "a", 2), (2, "v", 3)]
    assert sorted(tuple(r) for r in union.offsets().collect()) == [("left", 0, 2), ("n", 3, 1), ("right", 2, 1)]
    test = {**train, "left": UN.counted(bag([(9, "new", 4), (9, "a", 7)]), "id")}
    rows = {r[0]: (list(r[1]), list(r[2])) for r in union.transform(test).collect()}
    assert rows == {1: ([2, 3], [5.0, 0.5]), 9: ([0], [7.0])}


def test_standard_block_equals_the_dense_one(spark):
    rng = np.random.default_rng(3)
    dense = np.where(rng.random((40, 5)) < 0.3, rng.random((40, 5)), 0.0)
    dense[:, 3] = 0.0
    dense[:, 4] = 0.25
    entries = [(i, j, float(dense[i, j])) for i in range(40) for j in range(5) if dense[i, j]]
    df = spark.createDataFrame(entries, "row long, col int, v double")
    z, cols = UN.standard_block(df, "row", "col", "v", F.lit(40))
    got = {(r.row, r.col): r.z for r in UN.dense_rows(z, cols, spark.range(40).withColumnRenamed("id", "row"), "row", "col", [0, 1, 2, 4]).collect()}
    want = (dense - dense.mean(axis=0)) / np.where(dense.std(axis=0) > 1e-12, dense.std(axis=0), np.inf)
    assert len(got) == 160 and all(abs(got[i, j] - want[i, j]) < 1e-9 for i in range(40) for j in (0, 1, 2, 4))
