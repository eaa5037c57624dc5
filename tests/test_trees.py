"""Trees of all groups, boosting and pairwise ranking against plain Python that forms every pair."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabwright.operators import ranking as RK
from tabwright.operators import trees as TR

CLASSES = 3


def rows_of(seed, n=160, features=3, bins=5):
    """(id, group, label, bins): one group holds most rows, one has a single class, one a single row."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        g = "hot" if i % 5 else ("one" if i % 10 else "pure")
        b = [rng.randrange(bins) for _ in range(features)]
        y = 1 if g == "pure" else min(CLASSES - 1, (b[0] > 2) + (b[1] > 1 and rng.random() < 0.8))
        out.append((i, g, y, b))
    return [*out, (n, "lone", 2, [0] * features)]


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, g string, y int, _bins array<int>")


def gini(counts):
    n = sum(counts)
    s = float(counts[0]) * counts[0]
    for c in counts[1:]:
        s += float(c) * c
    return s / n


def brute_tree(rows, depth, min_rows, node=1):
    """{node: (feature, bin, counts)} by trying every cut of every feature."""
    counts = [sum(y == k for _, _, y, _ in rows) for k in range(CLASSES)]
    best = None
    for f in range(len(rows[0][3])) if depth else ():
        for b in sorted({r[3][f] for r in rows}):
            left = [r for r in rows if r[3][f] <= b]
            if len(left) < min_rows or len(rows) - len(left) < max(min_rows, 1):
                continue
            lc = [sum(y == k for _, _, y, _ in left) for k in range(CLASSES)]
            gain = gini(lc) + gini([c - x for c, x in zip(counts, lc)]) - gini(counts)
            if gain > 1e-9 and (best is None or gain > best[0]):
                best = gain, f, b
    if best is None:
        return {node: (None, None, counts)}
    _, f, b = best
    below = [brute_tree([r for r in rows if (r[3][f] > b) == side], depth - 1, min_rows, 2 * node + side) for side in (False, True)]
    return {node: (f, b, counts), **below[0], **below[1]}


@pytest.mark.parametrize("seed,depth,min_rows", [(1, 3, 1), (2, 4, 4), (3, 0, 1)])
def test_trees_of_all_groups(spark, seed, depth, min_rows):
    rows = rows_of(seed)
    df = table(spark, rows)
    stats = [f"c{k}" for k in range(CLASSES)]
    train = df.select("id", "g", "_bins", *[(F.col("y") == k).cast("long").alias(f"c{k}") for k in range(CLASSES)])
    tree = TR.grow(train, "g", "id", stats, depth=depth, min_rows=min_rows)
    got = {}
    for r in tree.collect():
        got.setdefault(r.g, {})[r.node] = (r.feature, r.bin, list(r.stats))
    want = {g: brute_tree([r for r in rows if r[1] == g], depth, min_rows) for g in {r[1] for r in rows}}
    assert got == want
    for r in TR.descend(df, tree, "g", "id", depth).collect():
        node = 1
        while want[r.g][node][0] is not None:
            f, b, _ = want[r.g][node]
            node = 2 * node + (r._bins[f] > b)
        assert (r.node, list(r.stats)) == (node, want[r.g][node][2])
    assert TR.grow(train.limit(0), "g", "id", stats).count() == 0


def test_edges_and_bins(spark):
    df = spark.createDataFrame([(i, 7, i % 3 if i else None, i * i) for i in range(100)], "id long, same int, few int, much int")
    edges = TR.bin_edges(df, ["same", "few", "much"], 4)
    values = sorted(i * i for i in range(100))
    assert edges == [[], [0, 1], [values[24], values[49], values[74]]]
    got = df.select("id", TR.binned(["same", "few", "much"], edges).alias("b")).collect()
    assert all(r.b == [0, r.id % 3 if r.id else 0, sum(e < r.id ** 2 for e in edges[2])] for r in got)


def test_pair_residuals_equal_all_pairs(spark):
    rng = random.Random(4)
    rows = [(*r[:2], None if r[0] % 11 == 3 else r[2], r[3], [rng.uniform(-1, 1)]) for r in rows_of(4)]
    df = spark.createDataFrame(rows, "id long, g string, y int, _bins array<int>, _scores array<double>")
    got = sorted(tuple(r) for r in TR.pair_gradients("g", "y", "id")(df).select("_bins", "_g", "_h", "_n").collect())
    want = []
    for i, g, y, b, (s,) in rows:
        if y is None:
            continue
        mine = [(yy, ss) for _, gg, yy, _, (ss,) in rows if gg == g and yy is not None]
        lose = sum(math.exp(-(s - ss)) for yy, ss in mine if yy < y)
        win = sum(math.exp(-(ss - s)) for yy, ss in mine if yy > y)
        want.append((b, (win - lose) / len(mine) * TR.SCALE, (win + lose) / len(mine) * TR.SCALE, 1))
    want.sort()
    # fixed point: a unit a row of the group at most
    assert len(got) == len(want) and all(list(a[0]) == b[0] for a, b in zip(got, want))
    for col in (1, 2):
        assert all(math.isclose(x, y, abs_tol=40) for x, y in zip(sorted(r[col] for r in got), sorted(r[col] for r in want)))


def log_loss(rows):
    return sum(-math.log(r.p[r.y]) for r in rows) / len(rows)


def test_softmax_boosting(spark):
    df = table(spark, rows_of(5, n=400))
    seen = df.withColumn("label", F.when(F.col("id") % 3 > 0, F.col("y")))
    losses = []
    for rounds in (1, 6):
        model = TR.boost(seen, TR.softmax_gradients("label", CLASSES), CLASSES, rounds, 2)
        scored = model.score(df).withColumn("p", TR.softmax("_scores", CLASSES)).where("id % 3 = 0").collect()
        assert all(math.isclose(sum(r.p), 1) for r in scored) and len(model.rounds) == rounds
        losses.append(log_loss(scored))
    share = [sum(r.y == k for r in scored) / len(scored) for k in range(CLASSES)]
    assert losses[1] < losses[0] < -sum(s * math.log(s) for s in share if s)


def test_pairwise_boosting_orders_held_out_pairs(spark):
    df = table(spark, rows_of(6, n=400))
    seen = df.withColumn("label", F.when(F.col("id") % 3 > 0, F.col("y")))
    model = TR.boost(seen, TR.pair_gradients("g", "label", "id"), 1, 5, 2)
    held = [(r.g, r.y, r._scores[0]) for r in model.score(df).where("id % 3 = 0").collect()]
    pairs = [(a[2] > b[2]) for a in held for b in held if a[0] == b[0] and a[1] > b[1]]
    assert sum(pairs) / len(pairs) > 0.75


@pytest.mark.parametrize("parts", [1, 5])
def test_hinge_gradient_equals_all_pairs(spark, parts):
    rng = random.Random(7)
    rows = [(i, g, None if i % 13 == 5 else y, b, rng.choice([-0.5, 0.0, 0.25, rng.uniform(-2, 2)])) for i, g, y, b in rows_of(7)]
    df = spark.createDataFrame(rows, "id long, g string, y int, _bins array<int>, s double").repartition(parts)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(3 * parts))
    try:
        got = {r.g: (list(r.gradient), r.pairs) for r in RK.hinge_gradient(df, "g", "y", "s", "_bins", [0, 1, 2]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = {g: ([0.0] * 3, 0.0) for g in {r[1] for r in rows}}
    for _, g, y, b, s in rows:
        for _, gg, yy, bb, ss in rows:
            if g == gg and y is not None and yy is not None and y > yy and ss > s - 1.0:
                want[g] = ([w + l - x for w, x, l in zip(want[g][0], b, bb)], want[g][1] + 1)
    assert got == want


def test_hinge_ranker_orders_held_out_pairs(spark):
    df = table(spark, rows_of(8, n=400)).withColumn("label", F.when(F.col("id") % 3 > 0, F.col("y"))).checkpoint()
    w = RK.fit_hinge_ranker(df, "g", "label", "_bins", unit=5, steps=6, rate=2.0)
    held = [(r.g, r.y, r.s) for r in df.where("id % 3 = 0").withColumn("s", RK.linear_score("_bins", w, 5)).collect()]
    pairs = [(a[2] > b[2]) for a in held for b in held if a[0] == b[0] and a[1] > b[1]]
    assert sum(pairs) / len(pairs) > 0.7
    flat = df.withColumn("label", F.lit(1))
    assert RK.fit_hinge_ranker(flat, "g", "label", "_bins") == [0.0] * 3
