"""Property tests: distributed operators against brute force on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabwright.operators import knn as K
from tabwright.operators import metrics as MT
from tabwright.operators.rank import rank_weighted_sum, row_number_by


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    # group "hot" holds over a third of the rows
    rows = [(i, "hot" if i % 3 == 0 or i % 7 == 0 else f"g{i % 5}", float(rnd.randint(0, 30)), float(rnd.random()))
            for i in range(600)]
    return spark.createDataFrame(rows, "id long, g string, y double, p double")


def test_row_number_matches_window(spark, skewed):
    got = row_number_by(skewed, ["p", "id"], ["g"], out="rn", partitions=7)
    ref = skewed.withColumn("rn_ref", F.row_number().over(Window.partitionBy("g").orderBy("p", "id")))
    j = got.join(ref, "id")
    assert j.where(F.col("rn") != F.col("rn_ref")).count() == 0
    assert got.count() == skewed.count()


def test_global_row_number(spark, skewed):
    got = row_number_by(skewed, [F.desc("p"), "id"], out="rn", size_col="n", partitions=5)
    rns = sorted(r["rn"] for r in got.collect())
    assert rns == list(range(1, 601))


def test_rank_weighted_sum(spark, skewed):
    got = {r["g"]: r for r in rank_weighted_sum(skewed, ["p", "id"], "y", ["g"], partitions=6).collect()}
    pdf = skewed.toPandas().sort_values(["g", "p", "id"])
    for g, sub in pdf.groupby("g"):
        ranks = np.arange(1, len(sub) + 1)
        assert got[g]["n"] == len(sub)
        assert got[g]["swr"] == pytest.approx(float((sub["y"].to_numpy() * ranks).sum()))


def _lorenz_gini(y, p, ids):
    order = sorted(range(len(y)), key=lambda i: (-p[i], -ids[i]))
    t_order = sorted(range(len(y)), key=lambda i: -y[i])

    def g(o):
        s = sum(y)
        cum, tot = 0.0, 0.0
        for k, i in enumerate(o):
            cum += y[i]
            tot += (k / (len(y) - 1)) - cum / s
        return tot
    return g(order) / g(t_order)


def test_gini_matches_lorenz(spark, skewed):
    got = {r["g"]: r["gini"] for r in MT.gini(skewed, "y", "p", "id", ["g"]).collect()}
    pdf = skewed.toPandas()
    for g, sub in pdf.groupby("g"):
        ref = _lorenz_gini(sub["y"].tolist(), sub["p"].tolist(), sub["id"].tolist())
        assert got[g] == pytest.approx(ref, rel=1e-9)


def test_gini_self_is_one(spark, skewed):
    assert MT.gini(skewed, "y", "y", "id").first()["gini"] == pytest.approx(1.0)


def test_auc_matches_brute_force(spark, skewed):
    df = skewed.withColumn("label", (F.col("y") > 15).cast("int")).withColumn("s", F.round("p", 1))
    got = MT.auc(df, "label", "s", "id").first()["auc"]
    pdf = df.toPandas()
    pos, neg = pdf[pdf.label == 1]["s"].to_numpy(), pdf[pdf.label == 0]["s"].to_numpy()
    ref = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got == pytest.approx(ref)


def test_pair_accuracy_matches_brute_force(spark, skewed):
    df = skewed.withColumn("r", (F.col("y") / 10).cast("int")).withColumn("s", F.round("p", 1))
    got = MT.pair_accuracy(df, "r", "s", "id", ["g"]).collect()
    pdf = df.toPandas()
    for row in got:
        sub = pdf[pdf.g == row["g"]]
        r, s = sub["r"].to_numpy(), sub["s"].to_numpy()
        hi = r[:, None] > r[None, :]
        ok = (hi & (s[:, None] > s[None, :])).sum()
        assert row["pair_accuracy"] == pytest.approx(ok / hi.sum())


def test_knn_matches_brute_force(spark):
    rnd = np.random.default_rng(5)
    q = [(i, [float(x) for x in rnd.normal(size=4)]) for i in range(40)]
    b = [(100 + i, [float(x) for x in rnd.normal(size=4)], int(rnd.integers(0, 3))) for i in range(60)]
    qdf = spark.createDataFrame(q, "id long, v array<double>")
    bdf = spark.createDataFrame(b, "id long, v array<double>, label int")
    got = K.knn(qdf, bdf, 3, "id", "id", "v", "label", block_rows=16)
    got = {(r["qid"], r["rank"]): r["bid"] for r in got.collect()}
    B = np.array([x[1] for x in b])
    for qid, v in q:
        d = np.sqrt(((B - np.array(v)) ** 2).sum(axis=1)).round(9)
        order = sorted(range(len(b)), key=lambda j: (d[j], b[j][0]))[:3]
        for rank, j in enumerate(order, 1):
            assert got[(qid, rank)] == b[j][0]


def test_exact_median(spark, skewed):
    from tabwright.operators.aggregates import exact_median
    got = {r["g"]: r["median"] for r in exact_median(skewed, "p", ["g"]).collect()}
    pdf = skewed.toPandas()
    for g, sub in pdf.groupby("g"):
        assert got[g] == pytest.approx(float(sub["p"].median()))


def test_group_centred_ranker_is_pairwise_least_squares(spark, skewed):
    """The all-pairs squared loss equals the group-centred weighted least squares objective."""
    from tabwright.operators.models import GroupCenteredRanker
    m = GroupCenteredRanker("g", ["p"], "y").fit(skewed)
    pdf = skewed.toPandas()
    num = den = 0.0
    for _, sub in pdf.groupby("g"):
        x, y = sub["p"].to_numpy(), sub["y"].to_numpy()
        dx, dy = x[:, None] - x[None, :], y[:, None] - y[None, :]
        num += (dx * dy).sum()
        den += (dx * dx).sum()
    assert m.weights[0] == pytest.approx(num / den, rel=1e-6)
