"""Hand-sized golden inputs (FIXTURES.md part C), values worked out on paper."""

import pytest
from pyspark.sql import functions as F

from tabwright.functions.scalar import capped_bin, parse_date_code, parse_type_code
from tabwright.operators import blend as B
from tabwright.operators import match as M
from tabwright.operators import metrics as MT
from tabwright.operators import panel as P
from tabwright.operators.folds import stratified_folds
from tabwright.operators.textfeat import overlap_ratio


def test_gini_a(spark):
    df = spark.createDataFrame([(i, float(i + 1), float(p)) for i, p in enumerate([2, 4, 8, 6, 10, 12, 14, 16])],
                               "id long, y double, p double")
    g = MT.gini(df, "y", "p", "id").first()["gini"]
    assert g == pytest.approx(0.9833333333, abs=1e-9)


def test_gini_ties_later_first(spark):
    df = spark.createDataFrame([(0, 4.0, 10.0), (1, 5.0, 10.0), (2, 5.0, 10.0), (3, 8.0, 10.0)],
                               "id long, y double, p double")
    assert MT.gini(df, "y", "p", "id").first()["gini"] == pytest.approx(1.0)


def test_kappa_a(spark):
    a, b = [1, 2, 3, 4, 4, 2], [1, 2, 2, 4, 3, 2]
    df = spark.createDataFrame(list(zip(a, b)), "a int, b int")
    assert MT.kappa_quadratic(df, "a", "b").first()["kappa"] == pytest.approx(0.85)
    # symmetric and 1 on equality
    assert MT.kappa_quadratic(df, "b", "a").first()["kappa"] == pytest.approx(0.85)
    assert MT.kappa_quadratic(df, "a", "a").first()["kappa"] == pytest.approx(1.0)


def test_rank_mean(spark):
    rows = [("f1", 1, 1, 0.9), ("f1", 2, 2, 0.1), ("f1", 3, 3, 0.5),
            ("f2", 1, 1, 0.8), ("f2", 2, 2, 0.3), ("f2", 3, 3, 0.2)]  # ids a, b, c = 1, 2, 3
    df = spark.createDataFrame(rows, "model string, row_no long, id long, pred double")
    out = {r["id"]: (r["mean_rank"], r["rank_score"]) for r in B.rank_average(df).collect()}
    assert out[1] == (2.0, 1.0)
    assert out[2] == (0.5, 0.0)
    assert out[3] == (0.5, 0.5)


def test_single_row_rank_mean(spark):
    df = spark.createDataFrame([("f1", 1, 1, 0.9)], "model string, row_no long, id long, pred double")
    assert B.rank_average(df).first()["rank_score"] == 0.0


def test_vote_tie_smallest(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "model string, id long, label int")
    assert B.vote(df).first()["vote"] == 1


def test_file_mean_int(spark):
    df = spark.createDataFrame([("a", 1, 3.0), ("b", 1, 4.0)], "model string, id long, pred double")
    r = B.mean_combine(df).first()
    assert r["mean_int"] == 3 and r["mean_pred"] == 3.5


def test_rounding(spark):
    df = spark.createDataFrame([(5.0, 2.0)], "s double, n double")
    r = df.select(*[B.int_mean(F.col("s"), F.col("n"), k).alias(k) for k in ("floor", "half_away", "half_even")]).first()
    assert (r["floor"], r["half_away"], r["half_even"]) == (2, 3, 2)


def test_nested_set(spark):
    from tabwright.plans.match import parse_nested
    lines = spark.createDataFrame([("x,1,{(a,b),(c,d)}",), ("y,0,{(e,f)}",)], "value string")
    rows = parse_nested(lines.withColumn("value", F.regexp_replace("value", "^x", "7"))
                        .withColumn("value", F.regexp_replace("value", "^y", "8"))).collect()
    assert [(r["id"], r["flag"], r["items"]) for r in rows] == [(7, 1, "a b|c d")]


def test_set_overlap(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "entity_id long, token string")  # p
    right = spark.createDataFrame([(2, "b"), (2, "c"), (3, "z")], "entity_id long, token string")  # q, r
    pairs = {(r["left_id"], r["right_id"]): r["n_common"] for r in M.overlap_pairs(left, right).collect()}
    assert pairs == {(1, 2): 1}


def test_set_overlap_salted_equals_plain(spark):
    import random
    rnd = random.Random(3)
    lrows = [(i, f"t{rnd.randint(0, 9)}") for i in range(50) for _ in range(3)]
    rrows = [(100 + i, f"t{rnd.randint(0, 9)}") for i in range(50) for _ in range(3)]
    left = spark.createDataFrame(lrows, "entity_id long, token string").distinct()
    right = spark.createDataFrame(rrows, "entity_id long, token string").distinct()
    salted = {tuple(r) for r in M.overlap_pairs(left, right, salt_buckets=4).collect()}
    plain = {tuple(r) for r in M.overlap_pairs(left, right, salt_buckets=1).collect()}
    brute = {}
    ls, rs = {}, {}
    for e, t in set(lrows):
        ls.setdefault(e, set()).add(t)
    for e, t in set(rrows):
        rs.setdefault(e, set()).add(t)
    for a, sa in ls.items():
        for b, sb in rs.items():
            if sa & sb:
                brute[(a, b)] = len(sa & sb)
    assert salted == plain == {(a, b, n) for (a, b), n in brute.items()}


def test_date_code(spark):
    df = spark.createDataFrame([("w3d5", "v10")], "date string, type string")
    w, d = parse_date_code("date")
    r = df.select(w.alias("w"), d.alias("d"), parse_type_code("type").alias("t")).first()
    assert (r["w"], r["d"], r["t"]) == (3, 5, 10)
    assert (r["d"] - 1) * 10 + r["t"] - 1 == 49
    wide = spark.createDataFrame([("w12d3",)], "date string").select(w.alias("w"), d.alias("d")).first()
    assert (wide["w"], wide["d"]) == (12, 3)


def test_bin(spark):
    df = spark.createDataFrame([(v, 2) for v in [0.0, 9.99, 10.0, 39.9, 40.0, 512.0, None]], "v double, klass int")
    got = [r[0] for r in df.select(F.coalesce(capped_bin("v"), 3 - F.col("klass")).alias("b")).collect()]
    assert got == [0, 0, 1, 3, 3, 3, 1]


def test_cosine_f1(spark):
    truth = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (2, 1, 1), (2, 2, 0), (3, 1, 0), (3, 2, 0)],
                                  "user_id long, slot int, cnt long")
    pred = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (2, 1, 0), (2, 2, 0), (3, 1, 1), (3, 2, 0)],
                                 "user_id long, slot int, cnt long")
    r = P.cosine_f1(truth, pred, ["user_id"], ["slot"]).first()
    assert r["precision"] == pytest.approx(0.5) and r["recall"] == pytest.approx(0.5)
    assert r["f1"] == pytest.approx(0.5)


def test_overlap_ratio(spark):
    df = spark.createDataFrame([(["red", "shoe"], ["red", "shoe", "new", "big"])], "q array<string>, t array<string>")
    r = df.select(overlap_ratio(F.col("q"), F.col("t")).alias("r"),
                  overlap_ratio(F.col("q"), F.col("t"), legacy_int=True).alias("ri")).first()
    assert r["r"] == 0.5 and r["ri"] == 0


def test_strat_folds(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)] + [(10 + i, 1) for i in range(5)], "id long, label int")
    f = stratified_folds(df, "id", "label", k=5, repeats=2)
    counts = f.groupBy("iter", "fold", "label").count().collect()
    for r in counts:
        assert r["count"] == (2 if r["label"] == 0 else 1)
    assert f.groupBy("iter", "id").count().where("count != 1").count() == 0


def test_product_over_sum(spark):
    df = spark.createDataFrame([(2.0, 6.0)], "a double, b double")
    assert df.select(B.product_over_sum(F.col("a"), F.col("b"))).first()[0] == 1.5


def test_experiment_registry(spark):
    from tabwright.operators.models import experiment_registry, grid_points
    spaces = {"ridge": {"regParam": ("float", 0.0, 1.0, 0.5)}, "gbt": {"maxDepth": ("int", 2, 4, 1),
                                                                        "stepSize": ("float", 0.1, 0.2, 0.1)}}
    exp, space = experiment_registry(spark, ["f1", "f2", "f3", "f4"], spaces)
    assert exp.count() == 8 and space.count() == 3
    pts = grid_points([(r["name"], r["kind"], r["lo"], r["hi"], r["step"])
                       for r in space.where("model = 'gbt'").collect()])
    assert len(pts) == 6 and {"maxDepth": 2, "stepSize": 0.1} in pts
