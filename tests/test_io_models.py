"""Readers/writers round trips and model-job behaviour (early abandon, failed trials, quality floors)."""

import os

import pytest
from pyspark.ml.regression import FMRegressor, LinearRegression
from pyspark.sql import functions as F

from tabwright.operators import models as MD
from tabwright.sources import files as IO

from .conftest import SF_SMALL


def test_tsv_and_positional(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text("userid\tdate\ttype\tcount\nu1\tw3d5\tv10\t4\nu2\tw1d1\tv2\tbad\n")
    df = IO.read_table(spark, str(p), "userid string, date string, type string, count int", sep="\t")
    assert df.count() == 2
    pos = IO.read_positional(spark, str(p), ["userid", "date", "type", "count"], {"count": "INT"}, sep="\t")
    got = {r["userid"]: r["count"] for r in pos.collect()}
    assert got == {"u1": 4, "u2": None}  # a failed cast is missing


def test_nested_sets_reader(spark, tmp_path):
    p = tmp_path / "sets.txt"
    p.write_text("x,1,{(a,b),(c,d)}\ny,0,{(e,f)}\n")
    rows = IO.read_nested_sets(spark, str(p)).collect()
    assert [(r["id"], r["flag"], r["items"]) for r in rows] == [("x", "1", "a b|c d")]


def test_submission_glob(spark, tmp_path):
    for name, rows in {"a.csv": "id,v\n3,0.5\n1,0.25\n", "b.csv": "id,v\n3,1.5\n1,2.0\n"}.items():
        (tmp_path / name).write_text(rows)
    s = IO.read_submissions(spark, str(tmp_path / "*.csv"))
    got = sorted((r["model"], r["row_no"], r["id"], r["pred"]) for r in s.collect())
    assert got == [("a", 1, 3, 0.5), ("a", 2, 1, 0.25), ("b", 1, 3, 1.5), ("b", 2, 1, 2.0)]


def test_blocks_partition_pruning(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 5).alias("fold"), (F.col("id") % 2).alias("iter"))
    IO.write_blocks(df, str(tmp_path / "blk"), ["iter", "fold"])
    part = IO.read_blocks(spark, str(tmp_path / "blk"), iter=1, fold=3)
    assert part.count() == 10
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_early_abandon_and_failed_trials(spark):
    df = spark.range(200).select("id", (F.col("id") % 5).alias("fold"), (F.col("id") * 2.0).alias("y"),
                                 F.col("id").cast("double").alias("x"))
    df = MD.assemble(df, ["x"])
    oof, tp = MD.oof_predict(df, None, lambda: LinearRegression(labelCol="y"), "id",
                             first_fold_bound=lambda scored: False)
    assert oof is None and tp is None
    rows = MD.evaluate_grid(df, lambda p: LinearRegression(labelCol="y", **p),
                            [{"regParam": 0.0}, {"noSuchParam": 1.0}], "id", lambda o: 0.0, "f", "linear")
    assert [r[6] for r in rows] == ["ok", "failed"] and rows[1][5] is None and "noSuchParam" in rows[1][7]


def test_oof_linear_beats_constant(spark):
    from tabwright.plans.models import _train_test, oof_linear_predictions
    train, test = _train_test(spark, SF_SMALL)
    out = oof_linear_predictions(train, test)
    assert out.where("pred < 0").count() == 0
    j = out.where("fold >= 0").join(train.select("o_orderkey", "y"), "o_orderkey")
    mse = j.agg(F.avg((F.col("y") - F.col("pred")) ** 2)).first()[0]
    var = j.agg(F.var_pop("y")).first()[0]
    assert mse < var


def test_factorisation_machine_reads_its_rows_once_and_is_the_library_s(spark, monkeypatch):
    rows = spark.range(300).select(*[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 250 - 2.0).alias(f"x{c}") for c in range(4)])
    rows = MD.assemble(rows.withColumn("z", F.col("x0") * F.col("x1") - F.col("x2") + 0.3), ["x0", "x1", "x2", "x3"]).repartition(4).cache()
    want = FMRegressor(labelCol="z", factorSize=3, maxIter=60, stepSize=0.05, seed=7).fit(rows)
    passes, whole = [], type(rows).mapInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", lambda df, *a, **k: passes.append(1) or whole(df, *a, **k))
    b, w, v = MD.fit_fm(rows, "features", "z", 60, factors=3, seed=7, rate=0.05)
    assert len(passes) == 1  # the steps used to read the rows again, each
    assert b == pytest.approx(want.intercept, abs=1e-6) and w == pytest.approx(want.linear.toArray(), abs=1e-6)
    assert v == pytest.approx(want.factors.toArray(), abs=1e-6)
    got = MD.predict_fm(rows, "features", (b, w, v)).select("x0", "prediction").orderBy("x0", "prediction").collect()
    old = want.transform(rows).select("x0", "prediction").orderBy("x0", "prediction").collect()
    assert [r.prediction for r in got] == pytest.approx([r.prediction for r in old], abs=1e-5)


def test_factorisation_machine_refuses_what_is_not_finite(spark):
    rows = MD.assemble(spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 1.0, 0.0), (0.5, float("nan"), 1.0)], "a double, b double, z double"), ["a", "b"])
    with pytest.raises(Exception, match="finite|NaN"):
        MD.fit_fm(rows, "features", "z", 5, factors=2)
