"""Step 7–8 model jobs.

Each query fits, predicts every row it should, and returns what SQL can state about the result: the
predicted keys, ``predicted`` (1 where a prediction exists) and ``beats_constant`` (1 when the loss on
rows the model has not seen is below that of the best constant prediction).  The predictions themselves
come from the functions named ``*_predictions``.

Regression/classification rows come from ``orders`` (features from its line items and customer,
target = order value ``sum(l_extendedprice) / 1000``, class = value above the mean value; in the
driver data ``o_totalprice`` and ``o_orderstatus`` are independent of every other column); train = md5-parity half 0,
test = half 1; folds = md5-derived (two hex digits) mod 5.  Rating models use ``labels`` ⋈
``documents``; the activity gate uses the window features of the event panel.
"""

from __future__ import annotations

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml import Pipeline
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabwright.functions.scalar import clamp0, day_index
from tabwright.operators import blocks as BL
from tabwright.operators import models as MD
from tabwright.operators import panel as P
from tabwright.operators.folds import half_split
from tabwright.operators.metrics import pair_accuracy
from tabwright.plans.folds import PARITY
from tabwright.plans.panel import PANEL_SQL
from tabwright.session import ensure_checkpoint_dir
from tabwright.sources.tables import Tables

ORDER_FEATURES = ["n_lines", "sum_qty", "avg_disc", "c_acctbal", "c_nationkey", "prio", "age_days"]
DOC_FEATURES = ["log_chars", "upper", "marks", "distinct_words"]


def order_table(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("double").alias("n_lines"),
                                              F.sum("l_quantity").alias("sum_qty"),
                                              F.avg("l_discount").alias("avg_disc"),
                                              (F.sum("l_extendedprice") / 1000).alias("value"))
    mean_value = li.agg(F.avg("value")).scalar()
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    h = F.md5(F.col("o_orderkey").cast("string"))
    hexv = lambda p: F.instr(F.lit("0123456789abcdef"), F.substring(h, p, 1)) - 1
    base = o.select(
        "o_orderkey", F.coalesce("n_lines", F.lit(0.0)).alias("n_lines"),
        F.coalesce("sum_qty", F.lit(0.0)).alias("sum_qty"), F.coalesce("avg_disc", F.lit(0.0)).alias("avg_disc"),
        F.coalesce("c_acctbal", F.lit(0.0)).alias("c_acctbal"),
        F.coalesce("c_nationkey", F.lit(0)).cast("double").alias("c_nationkey"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("prio"),
        day_index("o_orderdate", "1992-01-01").cast("double").alias("age_days"),
        F.coalesce("value", F.lit(0.0)).alias("y"),
        (F.coalesce("value", F.lit(0.0)) > mean_value).cast("double").alias("label"),
        ((hexv(31) * 16 + hexv(32)) % 5).cast("int").alias("fold"))
    split = half_split(base, "o_orderkey")
    return _materialised(MD.assemble(base.join(split, "o_orderkey"), ORDER_FEATURES))


def _train_test(spark, sf_dir):
    t = order_table(spark, sf_dir)
    return t.where("half = 0"), t.where("half = 1")


def _regression_floor(pred, truth, key):
    """1 if the mean squared error over the rows of ``truth`` (key, y) is below their variance."""
    j = truth.join(pred.select(key, "pred"), key, "left")
    mse, var = j.agg(F.avg((F.col("y") - F.col("pred")) ** 2), F.var_pop("y")).first()
    return int(mse is not None and mse < var)


def _class_floor(pred, truth, key):
    """1 if the accuracy over the rows of ``truth`` (key, y) is above the share of their largest class."""
    j = truth.join(pred.select(key, "pred"), key, "left")
    share = j.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("y") == F.col("pred")).cast("long")).alias("ok"))
    most, right = share.agg(F.max("n"), F.sum("ok")).first()
    return int((right or 0) > (most or 0))


def _stated(pred, keys, beats):
    return pred.select(*keys, F.col("pred").isNotNull().cast("int").alias("predicted"), F.lit(beats).alias("beats_constant"))


def _materialised(df):
    """One scan of the base tables for all fits and scorings that follow."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _oof_union(oof, test_pred, key):
    return oof.select(key, "fold", "pred").unionByName(test_pred.select(key, F.lit(-1).alias("fold"), "pred"))


def oof_linear_predictions(train, test):
    """C5 + L1 + P9: out-of-fold linear regression, clamped at 0, plus refit-on-all test predictions."""
    oof, tp = MD.oof_predict(train, test, lambda: LinearRegression(labelCol="y"), "o_orderkey")
    return _oof_union(oof, tp, "o_orderkey").withColumn("pred", clamp0("pred"))


def q_oof_linear(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    pred = _materialised(oof_linear_predictions(train, test))
    truth = train.unionByName(test).select("o_orderkey", "y")
    return _stated(pred, ["o_orderkey", "fold"], _regression_floor(pred, truth, "o_orderkey"))


def oof_gbt_predictions(train, test, trees=20, share=0.0784):
    """C5 + L6: boosted trees on the log(1 + y) label; a key hash sets aside ``share`` of the training
    rows of each fold as the hold-out for early stopping (Z23)."""
    train = train.withColumn("log_y", F.log1p("y")).withColumn(
        "is_val", F.pmod(F.xxhash64("o_orderkey"), F.lit(10000)) < int(share * 10000))

    def est():
        return GBTRegressor(labelCol="log_y", maxIter=trees, maxDepth=4, stepSize=0.1, seed=7,
                            validationIndicatorCol="is_val", subsamplingRate=0.9)

    oof, tp = MD.oof_predict(train, test.withColumn("is_val", F.lit(False)), est, "o_orderkey")
    return _oof_union(oof, tp, "o_orderkey").withColumn("pred", F.expm1("pred"))


def q_oof_gbt(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    pred = _materialised(oof_gbt_predictions(train, test))
    truth = train.unionByName(test).select("o_orderkey", "y")
    return _stated(pred, ["o_orderkey", "fold"], _regression_floor(pred, truth, "o_orderkey"))


def rf_predictions(train, test, trees=20):
    """L5 + K1 shape: random forest classifier fitted on train, (id, prediction) for test."""
    m = RandomForestClassifier(numTrees=trees, maxDepth=6, seed=7).fit(train)
    return m.transform(test).select(F.col("o_orderkey").alias("id"), F.col("prediction").cast("int").alias("pred"))


def q_rf_submit(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    pred = _materialised(rf_predictions(train, test))
    truth = test.select(F.col("o_orderkey").alias("id"), F.col("label").cast("int").alias("y"))
    return _stated(pred, ["id"], _class_floor(pred, truth, "id"))


def fm_predictions(train, test, steps=200):
    """Factorisation machine regression on standardised features and a standardised target."""
    mean, sd = train.agg(F.avg("y"), F.stddev_pop("y")).first()
    scaler = StandardScaler(inputCol="features", outputCol="sfeat", withMean=True, withStd=True).fit(train)
    model = MD.fit_fm(scaler.transform(train).withColumn("z", (F.col("y") - mean) / (sd or 1.0)), "sfeat", "z", steps, factors=4, seed=7, rate=0.05)
    return MD.predict_fm(scaler.transform(test), "sfeat", model).select("o_orderkey", (F.col("prediction") * (sd or 1.0) + mean).alias("pred"))


def q_fm(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    pred = _materialised(fm_predictions(train, test))
    return _stated(pred, ["o_orderkey"], _regression_floor(pred, test.select("o_orderkey", "y"), "o_orderkey"))


def doc_table(spark, sf_dir):
    """Documents with text features, rating and part: md5-derived thirds, of which the last is never trained on.

    rating (null without labels): 1, one more for good documents, one more for good ones above 1,500 characters."""
    t = Tables(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1))
    tokens = F.split(text, r"\s+")
    third = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 31, 2), 16, 10).cast("int") % 3
    d = t.documents.repartition("doc_id").select(
        "doc_id", "lang", F.log10(F.length(text) + 1).alias("log_chars"),
        (F.length(F.regexp_replace(text, r"[^A-Z]+", "")) / chars).alias("upper"),
        (F.length(F.regexp_replace(text, r"[^#$%&*!|]+", "")) / chars).alias("marks"),
        (F.size(F.array_distinct(tokens)) / F.size(tokens)).alias("distinct_words"),
        third.alias("part"), (F.length(text) > 1500).cast("int").alias("_long"))
    d = d.join(t.labels.select("doc_id", "quality"), "doc_id", "left").withColumn(
        "rating", (1 + F.col("quality") * (1 + F.col("_long"))).cast("double")).drop("quality", "_long")
    return _materialised(MD.assemble(d, DOC_FEATURES).withColumn("label", F.col("rating") - 1))


def _labelled(spark, sf_dir):
    """(rows to learn from, all rows, labelled rows held out)."""
    d = doc_table(spark, sf_dir)
    seen = d.where(F.col("rating").isNotNull())
    return seen.where("part < 2"), d, seen.where("part = 2")


def _rated(model, alld):
    return model.transform(alld).select("doc_id", (F.col("prediction") + 1).cast("int").alias("pred"))


def _rating_query(fit):
    def run(spark, sf_dir):
        train, alld, held = _labelled(spark, sf_dir)
        pred = _materialised(_rated(fit(train), alld))
        return _stated(pred, ["doc_id"], _class_floor(pred, held.select("doc_id", F.col("rating").cast("int").alias("y")), "doc_id"))
    run.__name__, run.__doc__ = fit.__name__, fit.__doc__
    return run


def fit_logit(train, steps=50):
    """L3: multi-class logistic regression, rows weighted by the square root of the inverse class share."""
    share = train.groupBy("label").agg(F.count(F.lit(1)).alias("_c"))
    n, k = share.agg(F.sum("_c"), F.count(F.lit(1))).first()
    weighted = train.join(share, "label").withColumn("w", F.sqrt(n / (k * F.col("_c"))))
    return LogisticRegression(weightCol="w", regParam=0.001, maxIter=steps).fit(weighted)


def fit_dtree(train, depth=5):
    """Decision tree classifier."""
    return DecisionTreeClassifier(maxDepth=depth, seed=7).fit(train)


def fit_linear_svc(train, steps=50):
    """Standardise → one-vs-rest linear SVM."""
    pipe = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="sfeat", withMean=True, withStd=True),
                            OneVsRest(classifier=LinearSVC(maxIter=steps, regParam=0.001), featuresCol="sfeat")])
    return pipe.fit(train)


def fit_multiclass_gbt(train, trees=10):
    """Multi-class boosted trees as one-vs-rest binary GBTs (3 rating classes)."""
    return OneVsRest(classifier=GBTClassifier(maxIter=trees, maxDepth=3, seed=7)).fit(train)


def rank_predictions(train, alld):
    """L9 (re-aimed, see README): pairwise squared-loss linear ranking within ``lang`` groups,
    fitted on group-centred rows instead of materialised pairs."""
    m = MD.GroupCenteredRanker("lang", DOC_FEATURES, "rating").fit(train)
    return m.transform(alld).select("doc_id", "lang", F.col("prediction").alias("pred"))


def q_rank_svc(spark, sf_dir):
    """The floor is the share of rightly ordered held-out pairs of a language, above one half."""
    train, alld, held = _labelled(spark, sf_dir)
    pred = _materialised(rank_predictions(train, alld))
    scored = held.select("doc_id", F.col("rating").cast("int").alias("y")).join(pred, "doc_id")
    got = pair_accuracy(scored, "y", "pred", "doc_id", ["lang"]).agg(F.avg("pair_accuracy")).first()[0]
    return _stated(pred, ["doc_id", "lang"], int((got or 0) > 0.5))


def stack_predictions(halves, test, overlap):
    """Two-fold cross stacking.  Stage 1 (logistic regression on document features): fit on half
    A → score B, fit on B → score A, fit on A ∪ B → score ``test``.  Stage 2: linear regression on
    [stage-1 expected rating, query-token overlap].  The overlap and the rows of stage 2 are worked out once,
    however often the fit reads them."""
    overlap = _materialised(overlap)
    a, b = halves.where("part = 0"), halves.where("part = 1")

    def stage1(fit_on, score):
        m = LogisticRegression(regParam=0.001, maxIter=50).fit(fit_on)
        probs = vector_to_array(F.col("probability"))
        exp = F.aggregate(F.transform(probs, lambda p, i: p * (i + 1)), F.lit(0.0), lambda acc, x: acc + x)
        return m.transform(score).select("doc_id", exp.alias("s1"))

    def stage2(s1):
        return MD.assemble(s1.join(overlap, "doc_id", "left").fillna(0.0, ["ratio"]), ["s1", "ratio"], "f2")

    s1 = stage1(a, b).unionByName(stage1(b, a)).join(halves.select("doc_id", "rating"), "doc_id")
    m2 = LinearRegression(featuresCol="f2", labelCol="rating").fit(_materialised(stage2(s1)))
    return m2.transform(stage2(stage1(halves, test))).select("doc_id", F.col("prediction").alias("pred"))


def q_cross_stack(spark, sf_dir):
    """C7 over all documents that are not trained on: the unlabelled and the held-out ones."""
    from tabwright.plans.text import q_token_overlap
    train, alld, held = _labelled(spark, sf_dir)
    test = alld.where("rating IS NULL OR part = 2")
    pred = _materialised(stack_predictions(train, test, q_token_overlap(spark, sf_dir).select("doc_id", "ratio")))
    return _stated(pred, ["doc_id"], _regression_floor(pred, held.select("doc_id", F.col("rating").alias("y")), "doc_id"))


RIDGE_GRID = [{"regParam": r, "elasticNetParam": e} for r in (0.0, 0.1, 1.0) for e in (0.0, 1.0)]
#: A grid point that no fit accepts: its trial fails and must stay out of the ranking.
FAILING_POINT = {"regParam": -1.0, "elasticNetParam": 0.0}
DEFAULTS = {"regParam": 0.0, "elasticNetParam": 0.0, "maxIter": 100}


def trial_table(train, grid):
    """Grid trials of ridge / lasso (elastic-net 0 or 1) scored by CV RMSE; the
    best trial that ran is marked, parameters are completed with the defaults of the space."""
    spark = train.sparkSession
    train = BL.stored(train.select("o_orderkey", "features", "y", "fold"), "fold")  # a trial reads each fold once, to score it

    def rmse(oof):
        return oof.agg(F.sqrt(F.avg((F.col("y") - F.col("pred")) ** 2))).first()[0]

    rows = MD.evaluate_grid(train, lambda p: LinearRegression(labelCol="y", **p), grid, "o_orderkey", rmse, "orders", "linear",
                            fit_rows=MD.other_folds(train, "features", "y"), keep=["y"])
    BL.drop(train)
    trials = spark.createDataFrame(rows, MD.TRIALS_SCHEMA)  # one row per trial: bounded by the grid
    params = F.from_json("params_json", "map<string,double>")
    defaults = F.create_map(*[F.lit(x) for kv in DEFAULTS.items() for x in (kv[0], float(kv[1]))])
    best = F.row_number().over(Window.orderBy((F.col("status") != "ok"), F.col("score").asc_nulls_last(), "trial_id"))
    return trials.withColumn("is_best", ((best == 1) & (F.col("status") == "ok")).cast("int")).withColumn(
        "full_params", F.to_json(F.map_concat(F.map_filter(defaults, lambda k, v: ~F.map_contains_key(params, k)),
                                              params)))


def q_trial_table(spark, sf_dir):
    """The trials, without the scores; ``one_best`` says that exactly one trial, one that ran, is the best."""
    train, _ = _train_test(spark, sf_dir)
    t = _materialised(trial_table(train, [*RIDGE_GRID, FAILING_POINT]))
    best, right, low = t.agg(F.sum("is_best"), F.sum(F.when(F.col("status") == "ok", F.col("is_best"))), F.min("score")).first()
    spread = train.agg(F.stddev_pop("y")).first()[0]
    return t.select("trial_id", "feat", "model", "params_json", "params_md5", "status", "full_params",
                    F.col("error").isNotNull().cast("int").alias("has_error"), F.col("score").isNotNull().cast("int").alias("scored"),
                    F.lit(int(best == right == 1)).alias("one_best"), F.lit(int(low < spread)).alias("beats_constant"))


KAPPA_GRID = [0.01, 0.1]


def q_kappa_search(spark, sf_dir):
    """Grid search scored by weighted kappa (2 folds, custom evaluator); a constant rating has kappa 0."""
    train, _, _ = _labelled(spark, sf_dir)
    lr = LogisticRegression(maxIter=50)
    grid = ParamGridBuilder().addGrid(lr.regParam, KAPPA_GRID).build()
    # the two folds come from the key, so that reruns agree
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=MD.QWKEvaluator(), numFolds=2, foldCol="part", seed=7)
    m = cv.fit(train)
    rows = [(float(pm[lr.regParam]), 1, int(s > 0)) for pm, s in zip(grid, m.avgMetrics)]
    return spark.createDataFrame(rows, "regParam double, scored int, beats_constant int")


def gate_lines(scored, types, cut=0.5):
    """All-ones vector lines (7 × types) of the users whose activity probability reaches ``cut``."""
    ones = scored.where(F.col("p") >= cut).withColumn("vec", F.array_repeat(F.lit(1).cast("long"), (types * 7).cast("int")))
    return P.vector_lines(ones)


def gate_scores(panel):
    """(user_id, label, p) of a boosted-tree activity gate on W9 windows (train windows 1–2, score window 3).

    Every user has some event in every whole week, so a user counts as active when the week after the window has more
    events a day than the median of those weeks in training; days without any event are not in the data."""
    w = P.window_features(panel, [1, 2, 3]).drop("label")
    week = panel.groupBy(F.col("user_id").alias("_u"), F.col("week").alias("_w")).agg(F.sum("cnt").alias("_n"))
    for name, ahead in (("_last", 1), ("_next", 2)):
        n = week.withColumnRenamed("_n", name)
        w = w.join(n, (F.col("user_id") == F.col("_u")) & (F.col("start_week") + ahead == F.col("_w")), "left").drop("_u", "_w")
    w = w.fillna(0, ["_last", "_next"])
    # the counts of the window, their total and the last week's total
    total = F.aggregate("features", F.lit(0).cast("long"), lambda a, x: a + x)
    vector = F.transform(F.concat("features", F.array(total, F.col("_last"))), lambda x: x.cast("double"))
    # the table may end within a week: three rows at most
    days = dict(panel.where("week BETWEEN 3 AND 5").groupBy("week").agg(F.countDistinct("day")).collect())
    rate = F.col("_next") / F.element_at(F.array(*[F.lit(days.get(s + 2, 7)) for s in (1, 2, 3)]), F.col("start_week").cast("int"))
    w = _materialised(w.select("user_id", "start_week", array_to_vector(vector).alias("features"), rate.alias("_rate")))
    middle = w.where("start_week < 3").agg(F.percentile("_rate", 0.5)).first()[0] or 0.0
    w = w.withColumn("label", (F.col("_rate") > middle).cast("double"))
    m = GBTClassifier(maxIter=20, maxDepth=3, seed=7).fit(w.where("start_week < 3"))
    scored = m.transform(w.where("start_week = 3")).select("user_id", "label", vector_to_array(F.col("probability"))[1].alias("p"))
    return _materialised(scored)


def q_activity_gate(spark, sf_dir):
    """Per user the label of the week after the window, whether the most frequent label (ties: 0) hits it, and whether a
    line is written for the users that pass the gate and for no others.  What the gate learns is tested on made-up events:
    the driver's events carry no signal for it."""
    panel = _materialised(P.event_panel(Tables(spark, sf_dir).events))
    scored = gate_scores(panel)
    lines = gate_lines(scored, P.n_types(panel)).withColumn("_line", F.lit(1))
    usual = scored.agg((F.sum("label") * 2 > F.count(F.lit(1))).cast("int")).scalar()
    out = scored.join(lines.select("user_id", "_line"), "user_id", "left")
    return out.select("user_id", F.col("label").cast("int").alias("active"), (F.col("label").cast("int") == usual).cast("int").alias("constant_hits"),
                      ((F.col("p") >= 0.5) == F.col("_line").isNotNull()).cast("int").alias("line_fits"))


QUERIES = {
    "oof_linear": q_oof_linear,
    "oof_gbt": q_oof_gbt,
    "rf_submit": q_rf_submit,
    "fm": q_fm,
    "logit": _rating_query(fit_logit),
    "dtree": _rating_query(fit_dtree),
    "linear_svc": _rating_query(fit_linear_svc),
    "multiclass_gbt": _rating_query(fit_multiclass_gbt),
    "rank_svc": q_rank_svc,
    "cross_stack": q_cross_stack,
    "trial_table": q_trial_table,
    "kappa_search": q_kappa_search,
    "activity_gate": q_activity_gate,
}

def _grid_sql():
    rows = []
    for i, p in enumerate([*RIDGE_GRID, FAILING_POINT]):
        js = f'{{"elasticNetParam": {p["elasticNetParam"]}, "regParam": {p["regParam"]}}}'
        full = f'{{"maxIter":{float(DEFAULTS["maxIter"])},"elasticNetParam":{p["elasticNetParam"]},"regParam":{p["regParam"]}}}'
        ok = int(p is not FAILING_POINT)
        rows.append(f"({i}, '{js}', '{full}', {ok})")
    return ", ".join(rows)


_HALF = f"CAST({PARITY.format(x=chr(39).join(['o_orderkey || ', '-0', '']))} AS INTEGER)"
_FOLD = "(instr('0123456789abcdef', substr(md5(CAST(o_orderkey AS VARCHAR)), 31, 1)) - 1) * 16 + " \
        "instr('0123456789abcdef', substr(md5(CAST(o_orderkey AS VARCHAR)), 32, 1)) - 1"
_PART = "((instr('0123456789abcdef', substr(md5(CAST(doc_id AS VARCHAR)), 31, 1)) - 1) * 16 + " \
        "instr('0123456789abcdef', substr(md5(CAST(doc_id AS VARCHAR)), 32, 1)) - 1) % 3"
_STATED = "1 AS predicted, 1 AS beats_constant"
_OOF_SQL = f"SELECT o_orderkey, CASE WHEN {_HALF} = 0 THEN ({_FOLD}) % 5 ELSE -1 END AS fold, {_STATED} FROM orders"
_DOC_SQL = f"SELECT doc_id, {_STATED} FROM documents"

ORACLE: dict[str, str] = {
    "oof_linear": _OOF_SQL,
    "oof_gbt": _OOF_SQL,
    "rf_submit": f"SELECT o_orderkey AS id, {_STATED} FROM orders WHERE {_HALF} = 1",
    "fm": f"SELECT o_orderkey, {_STATED} FROM orders WHERE {_HALF} = 1",
    "logit": _DOC_SQL,
    "dtree": _DOC_SQL,
    "linear_svc": _DOC_SQL,
    "multiclass_gbt": _DOC_SQL,
    "rank_svc": f"SELECT doc_id, lang, {_STATED} FROM documents",
    "cross_stack": f"SELECT doc_id, {_STATED} FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR {_PART} = 2",
    "trial_table": f"""SELECT i AS trial_id, 'orders' AS feat, 'linear' AS model, js AS params_json, md5(js) AS params_md5,
CASE WHEN ok = 1 THEN 'ok' ELSE 'failed' END AS status, full_js AS full_params, 1 - ok AS has_error, ok AS scored,
1 AS one_best, 1 AS beats_constant FROM (VALUES {_grid_sql()}) AS g(i, js, full_js, ok)""",
    "kappa_search": "SELECT CAST(r AS DOUBLE) AS \"regParam\", 1 AS scored, 1 AS beats_constant FROM (VALUES "
                    + ", ".join(f"({r})" for r in KAPPA_GRID) + ") AS g(r)",
    "activity_gate": f"""WITH {PANEL_SQL},
days AS (SELECT week, count(DISTINCT day) AS n FROM panel WHERE week BETWEEN 3 AND 5 GROUP BY week),
rate AS (SELECT u.user_id, s.start, coalesce(sum(p.cnt), 0) / coalesce(any_value(days.n), 7) AS rate
         FROM users u JOIN (SELECT unnest([1, 2, 3]) AS start) s ON TRUE LEFT JOIN panel p ON p.user_id = u.user_id AND p.week = s.start + 2
         LEFT JOIN days ON days.week = s.start + 2 GROUP BY u.user_id, s.start),
label AS (SELECT user_id, CAST(rate > (SELECT coalesce(quantile_cont(rate, 0.5), 0) FROM rate WHERE start < 3) AS INTEGER) AS active FROM rate WHERE start = 3)
SELECT user_id, active, CAST(active = (SELECT CAST(sum(active) * 2 > count(*) AS INTEGER) FROM label) AS INTEGER) AS constant_hits, 1 AS line_fits FROM label""",
}
