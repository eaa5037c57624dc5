"""Findings F14-F16, F20 and F27: a step's dear work is done once, however often its rows are read."""

import math

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tabwright.operators import blocks as BL
from tabwright.operators import models as MD
from tabwright.operators import textfeat as TF
from tabwright.plans import linear, models, neighbours, text

from .conftest import SF_SMALL


def _counted(df):
    """The rows of ``df``, and how many have been worked out so far."""
    n = df.sparkSession.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    return df.mapInArrow(rows, df.schema), n


def test_cross_stack_works_out_the_overlap_once(spark):
    train, alld, _ = models._labelled(spark, SF_SMALL)
    overlap, n = _counted(text.q_token_overlap(spark, SF_SMALL).select("doc_id", "ratio"))
    test = alld.where("rating IS NULL OR part = 2")
    pred = models.stack_predictions(train, test, overlap)
    assert pred.where("pred IS NOT NULL").count() == test.count()
    assert n.value == alld.count()


def test_overlap_takes_a_text_s_words_once(spark):
    plan = text.q_token_overlap(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2  # the query's and the text's


def test_null_query_has_no_overlap(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(0, "red fox"), (1, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    rows = [(0, "Red red dog"), (0, "fox fox"), (1, "red"), (2, ""), (4, None), (None, "red")]
    spark.createDataFrame([(i, t, "en", "web", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    got = [tuple(r) for r in text.q_token_overlap(spark, d).orderBy("doc_id", F.desc("ratio")).collect()]
    assert got == [(0, 1.0, 1), (0, 0.5, 0), (1, None, None), (2, 0.0, 0), (4, 0.0, 0)]


def _tables(spark, d, docs, queries, labels=()):
    spark.createDataFrame(queries, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    rows = [(i, t, g, "web", len(t or "")) for i, t, g in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")


def _words_taken(spark, run):
    """How many expressions take words in the statements that ``run`` writes and in what it returns."""
    plans, stored, checkpoint = [], BL.stored, DataFrame.checkpoint

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    try:
        BL.stored, DataFrame.checkpoint = lambda df: stored(seen(df)), lambda df, **k: checkpoint(seen(df), **k)
        out = run()
    finally:
        BL.stored, DataFrame.checkpoint = stored, checkpoint
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    return sum(p.count("regexp_extract_all") for p in plans), out


def test_weights_take_the_words_of_a_text_once(spark):
    n, w = _words_taken(spark, lambda: text._doc_weights(spark, SF_SMALL))
    assert n == 1
    tf = text._doc_tf(spark, SF_SMALL)
    want = TF.tfidf(tf, "doc_id", TF.fit_idf(tf, "doc_id", text.MIN_DF, text.MAX_DF, text.n_docs(spark, SF_SMALL)))
    each = lambda df: {(r.doc_id, r.term): r.w for r in df.collect()}
    got = each(BL.entries(w, ["doc_id"]))
    assert got == pytest.approx(each(want)) and got


def test_naive_bayes_of_packed_rows(spark, tmp_path):
    """Against a plain count: repeated documents and labels, groups that lack a class, null groups, classes and texts."""
    text_of = lambda i: " ".join(f"w{(i * k) % 7}" for k in range(1, 6))
    docs = [(i, text_of(i), ("en", "de", "fr")[i % 3]) for i in range(60)] + [(3, text_of(3), "en"), (50, text_of(50), "fr"), (70, None, "en"), (71, "w1", None), (72, "none", "fr")]
    labels = [(i, 1 if i % 3 == 2 else i % 2) for i in range(30)] + [(4, 1), (31, None)]
    _tables(spark, str(tmp_path), docs, [(0, "w1")], labels)
    w = {}
    for r in BL.entries(text._doc_weights(spark, str(tmp_path)), ["doc_id"]).collect():
        w.setdefault(r.doc_id, {})[r.term] = r.w
    seen, sums, vocab, heads = [(i, g, c) for i, c in labels for j, _, g in docs if i == j], {}, {}, {}
    for i, g, c in seen:
        for t, x in w.get(i, {}).items():
            sums[g, c, t] = sums.get((g, c, t), 0.0) + x
            vocab.setdefault(g, set()).add(t)
    for _, g, c in set(seen):
        heads[g, c] = heads.get((g, c), 0) + 1
    want = {}
    for i in {i for i, _, _ in docs} - {i for i, _ in labels}:
        groups, score = [g for j, _, g in docs if i == j and g], {}
        for g, c in heads:
            if g in groups:
                tot = sum(x for (h, d, _), x in sums.items() if (h, d) == (g, c))
                ll = sum(x * math.log((sums.get((g, c, t), 0.0) + 0.01) / (tot + 0.01 * len(vocab[g])))
                         for t, x in w.get(i, {}).items() if t in vocab.get(g, ())) if c is not None else 0.0
                score[c] = math.log(heads[g, c] / sum(n for (h, _), n in heads.items() if h == g)) + groups.count(g) * ll
        if score:
            want[i] = min(score, key=lambda c: (-score[c], c is not None, c))
    got = {r.doc_id: r.pred for r in neighbours.q_nb_by_group(spark, str(tmp_path)).collect()}
    assert got == want


def test_field_cosine_takes_the_words_of_a_text_once(spark):
    n, out = _words_taken(spark, lambda: text.q_field_cosine(spark, SF_SMALL))
    assert n == 2 and out.count() == text.pairs(spark, SF_SMALL).count()  # queries and texts


def test_similarity_of_repeated_and_empty_pairs(spark):
    q = spark.createDataFrame([(0, "a", 0.6), (0, "b", 0.8), (1, "c", 1.0)], "item_id long, term string, w double")
    t = spark.createDataFrame([(5, "b", 0.5), (5, "a", 0.5), (5, "z", 0.5), (6, "z", 1.0)], "doc_id long, term string, w double")
    pairs = spark.createDataFrame([(5, 0), (6, 1), (7, 0), (8, 9), (5, 1), (6, 0), (6, 0), (None, 0)], "doc_id long, item_id long")
    got = sorted((-1 if r[0] is None else r[0], r[1], round(r[2], 6), round(r[3], 6)) for r in TF.pair_similarity(q, t, pairs, "item_id", "doc_id").collect())
    assert got == [(-1, 0, 0.0, 0.0), (5, 0, 0.7, round(0.7 / (1 + 0.75 + 1.4), 6)), (5, 1, 0.0, 0.0), (6, 0, 0.0, 0.0), (6, 0, 0.0, 0.0), (6, 1, 0.0, 0.0), (7, 0, 0.0, 0.0), (8, 9, 0.0, 0.0)]
    twice = pairs.where("doc_id = 5 AND item_id = 0")
    assert [round(r.cosine, 6) for r in TF.pair_similarity(q, t, twice.union(twice), "item_id", "doc_id").collect()] == [1.4, 1.4]


def test_union_takes_the_words_of_a_text_once_a_block(spark):
    n, out = _words_taken(spark, lambda: linear.q_union_rows(spark, SF_SMALL))
    assert n <= 6  # a text's for its title; both for the overlap; a query's for its block, and to leave out those without words
    assert "SortMergeJoin [part" not in out._jdf.queryExecution().sparkPlan().toString()  # 401 columns go to the rows


def test_folds_are_fitted_from_sums_of_rows_read_once(spark):
    train = models.order_table(spark, SF_SMALL).where("half = 0").select("o_orderkey", "features", "y", "fold")
    counted, n = _counted(train.select("o_orderkey", vector_to_array("features").alias("x"), "y", "fold"))
    few = MD.other_folds(counted.withColumn("features", array_to_vector("x")), "features", "y")
    assert n.value <= 2 * train.count() and set(few) == {0, 1, 2, 3, 4}  # one look for nulls, one for the sums
    for p in models.RIDGE_GRID:
        fit = lambda rows: LinearRegression(labelCol="y", **p).fit(rows)
        a, b = fit(train.where("fold != 2")), fit(few[2])
        assert [*b.coefficients, b.intercept] == pytest.approx([*a.coefficients, a.intercept], rel=1e-5, abs=1e-6)


def test_folds_that_sums_cannot_tell_keep_their_rows(spark):
    rows = lambda f: spark.createDataFrame([(i, i % 2, f(i), float(i)) for i in range(12)], "id long, fold int, x array<double>, y double").withColumn(
        "features", array_to_vector("x"))
    assert MD.other_folds(rows(lambda i: [float(i * i), 1.0]), "features", "y") is None
    assert MD.other_folds(rows(lambda i: [float(i * i), 2.0 * i * i]), "features", "y") is None
    assert MD.other_folds(rows(lambda i: [float(i * i), math.nan]), "features", "y") is None
    assert MD.other_folds(rows(lambda i: [float(i * i), float(i % 5)]).withColumn("fold", F.lit(0)), "features", "y") is None


def test_trial_table_fits_no_fold_on_its_rows(spark, monkeypatch):
    seen, fit = [], LinearRegression.fit
    monkeypatch.setattr(LinearRegression, "fit", lambda self, rows, *a: (seen.append(rows.count()), fit(self, rows, *a))[1])
    out = models.q_trial_table(spark, SF_SMALL)
    assert out.where("status = 'ok'").count() == 6 and max(seen) == len(models.ORDER_FEATURES) + 2
