"""No caps, no division by zero, whole models: the rules that hold at any size."""

import math

import numpy as np

from pyspark.sql import functions as F

from tabwright.operators import match as M
from tabwright.operators import metrics as MX
from tabwright.operators import selection as S
from tabwright.operators.folds import shuffled_folds
from tabwright.operators import panel as P
from tabwright.plans import models
from tabwright.sources import files as IO
from tabwright.sources.tables import Tables


def brute_gini(rows):
    """rows: (key, y, score) → normalised Gini under ascending (score, key)."""
    def part(order):
        n, sw = len(order), sum(y for _, y, _ in order)
        return n / 2 - sum((i + 1) * y for i, (_, y, _) in enumerate(order)) / sw
    return part(sorted(rows, key=lambda r: (r[2], r[0]))) / part(sorted(rows, key=lambda r: (r[1], r[0])))


def _oof(spark, models, n=24, folds=2):
    rows = [(m, 0, i % folds, i, float((i * 7) % 11 + 1), float(((i * (k + 3)) % (7 + k)) + 0.01 * i))
            for k, m in enumerate(models) for i in range(n)]
    return spark.createDataFrame(rows, "model string, iter int, fold int, id long, y double, pred double"), rows


def _brute_round(rows, current, models, step):
    best = None
    for m in models:
        preds = {(f, i): (y, p) for mm, _, f, i, y, p in rows if mm == m}
        for k in range(int(round(1 / step)) + 1):
            w = round(k * step, 4)
            ginis = [brute_gini([(i, y, w * current[f, i] + (1 - w) * p) for (ff, i), (y, p) in preds.items() if ff == f])
                     for f in sorted({f for f, _ in preds})]
            cand = (-round(sum(ginis) / len(ginis), 9), m, w)
            best = cand if best is None or cand < best else best
    return best[1], best[2], -best[0]


def test_greedy_with_fifty_candidates_and_the_whole_loop(spark):
    models = [f"m{i:02d}" for i in range(50)]
    oof, rows = _oof(spark, models)
    start = models[0]
    current = {(f, i): p for m, _, f, i, _, p in rows if m == start}
    cur = oof.where(F.col("model") == start).select("iter", "fold", "id", "y", F.col("pred").alias("cur"))
    got = S.greedy_round(oof, cur, models, F.lit(0.0), step=0.25).first()
    model, w, gini = _brute_round(rows, current, models, 0.25)
    assert (got["model"], got["weight"]) == (model, w) and math.isclose(got["gini"], gini, abs_tol=1e-8)
    few = models[:6]
    chosen = S.greedy_blend(oof, start, few, -1.0, step=0.25)
    want, best = [(start, None)], -1.0
    while True:
        model, w, gini = _brute_round(rows, current, few, 0.25)
        if gini - best < 1e-6 or w > 0.9:
            break
        best = gini
        want.append((model, w))
        picked = {(f, i): p for m, _, f, i, _, p in rows if m == model}
        current = {k: w * v + (1 - w) * picked[k] for k, v in current.items()}
    assert [c[:2] for c in chosen] == want and len(chosen) >= 2


def test_a_model_of_many_files_is_one_model(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") / 4).alias("pred"))
    IO.write_submission(df.repartition(5), str(tmp_path / "first"))
    IO.write_submission(df.where("id < 10"), str(tmp_path / "second"))
    back = IO.read_submissions(spark, str(tmp_path / "*" / "part-*.csv"))
    rows = sorted((r["model"], r["row_no"], r["id"], r["pred"]) for r in back.collect())
    assert rows == [(m, i + 1, i, i / 4) for m, n in (("first", 1000), ("second", 10)) for i in range(n)]


def test_every_token_is_hot(spark):
    left = spark.range(60).select(F.col("id").alias("entity_id"), (F.col("id") % 2).alias("token"))
    right = spark.range(60).select((F.col("id") + 100).alias("entity_id"), (F.col("id") % 2).alias("token"))
    got = M.overlap_pairs(left, right, salt_buckets=7)
    assert got.count() == 2 * 30 * 30 and got.distinct().count() == 1800


def test_metrics_without_a_denominator_are_null(spark):
    flat = spark.createDataFrame([(i, 0.0, float(i), 1) for i in range(4)], "k long, y double, p double, one int")
    assert MX.gini(flat, "y", "p", "k").first()["gini"] is None
    assert MX.auc(flat, "y", "p", "k").first()["auc"] is None
    assert MX.kappa_quadratic(flat, "one", "one").first()["kappa"] is None


def test_fewer_rows_than_folds(spark):
    assert {r["fold"] for r in shuffled_folds(spark.range(3).withColumnRenamed("id", "k"), "k", 5).collect()} == {-1}


def test_activity_gate_predicts_the_week_after_the_window(spark, tmp_path):
    """Users are busy in every other week, so a busy last week of the window means a quiet next one: the gate is always
    right, a constant for half of the users."""
    rows = [(u, f"2024-01-{(w - 1) * 7 + d + 1:02d} 10:00:00", t) for u in range(40) for w in range(1, 6) for d in range(7 if w < 5 else 2)
            for t in ("click", "view") for _ in range(3 if w % 2 == u % 2 else 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "event_id long, user_id long, ts string, event_type string")
    df.selectExpr("event_id", "CAST(ts AS timestamp) AS ts", "user_id", "event_type", "CAST(1 AS double) AS value", "'{}' AS props").write.parquet(
        str(tmp_path / "events.parquet"))
    scored = models.gate_scores(P.event_panel(Tables(spark, str(tmp_path)).events)).collect()
    assert sorted(r.user_id for r in scored if r.p >= 0.5) == list(range(1, 40, 2))
    assert all(r.label == (r.p >= 0.5) for r in scored)
    out = models.q_activity_gate(spark, str(tmp_path)).collect()
    assert len(out) == 40 and all((r.active, r.line_fits) == (r.user_id % 2, 1) for r in out) and sum(r.constant_hits for r in out) == 20


def test_blend_ranks_of_ranges_are_those_of_the_whole_group(spark):
    """Many small ranges, ties, nulls, an outlier: the sums a weight are those of one sort of the group, and rows move a few times only."""
    rows = [("a" if i % 3 else "b", i, None if i % 17 == 0 else float(i % 7), None if i % 29 == 0 else float(i % 5), 1e300 if i == 50 else float((i * 37) % 101 // 4))
            for i in range(600)]
    df = spark.createDataFrame(rows, "model string, id long, y double, cur double, pred double")
    weights = [0.0, 0.25, 0.5, 1.0]
    got = {(r["model"], r["_k"]): (r["n"], r["sw"], r["swr"]) for r in S._blend_rank_sums(df, ["model"], weights, rows_a_piece=40, seen_a_piece=10).collect()}
    want = {}
    for m in ("a", "b"):
        for k, w in enumerate(weights):
            mine = [(y, i, None if c is None else w * c + (1 - w) * p) for mm, i, y, c, p in rows if mm == m]
            mine.sort(key=lambda t: (t[2] is not None, t[2] or 0.0, t[1]))
            want[m, k] = (len(mine), sum(t[0] or 0.0 for t in mine), sum((t[0] or 0.0) * (n + 1) for n, t in enumerate(mine)))
    assert got == want
    assert not S._blend_rank_sums(df.limit(0), ["model"], weights).collect()


def test_ranges_by_two_edges_and_orders_by_whole_numbers():
    """A row's range found by search, by the edges beside it and by counting edges is the same, with nulls, NaN and ties."""
    rnd = np.random.default_rng(4)
    n = 4000
    blend, ids, given = np.round(rnd.normal(size=n), 1), rnd.permutation(n), rnd.random(n) < 0.9
    blend[rnd.random(n) < 0.05] = np.nan
    blend = np.where(given, blend, -np.inf)
    order = np.lexsort((ids, blend, given))
    assert (S._order_of(blend, given, ids) == order).all()
    plain = rnd.normal(size=n) * 10.0 ** rnd.integers(-300, 300, n)
    plain[:1500] = plain[1500:3000] * (1 + 1e-15 * (np.arange(1500) % 3))
    plain[3000:3020] = 0.0 * np.array([1, -1] * 10)
    assert (S._order_of(plain, np.ones(n, bool), ids) == np.lexsort((ids, plain))).all()
    for cuts in (3, 40):
        at = order[np.sort(rnd.choice(n, cuts, replace=False))]
        edge = blend[at], ids[at], given[at]
        place = np.empty(n, int)
        place[order] = np.arange(n)
        want = (place[:, None] >= place[at][None, :]).sum(axis=1)
        assert (S._piece(blend, given, ids, edge) == want).all()
        assert all((S._within(blend, given, ids, edge, p) == (want == p)).all() for p in range(cuts + 1))


def test_a_candidate_is_ranked_alone_and_rows_travel_in_batches(spark, monkeypatch):
    models = ["a", "b", "c"]
    oof, rows = _oof(spark, models)
    cur = oof.where("model = 'a'").select("iter", "fold", "id", "y", F.col("pred").alias("cur"))
    seen, real = [], S._blend_rank_sums
    monkeypatch.setattr(S, "_blend_rank_sums", lambda c, *a: seen.append(sorted(r.model for r in c.select("model").distinct().collect())) or real(c, *a))
    got = S.greedy_round(oof, cur, models, F.lit(0.0), step=0.25, rows_at_once=30).first()
    model, w, gini = _brute_round(rows, {(f, i): p for m, _, f, i, _, p in rows if m == "a"}, models, 0.25)
    assert (got["model"], got["weight"]) == (model, w) and math.isclose(got["gini"], gini, abs_tol=1e-8) and seen == [["a"], ["b"], ["c"]]
    assert [r.mean_gini for r in S.model_scores(oof, models).orderBy("model").collect()] == [r.mean_gini for r in S.model_scores(oof).orderBy("model").collect()]
