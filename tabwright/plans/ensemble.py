"""Step 4: prediction files and metrics.

Prediction files → four formula models over ``orders`` (``m1..m4``) in the long table
``submissions(model, row_no, id, pred)``; line ordinal ``row_no`` = order key; the Gini target is
``o_totalprice``.  Ratings (kappa, confusion, pairwise order) come from ``labels`` ⋈ ``documents``:
true rating ``1 + quality + 2·toxic``, predicted rating ``least(4, 1 + floor(log10(n_chars + 1)))``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabwright.functions.scalar import day_index
from tabwright.operators import blend as B
from tabwright.operators import metrics as M
from tabwright.sources.tables import Tables

MODELS = ["m1", "m2", "m3", "m4"]
R6 = 6


def predictions():
    """The four models' (model, pred) of a row of ``orders``, as an array."""
    y = F.col("o_totalprice")
    return F.array(
        F.struct(F.lit("m1").alias("model"), (y / 1000).alias("pred")),
        F.struct(F.lit("m2").alias("model"), (F.log(y) * 10).alias("pred")),
        F.struct(F.lit("m3").alias("model"), ((F.col("o_custkey") % 97) + y / 5000).alias("pred")),
        F.struct(F.lit("m4").alias("model"), (day_index("o_orderdate", "1992-01-01") / 100 + y / 2000).alias("pred")),
    )


def submissions(spark, sf_dir):
    """One scan of ``orders`` exploded into the four model predictions."""
    o = Tables(spark, sf_dir).orders
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("row_no"), F.col("o_totalprice").alias("y"),
                    F.explode(predictions()).alias("m")).select(
        "id", "row_no", "y", "m.model", "m.pred",
        (F.floor("m.pred") % 4 + 1).cast("int").alias("label"))


def ratings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", "quality", "n_chars",
        (1 + F.col("quality") + 2 * F.col("toxic")).cast("int").alias("rating"),
        F.least(F.lit(4), 1 + F.floor(F.log10(F.col("n_chars") + 1))).cast("int").alias("pred_rating"))


def q_file_mean(spark, sf_dir):
    m = B.mean_combine(submissions(spark, sf_dir))
    return m.select("id", F.round("mean_pred", R6).alias("mean_pred"), "mean_int")


def q_file_vote(spark, sf_dir):
    return B.vote(submissions(spark, sf_dir))


def q_rank_mean(spark, sf_dir):
    r = B.rank_average(submissions(spark, sf_dir).select("model", "row_no", "id", "pred"))
    return r.select("id", F.round("mean_rank", R6).alias("mean_rank"), F.round("rank_score", 9).alias("rank_score"))


def q_int_means(spark, sf_dir):
    s = submissions(spark, sf_dir).groupBy("id").agg(F.sum("label").alias("s"), F.count(F.lit(1)).alias("n"))
    return s.select("id", *[B.int_mean(F.col("s"), F.col("n"), r).alias(f"mean_{r}")
                            for r in ("floor", "half_away", "half_even")])


def q_geo_mean(spark, sf_dir):
    w = B.wide(submissions(spark, sf_dir), MODELS)
    g = B.geo_mean2(F.col("m1"), F.col("m2"))
    return w.select("id", F.round(g).cast("long").alias("geo_round"), F.bround(g).cast("long").alias("geo_even"))


def q_linear_power_blends(spark, sf_dir):
    w = B.wide(submissions(spark, sf_dir), MODELS)
    p1, p2 = F.col("m1"), F.col("m2")
    return w.select("id",
                    F.round(B.linear_blend(p1, p2, 0.3), R6).alias("lin"),
                    F.round(B.power_blend(p1, p2, 0.5, 1.2, 0.8), R6).alias("pow"),
                    F.round(B.product_over_sum(p1, p2), R6).alias("pos"),
                    F.round(1.5 * p1 + 8.5 * p2, R6).alias("unnorm"))


def q_gini_by_model(spark, sf_dir):
    g = M.gini(submissions(spark, sf_dir), "y", "pred", "id", ["model"])
    return g.select("model", F.round("gini", R6).alias("gini"))


def q_kappa(spark, sf_dir):
    k = M.kappa_quadratic(ratings(spark, sf_dir), "rating", "pred_rating")
    return k.select(F.round("kappa", R6).alias("kappa"))


def q_confusion(spark, sf_dir):
    return M.confusion(ratings(spark, sf_dir), "rating", "pred_rating")


def q_histogram(spark, sf_dir):
    return M.histogram(ratings(spark, sf_dir), "rating")


def q_logloss_acc(spark, sf_dir):
    r = ratings(spark, sf_dir)
    p1 = 1 / (1 + F.exp(-(F.log10(F.col("n_chars") + 1) - 2.5)))
    m = M.logloss_accuracy(r.withColumn("probs", F.array(1 - p1, p1)), "probs", "quality")
    return m.select(F.round("logloss", R6).alias("logloss"), F.round("accuracy", R6).alias("accuracy"))


def q_auc(spark, sf_dir):
    a = M.auc(ratings(spark, sf_dir), "quality", "n_chars", "doc_id")
    return a.select(F.round("auc", R6).alias("auc"))


def q_rmse(spark, sf_dir):
    s = submissions(spark, sf_dir).withColumn("y1000", F.col("y") / 1000)
    return M.rmse(s, "y1000", "pred", ["model"]).select("model", F.round("rmse", R6).alias("rmse"))


def q_pair_accuracy(spark, sf_dir):
    p = M.pair_accuracy(ratings(spark, sf_dir), "rating", "n_chars", "doc_id")
    return p.select(F.round("pair_accuracy", R6).alias("pair_accuracy"))


def q_cross_gini(spark, sf_dir):
    """C20: Gini of m3 against m1 as the truth, and the reverse."""
    w = B.wide(submissions(spark, sf_dir), ["m1", "m3"])
    a = M.gini(w, "m1", "m3", "id").select(F.lit("m1->m3").alias("direction"), "gini")
    b = M.gini(w, "m3", "m1", "id").select(F.lit("m3->m1").alias("direction"), "gini")
    return a.unionByName(b).select("direction", F.round("gini", R6).alias("gini"))


def q_order_consistency(spark, sf_dir):
    """Gini of the mean blend against each reference model (references in model order);
    ``consistent`` = not larger than the previous reference's Gini."""
    s = submissions(spark, sf_dir)
    blend = B.mean_combine(s).select("id", F.col("mean_pred").alias("new_pred"))
    j = s.select("model", "id", "pred").join(blend, "id")
    g = M.gini(j, "pred", "new_pred", "id", ["model"])
    prev = F.lag("gini").over(Window.orderBy("model"))  # one row per reference model
    return g.select("model", F.round("gini", R6).alias("gini"),
                    F.coalesce((F.col("gini") <= prev).cast("int"), F.lit(1)).alias("consistent"))


QUERIES = {
    "file_mean": q_file_mean,
    "file_vote": q_file_vote,
    "rank_mean": q_rank_mean,
    "int_means": q_int_means,
    "geo_mean": q_geo_mean,
    "linear_power_blends": q_linear_power_blends,
    "gini_by_model": q_gini_by_model,
    "kappa": q_kappa,
    "confusion": q_confusion,
    "histogram": q_histogram,
    "logloss_acc": q_logloss_acc,
    "auc": q_auc,
    "rmse": q_rmse,
    "pair_accuracy": q_pair_accuracy,
    "cross_gini": q_cross_gini,
    "order_consistency": q_order_consistency,
}

SUBS = """subs0 AS (
  SELECT o_orderkey AS id, o_orderkey AS row_no, o_totalprice AS y, 'm1' AS model, o_totalprice / 1000 AS pred FROM orders
  UNION ALL SELECT o_orderkey, o_orderkey, o_totalprice, 'm2', ln(o_totalprice) * 10 FROM orders
  UNION ALL SELECT o_orderkey, o_orderkey, o_totalprice, 'm3', (o_custkey % 97) + o_totalprice / 5000 FROM orders
  UNION ALL SELECT o_orderkey, o_orderkey, o_totalprice, 'm4',
         date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) / 100 + o_totalprice / 2000 FROM orders),
subs AS (SELECT *, CAST(floor(pred) % 4 + 1 AS INTEGER) AS label FROM subs0),
wide AS (SELECT id, max(pred) FILTER (WHERE model = 'm1') AS m1, max(pred) FILTER (WHERE model = 'm2') AS m2,
                max(pred) FILTER (WHERE model = 'm3') AS m3, max(pred) FILTER (WHERE model = 'm4') AS m4
         FROM subs GROUP BY id)"""

RATINGS = """ratings AS (
  SELECT l.doc_id, quality, n_chars, CAST(1 + quality + 2 * toxic AS INTEGER) AS rating,
         CAST(least(4, 1 + floor(log10(n_chars + 1))) AS INTEGER) AS pred_rating
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _gini_sql(src, grp, y, p, key):
    g = f"{grp}, " if grp else ""
    part = f"PARTITION BY {grp}" if grp else ""
    return f"""(SELECT {g}(n / 2 - sum(_y * rp) / sy) / (n / 2 - sum(_y * rt) / sy) AS gini FROM (
  SELECT {g}{y} AS _y, row_number() OVER ({part} ORDER BY {p}, {key}) AS rp,
         row_number() OVER ({part} ORDER BY {y}, {key}) AS rt,
         count(*) OVER ({part}) AS n, sum({y}) OVER ({part}) AS sy FROM {src}) GROUP BY {g}n, sy)"""


ORACLE = {
    "file_mean": f"""WITH {SUBS}
SELECT id, round(sum(pred) / 4, 6) AS mean_pred, CAST(trunc(sum(pred) / 4) AS BIGINT) AS mean_int FROM subs GROUP BY id""",
    "file_vote": f"""WITH {SUBS}
SELECT id, label AS vote FROM (
  SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, label) AS r FROM subs GROUP BY id, label)
WHERE r = 1""",
    "rank_mean": f"""WITH {SUBS},
r AS (SELECT row_no, id, row_number() OVER (PARTITION BY model ORDER BY pred, row_no, id) - 1 AS rank0 FROM subs),
m AS (SELECT row_no, id, avg(rank0) AS mean_rank FROM r GROUP BY row_no, id),
rr AS (SELECT *, row_number() OVER (ORDER BY mean_rank, row_no, id) - 1 AS k, count(*) OVER () AS n FROM m)
SELECT id, round(mean_rank, 6) AS mean_rank,
       round(coalesce(k / nullif(n - 1, 0), 0.0), 9) AS rank_score FROM rr""",
    "int_means": f"""WITH {SUBS}
SELECT id, CAST(floor(sum(label) / count(*)) AS BIGINT) AS mean_floor,
       CAST(round(sum(label) / count(*)) AS BIGINT) AS mean_half_away,
       CAST(round_even(sum(label) / count(*), 0) AS BIGINT) AS mean_half_even FROM subs GROUP BY id""",
    "geo_mean": f"""WITH {SUBS}
SELECT id, CAST(round(sqrt(m1 * m2)) AS BIGINT) AS geo_round, CAST(round_even(sqrt(m1 * m2), 0) AS BIGINT) AS geo_even
FROM wide""",
    "linear_power_blends": f"""WITH {SUBS}
SELECT id, round(0.3 * m1 + 0.7 * m2, 6) AS lin, round(0.5 * pow(m1, 1.2) + 0.5 * pow(m2, 0.8), 6) AS pow,
       round(CASE WHEN m1 + m2 = 0 THEN NULL ELSE m1 * m2 / (m1 + m2) END, 6) AS pos,
       round(1.5 * m1 + 8.5 * m2, 6) AS unnorm FROM wide""",
    "gini_by_model": f"WITH {SUBS} SELECT model, round(gini, 6) AS gini FROM "
                     + _gini_sql("subs", "model", "y", "pred", "id"),
    "kappa": f"""WITH {RATINGS}
SELECT round(1 - avg((rating - pred_rating) ^ 2)
       / (avg(rating ^ 2) + avg(pred_rating ^ 2) - 2 * avg(rating) * avg(pred_rating)), 6) AS kappa FROM ratings""",
    "confusion": f"""WITH {RATINGS},
lv AS (SELECT CAST(unnest(range(least(min(rating), min(pred_rating)), greatest(max(rating), max(pred_rating)) + 1))
              AS INTEGER) AS v FROM ratings)
SELECT a.v AS rating, b.v AS pred_rating, count(r.doc_id) AS n
FROM lv a CROSS JOIN lv b LEFT JOIN ratings r ON r.rating = a.v AND r.pred_rating = b.v GROUP BY a.v, b.v""",
    "histogram": f"""WITH {RATINGS},
lv AS (SELECT CAST(unnest(range(min(rating), max(rating) + 1)) AS INTEGER) AS v FROM ratings)
SELECT v AS rating, count(r.doc_id) AS n FROM lv LEFT JOIN ratings r ON r.rating = v GROUP BY v""",
    "logloss_acc": f"""WITH {RATINGS},
p AS (SELECT quality, 1 / (1 + exp(-(log10(n_chars + 1) - 2.5))) AS p1 FROM ratings)
SELECT round(avg(-ln(greatest(CASE WHEN quality = 1 THEN p1 ELSE 1 - p1 END, 1e-15))), 6) AS logloss,
       round(avg(CASE WHEN (CASE WHEN p1 > 1 - p1 THEN 1 ELSE 0 END) = quality THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM p""",
    "auc": f"""WITH {RATINGS},
r AS (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS ar
      FROM ratings)
SELECT round((sum(ar) FILTER (WHERE quality = 1) - sum(quality) * (sum(quality) + 1) / 2)
             / (sum(quality) * (count(*) - sum(quality))), 6) AS auc FROM r""",
    "rmse": f"WITH {SUBS} SELECT model, round(sqrt(avg((y / 1000 - pred) ^ 2)), 6) AS rmse FROM subs GROUP BY model",
    "pair_accuracy": f"""WITH {RATINGS}
SELECT round(count_if(a.n_chars < b.n_chars) / count(*), 6) AS pair_accuracy
FROM ratings a JOIN ratings b ON a.rating < b.rating""",
    "cross_gini": f"""WITH {SUBS}
SELECT 'm1->m3' AS direction, round(gini, 6) AS gini FROM {_gini_sql("wide", "", "m1", "m3", "id")}
UNION ALL
SELECT 'm3->m1', round(gini, 6) FROM {_gini_sql("wide", "", "m3", "m1", "id")}""",
    "order_consistency": f"""WITH {SUBS},
blend AS (SELECT id, sum(pred) / 4 AS new_pred FROM subs GROUP BY id),
j AS (SELECT s.model, s.id, s.pred, b.new_pred FROM subs s JOIN blend b USING (id)),
g AS {_gini_sql("j", "model", "pred", "new_pred", "id")}
SELECT model, round(gini, 6) AS gini,
       coalesce(CAST(gini <= lag(gini) OVER (ORDER BY model) AS INTEGER), 1) AS consistent FROM g""",
}
