"""Step 7: nearest neighbours on ``embeddings`` (base = md5-parity half 0, queries = half 1) and
per-group naive Bayes on document TF-IDF (groups = ``lang``; labelled documents train, the rest
are scored)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import knn as K
from tabwright.operators import nbayes as NB
from tabwright.operators.folds import half_split
from tabwright.plans.text import _doc_weights
from tabwright.sources.tables import Tables

K_VOTE = 5
K_MEANS = [1, 2, 4, 8]
K_WEIGHTED = [4, 64, 1024]


def _split(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    h = e.join(half_split(e, "vec_id"), "vec_id")
    return h.where("half = 1"), h.where("half = 0")


def q_knn_vote(spark, sf_dir):
    q, b = _split(spark, sf_dir)
    nn = K.knn(q, b, K_VOTE, "vec_id", "vec_id", "embedding", "label")
    return K.knn_vote(nn).select(F.col("qid").alias("vec_id"), F.col("vote").cast("int").alias("vote"))


def q_knn_mean_feature(spark, sf_dir):
    q, b = _split(spark, sf_dir)
    nn = K.knn(q, b, max(K_MEANS), "vec_id", "vec_id", "embedding", "label")
    m = K.knn_mean(nn, K_MEANS)
    return m.select(F.col("qid").alias("vec_id"), "k", F.round("mean_label", 6).alias("mean_label"))


def q_knn_weighted(spark, sf_dir):
    """L4: inverse-distance means and votes for small and for large k from one list of neighbours."""
    q, b = _split(spark, sf_dir)
    nn = K.knn(q, b, max(K_WEIGHTED), "vec_id", "vec_id", "embedding", "label")
    return K.knn_weighted(nn, K_WEIGHTED).select(F.col("qid").alias("vec_id"), "k", F.round("mean_label", 6).alias("mean_label"),
                                                 F.col("vote").cast("int").alias("vote"))


def q_nb_by_group(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = _doc_weights(spark, sf_dir)  # read by fitting and by scoring
    docs = t.documents.select("doc_id", "lang")
    lab = t.labels.join(docs, "doc_id").select("doc_id", "lang", "quality")
    model, classes, prior = NB.fit(w, lab, "doc_id", "lang", "quality")
    test = docs.join(t.labels.select("doc_id"), "doc_id", "left_anti")
    return NB.predict(w, test, "doc_id", "lang", model, classes, prior)


QUERIES = {
    "knn_vote": q_knn_vote,
    "knn_mean_feature": q_knn_mean_feature,
    "knn_weighted": q_knn_weighted,
    "nb_by_group": q_nb_by_group,
}

KNN = """e AS (SELECT vec_id, embedding, label,
              (instr('0123456789abcdef', substr(md5(vec_id || '-0'), 32, 1)) - 1) % 2 AS half FROM embeddings),
q AS (SELECT * FROM e WHERE half = 1), b AS (SELECT * FROM e WHERE half = 0),
d AS (SELECT q.vec_id AS qid, b.vec_id AS bid, CAST(b.label AS DOUBLE) AS blabel,
             round(sqrt(list_sum(list_transform(range(1, len(q.embedding) + 1),
                   lambda i: (CAST(q.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)) ^ 2))), 9) AS dist
      FROM q, b),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, bid) AS rank FROM d)"""


def _nb_sql():
    from tabwright.plans.text import DOCTOK, _tfidf_sql
    return f"""WITH {DOCTOK}, {_tfidf_sql('doctok', 'doc_id')},
lab AS (SELECT l.doc_id, d.lang, l.quality AS cls FROM labels l JOIN documents d USING (doc_id)),
t AS (SELECT w.*, lab.lang, lab.cls FROM w JOIN lab USING (doc_id)),
fc AS (SELECT lang, cls, term, sum(w) AS fc FROM t GROUP BY ALL),
tot AS (SELECT lang, cls, sum(w) AS tot FROM t GROUP BY ALL),
vocab AS (SELECT DISTINCT lang, term FROM t),
nv AS (SELECT lang, count(*) AS nv FROM vocab GROUP BY lang),
prior AS (SELECT lang, cls, ln(count(*) / sum(count(*)) OVER (PARTITION BY lang)) AS prior FROM lab GROUP BY lang, cls),
grid AS (SELECT v.lang, v.term, c.cls FROM vocab v JOIN (SELECT DISTINCT lang, cls FROM tot) c USING (lang)),
lp AS (SELECT g.lang, g.cls, g.term, ln((coalesce(fc, 0) + 0.01) / (tot + 0.01 * nv)) AS logp
       FROM grid g LEFT JOIN fc USING (lang, cls, term) JOIN tot USING (lang, cls) JOIN nv USING (lang)),
test AS (SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
s AS (SELECT w.doc_id, lp.cls, sum(w.w * lp.logp) AS ll FROM w JOIN test USING (doc_id)
      JOIN lp ON lp.lang = test.lang AND lp.term = w.term GROUP BY ALL),
cand AS (SELECT test.doc_id, p.cls, p.prior + coalesce(s.ll, 0) AS score FROM test JOIN prior p USING (lang)
         LEFT JOIN s ON s.doc_id = test.doc_id AND s.cls = p.cls)
SELECT doc_id, cls AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cls) AS r FROM cand) WHERE r = 1"""


ORACLE = {
    "knn_vote": f"""WITH {KNN},
c AS (SELECT qid, blabel, count(*) AS n FROM r WHERE rank <= {K_VOTE} GROUP BY ALL)
SELECT qid AS vec_id, CAST(blabel AS INTEGER) AS vote FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY n DESC, blabel) AS x FROM c) WHERE x = 1""",
    "knn_mean_feature": f"""WITH {KNN},
ks AS (SELECT unnest([{', '.join(map(str, K_MEANS))}]) AS k)
SELECT qid AS vec_id, k, round(avg(blabel), 6) AS mean_label FROM r JOIN ks ON r.rank <= ks.k GROUP BY qid, k""",
    "knn_weighted": f"""WITH {KNN},
ks AS (SELECT unnest([{', '.join(map(str, K_WEIGHTED))}]) AS k),
near AS (SELECT qid, k, blabel, CASE WHEN least > 0 THEN 1.0 / dist ELSE CAST(dist = 0 AS DOUBLE) END AS weight
         FROM (SELECT *, min(dist) OVER (PARTITION BY qid) AS least FROM r) JOIN ks ON rank <= k),
by_label AS (SELECT qid, k, blabel, sum(weight) AS weight FROM near GROUP BY ALL)
SELECT qid AS vec_id, k, round(sum(weight * blabel) / sum(weight), 6) AS mean_label,
       CAST(arg_max(blabel, (round(weight, 9), -blabel)) AS INTEGER) AS vote FROM by_label GROUP BY qid, k""",
    "nb_by_group": _nb_sql(),
}
