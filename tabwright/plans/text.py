"""Step 6: text features.  Relevance data → ``benchmark.text`` is the query, ``documents.text`` the
product title; document ``d`` is paired with query ``item_id = d % (number of queries)`` (every
document is used); markup → ``pages.html``."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import functions as F

from tabwright.functions import text as TX
from tabwright.operators import blocks as BL
from tabwright.operators import textfeat as TF
from tabwright.operators.encode import ordinal_codes
from tabwright.sources.tables import Tables

MIN_DF, MAX_DF = 3, 0.5
TOP_K = 200
NGRAMS = (1, 2, 3, 5, 6)


CHARS_A_TASK = 8_000_000


def docs(spark, sf_dir, chars_a_task=CHARS_A_TASK):
    """``documents`` hash-partitioned by ``doc_id`` before any per-row text work: the regex work is
    spread over all tasks even when a file holds one row group, and the later
    ``groupBy(doc_id, term)`` reuses this partitioning (text is shuffled once, not its tokens).

    A task gets about ``chars_a_task`` characters: the counts of its tokens stay in its memory however long the table is."""
    d = Tables(spark, sf_dir).documents
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return d.repartition(-(-chars // chars_a_task), "doc_id") if chars > least * chars_a_task else d.repartition("doc_id")


def n_docs(spark, sf_dir):
    return Tables(spark, sf_dir).documents.agg(F.count(F.lit(1))).scalar()


def pairs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    n = t.benchmark.agg(F.count(F.lit(1))).scalar()
    d = docs(spark, sf_dir).select("doc_id", "text", (F.col("doc_id") % n).alias("item_id"))
    q = t.benchmark.select("item_id", F.col("text").alias("query"))
    return d.join(q, "item_id")


def pair_words(spark, sf_dir):
    """(doc_id, q, t): the different words of each document's query and of its text.  Both are taken before the
    join: a query's words once, not once a document, and a text's words once however often an expression names them."""
    t = Tables(spark, sf_dir)
    n = t.benchmark.agg(F.count(F.lit(1))).scalar()
    words = F.array_distinct(TX.words("text", TX.WORD2))
    d = docs(spark, sf_dir).select("doc_id", (F.col("doc_id") % n).alias("item_id"), words.alias("t"))
    return d.join(t.benchmark.select("item_id", words.alias("q")), "item_id").select("doc_id", "q", "t")


def query_words(spark, sf_dir):
    """(doc_id, words): the words of each document's query."""
    b = Tables(spark, sf_dir).benchmark
    n = b.agg(F.count(F.lit(1))).scalar()
    d = docs(spark, sf_dir).select("doc_id", (F.col("doc_id") % n).alias("item_id"))
    return d.join(b.select("item_id", TX.words("text").alias("words")), "item_id").select("doc_id", "words")


def q_html_text(spark, sf_dir):
    p = Tables(spark, sf_dir).pages
    return p.select("page_id", TX.strip_markup("html").alias("text"))


def q_text_normalise(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select("doc_id", TX.legacy_clean(TX.min_length_default("text", "feature3null")).alias("norm"))


def q_prefixed_bag(spark, sf_dir):
    p = pairs(spark, sf_dir)
    bag = F.concat(TX.prefixed(TX.words("query"), "q"), TX.prefixed(TX.words("text"), "z"))
    return p.select("doc_id", F.array_join(bag, " ").alias("bag"))


def _doc_tokens(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", TX.drop_stop(TX.words("text")).alias("tokens"))


def _doc_tf(spark, sf_dir):
    return TF.term_counts(docs(spark, sf_dir), "doc_id", TX.words("text"), TX.STOP_WORDS)


def q_ngrams(spark, sf_dir):
    d = _doc_tokens(spark, sf_dir)
    out = None
    for n in NGRAMS:
        g = d.select("doc_id", F.lit(n).alias("n"), TX.ngrams("tokens", n).alias("g")).select(
            "doc_id", "n", F.size("g").cast("long").alias("n_grams"),
            F.size(F.array_distinct("g")).cast("long").alias("n_distinct"))
        out = g if out is None else out.unionByName(g)
    return out


def q_tfidf(spark, sf_dir):
    tf = _doc_tf(spark, sf_dir).checkpoint(eager=True)  # read by the document frequencies and by the weights
    w = TF.tfidf(tf, "doc_id", TF.fit_idf(tf, "doc_id", MIN_DF, MAX_DF, n_docs(spark, sf_dir)))
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.round(F.sum("w"), 6).alias("w_sum"),
                                   F.round(F.max("w"), 6).alias("w_max"))


def q_token_overlap(spark, sf_dir):
    return pair_words(spark, sf_dir).select("doc_id", F.round(TF.overlap_ratio("q", "t"), 6).alias("ratio"),
                                            TF.overlap_ratio("q", "t", legacy_int=True).alias("ratio_int"))


def q_query_coverage(spark, sf_dir):
    p = pairs(spark, sf_dir)
    items = p.select("item_id").distinct()
    queries = Tables(spark, sf_dir).benchmark.join(items, "item_id", "left_semi")  # each query's text once, not once a document
    qt = queries.select("item_id", F.explode(TX.words("text", TX.WORD2)).alias("term")).distinct()
    dt = p.select("doc_id", F.explode(TX.words("text", TX.WORD2)).alias("term")).distinct()
    cov = TF.coverage(qt, dt, p.select("doc_id", "item_id"), "item_id", "doc_id")
    ords = ordinal_codes(queries.select("item_id"), "item_id", "query_ord")
    return cov.join(ords, "item_id").select("doc_id", "item_id", F.round("coverage", 6).alias("coverage"),
                                            "query_ord")


def q_field_cosine(spark, sf_dir):
    """Both fields stay packed, one row a text; their terms are counted once for the document frequencies and the weights."""
    b = Tables(spark, sf_dir).benchmark
    n = b.agg(F.count(F.lit(1))).scalar()
    p = docs(spark, sf_dir).select("doc_id", (F.col("doc_id") % n).alias("item_id")).join(b.select("item_id"), "item_id")
    with BL.tidy(spark):
        counts = [BL.stored(BL.packed_counts(TF.term_counts(d, key, TX.words("text"), TX.STOP_WORDS), key))
                  for d, key in ((b, "item_id"), (docs(spark, sf_dir), "doc_id"))]
        idf = BL.stored(TF.fit_idf(_terms(counts, ["item_id", "doc_id"]), "term", MIN_DF, MAX_DF, n + n_docs(spark, sf_dir)))
        wq, wt = BL.weighed(counts[0], "item_id", idf), BL.weighed(counts[1], "doc_id", idf)
        BL.drop(*counts, idf)
    s = TF.pair_similarity(wq, wt, p, "item_id", "doc_id")
    return s.select("doc_id", "item_id", F.round("cosine", 6).alias("cosine"), F.round("qjaccard", 6).alias("qjaccard"))


def _terms(counts, keys):
    """The terms of every text of several packed tables; the texts without a key are one text."""
    each = [c.select(F.col(k).isNotNull().alias("_known"), F.explode("terms").alias("term")) for c, k in zip(counts, keys)]
    both = functools.reduce(lambda x, y: x.unionByName(y), each)
    return both.where("_known").select("term").unionAll(both.where("NOT _known").select("term").distinct())


def q_top_vocab(spark, sf_dir):
    tf = _doc_tf(spark, sf_dir)
    top = TF.top_terms(tf, TOP_K)
    # rank inside the k kept rows (a bounded window: k rows)
    from pyspark.sql import Window
    return top.select("term", "n", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("term"))).alias("rank"))


QUERIES = {
    "html_text": q_html_text,
    "text_normalise": q_text_normalise,
    "prefixed_bag": q_prefixed_bag,
    "ngrams": q_ngrams,
    "tfidf": q_tfidf,
    "token_overlap": q_token_overlap,
    "query_coverage": q_query_coverage,
    "field_cosine": q_field_cosine,
    "top_vocab": q_top_vocab,
}


# ---- DuckDB oracle statements (same regular expressions, same fixed lists) ----

def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _words(expr: str, pattern: str = TX.WORD) -> str:
    return f"regexp_extract_all(lower(translate({expr}, {_sq(TX.ACCENTED)}, {_sq(TX.UNACCENTED)})), {_sq(pattern)}, 0)"


_STOP = "[" + ", ".join(_sq(w) for w in TX.STOP_WORDS) + "]"


def _nostop(expr: str) -> str:
    return f"list_filter({expr}, lambda t: NOT list_contains({_STOP}, t))"


def _markup(expr: str) -> str:
    s = f"regexp_replace({expr}, '(?is)<script[^>]*>.*?</script>', ' ', 'g')"
    s = f"regexp_replace({s}, '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
    s = f"regexp_replace({s}, '(?s)<!--.*?-->', ' ', 'g')"
    s = f"regexp_replace({s}, '(?s)<[^>]*>', ' ', 'g')"
    for ent, ch in TX.ENTITIES:
        s = f"replace({s}, {_sq(ent)}, {_sq(ch)})"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


PAIRS = """pairs AS (SELECT d.doc_id, d.text, b.item_id, b.text AS query FROM documents d
          JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark))"""
DOCTOK = f"doctok AS (SELECT doc_id, {_nostop(_words('text'))} AS tokens FROM documents)"


def _tfidf_sql(src: str, key: str, n_expr: str = "(SELECT count(*) FROM documents)") -> str:
    return f"""tf AS (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(tokens) AS term FROM {src}) GROUP BY ALL),
nd AS (SELECT {n_expr} AS n),
idf AS (SELECT term, ln((1 + (SELECT n FROM nd)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term
        HAVING count(*) >= {MIN_DF} AND count(*) <= (SELECT n FROM nd) * {MAX_DF}),
w0 AS (SELECT {key}, term, (ln(tf) + 1) * idf AS w FROM tf JOIN idf USING (term)),
w AS (SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS w FROM w0)"""


ORACLE = {
    "html_text": f"SELECT page_id, {_markup('html')} AS text FROM pages",
    "text_normalise": """SELECT doc_id, lower(array_to_string(list_filter(string_split(
  regexp_replace(regexp_replace(regexp_replace(CASE WHEN length(text) < 3 THEN 'feature3null' ELSE text END,
    '[^a-zA-Z0-9]', ' ', 'g'), '[0-9]{1,3}px', ' ', 'g'), ' [0-9]{1,6} |000', ' ', 'g'), ' '),
  lambda t: length(t) > 2), ' ')) AS norm FROM documents""",
    "prefixed_bag": f"""WITH {PAIRS}
SELECT doc_id, array_to_string(list_concat(list_transform({_words('query')}, lambda t: 'q' || t),
                                           list_transform({_words('text')}, lambda t: 'z' || t)), ' ') AS bag
FROM pairs""",
    "ngrams": f"""WITH {DOCTOK},
g AS (SELECT doc_id, n, list_transform(range(1, greatest(len(tokens) - n + 2, 1)),
                                   lambda i: array_to_string(tokens[i:i + n - 1], ' ')) AS g
      FROM doctok, (SELECT unnest({list(NGRAMS)}) AS n))
SELECT doc_id, n, CAST(len(g) AS BIGINT) AS n_grams, CAST(len(list_distinct(g)) AS BIGINT) AS n_distinct FROM g""",
    "tfidf": f"""WITH {DOCTOK}, {_tfidf_sql('doctok', 'doc_id')}
SELECT doc_id, count(*) AS n_terms, round(sum(w), 6) AS w_sum, round(max(w), 6) AS w_max FROM w GROUP BY doc_id""",
    "token_overlap": f"""WITH {PAIRS},
s AS (SELECT doc_id, list_distinct({_words('query', TX.WORD2)}) AS q, list_distinct({_words('text', TX.WORD2)}) AS t
      FROM pairs)
SELECT doc_id, round(CASE WHEN len(t) > 0 THEN len(list_intersect(q, t)) / len(t) ELSE 0.0 END, 6) AS ratio,
       CAST(CASE WHEN len(t) > 0 THEN floor(len(list_intersect(q, t)) / len(t)) ELSE 0 END AS BIGINT) AS ratio_int
FROM s""",
    "query_coverage": f"""WITH {PAIRS},
qt AS (SELECT DISTINCT item_id, unnest({_words('query', TX.WORD2)}) AS term FROM pairs),
dt AS (SELECT DISTINCT doc_id, unnest({_words('text', TX.WORD2)}) AS term FROM pairs),
hit AS (SELECT p.doc_id, p.item_id, count(*) AS h FROM pairs p JOIN qt USING (item_id) JOIN dt USING (doc_id, term)
        GROUP BY ALL),
sz AS (SELECT item_id, count(*) AS s FROM qt GROUP BY item_id),
ords AS (SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS query_ord
         FROM (SELECT DISTINCT item_id FROM pairs))
SELECT p.doc_id, p.item_id, round(coalesce(coalesce(h, 0) / nullif(coalesce(s, 0), 0), 0.0), 6) AS coverage, query_ord
FROM pairs p LEFT JOIN hit USING (doc_id, item_id) LEFT JOIN sz USING (item_id) JOIN ords USING (item_id)""",
    "field_cosine": f"""WITH {PAIRS},
docs AS (SELECT 'q' || item_id AS key, {_nostop(_words('text'))} AS tokens FROM benchmark
         UNION ALL SELECT 'd' || doc_id, {_nostop(_words('text'))} FROM documents),
{_tfidf_sql('docs', 'key', "(SELECT count(*) FROM benchmark) + (SELECT count(*) FROM documents)")},
wq AS MATERIALIZED (SELECT CAST(substr(key, 2) AS BIGINT) AS item_id, term, w FROM w WHERE key LIKE 'q%'),
wt AS MATERIALIZED (SELECT CAST(substr(key, 2) AS BIGINT) AS doc_id, term, w FROM w WHERE key LIKE 'd%'),
-- a document meets its own query's terms only: no join on the term alone, in whatever order the joins run
own AS MATERIALIZED (SELECT p.doc_id, p.item_id, wt.term, wt.w FROM pairs p JOIN wt ON wt.doc_id = p.doc_id),
dot AS (SELECT own.doc_id, own.item_id, sum(own.w * wq.w) AS dot FROM own JOIN wq ON wq.item_id = own.item_id AND wq.term = own.term GROUP BY ALL),
sq AS (SELECT item_id, sum(w * w) AS qq FROM wq GROUP BY 1),
st AS (SELECT doc_id, sum(w * w) AS tt FROM wt GROUP BY 1),
o AS (SELECT p.doc_id, p.item_id, coalesce(dot, 0.0) AS dot, coalesce(qq, 0.0) AS qq, coalesce(tt, 0.0) AS tt
      FROM pairs p LEFT JOIN dot USING (doc_id, item_id) LEFT JOIN sq USING (item_id) LEFT JOIN st USING (doc_id))
SELECT doc_id, item_id, round(dot, 6) AS cosine,
       round(coalesce(dot / nullif(qq + tt + 2 * dot, 0.0), 0.0), 6) AS qjaccard FROM o""",
    "top_vocab": f"""WITH {DOCTOK},
tot AS (SELECT term, count(*) AS n FROM (SELECT unnest(tokens) AS term FROM doctok) GROUP BY term)
SELECT term, n, CAST(row_number() OVER (ORDER BY n DESC, term) AS INTEGER) AS rank
FROM tot ORDER BY n DESC, term LIMIT {TOP_K}""",
}


# ---- stemming and SVD: SQL states the invariants of the result (no DuckDB counterpart of the methods) ----

LSA_K, SVD_K, SVD_BOUND = 8, 3, 0.01
LSA_WIDE, LSA_BOUND = 100, 0.01


def q_stem_terms(spark, sf_dir):
    """T4: every distinct term has one stem, no longer than the term."""
    from tabwright.operators.lsa import stem_terms
    s = stem_terms(_doc_tf(spark, sf_dir).select("term"))
    return s.select("term", (F.length("stem").between(1, F.length("term"))).cast("int").alias("fits"))


def q_stem_bag(spark, sf_dir):
    """T2 + T4: clean → stem → bag; stemming merges terms and keeps every occurrence."""
    from tabwright.operators.lsa import stem_tokens
    tf = _doc_tf(spark, sf_dir).checkpoint(eager=True)
    bag = stem_tokens(tf, "doc_id").groupBy("doc_id").agg(F.sum("tf").cast("long").alias("n_tokens"), F.count(F.lit(1)).alias("_stems"))
    terms = tf.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_terms"))
    both = bag.join(terms, "doc_id")
    return both.select("doc_id", "n_tokens", (F.col("_stems") <= F.col("_terms")).cast("int").alias("merged"))


def _doc_weights(spark, sf_dir):
    """Every document's TF-IDF weights, one row a document (doc_id, terms, ws); texts are taken apart once."""
    with BL.tidy(spark):
        counts = BL.stored(BL.packed_counts(_doc_tf(spark, sf_dir), "doc_id"))
        idf = BL.stored(TF.fit_idf(counts.select(F.explode("terms").alias("term")), "doc_id", MIN_DF, MAX_DF, n_docs(spark, sf_dir)))
        out = BL.weighed(counts, "doc_id", idf)
        BL.drop(counts, idf)
    return out


def q_lsa_project(spark, sf_dir, k=LSA_K):
    """Fit the SVD on the labelled (train) documents, project every document with that basis
    (documents without a kept term have zero scores); ``orthonormal``: the basis vectors' products are
    0 and 1 to 1e-6; ``ordered``: the singular values fall."""
    from tabwright.operators.lsa import lsa_fit, lsa_project
    w = _doc_weights(spark, sf_dir)
    train = w.join(Tables(spark, sf_dir).labels.select("doc_id"), "doc_id", "left_semi")
    vdf, values = lsa_fit(train, "doc_id", k)
    vdf = BL.stored(vdf)
    a, b = vdf.select("term", F.col("comp").alias("i"), F.col("v").alias("x")), vdf.select("term", F.col("comp").alias("j"), F.col("v").alias("z"))
    off = a.join(b, "term").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("z")).alias("p")).agg(
        F.max(F.abs(F.col("p") - (F.col("i") == F.col("j")).cast("double")))).first()[0]
    every = Tables(spark, sf_dir).documents.select("doc_id").withColumn("comp", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    # a document without terms that the basis knows has no score; SQL says which those are
    scores = every.join(lsa_project(w, "doc_id", vdf), ["doc_id", "comp"], "left")
    falls = all(x >= y for x, y in zip(values, values[1:]))
    return scores.select("doc_id", F.col("comp").cast("int").alias("comp"), F.col("score").isNotNull().cast("int").alias("scored"),
                         F.lit(int(off is not None and off < 1e-6)).alias("orthonormal"), F.lit(int(falls)).alias("ordered"))


def q_group_svd(spark, sf_dir, k=SVD_K, bound=SVD_BOUND):
    """First components per query group (documents grouped by their paired query), every document of every group.
    The flags of a group are taken anew from the returned scores: ``converged``: each component's residual |X X'u - lambda u|
    is at most the bound times the largest lambda; ``orthogonal``: the components' products; ``ordered``: their sizes fall."""
    from tabwright.operators import lsa as L
    p = pairs(spark, sf_dir).select("doc_id", "item_id").checkpoint(eager=True)
    every = _doc_weights(spark, sf_dir)
    w = BL.stored_turns(lambda rows, keys: rows.join(keys, "doc_id").select("item_id", "doc_id", "terms", "ws"), every, p, "doc_id")
    BL.drop(every)
    scores = L.group_components(w, "item_id", "doc_id", k, bound).checkpoint(eager=True)
    wide = scores.groupBy("item_id", "doc_id").pivot("comp", list(range(k))).agg(F.first("score")).select(
        "item_id", "doc_id", *[F.col(str(c)).alias(f"s{c}") for c in range(k)]).checkpoint(eager=True)
    names = [f"s{c}" for c in range(k)]
    both = wide.join(L.group_products(w, wide, "item_id", "doc_id", names).select("item_id", "doc_id", *[F.col(n).alias(f"a{n}") for n in names]), ["item_id", "doc_id"])
    dots = both.groupBy("item_id").agg(
        *[F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for i, a in enumerate(names) for b in names[i:]],
        *[F.sum(F.col(f"a{n}") * F.col(n)).alias(f"h{n}") for n in names], *[F.sum(F.col(f"a{n}") ** 2).alias(f"b{n}") for n in names])
    lam = [F.col(n + n) for n in names]
    top = lam[0]
    left = [F.col(f"b{n}") - 2 * v * F.col(f"h{n}") + v ** 3 for n, v in zip(names, lam)]  # of the scores, sqrt(lambda) u
    tight = [r <= (bound * top) ** 2 * v * 1.002 + 1e-9 * top ** 3 for r, v in zip(left, lam)]
    apart = [F.abs(F.col(a + b)) <= 1e-6 * top for i, a in enumerate(names) for b in names[i + 1:]]
    falls = [b <= a * (1 + 1e-9) for a, b in zip(lam, lam[1:])] or [F.lit(True)]
    every = lambda tests: F.coalesce(functools.reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False)).cast("int")
    flags = dots.select("item_id", every(tight).alias("converged"), every(apart).alias("orthogonal"), every(falls).alias("ordered"))
    grid = p.withColumn("comp", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    # a document without kept terms has no score; SQL says which those are
    return grid.join(scores, ["item_id", "doc_id", "comp"], "left").join(flags, "item_id", "left").select(
        "doc_id", "item_id", F.col("comp").cast("int").alias("comp"), F.col("score").isNotNull().cast("int").alias("scored"),
        "converged", "orthogonal", "ordered")


def q_lsa_wide(spark, sf_dir, k=LSA_WIDE, bound=LSA_BOUND):
    """T13 at useful width: the basis of the labelled documents, applied to all.  ``scored``: the document has a score;
    ``within``: its scores hold no more than its own length (1); ``orthonormal``: the basis to 1e-6, by a Gram matrix of the
    returned vectors; ``ordered``: the singular values fall; ``converged``: every residual, taken anew from the returned
    vectors as |X'X v - lambda v|, is at most the bound times the largest lambda."""
    from tabwright.operators import lsa as L
    w = _doc_weights(spark, sf_dir)
    train = w.join(Tables(spark, sf_dir).labels.select("doc_id"), "doc_id", "left_semi")
    v, values, _ = L.lsa_fit_wide(train, "doc_id", k, bound=bound)
    with BL.tidy(spark):
        v = BL.stored(v)
        y, vy = L.Blocks(train, "doc_id").product(v, "v")
        (vv,), (yy,) = L._grams(v, [("v", "v")]), L._grams(y, [("y", "y")])
    lam = values ** 2
    left = yy.diagonal() - 2 * lam * vy.diagonal() + lam ** 2 * vv.diagonal()
    tight = bool(len(lam)) and float(left.max()) ** 0.5 <= bound * lam[0] * 1.001
    flags = {"orthonormal": abs(vv - np.eye(len(vv))).max() < 1e-6 if len(vv) else False, "ordered": all(a >= b for a, b in zip(values, values[1:])), "converged": tight}
    out = Tables(spark, sf_dir).documents.select("doc_id").join(L.lsa_project_wide(w, "doc_id", v), "doc_id", "left")
    power = F.aggregate("score", F.lit(0.0), lambda a, x: a + x * x)
    return out.select("doc_id", F.col("score").isNotNull().cast("int").alias("scored"), F.coalesce(power <= 1 + 1e-9, F.lit(True)).cast("int").alias("within"),
                      *[F.lit(int(f)).alias(n) for n, f in flags.items()])


_KNOWN = f"""{DOCTOK}, {_tfidf_sql('doctok', 'doc_id')},
known AS (SELECT DISTINCT doc_id FROM w WHERE term IN (SELECT term FROM w WHERE doc_id IN (SELECT doc_id FROM labels)))"""

QUERIES.update({"lsa_wide": q_lsa_wide, "stem_terms": q_stem_terms, "stem_bag": q_stem_bag, "lsa_project": q_lsa_project, "group_svd": q_group_svd})
ORACLE.update({
    "stem_terms": f"WITH {DOCTOK} SELECT DISTINCT unnest(tokens) AS term, 1 AS fits FROM doctok",
    "stem_bag": f"""WITH {DOCTOK} SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens, 1 AS merged FROM doctok WHERE len(tokens) > 0""",
    "lsa_project": f"""WITH {_KNOWN} SELECT doc_id, comp, CAST(doc_id IN (SELECT doc_id FROM known) AS INTEGER) AS scored, 1 AS orthonormal, 1 AS ordered
FROM documents, (SELECT CAST(unnest(range(0, {LSA_K})) AS INTEGER) AS comp)""",
    "lsa_wide": f"""WITH {_KNOWN} SELECT doc_id, CAST(doc_id IN (SELECT doc_id FROM known) AS INTEGER) AS scored, 1 AS within, 1 AS orthonormal, 1 AS ordered, 1 AS converged
FROM documents""",
    "group_svd": f"""WITH {PAIRS}, {DOCTOK}, {_tfidf_sql('doctok', 'doc_id')}
SELECT doc_id, item_id, comp, CAST(doc_id IN (SELECT doc_id FROM w) AS INTEGER) AS scored,
  CASE WHEN item_id IN (SELECT item_id FROM pairs WHERE doc_id IN (SELECT doc_id FROM w)) THEN 1 END AS converged,
  CASE WHEN item_id IN (SELECT item_id FROM pairs WHERE doc_id IN (SELECT doc_id FROM w)) THEN 1 END AS orthogonal,
  CASE WHEN item_id IN (SELECT item_id FROM pairs WHERE doc_id IN (SELECT doc_id FROM w)) THEN 1 END AS ordered
FROM pairs, (SELECT CAST(unnest(range(0, {SVD_K})) AS INTEGER) AS comp)""",
})
