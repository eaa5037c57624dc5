"""Step 0–1: rate cube scoring, rates, distinct/frequency tables, null repair, recodes, label transforms.

Domain mapping (survival table → ``lineitem``): outcome = ``l_linestatus = 'F'``, two-way flag =
``l_returnflag = 'R'``, class = ``l_linenumber % 3 + 1``, fare = ``l_quantity``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.scalar import bin_with_default, capped_bin, flag, hex_digit_parity, recode
from tabwright.operators import aggregates as agg
from tabwright.sources.tables import Tables

R6 = 6


def survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return li.select(
        "l_orderkey",
        flag("l_returnflag", "R").cast("int").alias("is_r"),
        (F.col("l_linenumber") % 3 + 1).alias("klass"),
        capped_bin("l_quantity").alias("fare_bin"),
        F.col("l_quantity").alias("fare"),
        (F.col("l_linestatus") == "F").cast("int").alias("outcome"),
    )


CUBE_KEYS = {"is_r": [0, 1], "klass": [1, 2, 3], "fare_bin": [0, 1, 2, 3]}


def q_rate_cube(spark, sf_dir):
    cube = agg.rate_cube(survival(spark, sf_dir), CUBE_KEYS, "outcome")
    return cube.select("is_r", "klass", "fare_bin", "n_rows", F.round("rate", R6).alias("rate"), "pred")


def q_rate_cube_score(spark, sf_dir):
    base = survival(spark, sf_dir)
    cube = agg.rate_cube(base, CUBE_KEYS, "outcome")
    scored = agg.score_by_lookup(base, cube, list(CUBE_KEYS), dense=True)
    return scored.groupBy("fare_bin", "pred").agg(F.count(F.lit(1)).alias("n_rows"))


def q_global_rate(spark, sf_dir):
    r = agg.global_rate(survival(spark, sf_dir), "outcome")
    return r.select("n_rows", "n_pos", F.round("rate", R6).alias("rate"))


def q_rate_by_flag(spark, sf_dir):
    r = agg.rate_by(survival(spark, sf_dir), ["is_r"], "outcome")
    return r.select("is_r", "n_rows", F.round("rate", R6).alias("rate"))


def q_distinct_values(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return agg.distinct_count(ev, ["event_type"], "user_id")


def q_freq_table(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.filter("event_type <> 'error'")  # P5: textual predicate
    return agg.freq_table(ev, ["user_id"])


def repair_base(spark, sf_dir) -> DataFrame:
    """orders ⟕ customer with NULLs injected on every 7th order key (the data has none)."""
    t = Tables(spark, sf_dir)
    hole = F.col("o_orderkey") % 7 == 0
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select("o_orderkey", "c_mktsegment",
                    F.when(hole, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("segment"),
                    F.when(hole, F.lit(None)).otherwise(F.col("o_totalprice")).alias("price")))


def q_fill_mode(spark, sf_dir):
    return agg.fill_mode(repair_base(spark, sf_dir), "segment").select("o_orderkey", "segment")


def q_fill_median(spark, sf_dir):
    out = agg.fill_median(repair_base(spark, sf_dir), "price")
    return out.select("o_orderkey", F.round("price", R6).alias("price"))


def q_fill_group_median(spark, sf_dir):
    out = agg.fill_group_median(repair_base(spark, sf_dir), "price", ["c_mktsegment"])
    return out.select("o_orderkey", "c_mktsegment", F.round("price", R6).alias("price"))


def q_fill_const(spark, sf_dir):
    out = repair_base(spark, sf_dir).fillna({"segment": "UNKNOWN", "price": 0.0})
    return out.select("o_orderkey", "segment", "price")


def q_default_bin(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    fare_text = F.when(F.col("l_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    klass = F.col("l_linenumber") % 3 + 1
    b = li.select(klass.alias("klass"), fare_text.alias("fare_text")).select(
        "klass", bin_with_default("fare_text", 3 - F.col("klass")).alias("fare_bin"))
    return b.groupBy("klass", "fare_bin").agg(F.count(F.lit(1)).alias("n_rows"))


SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}


def q_recode_map(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", recode("c_mktsegment", SEGMENT_CODES, 0).alias("segment_code"))


def q_max_scale(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_acctbal")
    out = agg.max_scale(c, "c_acctbal", "acct_scaled")
    return out.select("c_custkey", F.round("acct_scaled", R6).alias("acct_scaled"))


def q_label_transform(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.col("o_totalprice").alias("y"))
    norm = F.sqrt(o.agg(F.sum(F.col("y") * F.col("y"))).scalar())
    return o.select("o_orderkey",
                    F.round(F.log("y"), R6).alias("log_y"),
                    F.round(F.col("y") - 1, R6).alias("shift_y"),
                    F.round(F.col("y") / norm * 1000, R6).alias("l2_y_milli"))


NOISE_COPIES = 4


def q_label_noise(spark, sf_dir):
    """P20: K copies of each rated row; the first ``floor(var·K/max var)`` copies take a neighbouring
    rating (1→2, 4→3, 2→1|3, 3→2|4 by md5 parity of (id, copy)) instead of an unseeded draw."""
    t = Tables(spark, sf_dir)
    rated = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", (1 + F.col("quality") + 2 * F.col("toxic")).alias("rating"),
        F.log10(F.col("n_chars") + 1).alias("var"))
    max_var = rated.agg(F.max("var")).scalar()
    n_change = F.floor(F.col("var") * NOISE_COPIES / max_var)
    copies = rated.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(NOISE_COPIES - 1))))
    up = hex_digit_parity(F.concat_ws("-", "doc_id", "copy")) == 1
    neighbour = (F.when(F.col("rating") == 1, 2).when(F.col("rating") == 4, 3)
                 .when(up, F.col("rating") + 1).otherwise(F.col("rating") - 1))
    return copies.select("doc_id", "copy",
                         F.when(F.col("copy") < n_change, neighbour).otherwise(F.col("rating")).alias("label"))


QUERIES = {
    "rate_cube": q_rate_cube,
    "rate_cube_score": q_rate_cube_score,
    "global_rate": q_global_rate,
    "rate_by_flag": q_rate_by_flag,
    "distinct_values": q_distinct_values,
    "freq_table": q_freq_table,
    "fill_mode": q_fill_mode,
    "fill_median": q_fill_median,
    "fill_group_median": q_fill_group_median,
    "fill_const": q_fill_const,
    "default_bin": q_default_bin,
    "recode_map": q_recode_map,
    "max_scale": q_max_scale,
    "label_transform": q_label_transform,
    "label_noise": q_label_noise,
}

_SURV = """survival AS (
  SELECT l_orderkey, CAST(coalesce(l_returnflag = 'R', false) AS INTEGER) AS is_r,
         l_linenumber % 3 + 1 AS klass, CAST(least(floor(l_quantity / 10), 3) AS INTEGER) AS fare_bin,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS outcome
  FROM lineitem)"""
_CUBE = """grid AS (SELECT * FROM (VALUES (0), (1)) a(is_r), (VALUES (1), (2), (3)) b(klass),
                         (VALUES (0), (1), (2), (3)) c(fare_bin)),
stats AS (SELECT is_r, klass, fare_bin, count(*) AS n_rows, avg(outcome) AS rate FROM survival GROUP BY ALL),
cube AS (SELECT g.is_r, g.klass, g.fare_bin, coalesce(s.n_rows, 0) AS n_rows, coalesce(s.rate, 0.0) AS rate,
                CASE WHEN coalesce(s.rate, 0.0) >= 0.5 THEN 1 ELSE 0 END AS pred
         FROM grid g LEFT JOIN stats s USING (is_r, klass, fare_bin))"""
_REPAIR = """base AS (
  SELECT o_orderkey, c_mktsegment,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

ORACLE = {
    "rate_cube": f"WITH {_SURV}, {_CUBE} SELECT is_r, klass, fare_bin, n_rows, round(rate, 6) AS rate, pred FROM cube",
    "rate_cube_score": f"""WITH {_SURV}, {_CUBE}
SELECT s.fare_bin, coalesce(c.pred, 0) AS pred, count(*) AS n_rows
FROM survival s LEFT JOIN cube c USING (is_r, klass, fare_bin) GROUP BY ALL""",
    "global_rate": f"WITH {_SURV} SELECT count(*) AS n_rows, CAST(sum(outcome) AS BIGINT) AS n_pos, "
                   "round(avg(outcome), 6) AS rate FROM survival",
    "rate_by_flag": f"WITH {_SURV} SELECT is_r, count(*) AS n_rows, round(avg(outcome), 6) AS rate "
                    "FROM survival GROUP BY is_r",
    "distinct_values": "SELECT event_type, count(DISTINCT user_id) AS n_user_id FROM events GROUP BY event_type",
    "freq_table": "SELECT user_id, count(*) AS n_rows FROM events WHERE event_type <> 'error' GROUP BY user_id",
    "fill_mode": f"""WITH {_REPAIR},
m AS (SELECT segment FROM base WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)
SELECT o_orderkey, coalesce(base.segment, (SELECT segment FROM m)) AS segment FROM base""",
    "fill_median": f"""WITH {_REPAIR}
SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM base)), 6) AS price FROM base""",
    "fill_group_median": f"""WITH {_REPAIR},
med AS (SELECT c_mktsegment, median(price) AS m FROM base GROUP BY c_mktsegment)
SELECT o_orderkey, base.c_mktsegment, round(coalesce(price, med.m), 6) AS price
FROM base LEFT JOIN med ON base.c_mktsegment IS NOT DISTINCT FROM med.c_mktsegment""",
    "fill_const": f"WITH {_REPAIR} SELECT o_orderkey, coalesce(segment, 'UNKNOWN') AS segment, "
                  "coalesce(price, 0.0) AS price FROM base",
    "default_bin": """WITH b AS (
  SELECT l_linenumber % 3 + 1 AS klass,
         CASE WHEN l_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS fare_text FROM lineitem)
SELECT klass, CAST(coalesce(CASE WHEN TRY_CAST(fare_text AS DOUBLE) IS NOT NULL
                             THEN least(floor(TRY_CAST(fare_text AS DOUBLE) / 10), 3) END, 3 - klass) AS INTEGER)
         AS fare_bin,
       count(*) AS n_rows
FROM b GROUP BY ALL""",
    "recode_map": """SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
  WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 ELSE 0 END AS INTEGER) AS segment_code
FROM customer""",
    "max_scale": "SELECT c_custkey, round(c_acctbal / (SELECT max(c_acctbal) FROM customer), 6) AS acct_scaled "
                 "FROM customer",
    "label_transform": """SELECT o_orderkey, round(ln(o_totalprice), 6) AS log_y, round(o_totalprice - 1, 6) AS shift_y,
  round(o_totalprice / sqrt((SELECT sum(o_totalprice * o_totalprice) FROM orders)) * 1000, 6) AS l2_y_milli
FROM orders""",
    "label_noise": """WITH rated AS (
  SELECT l.doc_id, 1 + quality + 2 * toxic AS rating, log10(n_chars + 1) AS var
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
mx AS (SELECT max(var) AS m FROM rated),
copies AS (SELECT rated.*, c.copy FROM rated, (SELECT unnest(range(0, 4)) AS copy) c)
SELECT doc_id, CAST(copy AS INTEGER) AS copy,
  CASE WHEN copy < floor(var * 4 / (SELECT m FROM mx)) THEN
    CASE WHEN rating = 1 THEN 2 WHEN rating = 4 THEN 3
         WHEN (instr('0123456789abcdef', substr(md5(doc_id || '-' || copy), 32, 1)) - 1) % 2 = 1 THEN rating + 1
         ELSE rating - 1 END
  ELSE rating END AS label
FROM copies""",
}
