"""Step 5: folds and splits (``labels``, ``orders``) and encoders (``customer``, ``part``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import encode as E
from tabwright.operators import folds as FO
from tabwright.sources.tables import Tables

HOLDOUT_FRACTION = 0.0784


def q_strat_folds(spark, sf_dir):
    return FO.stratified_folds(Tables(spark, sf_dir).labels, "doc_id", "quality").select("iter", "doc_id", "fold")


def q_contig_folds(spark, sf_dir):
    return FO.contiguous_folds(Tables(spark, sf_dir).orders, "o_orderkey")


def q_shuffled_folds(spark, sf_dir):
    return FO.shuffled_folds(Tables(spark, sf_dir).orders, "o_orderkey", seed=7)


def q_half_split(spark, sf_dir):
    return FO.half_split(Tables(spark, sf_dir).labels, "doc_id")


def q_tail_holdout(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.log("o_totalprice").alias("log_y"))
    h = FO.tail_holdout(o, "o_orderkey", HOLDOUT_FRACTION)
    return h.select("o_orderkey", "split", F.round("log_y", 6).alias("log_y"))


def _part_split(spark, sf_dir):
    """Train ∪ test with a ``split`` column (md5 parity of the key)."""
    p = Tables(spark, sf_dir).part
    return p.join(FO.half_split(p, "p_partkey"), "p_partkey").withColumn(
        "split", F.when(F.col("half") == 1, F.lit("test")).otherwise(F.lit("train"))).drop("half")


def q_label_encode(spark, sf_dir):
    both = _part_split(spark, sf_dir)
    enc = E.label_encode(both, ["p_brand", "p_type"])
    return enc.select("p_partkey", "split", "p_brand_code", "p_type_code")


def q_onehot(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_brand", "p_type", "p_size")
    oh = E.sparse_onehot(p, "p_partkey", ["p_brand", "p_type", "p_size"])
    return oh.select("p_partkey", F.array_join("active", " ").alias("active"))


def q_dict_vector(spark, sf_dir):
    both = _part_split(spark, sf_dir)
    train, test = both.where("split = 'train'"), both.where("split = 'test'")  # U3: split back
    return E.dict_vectorize(train, test, "p_partkey", ["p_brand", "p_type"], ["p_size", "p_retailprice"]).select(
        "p_partkey", "feature", F.round("value", 6).alias("value"))


def q_mixed_mapper(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    enc = E.label_encode(c, ["c_mktsegment"])
    z = E.zscore(enc, ["c_acctbal", "c_nationkey"])
    return z.select("c_custkey", (F.col("c_acctbal") > 0).cast("int").alias("pos_bal"), "c_mktsegment_code",
                    F.round("c_acctbal_z", 6).alias("acctbal_z"), F.round("c_nationkey_z", 6).alias("nation_z"))


QUERIES = {
    "strat_folds": q_strat_folds,
    "contig_folds": q_contig_folds,
    "shuffled_folds": q_shuffled_folds,
    "half_split": q_half_split,
    "tail_holdout": q_tail_holdout,
    "label_encode": q_label_encode,
    "onehot": q_onehot,
    "dict_vector": q_dict_vector,
    "mixed_mapper": q_mixed_mapper,
}

PARITY = "(instr('0123456789abcdef', substr(md5({x}), 32, 1)) - 1) % 2"
PSPLIT = f"""ps AS (SELECT *, CASE WHEN {PARITY.format(x="p_partkey || '-0'")} = 1 THEN 'test' ELSE 'train' END AS split
        FROM part)"""


def _codes(col):
    return f"""(SELECT {col}, CAST(row_number() OVER (ORDER BY {col}) - 1 AS INTEGER) AS {col}_code
        FROM (SELECT DISTINCT {col} FROM ps))"""


ORACLE = {
    "strat_folds": """WITH r AS (SELECT doc_id, quality, i AS iter FROM labels, (SELECT unnest(range(0, 2)) AS i))
SELECT CAST(iter AS INTEGER) AS iter, doc_id,
       CAST((row_number() OVER (PARTITION BY iter, quality ORDER BY md5(doc_id || '-' || (711 + iter * 1000)), doc_id)
             - 1) % 5 AS INTEGER) AS fold
FROM r""",
    "contig_folds": """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n
           FROM orders),
p AS (SELECT *, n // 5 AS q, n % 5 AS rem FROM r)
SELECT o_orderkey, CAST(CASE WHEN rn <= rem * (q + 1) THEN (rn - 1) // (q + 1)
                             ELSE rem + (rn - 1 - rem * (q + 1)) // q END AS INTEGER) AS fold FROM p""",
    "shuffled_folds": """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || '-7'), o_orderkey) AS rn,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST(CASE WHEN (rn - 1) // (n // 5) < 5 THEN (rn - 1) // (n // 5) ELSE -1 END AS INTEGER) AS fold
FROM r""",
    "half_split": f"SELECT doc_id, CAST({PARITY.format(x=chr(39).join(['doc_id || ', '-0', '']))} AS INTEGER) AS half "
                  "FROM labels",
    "tail_holdout": f"""WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey DESC) AS rn,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN rn <= floor(n * {HOLDOUT_FRACTION}) THEN 'holdout' ELSE 'train' END AS split,
       round(ln(o_totalprice), 6) AS log_y FROM r""",
    "label_encode": f"""WITH {PSPLIT}
SELECT p_partkey, split, p_brand_code, p_type_code FROM ps
JOIN {_codes("p_brand")} USING (p_brand) JOIN {_codes("p_type")} USING (p_type)""",
    "onehot": f"""WITH {PSPLIT},
b AS {_codes("p_brand")}, t AS {_codes("p_type")}, s AS {_codes("p_size")}
SELECT p_partkey, CAST(p_brand_code AS VARCHAR) || ' ' || CAST(p_type_code + (SELECT count(*) FROM b) AS VARCHAR) || ' '
       || CAST(p_size_code + (SELECT count(*) FROM b) + (SELECT count(*) FROM t) AS VARCHAR) AS active
FROM ps JOIN b USING (p_brand) JOIN t USING (p_type) JOIN s USING (p_size)""",
    "dict_vector": f"""WITH {PSPLIT},
lf AS (SELECT p_partkey, split, 'p_brand=' || p_brand AS feature, 1.0 AS value FROM ps
       UNION ALL SELECT p_partkey, split, 'p_type=' || p_type, 1.0 FROM ps
       UNION ALL SELECT p_partkey, split, 'p_size', CAST(p_size AS DOUBLE) FROM ps
       UNION ALL SELECT p_partkey, split, 'p_retailprice', p_retailprice FROM ps)
SELECT p_partkey, feature, round(value, 6) AS value FROM lf
WHERE split = 'test' AND feature IN (SELECT feature FROM lf WHERE split = 'train')""",
    "mixed_mapper": """WITH codes AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER)
                              AS c_mktsegment_code FROM (SELECT DISTINCT c_mktsegment FROM customer))
SELECT c_custkey, CAST(c_acctbal > 0 AS INTEGER) AS pos_bal, c_mktsegment_code,
       round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6)
         AS acctbal_z,
       round((c_nationkey - (SELECT avg(c_nationkey) FROM customer))
             / (SELECT stddev_pop(c_nationkey) FROM customer), 6) AS nation_z
FROM customer JOIN codes USING (c_mktsegment)""",
}
