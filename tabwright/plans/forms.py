"""Scans by form (S1–S3), codes and slices of panel vectors (F7, F9, F10), the low-variance filter (P19), codes fitted on the
training rows (E6) and the pair features of a same-customer join (E5, J1, J14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions import scalar as SC
from tabwright.operators import panel as P
from tabwright.operators.encode import label_encode, pair_encode
from tabwright.operators.folds import half_split
from tabwright.plans.folds import PARITY
from tabwright.plans.match import _World
from tabwright.plans.panel import PANEL_SQL, _dense_week
from tabwright.sources import files as IO
from tabwright.sources.tables import Tables

WEEK, MAX_VARIANCE = 4, 2.1
CATEGORICAL = ["priority", "segment", "nation", "year", "month", "lines"]
NUMERIC = ["price", "balance", "quantity"]


def q_scan_forms(spark, sf_dir):
    """S1–S3 + P6: ``supplier`` written as header CSV, as CSV read by position (cast at use) and as TSV, and read back."""
    s = Tables(spark, sf_dir).supplier.select("s_suppkey", "s_name", "s_acctbal")
    schema, out = "s_suppkey long, s_name string, s_acctbal double", None
    for form, sep in (("csv", ","), ("positional", ","), ("tsv", "\t")):
        path = IO.scratch_path(spark, f"scan-{form}")
        s.write.option("header", True).option("sep", sep).csv(path)
        names = ["s_suppkey", "s_name", "s_acctbal"]
        back = IO.read_positional(spark, path, names, {"s_suppkey": "bigint", "s_acctbal": "double"}, sep) if form == "positional" \
            else IO.read_table(spark, path, schema, sep)
        back = back.select(F.lit(form).alias("form"), *names)
        out = back if out is None else out.unionByName(back)
    return out


def q_panel_slices(spark, sf_dir):
    """F7 on codes, F9, F10: per user the week's vector by (day, type); the first day's total, every type's days of type 1, and
    the week and type read back from their codes."""
    panel = P.event_panel(Tables(spark, sf_dir).events)
    types = panel.agg(F.max("type")).first()[0] or 1
    week = P.dense_week(panel, WEEK).withColumn("slot", (F.col("day") - 1) * types + F.col("type") - 1)
    vec = P.vector_of(week, ["user_id"], "slot", "cnt").withColumns({
        "code": F.concat(F.lit(f"w{WEEK}d"), F.lit(P.DAYS).cast("string")), "tcode": F.concat(F.lit("v"), F.lit(types).cast("string"))})
    w, d = SC.parse_date_code("code")
    first = F.transform(SC.strided("vec", 0, types), lambda x: x.cast("string"))
    return vec.select("user_id", SC.slot_sum("vec", 1, types).alias("first_day"), F.array_join(first, ",").alias("type_1"),
                      w.alias("week"), d.alias("last_day"), SC.parse_type_code("tcode").alias("types"))


def q_low_variance_rows(spark, sf_dir):
    """Orders whose line numbers vary little."""
    li = Tables(spark, sf_dir).lineitem.groupBy("l_orderkey").agg(F.var_pop("l_linenumber").alias("var"), F.count(F.lit(1)).alias("n"))
    return li.where(SC.low_variance("var", MAX_VARIANCE)).select("l_orderkey", "n", F.round("var", 6).alias("var"))


def q_train_codes(spark, sf_dir):
    """Customer and priority of one half of the orders by the codes of the other half; values unseen there have none."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    o = o.join(half_split(o, "o_orderkey"), "o_orderkey")
    out = label_encode(o.where("half = 1"), ["o_custkey", "o_orderpriority"], fit_on=o.where("half = 0"))
    return out.select("o_orderkey", F.col("o_custkey_code").alias("customer"), F.col("o_orderpriority_code").alias("priority"))


def _attributes(world):
    li = world.t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("long").alias("lines"), F.sum("l_quantity").alias("quantity"))
    o = world.t.orders.join(world.t.customer, F.col("o_custkey") == F.col("c_custkey")).join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select(F.col("o_orderkey").alias("entity_id"), F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                    F.coalesce("lines", F.lit(0)).alias("lines"), F.col("o_totalprice").alias("price"), F.col("c_acctbal").alias("balance"),
                    F.coalesce("quantity", F.lit(0.0)).alias("quantity"))


def _pairs(spark, sf_dir):
    """Every (device, cookie) pair of one customer with both sides' attributes (J1), suffixed _x and _y."""
    world = _World(spark, sf_dir)
    a, out = _attributes(world), world.same_customer_candidates()
    for side, key in (("x", "left_id"), ("y", "right_id")):
        out = out.join(a.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{c}_{side}") for c in [*CATEGORICAL, *NUMERIC]]), key)
    return out


def q_pair_features(spark, sf_dir):
    """E5: one-hot strings of six attributes of each side and three max-scaled numbers of each side."""
    sides = lambda cols: [f"{c}_{s}" for s in ("x", "y") for c in cols]
    out = pair_encode(_pairs(spark, sf_dir), sides(CATEGORICAL), sides(NUMERIC))
    return out.select("left_id", "right_id", *sides(CATEGORICAL), *[F.round(c, 6).alias(c) for c in sides(NUMERIC)])


def q_pair_attr_equal(spark, sf_dir):
    """J14 on the J1 join: pairs, and those whose sides agree in priority or in year."""
    p = _pairs(spark, sf_dir)
    return p.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("priority_x") == F.col("priority_y")).alias("same_priority"),
                 F.count_if(F.col("year_x") == F.col("year_y")).alias("same_year"))


QUERIES = {"scan_forms": q_scan_forms, "panel_slices": q_panel_slices, "low_variance_rows": q_low_variance_rows, "train_codes": q_train_codes,
           "pair_features": q_pair_features, "pair_attr_equal": q_pair_attr_equal}

_HALF = f"CAST({PARITY.format(x=chr(39).join(['o_orderkey || ', '-0', '']))} AS INTEGER)"
_ATTR = """attr AS MATERIALIZED (SELECT o_orderkey AS entity_id, o_custkey, o_orderstatus, o_orderpriority AS priority, c_mktsegment AS segment, c_nationkey AS nation,
  year(o_orderdate) AS year, month(o_orderdate) AS month, coalesce(li.lines, 0) AS lines, o_totalprice AS price, c_acctbal AS balance, coalesce(li.quantity, 0) AS quantity
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey) li ON o_orderkey = l_orderkey)"""
_SIDES = ", ".join(f"{s}.{c} AS {c}_{s}" for s in ("x", "y") for c in [*CATEGORICAL, *NUMERIC])
_PAIRS = f"""{_ATTR}, pair AS MATERIALIZED (SELECT x.entity_id AS left_id, y.entity_id AS right_id, {_SIDES}
  FROM attr x JOIN attr y ON x.o_custkey = y.o_custkey AND x.o_orderstatus = 'F' AND y.o_orderstatus = 'O')"""


def _pair_features_sql() -> str:
    ctes, cols, joins = [_PAIRS], [], []
    for s in ("x", "y"):
        for c in CATEGORICAL:
            n = f"{c}_{s}"
            ctes.append(f"d_{n} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT {n} AS v FROM pair))")
            cols.append(f"array_to_string(list_transform(range(d_{n}.n), lambda i: CASE WHEN i = d_{n}.pos THEN '1' ELSE '0' END), ' ') AS {n}")
            joins.append(f"JOIN d_{n} ON d_{n}.v = pair.{n}")
        cols += [f"round({c}_{s} / (SELECT max({c}_{s}) FROM pair), 6) AS {c}_{s}" for c in NUMERIC]
    return f"WITH {', '.join(ctes)} SELECT left_id, right_id, {', '.join(cols)} FROM pair {' '.join(joins)}"


ORACLE = {
    "scan_forms": "SELECT form, s_suppkey, s_name, s_acctbal FROM supplier, (SELECT unnest(['csv', 'positional', 'tsv']) AS form)",
    "panel_slices": f"""WITH {PANEL_SQL}, dense AS ({_dense_week(WEEK)})
SELECT user_id, CAST(sum(CASE WHEN day = 1 THEN cnt ELSE 0 END) AS BIGINT) AS first_day, string_agg(CASE WHEN type = 1 THEN CAST(cnt AS VARCHAR) END, ',' ORDER BY day) AS type_1,
       {WEEK} AS week, 7 AS last_day, max(type) AS types FROM dense GROUP BY user_id""",
    "low_variance_rows": f"""SELECT l_orderkey, count(*) AS n, round(var_pop(l_linenumber), 6) AS var FROM lineitem GROUP BY l_orderkey HAVING var_pop(l_linenumber) < {MAX_VARIANCE}""",
    "train_codes": f"""WITH o AS (SELECT *, {_HALF} AS half FROM orders),
c AS (SELECT o_custkey, CAST(row_number() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT o_custkey FROM o WHERE half = 0)),
p AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT o_orderpriority FROM o WHERE half = 0))
SELECT o_orderkey, c.code AS customer, p.code AS priority FROM o LEFT JOIN c USING (o_custkey) LEFT JOIN p USING (o_orderpriority) WHERE half = 1""",
    "pair_features": _pair_features_sql(),
    "pair_attr_equal": f"""WITH {_PAIRS} SELECT count(*) AS pairs, count(*) FILTER (WHERE priority_x = priority_y) AS same_priority,
       count(*) FILTER (WHERE year_x = year_y) AS same_year FROM pair""",
}
