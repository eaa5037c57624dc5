"""Step 3: device/cookie matching through shared tokens.

Domain mapping: devices = orders with status 'F', cookies = orders with status 'O' (whole table,
split by an attribute); an entity's tokens (IP addresses) are the ``l_partkey`` of its line items,
with ``l_suppkey`` as the second field; a token is *cellular* when its part has ``p_size <= 25``;
an entity's country is its customer's ``c_nationkey``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import match as M
from tabwright.sources.tables import Tables


class _World:
    def __init__(self, spark, sf_dir):
        t = Tables(spark, sf_dir)
        self.t = t
        o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
        self.devices = o.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("entity_id"),
                                                                    "o_custkey")
        self.cookies = o.where(F.col("o_orderstatus") == "O").select(F.col("o_orderkey").alias("entity_id"),
                                                                    "o_custkey")
        li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
        self.dev_tokens = M.tokens_of(self.devices, "entity_id", li, "l_orderkey", "l_partkey")
        self.cookie_tokens = M.tokens_of(self.cookies, "entity_id", li, "l_orderkey", "l_partkey")
        self.cellular = t.part.where(F.col("p_size") <= 25).select(F.col("p_partkey").alias("token"))

    def country(self, entities):
        c = self.t.customer.select("c_custkey", "c_nationkey")
        return entities.join(c, entities["o_custkey"] == c["c_custkey"]).select(
            "entity_id", F.col("c_nationkey").alias("country"))

    def same_customer_candidates(self):
        """Every (device, cookie) pair of one customer (the J1 equi-join; zeros possible)."""
        cookies = self.cookies.select("o_custkey", F.col("entity_id").alias("right_id"))
        return self.devices.join(cookies, "o_custkey").select(F.col("entity_id").alias("left_id"), "right_id")


def q_equi_suffix_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    left = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"),
                             F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("date"))
    right = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price"),
                            F.col("o_orderdate").alias("date"))
    return M.suffix_join(left, right, ["orderkey"])


def q_merge_route_join(spark, sf_dir):
    w = _World(spark, sf_dir)
    stream = w.t.lineitem.select("l_orderkey", "l_partkey")
    routed = M.route_merge(stream, "l_orderkey", {"device": w.devices, "cookie": w.cookies})
    return routed.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.countDistinct("l_orderkey").alias("n_entities"))


def q_token_sets(spark, sf_dir):
    w = _World(spark, sf_dir)
    li = w.t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    toks = M.tokens_of(w.devices, "entity_id", li, "l_orderkey", "l_partkey", "l_suppkey")
    return M.token_set_string(toks)


def q_same_attr_count(spark, sf_dir):
    w = _World(spark, sf_dir)
    pairs = M.first_overlap(w.dev_tokens, w.cookie_tokens)
    lc, rc = w.country(w.devices), w.country(w.cookies)
    j = (pairs.join(lc.select(F.col("entity_id").alias("left_id"), F.col("country").alias("cx")), "left_id")
         .join(rc.select(F.col("entity_id").alias("right_id"), F.col("country").alias("cy")), "right_id"))
    return j.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.col("cx") == F.col("cy")).alias("n_same"))


def q_set_overlap_pairs(spark, sf_dir):
    w = _World(spark, sf_dir)
    return M.overlap_pairs(w.dev_tokens, w.cookie_tokens)


def q_set_overlap_first(spark, sf_dir):
    w = _World(spark, sf_dir)
    return M.first_overlap(w.dev_tokens, w.cookie_tokens)


def q_set_overlap_hist(spark, sf_dir):
    w = _World(spark, sf_dir)
    cnt = M.common_count(w.same_customer_candidates(), w.dev_tokens, w.cookie_tokens)
    return cnt.groupBy("n_common").agg(F.count(F.lit(1)).alias("n_pairs"))


def q_flagged_tokens(spark, sf_dir):
    w = _World(spark, sf_dir)
    return M.count_flagged(w.devices, w.dev_tokens, w.cellular)


def q_pair_exists(spark, sf_dir):
    w = _World(spark, sf_dir)
    cnt = M.common_count(w.same_customer_candidates(), w.dev_tokens, w.cookie_tokens, w.cellular)
    return cnt.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.col("n_common") > 0).alias("n_with_common"),
                   F.count_if(F.col("n_flagged") > 0).alias("n_with_flagged"))


def q_pair_attr_filter(spark, sf_dir):
    w = _World(spark, sf_dir)
    lc, rc = w.country(w.devices), w.country(w.cookies)
    # only pairs of one country are formed; the filter then looks both sides up as before
    pairs = M.overlap_pairs(M.with_attr_tokens(w.dev_tokens, lc, "country"), M.with_attr_tokens(w.cookie_tokens, rc, "country"))
    return M.same_attr_filter(pairs, lc, rc, "country").select(
        "left_id", "right_id")


def q_match_lists(spark, sf_dir):
    w = _World(spark, sf_dir)
    pairs = M.overlap_pairs(w.dev_tokens, w.cookie_tokens)
    return M.match_lists(w.devices, pairs)


def _nested_lines(spark, sf_dir):
    """Source lines ``id,flag,{(a,b),(c,d)}`` built per order from its line items (≤ 7 items)."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("flag"))
    items = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey"))).alias("its"))
    body = F.array_join(F.transform("its", lambda x: F.format_string("(%d,%d)", x["l_partkey"], x["l_suppkey"])), ",")
    return items.join(o, items["l_orderkey"] == o["o_orderkey"]).select(
        F.format_string("%d,%d,{", "o_orderkey", "flag").alias("head"), body.alias("body")).select(
        F.concat("head", "body", F.lit("}")).alias("value"))


def parse_nested(lines):
    """Split at ``{``, drop flag ``0`` rows, extract the ``(a,b)`` groups → ``a b|c d``."""
    head = F.split(F.split(F.col("value"), r"\{")[0], ",")
    rest = F.split(F.col("value"), r"\{")[1]
    groups = F.regexp_extract_all(rest, F.lit(r"\(([^)]*)\)"), 1)
    return lines.select(head[0].cast("long").alias("id"), head[1].alias("flag"), groups.alias("g")).where(
        F.col("flag") != "0").select("id", F.col("flag").cast("int").alias("flag"),
                                     F.array_join(F.transform("g", lambda s: F.regexp_replace(s, ",", " ")),
                                                  "|").alias("items"))


def q_nested_set_parse(spark, sf_dir):
    return parse_nested(_nested_lines(spark, sf_dir))


def q_nested_set_write(spark, sf_dir):
    p = parse_nested(_nested_lines(spark, sf_dir))
    return p.select("id", F.format_string('%d,%d,"%s"', "id", "flag", "items").alias("line"))


def q_line_repair(spark, sf_dir):
    """K9: lines whose tab was lost (``uid`` glued to the first value) are split again."""
    from tabwright.plans.panel import q_panel_vector_lines
    lines = q_panel_vector_lines(spark, sf_dir)
    broken = lines.select("user_id", "line", F.regexp_replace("line", "\t", "").alias("broken"))
    fixed = F.regexp_replace("broken", r"^([^,]*)([^,])(,.*)$", "$1\t$2$3")
    return broken.select("user_id", fixed.alias("repaired"), (fixed == F.col("line")).cast("int").alias("ok"))


def q_onehot_string(spark, sf_dir):
    """One-hot of the customer segment against the sorted distinct segments, as a string."""
    from tabwright.functions.scalar import onehot_string
    from tabwright.operators.encode import ordinal_codes
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    codes = ordinal_codes(c, "c_mktsegment", "pos")
    n = codes.agg(F.count(F.lit(1))).scalar()
    # the count is projected first: subqueries may not sit inside the higher-order function
    return c.join(codes, "c_mktsegment").withColumn("n", n).select(
        "c_custkey", onehot_string("pos", "n").alias("onehot"))


QUERIES = {
    "equi_suffix_join": q_equi_suffix_join,
    "merge_route_join": q_merge_route_join,
    "token_sets": q_token_sets,
    "same_attr_count": q_same_attr_count,
    "set_overlap_pairs": q_set_overlap_pairs,
    "set_overlap_first": q_set_overlap_first,
    "set_overlap_hist": q_set_overlap_hist,
    "flagged_tokens": q_flagged_tokens,
    "pair_exists": q_pair_exists,
    "pair_attr_filter": q_pair_attr_filter,
    "match_lists": q_match_lists,
    "nested_set_parse": q_nested_set_parse,
    "nested_set_write": q_nested_set_write,
    "line_repair": q_line_repair,
    "onehot_string": q_onehot_string,
}

W = """dev AS (SELECT o_orderkey AS entity_id, o_custkey FROM orders WHERE o_orderstatus = 'F'),
coo AS (SELECT o_orderkey AS entity_id, o_custkey FROM orders WHERE o_orderstatus = 'O'),
tok AS (SELECT DISTINCT l_orderkey AS entity_id, l_partkey AS token FROM lineitem),
dt AS (SELECT * FROM tok WHERE entity_id IN (SELECT entity_id FROM dev)),
ct AS (SELECT * FROM tok WHERE entity_id IN (SELECT entity_id FROM coo)),
cell AS (SELECT p_partkey AS token FROM part WHERE p_size <= 25),
pairs AS (SELECT dt.entity_id AS left_id, ct.entity_id AS right_id, count(*) AS n_common
          FROM dt JOIN ct USING (token) GROUP BY ALL),
devc AS (SELECT entity_id, c_nationkey AS country FROM dev JOIN customer ON o_custkey = c_custkey),
cooc AS (SELECT entity_id, c_nationkey AS country FROM coo JOIN customer ON o_custkey = c_custkey),
firsts AS (SELECT dt.entity_id AS left_id, min(ct.entity_id) AS right_id FROM dt JOIN ct USING (token) GROUP BY 1),
cand AS (SELECT d.entity_id AS left_id, c.entity_id AS right_id FROM dev d JOIN coo c USING (o_custkey)),
candc AS (SELECT c.left_id, c.right_id, count(x.token) AS n_common, count(cell.token) AS n_flagged
          FROM cand c LEFT JOIN (SELECT dt.entity_id AS left_id, ct.entity_id AS right_id, token
                                 FROM dt JOIN ct USING (token)) x USING (left_id, right_id)
          LEFT JOIN cell ON cell.token = x.token
          GROUP BY c.left_id, c.right_id)"""

NESTED = """items AS (SELECT l_orderkey, string_agg('(' || l_partkey || ',' || l_suppkey || ')', ','
                    ORDER BY l_linenumber, l_partkey, l_suppkey) AS body FROM lineitem GROUP BY 1),
lines AS (SELECT o_orderkey || ',' || CAST(o_orderstatus = 'F' AS INTEGER) || ',{' || body || '}' AS value
          FROM items JOIN orders ON l_orderkey = o_orderkey),
parsed AS (SELECT CAST(split_part(split_part(value, '{', 1), ',', 1) AS BIGINT) AS id,
                  split_part(split_part(value, '{', 1), ',', 2) AS flag,
                  list_transform(regexp_extract_all(split_part(value, '{', 2), '\\(([^)]*)\\)', 1),
                                 lambda s: replace(s, ',', ' ')) AS g
           FROM lines),
kept AS (SELECT id, CAST(flag AS INTEGER) AS flag, array_to_string(g, '|') AS items FROM parsed WHERE flag <> '0')"""

from tabwright.plans.panel import ORACLE as _PANEL_ORACLE  # noqa: E402

ORACLE = {
    "line_repair": "WITH lines AS (" + _PANEL_ORACLE["panel_vector_lines"] + """),
b AS (SELECT user_id, line, replace(line, chr(9), '') AS broken FROM lines),
r AS (SELECT user_id, line, regexp_replace(broken, '^([^,]*)([^,])(,.*)$', '\\1' || chr(9) || '\\2\\3') AS repaired
      FROM b)
SELECT user_id, repaired, CAST(repaired = line AS INTEGER) AS ok FROM r""",
    "equi_suffix_join": """SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_extendedprice AS price_x,
  l_shipdate AS date_x, o_totalprice AS price_y, o_orderdate AS date_y
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "merge_route_join": """WITH tagged AS (SELECT o_orderkey AS entity_id, 'device' AS kind FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, 'cookie' FROM orders WHERE o_orderstatus = 'O')
SELECT kind, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_entities
FROM lineitem LEFT JOIN tagged ON l_orderkey = entity_id GROUP BY kind""",
    "token_sets": """SELECT entity_id, array_to_string(list_sort(list(DISTINCT item)), '|') AS items FROM (
  SELECT DISTINCT l_orderkey AS entity_id, l_partkey || ' ' || l_suppkey AS item FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')) GROUP BY entity_id""",
    "same_attr_count": f"""WITH {W}
SELECT count(*) AS n_pairs, count_if(a.country = b.country) AS n_same
FROM firsts f JOIN devc a ON a.entity_id = f.left_id JOIN cooc b ON b.entity_id = f.right_id""",
    "set_overlap_pairs": f"WITH {W} SELECT * FROM pairs",
    "set_overlap_first": f"WITH {W} SELECT * FROM firsts",
    "set_overlap_hist": f"WITH {W} SELECT n_common, count(*) AS n_pairs FROM candc GROUP BY n_common",
    "flagged_tokens": f"""WITH {W}
SELECT d.entity_id, count(dt.token) AS n_tokens, count(cell.token) AS n_flagged
FROM dev d LEFT JOIN dt USING (entity_id) LEFT JOIN cell ON cell.token = dt.token GROUP BY d.entity_id""",
    "pair_exists": f"""WITH {W}
SELECT count(*) AS n_pairs, count_if(n_common > 0) AS n_with_common, count_if(n_flagged > 0) AS n_with_flagged
FROM candc""",
    "pair_attr_filter": f"""WITH {W}
SELECT p.left_id, p.right_id FROM pairs p JOIN devc a ON a.entity_id = p.left_id
JOIN cooc b ON b.entity_id = p.right_id WHERE a.country = b.country""",
    "match_lists": f"""WITH {W}
SELECT d.entity_id AS left_id, coalesce(array_to_string(list_sort(list(p.right_id)), ' '), '') AS matches
FROM dev d LEFT JOIN pairs p ON p.left_id = d.entity_id GROUP BY d.entity_id""",
    "nested_set_parse": f"WITH {NESTED} SELECT id, flag, items FROM kept",
    "nested_set_write": f"WITH {NESTED} SELECT id, id || ',' || flag || ',\"' || items || '\"' AS line FROM kept",
    "onehot_string": """WITH seg AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS pos
                     FROM (SELECT DISTINCT c_mktsegment FROM customer)),
n AS (SELECT count(*) AS n FROM seg)
SELECT c_custkey, array_to_string(list_transform(range(0, (SELECT n FROM n)),
                                                 lambda i: CASE WHEN i = pos THEN '1' ELSE '0' END), ' ') AS onehot
FROM customer JOIN seg USING (c_mktsegment)""",
}
