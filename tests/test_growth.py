"""What a task holds and what is shuffled must not follow the table: plans, and results against plain Python."""

import itertools

from tabwright.operators import aggregates as AG
from tabwright.operators import encode as EN
from tabwright.operators import match as M
from tabwright.operators import metrics as MX
from tabwright.operators import selection as S
from tabwright.plans import selection, text
from tabwright.sources import files as IO


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_get_a_task_for_so_many_characters(spark, tmp_path):
    rows = [(i, "word " * 40, "en", "s", 200) for i in range(100)] + [(100, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    many = text.docs(spark, str(tmp_path), chars_a_task=1000)
    assert many.rdd.getNumPartitions() == 20 and many.count() == 101
    assert text.docs(spark, str(tmp_path)).rdd.getNumPartitions() <= 8


def test_dense_cube_goes_to_the_rows(spark):
    keys = {"a": [0, 1], "b": [0, 1]}
    df = spark.createDataFrame([(0, 0, 1), (0, 0, 1), (1, 1, 0), (1, 0, 1), (2, 0, 1), (None, 0, 1)], "a int, b int, y int")
    out = AG.score_by_lookup(df, AG.rate_cube(df, keys, "y"), ["a", "b"], dense=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _plan(out).count("SortMergeJoin") == 1  # the cube's own, grid to counts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.a is None, r.a, r.b, r.pred) for r in out.where("a IS NOT NULL").collect()) == [
        (False, 0, 0, 1), (False, 0, 0, 1), (False, 1, 0, 1), (False, 1, 1, 0), (False, 2, 0, 0)]


def test_lines_stay_where_they_are_read(spark, tmp_path):
    df = spark.createDataFrame([(i, i / 2) for i in range(50)], "id long, pred double")
    IO.write_submission(df, f"{tmp_path}/m1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        back = IO.read_submissions(spark, f"{tmp_path}/m*/part-*.csv")
        assert "SortMergeJoin" not in _plan(back)
        assert sorted((r.row_no, r.id, r.pred) for r in back.collect()) == [(i + 1, i, i / 2) for i in range(50)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_model_is_named_once_a_block(spark, tmp_path):
    """Patterns over the path are searched after the lines of a block have become one count."""
    df = spark.createDataFrame([(i, i / 2) for i in range(50)], "id long, pred double")
    IO.write_submission(df, f"{tmp_path}/m1")
    back = IO.read_submissions(spark, f"{tmp_path}/m*/part-*.csv")
    nodes = back._jdf.queryExecution().optimizedPlan().toString().splitlines()
    named = [i for i, n in enumerate(nodes) if "regexp_extract" in n]
    counted = [i for i, n in enumerate(nodes) if "Aggregate" in n]
    assert named and max(named) <= counted[0]
    assert {r.model for r in back.select("model").collect()} == {"m1"}


def test_one_hot_dictionaries_go_to_the_rows(spark):
    df = spark.createDataFrame([(i, "xyz"[i % 3], float(i)) for i in range(9)] + [(9, None, 1.0)], "id long, c string, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = EN.pair_encode(df, ["c"], ["v"])
        assert "SortMergeJoin" not in _plan(out)
        hot = {"x": "1 0 0", "y": "0 1 0", "z": "0 0 1"}
        assert sorted((r.id, r.c, r.v) for r in out.collect()) == [(i, hot["xyz"[i % 3]], i / 8) for i in range(9)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tokens_of_one_attribute_value(spark):
    tokens = spark.createDataFrame([(1, 7), (1, 8), (2, 7), (3, 7), (4, 7), (5, None)], "entity_id long, token long")
    attrs = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, None), (5, "a"), (1, "a")], "entity_id long, country string")
    got = M.with_attr_tokens(tokens, attrs, "country").collect()
    assert sorted((r.entity_id, r.token["_a"], r.token["token"]) for r in got) == [(1, "a", 7), (1, "a", 8), (2, "a", 7), (2, "b", 7)]


def test_out_of_fold_rows_of_repeated_orders(spark, tmp_path):
    """As a self-join by id: rows that repeat an id meet each other's targets, rows without an id are left out."""
    import datetime
    day = datetime.datetime(1992, 1, 11)
    rows = [(1, 5, "F", 1000.0, day, "1"), (1, 6, "F", 3000.0, day, "1"), (2, 7, "F", 500.0, day, "1"), (None, 8, "F", 9.0, day, "1"), (3, 9, "F", None, day, "1"),
            (4, None, "F", 2000.0, day, "1")]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/orders.parquet")
    o = selection.oof(spark, str(tmp_path))
    got = sorted(((r.model, r.iter, r.id, r.y, r.pred) for r in o.collect()), key=str)
    targets = {1: [1000 / 1000 + 5, 3000 / 1000 + 6], 2: [0.5 + 7], 3: [None], 4: [None]}
    m1, m3 = {1: [1.0, 3.0], 2: [0.5], 3: [None], 4: [2.0]}, {1: [5 + 0.2, 6 + 0.6], 2: [7 + 0.1], 3: [None], 4: [None]}
    for name, want in (("m1", m1), ("m3", m3)):
        mine = [g for g in got if g[0] == name]
        assert len(mine) == 2 * 7 and sorted(map(str, mine)) == sorted(
            str((name, it, k, y, p)) for it in (0, 1) for k in want for p, y in itertools.product(want[k], targets[k]))
    five = {(g[2], g[3]): g[4] for g in got if g[0] == "m5"}
    assert len(five) == 5 and five[4, None] == 2.0 and abs(five[1, 6.0] - (1 + 3 + 5.2 + 6.6) / 4) < 1e-12 and five[3, None] is None
    plan = _plan(o.where("model <> 'm5'"))
    assert "Generate" not in plan[plan.index("Exchange"):]  # rows become many above the shuffles only


def test_gini_by_variant_is_the_gini_of_each(spark):
    rows = [(0, m, i, float((i * 7) % 11 + 1), float((i * (k + 3)) % (7 + k))) for k, m in enumerate("abc") for i in range(20) if m != "c" or i % 3]
    rows += [(0, "b", 3, 5.0, 1.0), (1, "a", 1, 1.0, 2.0), (1, "a", 2, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "f int, m string, id long, y double, p double")
    got = {(r.f, r.m): r.gini for r in MX.gini_by_variant(df, "y", "p", "id", ["f"], ["m"]).collect()}
    want = {(r.f, r.m): r.gini for r in MX.gini(df, "y", "p", "id", ["f", "m"]).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_matrix_without_a_pivot(spark):
    df = spark.createDataFrame([("a", 0, 1, 1.0, 2.0), ("b", 0, 1, 1.0, None), ("a", 0, 2, None, 3.0), ("c", 0, 3, 1.0, 3.0)], "model string, iter int, id long, y double, pred double")
    out = S.stack_matrix(df, ["a", "b"])
    assert "pivotfirst" not in _plan(out).lower()
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(0, 1, 1.0, 2.0, None), (0, 2, None, 3.0, None), (0, 3, 1.0, None, None)], key=str)


def test_prefix_ensembles_meet_once(spark):
    rows = [(m, 0, i % 2, i, float((i * 7) % 11 + 1), float((i * (k + 3)) % (7 + k)) + i / 100) for k, m in enumerate("abc") for i in range(20)]
    df = spark.createDataFrame(rows, "model string, iter int, fold int, id long, y double, pred double")
    got = {r.m: r.mean_gini for r in S.rank_average_select(df, ["b", "a", "c"]).collect()}
    for m in (1, 2, 3):
        ginis = []
        for f in (0, 1):
            score = {}
            for name in ["b", "a", "c"][:m]:
                ranked = sorted((p, i) for mm, _, ff, i, _, p in rows if mm == name and ff == f)
                for r, (_, i) in enumerate(ranked):
                    score.setdefault(i, []).append(r + 1)
            e = [(i, y, sum(score[i]) / m) for mm, _, ff, i, y, _ in rows if mm == "a" and ff == f]
            part = lambda o: len(o) / 2 - sum((k + 1) * y for k, (_, y, _) in enumerate(o)) / sum(y for _, y, _ in o)
            ginis.append(part(sorted(e, key=lambda r: (r[2], r[0]))) / part(sorted(e, key=lambda r: (r[1], r[0]))))
        assert abs(got[m] - sum(ginis) / 2) < 1e-9
