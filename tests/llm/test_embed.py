import numpy as np

from tabwright.llm import embed_dedup as E
from tabwright.llm.common import read


def brute(rows, cosine=0.95):
    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ids = [i for i, v in rows]
    vec = [np.array(v, float) if fine(v) else None for _, v in rows]
    up, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in range(len(rows)):
        for b in range(a):
            x, y = vec[a], vec[b]
            if x is not None and y is not None and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                up[p] = q
    low = {}
    for a in range(len(rows)):
        low[find(a)] = min(low.get(find(a), ids[a]), ids[a])
    return sorted((ids[a], links[a], low[find(a)], ids[a] == low[find(a)]) for a in range(len(rows)))


def test_whole_small_table_against_all_pairs(spark):
    table = read(spark, "/root/testdata/sf0.01", "embeddings")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()])
    for block in (37, 2048):
        assert sorted(tuple(r) for r in E.embedding_groups(table, block_rows=block).collect()) == want


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0, 0.0]), (7, [2.0, 0.0]),
            (8, [1.0, 0.0]), (9, [1.0]), (10, [1.0, 0.2]), (11, [1e-30, 0.0]), (12, [-1.0, 0.0]), (13, [3e38, 3e37])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS node", "1 AS n")
    assert sorted(tuple(r) for r in E.embedding_groups(df).collect()) == brute(rows)
    assert E.embedding_groups(df.limit(0)).count() == 0
    assert E.embedding_groups(df.filter("vec_id < 3")).count() == 3


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.16).tolist()) for i in range(150)] + [(150 + i, rng.normal(size=16).tolist()) for i in range(60)]
    rows += [(300 + i, rows[0][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in E.embedding_groups(df, block_rows=32).collect()) == brute(rows)
