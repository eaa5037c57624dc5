import random
import re

import numpy as np
import xxhash

from tabwright.llm import exact_dedup
from tabwright.llm import simhash_dedup as S
from tabwright.llm.common import read


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_groups(fps, radius=2):
    ids = sorted(fps)
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints_and_groups_of_a_whole_table(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    want = {r.doc_id: brute_fp(r.text) for r in docs.collect()}
    got = {r.doc_id: r for r in S.simhash_digest(docs).collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == want
    assert {i: r.component_id for i, r in got.items()} == brute_groups(want)


def test_awkward_rows(spark, docs):
    texts = [None, "", "  \t", "One", "one", "a b", "A  B\n", "x y z w", "x y z w", "Ä b c", "ä b c"]
    out = {r.doc_id: (r.fingerprint, r.component_id) for r in S.simhash_digest(docs(texts, extra=True)).collect()}
    assert {i: int(f, 16) for i, (f, _) in out.items()} == {i: brute_fp(t) for i, t in enumerate(texts)}
    assert out[0][1] == out[1][1] == out[2][1] == 0 and out[4][1] == 3 and out[6][1] == 5 and out[8][1] == 7
    assert S.simhash_digest(docs(texts).limit(0)).count() == 0


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "other words here")],
                               "doc_id long, text string")
    rows = S.simhash_groups(df).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in rows if r.component_id is not None) == [(False, 3)] * 2 + [(True, 3)] * 2
    assert sum(r.component_id is None for r in rows) == 1


def test_dedup_keeps_one_row_of_each_component(spark):
    x, y, z = "red fish swims far", "blue bird sings at dawn", "old trees fall in storms"
    rows = [(5, x, "x5"), (9, x, "x9"), (2, y, "y2"), (5, y, "y5"), (7, z, "z7"), (7, z, "z7"), (8, z, "z8"), (5, "one more text here", "o5"),
            (None, "nobody knows this one", "n"), (None, "nobody knows this one", "n"), (None, x, "nx"), (1, None, "e1"), (1, "", "e1"), (4, " ", "e4")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    want = ["e1", "n", "o5", "x5", "y2", "z7"]
    assert sorted(r.tag for r in S.simhash_dedup(df).collect()) == want
    assert sorted(r.tag for r in exact_dedup.exact_dedup(df).collect()) == sorted([*want, "e4"])
    assert S.simhash_dedup(df.limit(0)).columns == df.columns and S.simhash_dedup(df.limit(0)).count() == 0


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(random.Random(1).choices(["aa", "b", "Cc", "ddd"], k=5000))
    monkeypatch.setattr(S, "_PIECE", 37)
    assert S.fingerprint(text.encode()) == brute_fp(text)


def test_trees_find_what_all_pairs_find_even_in_hot_buckets(spark):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2 ** 63))
    fps = {base ^ sum(1 << int(b) for b in rng.choice(30, rng.integers(0, 6), replace=False)) for _ in range(400)}
    fps |= {int(x) for x in rng.integers(0, 2 ** 63, 100)}
    fps |= {base ^ (1 << 63), 0, (1 << 64) - 1, (1 << 64) - 2}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    from tabwright.llm.components import components
    for shard in (16, 4096):
        edges = S.links(classes, 2, shard)
        for e in edges.collect():
            assert e.u != e.v
        labels = {r.node: r.label for r in components(edges).collect()}
        want = brute_groups({s: s & (2 ** 64 - 1) for s in signed})
        assert {s: labels.get(s, s) for s in signed} == want


def test_masks_leave_room_for_every_flip():
    for radius in (0, 1, 2, 3, 6):
        masks = [m & (2 ** 64 - 1) for m in S.block_masks(radius)]
        rng = random.Random(radius)
        for _ in range(200):
            flip = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(m & flip == 0 for m in masks)
