import hashlib
from collections import Counter

import numpy as np

from tabwright.llm import suffix_dedup as X
from tabwright.llm.common import read


def brute(texts, size=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - size + 1):
            if seen[d[i:i + size]] > 1:
                gone[i:i + size] = True
        spans = int(np.sum(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_whole_small_table_against_every_window(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.collect()
    want = {r.doc_id: w for r, w in zip(rows, brute([r.text for r in rows]))}
    got = {r[0]: tuple(r[1:]) for r in X.suffix_digest(docs).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 0


def awkward(seed=3):
    rng = np.random.default_rng(seed)
    word = lambda n: "".join(rng.choice(list("abcdefgh é\n"), n))
    shared, other = word(260), word(199)
    texts = [None, "", "a" * 199, "a" * 200, "a" * 201, "b" * 200, "ab" * 300, "xyz" * 150 + word(90)]
    texts += [word(50) + shared + word(70) for _ in range(30)] + [shared[:230] + word(9) for _ in range(5)]
    texts += [word(300) + other + word(20), other + word(400), word(800) * 2]
    copy = word(500)
    return texts + [copy, copy, copy[:250] + "!" + copy[250:], copy[:210] + word(10) + copy[300:]]


def test_awkward_rows_and_hot_buckets(spark, docs):
    texts = awkward()
    want = brute(texts)
    table = docs(texts, extra=True)
    for hot in (3, 2048):
        got = {r[0]: tuple(r[1:5]) for r in X.cut_repeats(table, hot=hot).collect()}
        assert [got[i] for i in range(len(texts))] == want
    assert X.suffix_digest(table.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    a, b = "p" * 150 + "q" * 150, "r" * 20 + "s" * 260
    df = spark.createDataFrame([(None, a), (None, b), (1, a), (1, a), (1, b + "t" * 10)], "doc_id long, text string")
    got = sorted((tuple(r) for r in X.suffix_digest(df).collect()), key=repr)
    want = sorted(((i, *w) for i, w in zip([None, None, 1, 1, 1], brute([a, b, a, a, b + "t" * 10]))), key=repr)
    assert got == want


def test_lists_grow_with_the_rows_that_repeat(spark):
    """Runs a row do not depend on how many rows repeat it, and neither do the contexts that are moved."""
    text = " ".join(f"word{i * i % 977} and {i}" for i in range(400))
    found = {}
    for k in (20, 60):
        df = spark.createDataFrame([(None, text)] * k + [(1, text[:900] + "?" + text[901:])], "doc_id long, text string")
        rows = X.repeats(df).selectExpr("coalesce(id, 0) AS id", "size(runs) AS n").collect()
        found[k] = {r.id: r.n for r in rows}
        assert len(rows) == k + 1
    assert found[20] == found[60]


def test_pieces_of_a_long_text(monkeypatch):
    monkeypatch.setattr(X, "_PIECE", 97)
    data = awkward()[7].encode() * 3
    runs = [(int(k), int(s), int(n)) for key, start, count, _ in X.segments(data) for k, s, n in zip(key, start, count)]
    assert sum(n for _, _, n in runs) == len(data) - 199
    keys = {s + j: k for k, s, n in runs for j in range(n)}
    by = {}
    for i in range(len(data) - 199):
        assert by.setdefault(data[i:i + 200], keys[i]) == keys[i]


def test_cover_has_every_difference():
    for period in (7, 31, 40):
        cover = X.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period)) and len(cover) ** 2 < 4 * period
