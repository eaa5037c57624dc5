"""The Merkle manifest against a plain level-by-level tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tabwright.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    """(left, right) a level."""
    out = []
    for nodes in tree[:-1]:
        run = i // 3 * 3
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 3])))
        i //= 3
    return out


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars) in any order; digest rows by position in ``rows``."""
    def leaf(r, text):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)])

    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r, leaf(r, r[1])))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in by:
        by[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {s: levels([d for _, d in by[s]]) for s in by}
    crown = levels([trees[s][-1][0] for s in order])
    out = []
    for s in by:
        for i, (r, d) in enumerate(by[s]):
            steps = siblings(trees[s], i) + siblings(crown, order.index(s))
            bad = r[1] is not None and zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 2 == 0
            x = leaf(r, r[1].replace("\n", "")) if bad else d
            for a, b in steps:
                x = h(a, x, b)
            out.append((r[0], d, trees[s][-1][0], crown[-1][0], h("".join(a + b for a, b in steps)), x, x == crown[-1][0]))
    return sorted(out, key=repr)


def digest(df, **options):
    return sorted((tuple(r) for r in merkle.manifest_digest(df, **options).collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, merkle.HEIGHT])
def test_manifest(spark, docs, height):
    texts = [None, "", "a\nb", "plain", "\n", "é\n中" * 50, "Long.\n" * 3000] + [f"text {i}\n{i % 3}" for i in range(60)]
    rows = [(i, t, None if i % 9 == 4 else "en", [None, "", "a", "é", "n", "a", "a"][i % 7], None if i % 5 == 0 else i) for i, t in enumerate(texts)]
    rows += [(None, "x\ny", "en", None, 1), (7, texts[7], "en", "n", 7), (7, texts[7], "en", "n", 7), (1000, "alone", "en", "z", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = digest(df.selectExpr("*", "1 AS position", "'x' AS leaf", "'y' AS _pos", "'z' AS witness"), height=height)
    assert got == brute(rows) and any(not r[-1] for r in got) and any(r[-1] for r in got)
    assert digest(df.limit(0), height=height) == []
    one = df.filter("doc_id = 1000")
    assert digest(one, height=height) == brute([rows[-1]])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 27, 28, 81, 100])
def test_incremental_witnesses(n):
    nodes = [h(str(i)) for i in range(n)]
    tree, want = merkle.Witnesses(), levels(nodes)
    for i, node in enumerate(nodes):
        tree.append(node)
        done = (i + 1) // 3 * 3  # what lies in full runs has its first step already
        assert all(len(p) > 0 for p in tree.paths[:done])
    assert tree.root() == want[-1][0]
    for i, path in enumerate(tree.paths):
        assert [tuple(s.split("*")) for s in path] == siblings(want, i)


def test_witness_folds_to_the_root(spark, docs):
    df = merkle.manifest(docs([f"t{i}" for i in range(40)]), carry={"text": F.col("text")}, height=2)
    rows = df.withColumn("back", merkle.fold(F.col("leaf"), F.col("witness"))).collect()
    assert len(rows) == 40 and all(r.back == r.root for r in rows) and {r.text for r in rows} == {f"t{i}" for i in range(40)}
