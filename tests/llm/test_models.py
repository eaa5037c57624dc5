"""Quality classifier, packing and the pipeline: held-out accuracy, exact round trips, brute force."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabwright.llm import exact_dedup, packing, quality_gam, simhash_dedup
from tabwright.llm.common import read

SMALL = "/root/testdata/sf0.001"


def test_quality_on_held_out_rows(spark):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    rows = {r.doc_id: r for r in quality_gam.quality_digest(docs, labels).collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [(rows[r.doc_id].predicted, r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) >= 0.95


def test_quality_never_learns_from_held_out_labels(spark):
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    lies = labels.withColumn("quality", F.when(quality_gam.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda x: sorted((r.doc_id, r.score) for r in quality_gam.quality_digest(docs, x).collect())
    assert score(labels) == score(lies)


def test_quality_awkward_rows(spark, docs):
    texts = [None, "", " \n", "word " * 50, "!!! ### $$$ " * 40, "word " * 50, "x" * 30000]
    labels = spark.createDataFrame([(3, 1, 0), (3, None, 0), (4, 0, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    table = docs(texts, extra=True).withColumn("score", F.lit("mine"))
    rows = {r.doc_id: r for r in quality_gam.quality_digest(table, labels).collect()}
    assert len(rows) == len(texts) and rows[3].score == rows[5].score and rows[0].score == rows[1].score
    assert all(r.score == 1 for r in quality_gam.quality_digest(table, labels.limit(0)).collect())
    assert quality_gam.quality_filter(table, labels.limit(0)).columns == table.columns
    assert quality_gam.quality_digest(table.limit(0), labels).count() == 0


def test_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.PairwiseGam(rounds=20).fit(x[:3000], y[:3000])
    assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.95


def test_features_do_not_depend_on_pieces(monkeypatch):
    text = ("Some words, and MORE!\n" * 400).encode()
    whole = quality_gam.text_features(text)
    monkeypatch.setattr(quality_gam, "_PIECE", 500)
    cut = quality_gam.text_features(text)
    i = quality_gam.FEATURES.index("top_word")
    assert len(whole) == len(quality_gam.FEATURES) and whole[i] == cut[i]


def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [[*e.ids, 0] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_pieces(rows, ids):
    seen, places = defaultdict(int), defaultdict(list)
    for r in rows:
        want = np.array(ids[r.doc_id], "<u4")
        assert r.doc_tokens == len(want) and r.ids_crc32 == zlib.crc32(want[r.start:r.start + r.length].tobytes()) and r.length > 0
        seen[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return seen, places


def test_packing_round_trip(spark):
    docs = read(spark, SMALL, "documents")
    table = docs.collect()
    ids = dict(zip([r.doc_id for r in table], reference_ids([r.text for r in table])))
    seen, places = check_pieces(packing.pack(docs).collect(), ids)
    assert seen == {i: len(x) for i, x in ids.items()}
    total = sum(map(len, ids.values()))
    assert len(places) <= -(-total // 1024) * 1.02 + 1


def test_packing_awkward_rows(spark, docs):
    texts = [None, "", "a", "a", "<|endoftext|> x", "  two  spaces \n\n and\ttabs ", "é中 " * 3000, "w" * 5000, "b " * 1023, "b " * 1024]
    ids = dict(enumerate(reference_ids(texts)))
    seen, _ = check_pieces(packing.pack(docs(texts, extra=True)).collect(), ids)
    assert seen == {i: len(x) for i, x in ids.items()}
    assert packing.pack(docs(texts).limit(0)).count() == 0


def test_segments_of_a_long_text_encode_alike(monkeypatch):
    encode = packing.encoder()
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(["a", "b", " ", "  ", "\n", "\t", "'s", "é", "1", "!", "中", "\r\n", " \n"], 60)) for _ in range(500)]
    monkeypatch.setattr(packing, "_SEGMENT", 7)
    assert [np.frombuffer(b"".join(encode(t)), "<u4").tolist() for t in texts] == [x[:-1] for x in reference_ids(texts)]


@pytest.mark.parametrize("seed", range(4))
def test_column_generation(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 65), 20, replace=False))
    demand = rng.integers(1, 200, 20)
    bins = packing.pack_lengths(lengths, demand, 64)
    used = defaultdict(int)
    for pattern, n in bins:
        assert sum(size * k for size, k in pattern.items()) <= 64
        for size, k in pattern.items():
            used[size] += k * n
    assert dict(used) == dict(zip(lengths.tolist(), demand.tolist()))
    pool = np.diag(64 // lengths)
    _, x, bound = packing.solve_patterns(lengths, demand.astype(float), 64, pool, 1e-6)
    assert bound <= sum(n for _, n in bins) <= x.sum() + 20 and x.sum() <= bound * 1.01 + 1


def test_pipeline_stages_against_plain_python(spark):
    docs = read(spark, SMALL, "documents")
    table = docs
    kept = corpus_pipeline.quality_stage(spark, table, SMALL)
    good = {r.doc_id for r in quality_gam.quality_digest(docs, read(spark, SMALL, "labels")).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == good and tuple(kept.columns) == corpus_pipeline.COLUMNS
    groups = {r.doc_id: r.kept for r in exact_dedup.exact_groups(kept).collect()}
    exact = corpus_pipeline.exact_stage(spark, kept, SMALL)
    assert {r.doc_id for r in exact.collect()} == {i for i, k in groups.items() if k}
    comps = {r.doc_id: r.component_id for r in simhash_dedup.simhash_groups(exact).collect()}
    near = corpus_pipeline.simhash_stage(spark, exact, SMALL)
    assert {r.doc_id for r in near.collect()} == set(comps.values()) and near.count() == len(set(comps.values()))


def test_pipeline_runs_whole(spark):
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    assert pieces and [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup", "mixing sources", "packing"]
    table = {r.doc_id: r.text for r in read(spark, SMALL, "documents").collect()}
    ids = dict(zip(table, reference_ids(list(table.values()))))
    check_pieces(pieces, ids)
