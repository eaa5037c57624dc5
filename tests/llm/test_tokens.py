"""BPE tree codec and token alignment against the libraries and plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tabwright.llm import bpe_tree, token_align

PIECES = [*" '\n\ta1é,lLsre.中　 \x1c\x85dtvm2▁\x00́", "'ll", "'re", "  ", "\n\n", "word", "中文字", "<|endoftext|>", "<s>", "<0x41>", "▁x", "🙂"]
FIXED = [None, "", " ", "\n", " a", "a b  c ", "Long words. " * 900, "x" * 3000, "中" * 2000, " " * 1500, "ab1" * 800, "same", "same", "▁", "a▁b", "a b", "naïve café\n\n  x"]


def mixed(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(1, 70))) for _ in range(n)]


def test_joined_halves_are_the_whole():
    c = bpe_tree.codec()
    whole, rng = c.plain, random.Random(1)
    for text in [*mixed(3000, 2), *[t or "" for t in FIXED]]:
        c = bpe_tree.Codec.__new__(bpe_tree.Codec)
        c.__dict__ = {**bpe_tree.codec().__dict__, "leaf": rng.choice([1, 2, 3, 7, 40])}
        ids = c.encode(text)
        assert ids.tolist() == whole(text) and c.decode(ids) == text.encode()


def test_seam_window_is_local(monkeypatch):
    c, seen = bpe_tree.codec(), []
    left, right = "some words here, " * 500, "and 12 more of them. " * 500
    a, b = c.encode(left), c.encode(right)
    real = c.plain
    monkeypatch.setattr(c, "plain", lambda t: seen.append(t) or real(t))
    assert c.join(left, a, right, b).tolist() == real(left + right) and len("".join(seen)) < 40


@pytest.mark.parametrize("part", [11, bpe_tree.PART])
def test_codec_rows(spark, docs, part):
    texts = [*FIXED, *mixed(60, 3)]
    df = docs(texts, extra=True)
    got = {r.doc_id: r for r in bpe_tree.decode(bpe_tree.encode(df, part=part)).collect()}
    plain = bpe_tree.codec().plain
    for i, t in enumerate(texts):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == plain(t or "") and bytes(got[i].bytes) == (t or "").encode()
    assert len(got) == len(texts)
    twice = spark.createDataFrame([(None, "ab " * 20)] * 3 + [(5, None)], "doc_id long, text string")
    assert sorted(len(r.ids) for r in bpe_tree.encode(twice, part=part).collect())[1:] == [4 * len(plain("ab " * 20))] * 3
    assert bpe_tree.codec_digest(df.limit(0)).count() == 0


def test_codec_digest(spark, docs):
    for r in bpe_tree.codec_digest(docs(FIXED)).collect():
        ids = bpe_tree.codec().plain(FIXED[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((FIXED[r.doc_id] or "").encode()).hexdigest())


def test_gallop():
    rng = np.random.default_rng(4)
    for n, m in ((0, 5), (1, 1), (40, 2000), (300, 310)):
        long = np.unique(rng.integers(0, 5000, m))
        short = np.unique(rng.integers(0, long[-1] + 1, n))
        want = np.searchsorted(long, short)
        assert (token_align.gallop(short, long) == want).all()
        assert (token_align.gallop(short, long, np.maximum(want - rng.integers(0, 9, len(want)), 0)) == want).all()


def brute(texts):
    """The contract read literally, with the named tokenizers."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    plain = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
    a_bytes = {i: bytes(byte[c] for c in k) for k, i in a_model.get_vocab(with_added_tokens=False).items()}

    def b_bytes(i):
        p = b_model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()

    rows, held, links_of = [], Counter(), []
    for text in texts:
        a, b = (a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)) if text else ([], [])
        sizes = [[len(a_bytes[i]) for i in a], [len(b_bytes(i)) for i in b]]
        if not b"".join(a_bytes[i] for i in a) == b"".join(map(b_bytes, b)) == (" " + text if text else "").encode():
            a, b, sizes = [], [], [[], []]
        ends = [np.cumsum(s).tolist() if s else [] for s in sizes]
        spans = [list(zip([0, *e], e)) for e in ends]
        links = [(x, y) for x, (s, e) in zip(a, spans[0]) for y, (u, v) in zip(b, spans[1]) if s < v and u < e]
        groups, lo = [], 0
        for hi in sorted(set(ends[0]) & set(ends[1])):
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, es) if lo < e <= hi) for ids, es in ((a, ends[0]), (b, ends[1]))))
            lo = hi
        rows.append([len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
        links_of.append(links)
        held.update(set(links))
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [(*r[:4], sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), r[4]) for r, links in zip(rows, links_of)]


@pytest.mark.parametrize("block,piece,words", [(token_align.BLOCK, token_align.SLICE, token_align.WORDS), (500, 40, 30)])
def test_alignment(spark, docs, monkeypatch, block, piece, words):
    texts = [t if len(t or "") < 400 else t[:400] for t in FIXED] + mixed(120, 5)
    if block == 500:  # the tasks see the module as the driver has it only through the closure
        rows = run_blocks(texts, block, piece, words)
    else:
        rows = {r.doc_id: tuple(r)[1:] for r in token_align.align_digest(docs(texts, extra=True)).collect()}
        assert [rows[i] for i in range(len(texts))] == brute(texts)
        twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
        assert sorted(r.count_sum for r in token_align.align_digest(twice).collect()) == [0, 4, 4]
        assert token_align.align_digest(docs(texts).limit(0)).count() == 0
        return
    want = brute(texts)
    assert [r[:4] for r in rows] == [w[:4] for w in want] and [r[4] for r in rows] == [w[6] for w in want]


def run_blocks(texts, block, piece, words):
    """Figures and hash of each text from blocks, slices and a word table that are all small."""
    old = token_align.SLICE, token_align.WORDS
    token_align.SLICE, token_align.WORDS = piece, words
    try:
        out = []
        for at in range(0, len(texts), 7):
            b = token_align.Block(token_align.tokenizer_pair())
            b.add([(i, t or "") for i, t in enumerate(texts[at:at + 7])])
            row = b.row(0)
            out += [(*(int(row[f][i]) for f in token_align.FIGURES), row["groups_sha256"][i]) for i in range(len(row["ids"]))]
        return out
    finally:
        token_align.SLICE, token_align.WORDS = old


def test_query_on_small_documents(spark):
    from tabwright.llm.common import read
    df = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in df.collect()}
    got = {r.doc_id: tuple(r)[1:] for r in token_align.align_digest(df).collect()}
    short = sorted(texts)
    cut = {i: (texts[i] or "")[:600] for i in short}
    again = {r.doc_id: tuple(r)[1:] for r in token_align.align_digest(spark.createDataFrame(sorted(cut.items()), "doc_id long, text string")).collect()}
    assert [again[i] for i in short] == brute([cut[i] for i in short])
    assert len(got) == len(texts) and all(got[i][0] > 0 for i in short if texts[i] and "▁" not in texts[i])
