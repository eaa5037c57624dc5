"""Exact dedup, sharding, chat, URL rules and mixing against plain Python."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from tabwright.llm import chat, exact_dedup, mixing, sharding, url_filter

TEXTS = [None, "", " ", "\t\n", "a b", "a  b", "a\u00a0b", "a b ", "Long text. " * 2000, "Long text.\n" * 2000, "ä" * 9000, "a b"]


def test_exact_groups(spark, docs):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in TEXTS]
    rows = {r.doc_id: r for r in exact_dedup.exact_groups(docs(TEXTS, extra=True)).collect()}
    for i, n in enumerate(norm):
        group = [j for j, m in enumerate(norm) if m == n]
        r = rows[i]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (group[0], len(group), i == group[0], hashlib.sha256(n.encode()).hexdigest())
    kept = exact_dedup.exact_dedup(docs(TEXTS, extra=True))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({norm.index(n) for n in norm}) and "recipe" in kept.columns
    assert exact_dedup.exact_groups(docs(TEXTS).limit(0)).count() == 0


def test_chunks_concatenate_and_resynchronise(spark):
    base = " ".join(f"word{i * i} and, more." for i in range(4000))
    df = spark.createDataFrame([(base,), ("x" + base,), ("é" * 9999,), ("",)], "t string").select("t", exact_dedup.chunks(F.col("t")).alias("c"))
    got = [r for r in df.collect()]
    assert all("".join(r.c) == r.t for r in got) and max(len(x) for r in got for x in r.c) <= exact_dedup.MAX_CHARS
    assert len(set(got[0].c) & set(got[1].c)) > 0.9 * len(got[0].c)


def test_clashing_chunk_hashes_are_told_apart(spark, docs, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: real(F.lit(1)))  # every chunk clashes
    texts = ["one", "two", "one", "three. " * 200, "three. " * 200, "three. " * 199]
    rows = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(docs(texts)).collect()}
    assert rows == {0: 0, 1: 1, 2: 0, 3: 3, 4: 3, 5: 5}


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (2, "a"), (2, "a"), (None, "b"), (2, "c")], "doc_id long, text string")
    rows = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df).collect() if r.doc_id)
    assert rows == [(2, 2, 1, True), (2, 2, 4, True), (2, 2, 4, True)]


def jump(key, n):
    b, j, key = -1, 0, key & (2 ** 64 - 1)
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) & (2 ** 64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [0, 1, -1, 42, 2 ** 62, -(2 ** 63), 123456789] + [xxhash.xxh64_intdigest(struct.pack("<q", i)) - 2 ** 63 for i in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 100, 3000):
        got = {r.k: r.s for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert all(got[k] == jump(k, n) for k in keys)


def test_shards(spark, docs):
    df = docs(TEXTS, extra=True).drop("size", "shard").unionByName(docs(["same"]).limit(0), allowMissingColumns=True)
    rows = sharding.shard_digest(df).collect()
    slots = defaultdict(list)
    for r in rows:
        t = (TEXTS[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(t) + 1, zlib.crc32(t), "key") and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert len(rows) == len(TEXTS) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = spark.createDataFrame([(None, "x"), (None, "x"), (5, None)], "doc_id long, text string")
    assert sharding.shard_digest(again).count() == 3 and sharding.shard_digest(again.limit(0)).count() == 0


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, None, "x"), (2, 0, "system", "alone"),
            (None, None, "ann", "é"), (3, 9, "ann", "b"), (3, 9, "ann", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS position", "'z' AS piece", "0 AS _part")
    got = chat.perspectives(df).collect()
    whole = defaultdict(dict)
    for r in got:
        whole[r.conv_id, r.perspective][r.position] = r
    assert set(whole) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (3, "ann")}
    for (conv, who), parts in whole.items():
        text = "".join(parts[i].piece for i in range(len(parts)))
        for r in parts.values():
            assert text[r.start:].startswith(r.piece) and (r.mask_start is not None) == (r.speaker == who)
            if r.mask_start is not None:
                assert text[r.mask_start:r.mask_end].endswith("<|end|>\n") and r.mask_end == r.start + len(r.piece)
    text = "".join(whole[1, "bob"][i].piece for i in range(5))
    assert text == ("<|system|>\nbe kind<|end|>\n<|user name=ann|>\nhi < |end|><|end|>\n" + "<|assistant|>\n<|end|>\n" * 2
                    + "<|user name=unknown|>\nx<|end|>\n")
    assert chat.perspectives(df.limit(0)).count() == 0


def test_long_dialogue_in_blocks(spark, monkeypatch):
    df = spark.range(500).selectExpr("7 AS conv_id", "id AS turn", "IF(id % 2 = 0, 'a', 'b') AS role", "repeat('t', CAST(id % 7 AS int)) AS text")
    whole = sorted(tuple(r) for r in chat.perspectives(df).fillna(-1).collect())
    monkeypatch.setattr(chat, "MESSAGES_A_BLOCK", 11)
    assert sorted(tuple(r) for r in chat.perspectives(df).fillna(-1).collect()) == whole


def test_no_message_is_lost(spark):
    rows = [(1, None, "ann", "ok"), (1, None, "ann", "ok"), (1, None, "ann", "ok"), (1, 2, None, "x"), (1, 2, "unknown", "x"), (1, 3, "bob", None),
            (1, 3, "bob", ""), (1, 4, "bob", "a <| b")]
    got = chat.perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for who in ("ann", "bob", "unknown"):
        assert sorted(r.position for r in got if r.perspective == who) == list(range(8))


def test_dialogue_without_turns_is_spread(spark, monkeypatch):
    monkeypatch.setattr(chat, "MESSAGES_A_BLOCK", 50)
    df = spark.range(4000).selectExpr("CAST(NULL AS long) AS conv_id", "CAST(NULL AS long) AS turn", "IF(id % 3 = 0, 'a', 'b') AS role", "'ok' AS text")
    got = chat.perspectives(df)
    assert got.groupBy("perspective").count().collect() and sorted(r.position for r in got.filter("perspective = 'a'").collect()) == list(range(4000))
    whole = "".join(r.piece for r in sorted(got.filter("perspective = 'b'").collect(), key=lambda r: r.position))
    assert all(whole[r.start:].startswith(r.piece) for r in got.filter("perspective = 'b'").orderBy("start").limit(300).collect())


def test_url_parts_and_rules(spark):
    urls = {"http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"), "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
            "x://net": ("net", "", None, "allow"), "http://notnet/": ("notnet", "/", None, "allow"), "http://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
            "http://www.example.com/de/a://b": ("www.example.com", "/de/a://b", "example.com/de/", "block"), "no url": ("", "", None, "allow"), None: ("", "", None, "allow"),
            "": ("", "", None, "allow"), "http://h?x=://net/": ("h", "", None, "allow"), "http://h#/": ("h", "", None, "allow"), "://É.ORG/fr/": ("É.org", "/fr/", "org/fr/", "allow")}
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string").selectExpr("*", "'x' AS host", "0 AS trust")
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(df).collect()}
    assert [got[i] for i in range(len(urls))] == [v[:3] for v in urls.values()]
    ruled = {r.page_id: r.verdict for r in url_filter.judge(df).filter("rule IS NOT NULL").collect()}
    assert all(ruled[i] == v[3] for i, v in enumerate(urls.values()) if v[2])
    assert url_filter.judge(df.limit(0)).count() == 0


def brute_rank(edges, seeds, damping, tolerance):
    """The same walk on dictionaries, in whole units."""
    out = defaultdict(int)
    for (s, _), n in edges.items():
        out[s] += n
    base = {h: int(int(1e12 * w / sum(seeds.values())) * (1 - damping)) for h, w in seeds.items()}
    rank = dict(base)
    for _ in range(100):
        new = defaultdict(int, base)
        for (s, d), n in edges.items():
            new[d] += int(rank.get(s, 0) * (n / out[s]) * damping)
        moved = sum(abs(new.get(h, 0) - rank.get(h, 0)) for h in set(new) | set(rank))
        rank = dict(new)
        if moved <= tolerance * 1e12:
            break
    return rank


def test_propagation_blocks_who_links_to_blocked_hosts(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/p">x</a>' for h in hosts)
    pages = [("http://bad.net/", ""), ("http://farm.io/a", link("bad.net", "bad.net", "bad.net")), ("http://farm.io/b", link("bad.net")),
             ("http://news.org/fr/", link("friend.io", "friend.io")), ("http://friend.io/", link("news.org")), ("http://far.io/", link("farm.io")), ("http://quiet.io/", "")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    rows = {r.host: r for r in url_filter.judge(df, tolerance=1e-4).collect()}
    assert {h: r.verdict for h, r in rows.items()} == {
        "bad.net": "block", "farm.io": "block", "far.io": "block", "news.org": "allow", "friend.io": "allow", "quiet.io": "allow"}
    trust = brute_rank({("farm.io", "bad.net"): 4, ("news.org", "friend.io"): 2, ("friend.io", "news.org"): 1, ("far.io", "farm.io"): 1}, {"news.org": 1}, 0.8, 1e-4)
    assert abs(rows["news.org"].trust - trust["news.org"]) < 1e9 and abs(rows["friend.io"].trust - trust["friend.io"]) < 1e9


def test_propagation_does_not_depend_on_the_number_of_seeds(spark):
    pages = [(f"http://s{i}.net/", "") for i in range(40)] + [(f"http://t{i}.org/fr/", "") for i in range(40)]
    chain = ["s0.net", "a.io", "b.io", "c.io", "d.io", "e.io"]
    pages += [(f"http://{h}/", f'<a href="http://{to}/">x</a>') for to, h in zip(chain, chain[1:])]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    rows = {r.host: r for r in url_filter.judge(df).collect()}
    assert all(rows[h].verdict == "block" and abs(rows[h].distrust / (0.2 * 1e12 / 40 * 0.8 ** i) - 1) < 1e-8 for i, h in enumerate(chain))
    # a seed that holds 1e-20 of its kind's mass still marks the hosts behind it
    seeds = spark.createDataFrame([("distrust", "big", 1e20), ("distrust", "s", 1.0)], "kind string, host string, weight double")
    edges = spark.createDataFrame([("distrust", "s", "a", 1), ("distrust", "a", "b", 1)], "kind string, src string, dst string, links long")
    mass = {r.host: r.mass for r in url_filter.propagate(edges, seeds).collect()}
    assert abs(mass["b"] / mass["s"] - 0.64) < 1e-9


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = goal - sum(fixed.values())
        level = {s: left * w[s] / sum(w[f] for f in free) for s in free}
        over = [s for s in free if level[s] > most * sizes[s]]
        if not over:
            return {**fixed, **level}
        fixed |= {s: most * sizes[s] for s in over}


def test_mixing(spark, docs):
    texts = ["w " * (1 + i * 7 % 83) for i in range(300)] + [None, "", "z " * 3000]
    df = docs(texts, sources=["b", "a", None, "é", "Z", "c", "a"], extra=True)
    rows = mixing.mix(df).collect()
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")) and r.taken == r.size * r.copies and 0 <= r.copies <= 2
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = brute_targets(size)
    assert all(abs(target[s] - want[s]) < 1e-6 for s in want)
    assert all(abs(taken[s] - want[s]) <= 0.03 * want[s] + 20 for s in want)
    assert sorted((r.doc_id, r.taken) for r in mixing.mix(df).collect()) == sorted((r.doc_id, r.taken) for r in rows)
    assert mixing.mixed_rows(df).count() == sum(r.copies for r in rows) and mixing.mix(df.limit(0)).count() == 0


def pareto(docs, target):
    """The rule on a list of (id, text, number, words) of one source: rows of copies, by the definition."""
    size = sum(w for *_, w in docs)
    rate = min(2.0, target / size)
    copies, p = int(rate), rate - int(rate)

    def u(i, x, k):
        h = hashlib.md5(f"mix:{'' if i is None else i}:{x}:{k}".encode()).hexdigest()[:12]
        return (int(h, 16) + 0.5) / 2 ** 48

    order = sorted(range(len(docs)), key=lambda n: ((q := u(*docs[n][:3])) / (1 - q) * (1 - p) / p if p else float("inf"), docs[n][0] or 0))
    more = set()
    while True:
        gap = target - sum(w * (copies + (n in more)) for n, (*_, w) in enumerate(docs))
        fit = [n for n in order if n not in more and copies < 2 and 0 < docs[n][3] <= gap]
        if not fit:
            return [copies + (n in more) for n in range(len(docs))]
        run = 0
        for n in fit:
            if run + docs[n][3] <= gap:
                more.add(n)
            run += docs[n][3]


def test_mixing_is_pareto_order_sampling(spark, docs):
    texts = ["w " * (1 + i * 7 % 83) for i in range(200)] + ["z " * 900, "y " * 5]
    df = docs(texts, sources=["a", "b"])
    hashed = {r.doc_id: r.x for r in df.select("doc_id", F.xxhash64("text").alias("x")).collect()}
    rows = sorted(mixing.mix(df).collect())
    for source in ("a", "b"):
        mine = [r for r in rows if r.source == source]
        want = pareto([(r.doc_id, hashed[r.doc_id], 0, r.size) for r in mine], mine[0].target)
        assert [r.copies for r in mine] == want


def test_sources_of_null_and_repeated_ids_reach_their_target(spark):
    rows = [(None, "w " * 10, "z") for _ in range(1000)] + [(i % 50, "v " * 10, "b") for i in range(1000)]
    rows += [(None, "u " * (1 + i % 19), "c") for i in range(1000)] + [(i, "t " * 10, "a") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix(df).collect()
    taken, target = defaultdict(int), {}
    for r in plan:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(plan) == 4000 and all(0 <= target[s] - taken[s] < 10 for s in target)
    assert sorted(map(repr, mixing.mix(df).collect())) == sorted(map(repr, plan))
    kept = Counter(r.source for r in mixing.mixed_rows(df.withColumn("_copies", F.lit("mine")).withColumn("_size", F.lit(3))).collect())
    assert all(kept[s] == sum(r.copies for r in plan if r.source == s) for s in target)
    mine = mixing.mixed_rows(df.withColumn("_k", F.monotonically_increasing_id()).withColumn("_row", F.lit("v"))).select("_k", "_row")
    assert mine.filter("_row <> 'v'").isEmpty() and mine.groupBy("_k").count().filter("count > 2").isEmpty()


def test_mixing_prefers_and_handles_repeated_rows(spark):
    df = spark.createDataFrame([(i % 40, "w " * 10, "s", float(1 + i % 2)) for i in range(80)], "doc_id long, text string, source string, p double")
    rows = mixing.mix(df, prefer=F.col("p"), share=0.5).collect()
    by = defaultdict(int)
    for r in rows:
        by[r.doc_id % 2] += r.copies
    assert len(rows) == 80 and abs(sum(r.taken for r in rows) - 400) < 10 and by[1] > by[0]


def test_mixing_turns_do_not_materialise_all_rows_again(spark, docs, monkeypatch):
    """Sizes of a wide range need many turns; each reads what may still be taken, and its plan carries nothing of the last one's."""
    texts = ["w " * int(1.06 ** (i % 120)) for i in range(360)]
    df = docs(texts, sources=["a", "b"])
    hashed = {r.doc_id: r.x for r in df.select("doc_id", F.xxhash64("text").alias("x")).collect()}
    kept, whole = mixing.materialise, []

    def seen(frame):
        if "_q" in frame.columns:
            whole.append(frame)
        return kept(frame)

    monkeypatch.setattr(mixing, "materialise", seen)
    rows = sorted(mixing.mix(df).collect())
    for source in ("a", "b"):
        mine = [r for r in rows if r.source == source]
        assert [r.copies for r in mine] == pareto([(r.doc_id, hashed[r.doc_id], 0, r.size) for r in mine], mine[0].target)
    assert len(rows) == 360 and len(whole) == 1
