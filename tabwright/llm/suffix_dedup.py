"""Suffix-array dedup: remove every byte covered by a 200-byte string that also starts elsewhere.

The suffixes (to depth ``size``) are sorted bucket by bucket, with a difference cover to
settle long ties, so that memory is bounded by a batch of buckets:

1. Bucket key.  The key of a suffix is the smallest hash of the ``GRAM``-byte strings in its
   first ``size`` bytes.  Equal suffixes have equal keys, and neighbouring suffixes share
   one: a run of suffixes around one anchor (at most size - GRAM + 1) is a segment.  One
   Arrow pass emits a row per segment, about one per 85 bytes, never one per suffix.
2. Keys that occur once are settled.  Keys whose segments all have one content (interiors
   of copies and shared passages) are repeated whole.  Only for the others does text move:
   one context per different content, at most 2 * size bytes.
3. Blockwise sort.  A task takes its buckets batch by batch.  Sample positions, those whose
   distance to the anchor is in a difference cover modulo ``PERIOD``, are ranked to depth
   size - PERIOD by doubling.  Then each bucket's suffixes are sorted by their first PERIOD
   bytes, ties by the rank of the sample position that the cover gives, and what is still
   tied by the last PERIOD bytes.  Contexts are laid out by their anchor, so equal suffixes
   have equal residues.  Equal classes with two members are repeated strings.
4. A bucket of more than ``hot`` different contexts (a passage that a large part of all
   documents share, at its edges) is not given to one task: its suffixes are grouped by a
   128-bit digest of their ``size`` bytes, with partial aggregation.  Nothing is capped.
5. The repeated runs return to their documents, which are cut.

Defined results: a null text counts as empty; texts under ``size`` bytes lose nothing;
repeated rows are copies of each other; rows that share an id but not the text are kept
apart; matches never cross rows; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, materialise, prefixed, same, with_group_values

SIZE, GRAM, PERIOD, HOT = 200, 32, 40, 2048
_PIECE = 1 << 20  # suffixes of one text hashed at a time


def difference_cover(period: int) -> list[int]:
    """Residues such that every difference modulo ``period`` is one between two of them (greedy)."""
    cover, missing = [0], set(range(1, period))
    while missing:
        def gain(x: int) -> int:
            return len(missing & {d for c in cover for d in ((x - c) % period, (c - x) % period)})
        x = max((x for x in range(period) if x not in cover), key=lambda x: (gain(x), -x))
        missing -= {d for c in cover for d in ((x - c) % period, (c - x) % period)}
        cover.append(x)
    return sorted(cover)


COVER = difference_cover(PERIOD)
_TO_SAMPLE = np.array([next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER) for r in range(PERIOD)])


def _words(data: bytes, order: str) -> np.ndarray:
    """The 8-byte word that starts at each position."""
    return np.ndarray((max(len(data) - 7, 0),), order + "u8", buffer=data, strides=(1,))


def gram_hashes(data: bytes) -> np.ndarray:
    """A mixed hash of the GRAM bytes at each position."""
    w, n = _words(data, "<"), len(data) - GRAM + 1
    h = np.zeros(n, np.uint64)
    for k, odd in zip(range(0, GRAM, 8), (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        h += w[k:k + n] * np.uint64(odd)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    return np.minimum(h[:len(h) - (width - reach)], h[width - reach:]) if width > reach else h


def segments(data: bytes, size: int = SIZE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, start, suffixes, anchor) of each run of suffixes with one leftmost anchor, piece by piece."""
    width = size - GRAM + 1
    for at in range(0, max(len(data) - size + 1, 0), _PIECE):
        piece = data[at:at + _PIECE + size - 1]
        h = gram_hashes(piece)
        key = _window_min(h, width)
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (h[:len(key) - 1] == key[:-1])))
        start = np.flatnonzero(new)
        last = np.concatenate((start[1:], [len(key)])) - 1
        yield key[start], start + at, last - start + 1, (h, last, at)


def _anchors(h: np.ndarray, last: np.ndarray, key: np.ndarray, width: int) -> np.ndarray:
    """First position at or behind each run's last suffix that holds the key."""
    return last + (h[np.minimum(last[:, None] + np.arange(width), len(h) - 1)] == key[:, None]).argmax(axis=1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("x"), text.alias("text"))


def _segment_rows(keyed: DataFrame, size: int) -> DataFrame:
    """(m, c, id, x, at): bucket key, digest of the context, row key, start * 256 + suffixes."""
    kind = keyed.schema["id"].dataType
    schema = T.StructType([T.StructField("m", T.LongType()), T.StructField("c", T.LongType()), T.StructField("id", kind),
                           T.StructField("x", T.LongType()), T.StructField("at", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            ids, xs = b.column(0), b.column(1).to_numpy()
            for row in range(b.num_rows):
                data = b.column(2)[row].as_py()
                if len(data) < size:
                    continue
                for key, start, count, _ in segments(data, size):
                    ends = start + count + (size - 1)
                    c = np.array([digest(data[s:e]) for s, e in zip(start.tolist(), ends.tolist())], np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(c), pa.array([ids[row].as_py()] * len(c), ids.type),
                         pa.array(np.full(len(c), xs[row])), pa.array(start * 256 + count)], names=["m", "c", "id", "x", "at"])

    return keyed.filter(F.octet_length("text") >= size).mapInArrow(run, schema)


def _context_rows(keyed: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(m, c, before, suffixes, context): the text around one representative of each content."""
    lists = wanted.groupBy("id", "x").agg(F.collect_list(F.struct("at", "m", "c")).alias("list"))  # bounded by the text's own length
    lists = prefixed(lists, ["id", "x"])
    met = keyed.join(lists, same(keyed, lists, ["id", "x"])).select("text", "list", "id", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # of this task's rows; a row that repeats another would give the same contexts
        for b in batches:
            for row, key in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                if key in seen:
                    continue
                seen.add(key)
                data = b.column(0)[row].as_py()
                items = b.column(1)[row].values
                at, m, c = (items.field(k).to_numpy() for k in range(3))
                start, count = at >> 8, at & 255
                texts = [data[s:e] for s, e in zip(start.tolist(), (start + count + size - 1).tolist())]
                before = np.array([int(_anchors(gram_hashes(t), np.array([n - 1]), np.array([k], np.int64).view(np.uint64), size - GRAM + 1)[0])
                                   for t, n, k in zip(texts, count.tolist(), m.tolist())], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(c), pa.array(before), pa.array(count.astype(np.int32)),
                                                  pa.array(texts, pa.binary())], names=["m", "c", "before", "suffixes", "context"])

    return met.mapInArrow(run, "m long, c long, before int, suffixes int, context binary")


def _refine(cls: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Dense classes in the order of (cls, key)."""
    order = np.lexsort((key, cls))
    a, k = cls[order], key[order]
    new = np.concatenate(([0], (a[1:] != a[:-1]) | (k[1:] != k[:-1])))
    out = np.empty(len(cls), np.int64)
    out[order] = np.cumsum(new)
    return out


def repeated_suffixes(bucket: np.ndarray, before: np.ndarray, count: np.ndarray, contexts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """Per context, which of its first ``count`` suffixes equal another suffix of the same bucket to depth ``size``."""
    lead = -before % PERIOD  # puts every anchor at a multiple of the period
    room = lead + np.array([len(t) for t in contexts])
    room = -(-(room + 8) // PERIOD) * PERIOD
    base = np.cumsum(room) - room + lead
    text = bytearray(int(room.sum()))
    for at, t in zip(base.tolist(), contexts):
        text[at:at + len(t)] = t
    words = _words(bytes(text), ">")
    word = lambda at: words[at].astype(np.uint64)

    # 1. sample ranks to depth size - PERIOD, by doubling from PERIOD bytes
    depth = size - PERIOD
    ends = base + np.array([len(t) for t in contexts])
    every = np.arange(len(text))
    sample = every[np.isin(every % PERIOD, COVER)]
    owner = np.searchsorted(base - lead, sample, "right") - 1
    sample = sample[(sample >= base[owner]) & (sample + PERIOD <= ends[owner])]
    rank_at = np.full(len(text) + size, -1, np.int64)
    rank = np.zeros(len(sample), np.int64)
    for k in range(0, PERIOD, 8):
        rank = _refine(rank, word(sample + k))
    rank_at[sample] = rank
    known = PERIOD
    while known < depth:
        step = min(known, depth - known)
        sample = sample[rank_at[sample + step] >= 0]
        rank = _refine(rank_at[sample], rank_at[sample + step])
        rank_at[:] = -1
        rank_at[sample] = rank
        known += step

    # 2. the suffixes of each bucket: PERIOD bytes, sample rank, last PERIOD bytes; settled ones leave early
    of = np.repeat(np.arange(len(contexts)), count)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = base[of] + inside
    # equal suffixes lie equally far from their anchor, so only those are compared: one residue, one way to the sample
    live, cls = np.arange(len(of)), bucket[of].astype(np.int64) * (size + 1) + (before[of] - inside)
    stages = [lambda p, k=k: word(p + k) for k in range(0, PERIOD, 8)]
    stages.append(lambda p: rank_at[p + _TO_SAMPLE[p % PERIOD]])
    stages += [lambda p, k=k: word(p + k) for k in range(depth, size, 8)]
    for key in stages:
        cls = _refine(cls, key(at[live]))
        tied = np.bincount(cls)[cls] > 1
        live, cls = live[tied], cls[tied]
        if not len(live):
            break
    hit = np.zeros(len(of), bool)
    hit[live] = True
    return np.split(hit, np.cumsum(count)[:-1])


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return edge[::2], edge[1::2] - edge[::2]


def _bucket_results(contexts: DataFrame, size: int) -> DataFrame:
    """(m, c, runs): repeated runs of suffixes of each context, buckets sorted batch by batch."""
    ordered = contexts.repartition("m").sortWithinPartitions("m", "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(t: pa.Table) -> pa.RecordBatch:
            m, c, before, count = (t.column(k).to_numpy() for k in ("m", "c", "before", "suffixes"))
            first = np.concatenate(([True], (m[1:] != m[:-1]) | (c[1:] != c[:-1])))  # one row per content
            texts = [x for x, f in zip(t.column("context").to_pylist(), first) if f]
            m, c, before, count = m[first], c[first], before[first].astype(np.int64), count[first].astype(np.int64)
            bucket = np.cumsum(np.concatenate(([0], m[1:] != m[:-1])))
            found = [_runs(h) for h in repeated_suffixes(bucket, before, count, texts, size)]
            keep = [i for i, (s, _) in enumerate(found) if len(s)]
            runs = [[(int(s) << 8) + int(n) for s, n in zip(*found[i])] for i in keep]
            return pa.RecordBatch.from_arrays([pa.array(m[keep]), pa.array(c[keep]), pa.array(runs, pa.list_(pa.int64()))], names=["m", "c", "runs"])

        held: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            m = t.column("m").to_numpy()
            cut = int(np.searchsorted(m, m[-1]))  # the last bucket may go on
            held = t.slice(cut)
            if cut:
                yield done(t.slice(0, cut))
        if held is not None:
            yield done(held)

    return ordered.mapInArrow(run, "m long, c long, runs array<long>")


def _hot_results(contexts: DataFrame, size: int) -> DataFrame:
    """The same for hot buckets (contexts with ``part``, the piece of the bucket they are in).

    A task takes one piece of a bucket.  Suffixes that are equal inside a piece are settled there;
    one row per different suffix (a digest of its bytes, with its count) goes on to meet the other
    pieces, so copies inside a piece are combined before anything is shuffled."""
    ordered = contexts.repartition("m", "part").sortWithinPartitions("m", "part", "c")
    schema = "m long, c long, k long, w1 long, w2 long, n long, runs array<long>"
    names = ["m", "c", "k", "w1", "w2", "n", "runs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            rows = [r for i, r in enumerate(rows) if not i or r[:2] != rows[i - 1][:2]]  # one row per content
            count = np.array([r[2] for r in rows])
            digests = b"".join([xxhash.xxh3_128_digest(t[k:k + size]) for _, _, n, t in rows for k in range(n)])
            both = np.frombuffer(digests, [("a", "<i8"), ("b", "<i8")])
            _, first, back, times = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
            of = np.repeat(np.arange(len(rows)), count)
            inside = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            c = np.array([r[1] for r in rows])
            hits = np.split(times[back] > 1, np.cumsum(count)[:-1])
            runs = [[(int(s) << 8) + int(n) for s, n in zip(*_runs(h))] for h in hits]
            known = [i for i, r in enumerate(runs) if r]
            cols = [np.full(len(first) + len(known), rows[0][0]), np.concatenate((c[of[first]], c[known])),
                    *[np.concatenate((x, np.zeros(len(known), np.int64))) for x in (inside[first], both["a"][first], both["b"][first], times)]]
            return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array([None] * len(first) + [runs[i] for i in known], pa.list_(pa.int64()))],
                                              names=names)

        held, key = [], None
        for b in batches:
            for row in zip(*(col.to_pylist() for col in b.columns)):
                m, c, _, count, text, part = row
                if held and key != (m, part):
                    yield done(held)
                    held = []
                key = (m, part)
                held.append((m, c, count, text))
        if held:
            yield done(held)

    pieces = materialise(ordered.mapInArrow(run, schema))
    met = with_group_values(pieces.filter("runs IS NULL"), ["w1", "w2"], ["m", "c", "k"], {"_n": F.sum("n")}, {"total": F.sum("_n")}, salts=16)
    more = met.filter("n = 1 AND total > 1").select("m", "c", F.array(F.shiftleft("k", 8) + 1).alias("runs"))
    found = pieces.filter("runs IS NOT NULL").select("m", "c", "runs").unionByName(more)
    return found.groupBy("m", "c").agg(F.flatten(F.collect_list("runs")).alias("runs"))  # one context's suffixes


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, hot: int = HOT) -> DataFrame:
    """(id, x, text, runs): every row with its repeated runs of suffixes (start * 256 + count); null without any."""
    keyed = _keyed(docs, id_col, text_col)
    rows = _segment_rows(keyed, size)
    known = rows.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).filter("n > 1")
    known = materialise(known.select(F.col("m").alias("_m"), (F.col("low") != F.col("high")).alias("mixed")))
    hits = materialise(rows.join(known, F.col("m") == F.col("_m")).select("m", "c", "id", "x", "at", "mixed"))
    contents = hits.filter("mixed").groupBy("m", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "x", "at")).alias("one"))
    contents = materialise(contents.select("m", "c", "n", "one.id", "one.x", "one.at"))
    sizes = contents.groupBy("m").agg(F.count(F.lit(1)).alias("different")).filter(F.col("different") > hot)
    sizes = materialise(sizes.select("m", F.ceil(F.col("different") / hot).alias("_pieces")))
    contexts = materialise(_context_rows(keyed, contents.select("id", "x", "at", "m", "c"), size))
    # pieces reach the contexts on (m, salt): a hot bucket is never one join task
    sized = attach(contexts, sizes, ["m"], ["c"], salts=16, how="left")
    usual = sized.filter("_pieces IS NULL").select(*contexts.columns)
    crowded = sized.filter("_pieces IS NOT NULL").select(*contexts.columns, F.pmod(F.xxhash64("c"), F.col("_pieces")).alias("part"))
    found = _bucket_results(usual, size).unionByName(_hot_results(crowded, size))
    # contents that occur twice are repeated whole
    copies = contents.filter("n > 1").select("m", "c", F.lit(True).alias("whole"))
    both = found.select("m", "c", "runs", F.lit(False).alias("whole")).unionByName(
        copies.select("m", "c", F.lit(None).cast("array<long>").alias("runs"), "whole"))
    results = both.groupBy("m", "c").agg(F.max("whole").alias("whole"), F.first("runs", ignorenulls=True).alias("runs"))
    mixed = attach(hits.filter("mixed"), materialise(results), ["m", "c"], ["id", "x", "at"], salts=16)
    mixed = mixed.select("id", "x", F.when(F.col("whole"), F.array("at")).otherwise(
        F.transform("runs", lambda r: F.shiftleft(F.shiftright("at", 8) + F.shiftright(r, 8), 8) + r.bitwiseAND(F.lit(255)))).alias("r"))
    runs = hits.filter("NOT mixed").select("id", "x", F.array("at").alias("r")).unionByName(mixed)
    # a set: rows that repeat id and text bring the same runs, so a list is bounded by the text's own length
    runs = runs.groupBy("id", "x").agg(F.flatten(F.collect_set("r")).alias("runs"))
    runs = prefixed(runs, ["id", "x"])
    return keyed.join(runs, same(keyed, runs, ["id", "x"]), "left").select("id", "x", "text", "runs")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, hot: int = HOT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept_text binary, span_starts, span_ends)."""
    rows = repeats(docs, id_col, text_col, size, hot).select("id", "text", "runs")
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.BinaryType()),
                           T.StructField("span_starts", T.ArrayType(T.LongType())), T.StructField("span_ends", T.ArrayType(T.LongType()))])

    def one(data: bytes, runs: np.ndarray) -> tuple:
        start = np.sort(runs)
        begin, end = start >> 8, (start >> 8) + (start & 255) + (size - 1)
        reach = np.maximum.accumulate(end)
        new = np.concatenate(([True], begin[1:] > reach[:-1])) if len(start) else np.zeros(0, bool)
        begin = begin[new]
        end = reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(reach) - 1]))] if len(start) else reach
        edges = [0, *np.stack((begin, end), axis=1).ravel().tolist(), len(data)]
        kept = b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])])
        return len(data), len(data) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), kept, begin.tolist(), end.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in range(b.num_rows):
                runs = b.column(2)[i]
                out.append(one(b.column(1)[i].as_py(), runs.values.to_numpy() if runs.is_valid else np.zeros(0, np.int64)))
            types = [pa.int64()] * 3 + [pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[k] for r in out], t) for k, t in enumerate(types)]], names=schema.names)

    return rows.mapInArrow(run, schema)


def suffix_digest(docs: DataFrame) -> DataFrame:
    return cut_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
