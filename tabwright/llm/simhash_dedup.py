"""SimHash near-dedup with BK-trees.

1. Each text gets a 64-bit fingerprint of its word shingles (Arrow batches, one pass).
   Equal fingerprints collapse to one class, so copies cost nothing further on.
2. Fingerprints within ``radius`` bits agree on at least two of ``radius + 2`` bit blocks.
   Each pair of blocks gives a bucket; any linked pair shares a bucket.  A bucket larger
   than ``shard`` nodes is cut into tree shards, and every (tree shard, query shard) pair
   is one unit of work, so a bucket of any size is searched whole with bounded memory.
3. A unit builds a BK-tree over its tree shard, children keyed by integer Hamming
   distance to the parent, and searches it for every query following only edges within
   the radius.  All trees of an Arrow batch are built and searched together, level by level.
   It returns a spanning forest of the links found, never the pairs.
4. Components of the forest give the groups.

The shard trees travel to the tasks by shuffle: their number grows with the data, so
there is no size bound under which all of them could be broadcast; one tree is bounded.

Defined results: a null text counts as empty; texts without words have fingerprint zero
and link like any other; fewer words than a shingle are one shingle of all; repeated rows
share a class; component_id is the smallest id of the component (null ids come last, so it
is null only where all ids are); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, keep_one, materialise, with_group_values
from .components import components

SHINGLE, RADIUS, SEED, SHARD = 3, 2, 42, 4096
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PIECE = 1 << 22  # bytes of a text that are split into words at a time
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)  # most significant first


def _count_bits(words: list[bytes], shingle: int, counts: np.ndarray) -> int:
    """Add the set bits of the hashes of all shingles of ``words``; return their number."""
    n = len(words) - shingle + 1
    if n <= 0:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist())])
    cells = np.frombuffer(hashes, np.uint8).reshape(-1, 8) + (np.arange(8, dtype=np.int64) * 256)
    counts += (np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return n


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text as an unsigned 64-bit integer."""
    counts, total, held, at = np.zeros(64, np.int64), 0, [], 0
    size = len(text)
    while at < size:
        end = min(size, at + _PIECE)
        while end < size and text[end] not in b" \t\n\r\x0b\x0c":  # cut between words only
            end += 1
        words = held + text[at:end].translate(_LOWER).split()
        at = end
        if at >= size and total == 0 and len(words) < shingle:
            if not words:
                return 0
            total += _count_bits(words, len(words), counts)
            break
        got = _count_bits(words, shingle, counts)
        total += got
        held = words[got:] if got else words
    if not total:
        return 0
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp), fp a bigint with the fingerprint's 64 bits."""
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    schema = T.StructType([rows.schema[id_col], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=[id_col, "fp"])

    return rows.mapInArrow(run, schema)


def block_masks(radius: int) -> list[int]:
    """Signed 64-bit masks of every pair of radius + 2 bit blocks."""
    cuts = [round(i * 64 / (radius + 2)) for i in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(blocks, 2))]


def _forest(f: np.ndarray, roots: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees over all ``nodes`` at once; roots[i] is the root of nodes[i]'s tree.

    Returns edge keys parent * 65 + distance in order, and the children."""
    keys, kids = [], []
    at = roots
    waiting = nodes != roots
    pending, at = nodes[waiting], at[waiting]
    while len(pending):
        key = at * 65 + np.bitwise_count(f[pending] ^ f[at]).astype(np.int64)
        order = np.argsort(key, kind="stable")
        key, pending = key[order], pending[order]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        child = pending[first]
        keys.append(key[first])
        kids.append(child)
        at = child[np.cumsum(first) - 1][~first]
        pending = pending[~first]
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, kids = np.concatenate(keys), np.concatenate(kids)
    order = np.argsort(keys, kind="stable")
    return keys[order], kids[order]


def _search(f: np.ndarray, keys: np.ndarray, kids: np.ndarray, q: np.ndarray, node: np.ndarray, radius: int,
            most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) hits; only edges whose key is within the radius of the distance are followed."""
    stack = [(q[i:i + most], node[i:i + most]) for i in range(0, len(q), most)]
    while stack:
        q, node = stack.pop()
        d = np.bitwise_count(f[q] ^ f[node]).astype(np.int64)
        hit = (d <= radius) & (q != node)
        if hit.any():
            yield q[hit], node[hit]
        lo = np.searchsorted(keys, node * 65 + np.maximum(d - radius, 0), "left")
        n = np.searchsorted(keys, node * 65 + np.minimum(d + radius, 64), "right") - lo
        some = n > 0
        q, lo, n = q[some], lo[some], n[some]
        if not len(n):
            continue
        done = np.cumsum(n)
        for part in np.split(np.arange(len(n)), np.searchsorted(done, np.arange(most, done[-1], most))):
            if len(part):
                m = n[part]
                inside = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                stack.append((np.repeat(q[part], m), kids[np.repeat(lo[part], m) + inside]))


def _union(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return label
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def link_units(fp: np.ndarray, unit: np.ndarray, tree: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges (fp, fp) of the links inside each unit; rows of a unit are adjacent."""
    f = fp.view(np.uint64)
    nodes = np.flatnonzero(tree)
    if not len(nodes):
        return fp[:0], fp[:0]
    own = unit[nodes]
    first = np.concatenate(([True], own[1:] != own[:-1]))
    root_of = np.full(unit[-1] + 1, -1, np.int64)
    root_of[own[first]] = nodes[first]
    keys, kids = _forest(f, root_of[own], nodes)
    q = np.flatnonzero(query)
    q = q[root_of[unit[q]] >= 0]
    label = np.arange(len(fp))
    for u, v in _search(f, keys, kids, q, root_of[unit[q]], radius):
        label = _union(label, u, v)
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return fp[linked], fp[label[linked]]


def links(classes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Forest edges (u, v) between distinct fingerprints (fp) that lie within ``radius`` bits."""
    keys = F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(block_masks(radius))])
    rows = classes.select("fp", F.explode(keys).alias("k")).select("fp", "k.c", "k.key")
    rows = with_group_values(rows, ["c", "key"], ["fp"], {"_n": F.count(F.lit(1))}, {"n": F.sum("_n")}, salts=16).filter("n > 1")
    shards = F.ceil(F.col("n") / F.lit(shard)).cast("int")
    rows = rows.withColumn("_shards", shards).withColumn("s", F.pmod(F.xxhash64("fp"), F.col("_shards")).cast("int"))
    rows = rows.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1)))
    units = rows.select("c", "key", F.least("s", "t").alias("i"), F.greatest("s", "t").alias("j"),
                        (F.col("s") <= F.col("t")).alias("tree"), (F.col("s") >= F.col("t")).alias("query"), "fp")
    units = units.repartition("c", "key", "i", "j").sortWithinPartitions("c", "key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(cols: list[np.ndarray], unit: np.ndarray) -> pa.RecordBatch:
            u, v = link_units(cols[6], unit, cols[4], cols[5], radius)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        held: list[np.ndarray] | None = None
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.concatenate((h, c)) for h, c in zip(held, cols)]
            new = np.zeros(len(cols[0]), bool)
            for c in cols[:4]:
                new[1:] |= c[1:] != c[:-1]
            unit = np.cumsum(new)
            cut = int(np.searchsorted(unit, unit[-1]))  # the last unit may go on in the next batch
            held = [c[cut:] for c in cols]
            if cut:
                yield done([c[:cut] for c in cols], unit[:cut])
        if held is not None:
            yield done(held, np.zeros(len(held[0]), np.int64))

    return units.mapInArrow(run, "u long, v long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
                   shard: int = SHARD) -> DataFrame:
    """(id, fp, component_id), one row per input row."""
    table = materialise(fingerprints(docs, id_col, text_col, shingle))
    classes = materialise(table.groupBy("fp").agg(F.min(id_col).alias("_rep")))
    labels = components(links(classes, radius, shard)).withColumnRenamed("node", "_node")
    named = classes.join(labels, classes["fp"] == labels["_node"], "left").select(
        "fp", "_rep", F.coalesce("label", "fp").alias("_label"))
    named = with_group_values(named, ["_label"], ["fp"], {"_low": F.min("_rep")}, {"component_id": F.min("_low")}, salts=16)
    return attach(table, named.select("fp", "component_id"), ["fp"], [id_col])


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row with the smallest id (null ids come last).

    The groups are built on (id, SHA-256 of the text), which no two components share even
    where they share ids; of rows that repeat both one stays."""
    keys = {"_d_id": F.col(id_col), "_d_sha": F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)}
    named = docs.select(F.struct(F.col(id_col).isNull().alias("none"), *[c.alias(k) for k, c in keys.items()]).alias("_d_key"),
                        F.col(text_col).alias("_d_text"))
    groups = simhash_groups(named, "_d_key", "_d_text", shingle, radius).groupBy("_d_key").agg(
        F.max(F.col("_d_key") == F.col("component_id")).alias("_stays"), F.count(F.lit(1)).alias("_n"))
    return keep_one(docs, keys, groups.filter("NOT _stays OR _n > 1").select("_d_key._d_id", "_d_key._d_sha", "_stays"))


def simhash_digest(docs: DataFrame) -> DataFrame:
    out = simhash_groups(docs)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
