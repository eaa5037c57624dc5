"""Packing by cutting-stock column generation.

1. One Arrow pass tokenises each text, appends the end id and cuts it into full pieces of
   ``capacity`` ids and one remainder; only lengths and checksums leave the task.
2. A full piece is a sequence of its own.  The remainders' length histogram, in classes of
   ``grain`` ids rounded up (``capacity / grain`` numbers, whatever the table's size), goes to
   the driver, where the linear program over packing patterns is solved by column
   generation: a knapsack dynamic program prices the next pattern and the simplex basis is
   updated, until the bound it proves on the remaining gain is under ``tolerance``.  The rounded
   columns are the packing, also where plain best fit happens to need a sequence less.
3. Rounded-down pattern counts, then fractional patterns that still fit, then best fit for
   the few remainders left over, give runs of bins.  Documents of a class are ranked (in
   hash blocks, no task holds a class), and a rank interval of each pattern says which bin
   a document gets.  The pattern table has at most (patterns x classes in a pattern) rows,
   a bound that depends on ``capacity`` alone, so it is broadcast.  Offsets are running
   sums of the true lengths inside a sequence, so rounding up leaves no gap.

Defined results: null and empty texts are the end id alone; repeated rows are packed each
for itself; a text of any length is cut, never shortened; an empty table gives an empty table.

The ids come from the rank file of ``byte_bpe_50k.json``'s vocabulary by another library; the tests hold
them against the named one, special strings inside texts included.
"""

from __future__ import annotations

import base64
import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, with_block_rank

CAPACITY, END_ID, VOCABULARY, TOLERANCE, GRAIN = 1024, 0, "byte_bpe_50k.tiktoken", 0.001, 4
_SEGMENT = 1 << 20  # characters encoded at a time
_ENCODERS: dict[str, Callable[[str], Iterator[bytes]]] = {}


def encoder(vocabulary: str = VOCABULARY) -> Callable[[str], Iterator[bytes]]:
    """text -> little-endian uint32 ids, in segments.  ``vocabulary`` is a ranks file: a path, or a name in public_tokenizers.

    A single space between two words always starts a new pre-token, so a long text may be cut there."""
    if vocabulary in _ENCODERS:
        return _ENCODERS[vocabulary]
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(text: str) -> Iterator[bytes]:
        at = 0
        while len(text) - at > _SEGMENT:
            cut = at + _SEGMENT
            while (cut := text.find(" ", cut)) > 0 and (cut + 1 >= len(text) or text[cut + 1].isspace() or text[cut - 1].isspace()):
                cut += 1
            if cut < 0:
                break
            yield np.array(plain(text[at:cut]), "<u4").tobytes()
            at = cut
        yield np.array(plain(text[at:]), "<u4").tobytes()

    _ENCODERS[vocabulary] = encode
    return encode


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, doc_tokens, crcs): crcs holds the CRC-32 of each piece's ids, in order."""
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = T.StructType([rows.schema[id_col], T.StructField("doc_tokens", T.LongType()),
                           T.StructField("crcs", T.ArrayType(T.LongType()))])
    tail, wide = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def one(text: str, encode) -> tuple[int, list[int]]:
        crcs, size, held = [], 0, b""
        for ids in encode(text):
            held += ids
            size += len(ids)
            full = len(held) // wide * wide
            crcs += [zlib.crc32(held[i:i + wide]) for i in range(0, full, wide)]
            held = held[full:]
        held += tail
        return (size + 4) // 4, [*crcs, zlib.crc32(held)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for b in batches:
            got = [one(t.as_py(), encode) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _ in got], pa.int64()), pa.array([c for _, c in got], pa.list_(pa.int64()))],
                names=[id_col, "doc_tokens", "crcs"])

    return rows.mapInArrow(run, schema)


def _knapsack(lengths: np.ndarray, gain: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: copies of each length with total length up to capacity."""
    worth = np.zeros(capacity + 1)
    dense = np.zeros(capacity + 1)
    dense[lengths] = gain
    take = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        options = dense[1:c + 1] + worth[c - 1::-1]
        i = int(options.argmax())
        if options[i] > worth[c - 1]:
            worth[c], take[c] = options[i], i + 1
        else:
            worth[c] = worth[c - 1]
    copies, c = np.zeros(capacity + 1, np.int64), capacity
    while c > 0:
        if take[c]:
            copies[take[c]] += 1
            c -= take[c]
        else:
            c -= 1
    return float(worth[capacity]), copies[lengths]


def best_fit(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[dict, int]]:
    """[(copies by length, bins)], longest lengths first, each into the fullest bins that have room."""
    room: dict[int, list[tuple[dict, int]]] = {}

    def put(pattern: dict, size: int, copies: int, bins: int, space: int) -> None:
        if bins > 0:
            room.setdefault(space - size * copies, []).append((pattern | {size: copies} if copies else pattern, bins))

    for i in np.argsort(-lengths, kind="stable"):
        size, need = int(lengths[i]), int(demand[i])
        while need > 0:
            space = min((r for r in room if r >= size), default=0)
            pattern, bins = room[space].pop() if space else ({}, need)
            if space and not room[space]:
                del room[space]
            space = space or capacity
            per = min(space // size, need)
            whole = min(bins, need // per)
            put(pattern, size, per, whole, space)
            need, bins = need - per * whole, bins - whole
            if need and bins:  # one more bin takes the rest, the others stay as they were
                put(pattern, size, min(per, need), 1, space)
                need, bins = need - min(per, need), bins - 1
            if pattern:
                put(pattern, size, 0, bins, space)
    return [x for group in room.values() for x in group]


def _inverse(basis: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination; plain array operations, as threads of a linear algebra library
    would fight with Spark's for the driver's cores."""
    m = len(basis)
    a = np.concatenate((basis, np.eye(m)), axis=1)
    for i in range(m):
        p = i + int(np.abs(a[i:, i]).argmax())
        a[[i, p]] = a[[p, i]]
        a[i] /= a[i, i]
        way = a[:, i].copy()
        way[i] = 0
        a -= way[:, None] * a[i]
    return a[:, m:]


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int, pool: np.ndarray,
                   tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, float]:
    """(patterns as columns, how often each is used, lower bound on bins) of the relaxed program.

    Simplex steps first use the columns of ``pool`` (the best-fit patterns); when none of
    them helps, the knapsack prices new ones.  Steps end when pricing finds no better pattern, or
    proves a bound that the bins exceed by at most ``tolerance``, a share of the bound.  Demands are
    perturbed a little, against steps of length zero."""
    basis = np.diag(capacity // lengths).astype(float)
    inverse = np.diag(1 / np.diag(basis))
    shaken = demand * (1 + 1e-4 * np.random.default_rng(0).random(len(demand)))
    x = (inverse * shaken).sum(axis=1)
    bound, pool = float(demand @ lengths) / capacity, pool.astype(float)
    for step in itertools.count():
        prices = inverse.sum(axis=0)
        values = (pool * prices[:, None]).sum(axis=0)
        if values.max(initial=0) > 1 + 1e-7:
            column = pool[:, int(values.argmax())]
        else:
            value, column = _knapsack(lengths, prices, capacity)
            bound = max(bound, float(demand @ prices) / max(value, 1e-9))
            if value <= 1 + 1e-7 or x.sum() <= (1 + tolerance) * bound:
                break  # optimal, or what any further pattern could save is under the tolerance
        way = (inverse * column).sum(axis=1)
        ratios = np.where(way > 1e-9, x / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratios.argmin())
        if not np.isfinite(ratios[out]):
            break
        basis[:, out] = column
        if step % 200 == 199:  # rebuild before rounding errors add up
            inverse = _inverse(basis)
            x = np.maximum((inverse * shaken).sum(axis=1), 0)
        else:
            row, t = inverse[out] / way[out], ratios[out]
            way[out] -= 1  # turns the pivot row's own update into a replacement
            inverse -= way[:, None] * row
            x = np.maximum(x - t * way, 0)
    return basis.astype(np.int64), x, bound


def pack_lengths(lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY, tolerance: float = TOLERANCE) -> list[tuple[dict, int]]:
    """Bins as [(copies by length, number of bins)]; together they use each length as often as demanded."""
    if not len(lengths):
        return []
    simple = best_fit(lengths, demand, capacity)
    pool = np.array([[p.get(int(n), 0) for n in lengths] for p, _ in simple], np.int64).T
    patterns, x, _ = solve_patterns(lengths, demand.astype(float), capacity, pool, tolerance)
    left = demand.astype(np.int64).copy()
    bins: list[tuple[dict, int]] = []
    order = np.argsort(-(x - np.floor(x)), kind="stable")
    for use in (np.floor(x + 1e-9).astype(np.int64), np.ones(len(x), np.int64)):  # whole uses, then fractions that still fit
        for p in order:
            a = patterns[:, p]
            used = a > 0
            fit = min(int(use[p]), int((left[used] // a[used]).min()))
            if fit > 0:
                bins.append(({int(lengths[i]): int(a[i]) for i in np.flatnonzero(a)}, fit))
                left -= a * fit
    return bins + best_fit(lengths, left, capacity)


def interval_rows(bins: list[tuple[dict, int]]) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """((class, first rank, end rank, copies a bin, first sequence), …) and the number of sequences."""
    rows, given, sequence = [], {}, 0
    for copies, n in bins:
        for size, per in copies.items():
            lo = given.get(size, 0)
            rows.append((size, lo, lo + per * n, per, sequence))
            given[size] = lo + per * n
        sequence += n
    return rows, sequence


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
         vocabulary: str = VOCABULARY, tolerance: float = TOLERANCE, grain: int = GRAIN, blocks: int = 256) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece."""
    if capacity % grain:
        raise ValueError("capacity must be a multiple of grain")
    spark = docs.sparkSession
    table = materialise(token_pieces(docs, id_col, text_col, capacity, end_id, vocabulary))
    table = table.withColumn("_rest", F.col("doc_tokens") % capacity).withColumn("_full", F.expr(f"doc_tokens div {capacity}"))
    table = table.withColumn("_class", F.expr(f"cast((_rest + {grain - 1}) div {grain} as int)"))
    histogram = sorted(tuple(r) for r in table.filter("_rest > 0").groupBy("_class").count().collect())  # capacity / grain rows
    sizes, demand = (np.array([h[i] for h in histogram], np.int64) for i in (0, 1))
    intervals, mixed = interval_rows(pack_lengths(sizes, demand, capacity // grain, tolerance))
    intervals = spark.createDataFrame(intervals, "_size int, _lo long, _hi long, _per long, _sequence long")
    order = [F.col(id_col), F.col("doc_tokens"), F.col("crcs")]
    block = F.pmod(F.xxhash64(id_col, "doc_tokens", "crcs"), F.lit(blocks))
    ranked = with_block_rank(table.filter("_rest > 0"), ["_class"], block, order, "_rank")
    rest = ranked.join(F.broadcast(intervals), (F.col("_class") == F.col("_size")) & (F.col("_rank") >= F.col("_lo")) &
                       (F.col("_rank") < F.col("_hi")))
    inside = Window.partitionBy("sequence_id").orderBy(F.col("_class").desc(), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    rest = rest.select(
        id_col, (F.col("_full") * capacity).alias("start"), F.col("_rest").alias("length"), F.element_at("crcs", -1).alias("ids_crc32"),
        "doc_tokens", F.expr("_sequence + (_rank - _lo) div _per").alias("sequence_id"), "_class", "_rank")
    rest = rest.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).drop("_class", "_rank")
    numbered = with_block_rank(table.filter("_full > 0"), [], block, order, "_first", weight=F.col("_full"))
    full = numbered.select("*", F.posexplode(F.slice("crcs", F.lit(1), F.col("_full").cast("int"))).alias("_k", "_crc"))
    full = full.select(
        id_col, (F.col("_k") * F.lit(capacity).cast("long")).alias("start"), F.lit(capacity).cast("long").alias("length"),
        F.col("_crc").alias("ids_crc32"), "doc_tokens", (F.lit(mixed) + F.col("_first") + F.col("_k")).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return full.unionByName(rest)


def pack_digest(docs: DataFrame) -> DataFrame:
    return pack(docs)
