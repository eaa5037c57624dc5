"""Embedding near-dedup by an epsilon grid order join.

cos >= t between unit vectors means a distance of at most eps = sqrt(2 - 2 t).
1. Equal vectors collapse to one class with a count.
2. Classes are rotated onto leading principal dimensions (fitted on a bounded sample; any
   rotation keeps the join exact, a good one prunes more) and sorted by their grid cells
   of side eps: range partitions, cut into intervals of at most ``block_rows`` vectors.
3. The sequence of intervals is joined with itself recursively: a pair of parent intervals
   whose bounding boxes are within eps is replaced by the pairs of their children, level
   by level, as DataFrame joins.  Provably distant intervals never meet.
4. A task joins two intervals, again by sub-intervals whose boxes are within eps, and
   returns per vector the number of links and a spanning forest, never the pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite parts link
with nothing and stay; vectors of different length never link; repeated rows are links of
each other; component_id is the smallest id of the component; other columns are ignored;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, materialise, with_group_values
from .components import components
from .simhash_dedup import _union

COSINE, DIMENSIONS, BLOCK_ROWS, SUB_ROWS, FAN, FIT_ROWS = 0.95, 8, 2048, 256, 16, 4096
_SLACK = 1e-9  # room for rounding in every pruning test


def comparable(vec: Column) -> Column:
    """True for vectors that can link with others."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def rotation(classes: DataFrame, dimensions: int, fit_rows: int) -> np.ndarray:
    """Leading principal directions (columns) of at most ``fit_rows`` unit vectors, chosen by hash."""
    got = [r[0] for r in classes.orderBy(F.xxhash64("node"), "node").select("vec").limit(fit_rows).collect()]
    if not got:
        return np.zeros((0, 0))
    size = max((len(v) for v in got), key=[len(v) for v in got].count)
    x = np.array([v for v in got if len(v) == size], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    values, vectors = np.linalg.eigh((x - x.mean(axis=0)).T @ (x - x.mean(axis=0)))
    return vectors[:, np.argsort(-values)[:dimensions]]


def _unit(vecs: np.ndarray) -> np.ndarray:
    vecs = vecs.astype(np.float64)
    vecs = vecs / np.abs(vecs).max(axis=1, keepdims=True)  # no overflow, no underflow
    return vecs / np.sqrt((vecs * vecs).sum(axis=1, keepdims=True))


def _coordinates(unit: np.ndarray, turn: np.ndarray, k: int) -> np.ndarray:
    y = unit @ turn if turn.shape[0] == unit.shape[1] else unit[:, :k]
    return np.pad(y, ((0, 0), (0, k - y.shape[1])))


def intervals(classes: DataFrame, turn: np.ndarray, eps: float, k: int, block_rows: int) -> DataFrame:
    """One row per interval of the grid order: (seq, l0.., h0.., payload of nodes, counts and vectors)."""
    cells = [f"c{i}" for i in range(k)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y = np.zeros((b.num_rows, k))
            sizes = np.diff(np.asarray(b.column(2).offsets))
            values = b.column(2).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                vecs = values[(ends[at] - size)[:, None] + np.arange(size)]
                y[at] = _coordinates(_unit(vecs), turn, k)
            grid = np.floor(y / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes.astype(np.int32)), *[pa.array(grid[:, i]) for i in range(k)]],
                                             names=["node", "n", "vec", "d", *cells])

    kind = classes.schema["vec"].dataType.simpleString()
    dtype = "<f4" if "float" in kind else "<f8"
    placed = classes.select("node", "n", "vec").mapInArrow(
        place, f"node long, n long, vec {kind}, d int, " + ", ".join(f"{c} int" for c in cells))
    ordered = placed.repartitionByRange("d", *cells, "node").sortWithinPartitions("d", *cells, "node")
    names = [f"{e}{i}" for e in "lh" for i in range(k)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0

        def block(nodes, counts, vecs):
            nonlocal made
            y = _coordinates(_unit(vecs), turn, k)
            row = [part, made, vecs.shape[1], *y.min(axis=0).tolist(), *y.max(axis=0).tolist(), nodes.astype("<i8").tobytes(),
                   counts.astype("<i8").tobytes(), vecs.astype(dtype).tobytes()]
            made += 1
            types = [pa.int32()] * 3 + [pa.float64()] * len(names) + [pa.binary()] * 3
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                              names=["part", "made", "d", *names, "nodes", "counts", "vecs"])

        held: list = []
        for b in batches:
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(2)):
                if held and (len(held) >= block_rows or held[0][2] != row[2]):
                    yield block(*pack(held))
                    held = []
                held.append((row[0], row[1], row[2], np.asarray(row[3].values)))
        if held:
            yield block(*pack(held))

    def pack(held):
        return np.array([h[0] for h in held]), np.array([h[1] for h in held]), np.stack([h[3] for h in held])

    blocks = materialise(ordered.mapInArrow(cut, "part int, made int, d int, " + ", ".join(f"{n} double" for n in names) +
                                            ", nodes binary, counts binary, vecs binary"))
    # one row per partition: consecutive numbers along the order
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return blocks.join(F.broadcast(parts), F.col("part") == F.col("_part")).select(
        (F.col("_before") + F.col("made")).alias("seq"), "d", *names, "nodes", "counts", "vecs")


def interval_pairs(blocks: DataFrame, eps: float, k: int, fan: int = FAN) -> DataFrame:
    """(a, b), a <= b: the pairs of intervals whose boxes are within eps, by recursion from the whole sequence."""
    boxes = [f"{e}{i}" for e in "lh" for i in range(k)]
    levels, count = [materialise(blocks.select("seq", *boxes))], blocks.count()
    while count > 1:
        up = levels[-1].groupBy(F.expr(f"seq div {fan}").alias("seq")).agg(
            *[F.min(c).alias(c) for c in boxes[:k]], *[F.max(c).alias(c) for c in boxes[k:]])
        levels.append(materialise(up))
        count = -(-count // fan)
    pairs = levels[-1].select(F.col("seq").alias("a"), F.col("seq").alias("b"))
    for level in reversed(levels[:-1]):
        left = level.select(F.expr(f"seq div {fan}").alias("_pa"), F.col("seq").alias("_a"), *[F.col(c).alias("x" + c) for c in boxes])
        right = level.select(F.expr(f"seq div {fan}").alias("_pb"), F.col("seq").alias("_b"), *[F.col(c).alias("y" + c) for c in boxes])
        gaps = [F.greatest(F.col(f"xl{i}") - F.col(f"yh{i}"), F.col(f"yl{i}") - F.col(f"xh{i}"), F.lit(0.0)) for i in range(k)]
        near = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= F.lit((eps + _SLACK) ** 2)
        pairs = pairs.join(left, F.col("a") == F.col("_pa")).join(right, (F.col("b") == F.col("_pb")) & (F.col("_a") <= F.col("_b")) & near)
        pairs = materialise(pairs.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    return pairs


def _near(ylo, yhi, zlo, zhi, eps) -> bool:
    gap = np.maximum(np.maximum(ylo - zhi, zlo - yhi), 0)
    return float((gap * gap).sum()) <= (eps + _SLACK) ** 2


def join_blocks(one: tuple, two: tuple, turn: np.ndarray, cosine: float, k: int, sub: int = SUB_ROWS) -> tuple[np.ndarray, ...]:
    """(nodes, link counts, forest u, forest v) of two intervals (nodes, counts, vectors); ``two`` is None for one with itself."""
    eps = np.sqrt(2 - 2 * cosine)
    sides = [one] if two is None else [one, two]
    units = [_unit(s[2]) for s in sides]
    ys = [_coordinates(u, turn, k) for u in units]
    nodes, weight = np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides])
    raw = np.concatenate([s[2] for s in sides]).astype(np.float64)
    links, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    first, last, shift = units[0], units[-1], 0 if two is None else len(one[0])
    for i in range(0, len(first), sub):
        for j in range(i if two is None else 0, len(last), sub):
            a, b = ys[0][i:i + sub], ys[-1][j:j + sub]
            if not _near(a.min(0), a.max(0), b.min(0), b.max(0), eps):
                continue
            s = first[i:i + sub] @ last[j:j + sub].T
            u, v = np.nonzero(s >= cosine - 1e-9)
            close = np.abs(s[u, v] - cosine) < 1e-9
            u, v = u + i, v + j + shift
            if close.any():  # on the edge: the cosine as written, one pair at a time
                x, z = raw[u[close]], raw[v[close]]
                exact = (x * z).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((z * z).sum(1)))
                keep = np.ones(len(u), bool)
                keep[np.flatnonzero(close)] = exact >= cosine
                u, v = u[keep], v[keep]
            if two is None and i == j:
                u, v = u[u != v], v[u != v]  # both directions are there
                links += np.bincount(u, weight[v], len(nodes)).astype(np.int64)
            else:
                links += (np.bincount(u, weight[v], len(nodes)) + np.bincount(v, weight[u], len(nodes))).astype(np.int64)
            label = _union(label, u, v)
    some, moved = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[some], links[some], nodes[moved], nodes[label[moved]]


def link_classes(classes: DataFrame, cosine: float = COSINE, k: int = DIMENSIONS, block_rows: int = BLOCK_ROWS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """classes: (node, n, vec).  Returns (kind, u, v): kind 0 a node and its number of links, kind 1 a forest edge."""
    turn, eps = rotation(classes, k, fit_rows), float(np.sqrt(2 - 2 * cosine))
    k = max(1, min(k, turn.shape[1] or 1))
    blocks = materialise(intervals(classes, turn, eps, k, block_rows))
    pairs = interval_pairs(blocks, eps, k)
    # either interval may take either side: this evens out how many partners meet one interval
    odd = (F.col("a") + F.col("b")) % 2 == 1
    pairs = pairs.select(F.when(odd, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(odd, F.col("a")).otherwise(F.col("b")).alias("b"))
    payload = ["d", "nodes", "counts", "vecs"]
    left = blocks.select(F.col("seq").alias("_a"), *[F.col(c).alias("a_" + c) for c in payload])
    right = blocks.select(F.col("seq").alias("_b"), *[F.col(c).alias("b_" + c) for c in payload])
    # a single interval meets itself without a second copy
    met = pairs.join(right, F.col("b") == F.col("_b")).join(left, (F.col("a") == F.col("_a")) & (F.col("a_d") == F.col("b_d")))
    met = met.select("a", "b", *["a_" + c for c in payload], *[F.when(F.col("a") != F.col("b"), F.col("b_" + c)).alias("b_" + c) for c in payload])
    dtype = "<f4" if "float" in classes.schema["vec"].dataType.simpleString() else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(d, nodes, counts, vecs):
            return np.frombuffer(nodes, "<i8"), np.frombuffer(counts, "<i8"), np.frombuffer(vecs, dtype).reshape(-1, d)

        for b in batches:
            for i in range(b.num_rows):
                row = [b.column(c)[i].as_py() for c in range(10)]
                nodes, counts, u, v = join_blocks(side(*row[2:6]), None if row[6] is None else side(*row[6:]), turn, cosine, k)
                kind = np.repeat(np.array([0, 1], np.int32), [len(nodes), len(u)])
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate((nodes, u))), pa.array(np.concatenate((counts, v)))],
                                                 names=["kind", "u", "v"])

    return met.mapInArrow(run, "kind int, u long, v long")


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE,
                     k: int = DIMENSIONS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    usable, rest = rows.filter(comparable(F.col("vec"))), rows.filter(~comparable(F.col("vec")))
    classes = usable.groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep"))
    classes = materialise(materialise(classes).withColumn("node", F.monotonically_increasing_id()))
    found = materialise(link_classes(classes, cosine, k, block_rows))
    counts = found.filter("kind = 0").groupBy(F.col("u").alias("_node")).agg(F.sum("v").alias("_links"))
    labels = components(found.filter("kind = 1").select("u", "v")).select(F.col("node").alias("_lnode"), "label")
    named = classes.join(counts, classes["node"] == counts["_node"], "left").join(labels, classes["node"] == labels["_lnode"], "left")
    named = materialise(named.select("vec", "node", "rep", (F.col("n") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"),
                                     F.coalesce("label", "node").alias("_label")))
    named = with_group_values(named, ["_label"], ["node"], {"_low": F.min("rep")}, {"component_id": F.min("_low")}, salts=16)
    out = attach(usable, named.select("vec", "n_links", "component_id"), ["vec"], ["id"]).select("id", "n_links", "component_id")
    out = out.unionByName(rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n_links").cast("long"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
