"""Merkle dataset manifest with incremental witnesses.

Every row is a leaf.  The leaves of a source, in order of id, are appended one after the other
to a tree of runs of ``ARITY`` nodes; the sources' roots are appended to a tree of their own.
A row's witness holds one step a level: the text whose hash is the parent, with ``*`` in place
of the row's own digest, so folding a leaf is ``h = H(step with * replaced by h)``.

1. Leaf digests and gapless positions inside the source come from a range-partitioned sort, so
   one source may hold any share of all rows.
2. ``Witnesses`` appends the nodes of an aligned block of ``ARITY ** HEIGHT`` positions: open
   runs hold the subtrees that wait for siblings, and a run that fills extends the witness of
   everything below it.  A block is one group, whatever its source's size.
3. Block roots are appends to the next tree up, in blocks again, until a source fits one block;
   the witnesses found there extend those of the block's rows.

Defined results: null fields hash as ``-``; rows of equal (source, id) are ordered by leaf digest,
repeated rows are leaves of their own; the null id comes first in its source, the null source first
of all; an empty table gives an empty table; columns beside the fields are neither hashed nor kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.rank import row_number_by

from .common import materialise

ARITY, HEIGHT = 3, 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = ("_tree", "_pos", "_size", "_digest")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Witnesses:
    """An append-only tree; ``paths[i]`` is the witness of the i-th node so far."""

    def __init__(self, arity: int = ARITY):
        self.arity, self.paths, self._open = arity, [], []

    def append(self, node: str) -> None:
        self.paths.append([])
        self._add(0, node, range(len(self.paths) - 1, len(self.paths)))

    def _add(self, level: int, node: str, below: range) -> None:
        if level == len(self._open):
            self._open.append([])
        self._open[level].append((node, below))
        if len(self._open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        nodes = [n for n, _ in run]
        for place, (_, below) in enumerate(run):
            step = "".join(nodes[:place]) + "*" + "".join(nodes[place + 1:])
            for i in below:
                self.paths[i].append(step)
        self._add(level + 1, digest("".join(nodes)), range(run[0][1].start, run[-1][1].stop))

    def root(self, height: int | None = None) -> str:
        """Close the open runs, up to ``height`` levels or else until one node remains."""
        level = 0
        while True:
            run = self._open[level]
            if level == height or height is None and len(run) == 1 and not any(self._open[level + 1:]):
                return run[0][0]
            if run:
                self._complete(level)
            level += 1


def _grown(nodes: pa.Table, arity: int, height: int) -> tuple[list[int], Witnesses, str]:
    """Of one block's nodes: their order, their witnesses and the block's root."""
    size, at = nodes.column("_size")[0].as_py(), nodes.column("_pos").to_pylist()
    order = sorted(range(len(at)), key=at.__getitem__)
    tree, digests = Witnesses(arity), nodes.column("_digest").to_pylist()
    for i in order:
        tree.append(digests[i])
    return order, tree, tree.root(height if size > arity ** height else None)


def _blocks(nodes: DataFrame, block: int) -> DataFrame:
    return nodes.withColumn("_part", F.floor(F.col("_pos") / block))


def ladder(nodes: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> list[DataFrame]:
    """nodes (_tree, _pos, _size, _digest, ...) with _size nodes in a tree, then the block roots above them, level by
    level, down to one root a tree.  Each level is ``arity ** height`` times smaller than the one before."""
    block = arity ** height

    def top(key, rows):
        size = -(-rows.column("_size")[0].as_py() // block)
        return pa.table({"_tree": [key[0].as_py()], "_pos": pa.array([key[1].as_py()], pa.int64()), "_size": pa.array([size], pa.int64()),
                         "_digest": [_grown(rows, arity, height)[2]]})

    levels = [nodes]
    while len(levels) == 1 or (levels[-1].agg(F.max("_size")).first()[0] or 0) > 1:
        cut = _blocks(levels[-1].select(*_NODE), block)
        levels.append(materialise(cut.groupBy("_tree", "_part").applyInArrow(top, "_tree string, _pos long, _size long, _digest string")))
    return levels


def descend(levels: list[DataFrame], above: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """The ladder's lowest nodes with the columns of ``above`` (_tree, _pos, _witness, ...: what lies above each tree's
    root), their own witnesses put in front."""
    for nodes in reversed(levels[:-1]):
        cut, upper = _blocks(nodes, arity ** height), above.withColumnRenamed("_pos", "_part")
        extra = [c for c in above.columns if c not in nodes.columns]
        kinds = T.StructType([*nodes.schema, *[above.schema[c] for c in extra]])
        above = cut.groupBy("_tree", "_part").cogroup(upper.groupBy("_tree", "_part")).applyInArrow(_below(nodes.columns, extra, arity, height), kinds)
    return above


def _below(names: list[str], extra: list[str], arity: int, height: int):
    def witness(key, rows, later):
        order, tree, _ = _grown(rows, arity, height)
        out, rest = rows.select(names).take(order), later.column("_witness")[0].as_py()
        for c in extra:
            values = [p + rest for p in tree.paths] if c == "_witness" else [later.column(c)[0].as_py()] * len(order)
            out = out.append_column(c, pa.array(values, later.schema.field(c).type))
        return out
    return witness


def leaf_digest(fields: Sequence[Column]) -> Column:
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in fields]), 256)


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf's digest leads to."""
    return F.aggregate(witness, leaf, lambda h, step: F.sha2(F.replace(step, F.lit("*"), h), 256))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
             carry: dict[str, Column] | None = None, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """(id, source, leaf, position, witness array<string>, subroot, root) and ``carry`` (name -> expression over docs)."""
    carry = carry or {}
    # a tree's name tells the null source from every text and sorts it first; nothing below compares nulls
    tree = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))
    leaves = materialise(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), tree.alias("_tree"),
                                     leaf_digest([F.col(c) for c in fields]).alias("_digest"),
                                     *[c.alias(f"_c_{n}") for n, c in carry.items()]))
    placed = row_number_by(leaves, [F.col("_id").asc_nulls_first(), "_digest"], group=["_tree"], out="_pos", size_col="_size")
    levels = ladder(materialise(placed.withColumn("_pos", F.col("_pos") - 1)), arity, height)
    # the sources' roots are the nodes of one more tree
    tops = row_number_by(levels[-1].select(F.col("_tree").alias("_name"), "_digest"), ["_name"], out="_pos", size_col="_size")
    crown = ladder(materialise(tops.select(F.lit("").alias("_tree"), (F.col("_pos") - 1).alias("_pos"), "_size", "_digest", "_name")), arity, height)
    above = crown[-1].select("_tree", "_pos", F.array().cast("array<string>").alias("_witness"), F.col("_digest").alias("_root"))
    above = descend(crown, above, arity, height).select(
        F.col("_name").alias("_tree"), F.lit(0).cast("long").alias("_pos"), "_witness", F.col("_digest").alias("_subroot"), "_root")
    rows = descend(levels, above, arity, height)
    return rows.select(F.col("_id").alias(id_col), F.col("_source").alias(source_col), F.col("_digest").alias("leaf"), F.col("_pos").alias("position"),
                       F.col("_witness").alias("witness"), F.col("_subroot").alias("subroot"), F.col("_root").alias("root"),
                       *[F.col(f"_c_{n}").alias(n) for n in carry])


def manifest_digest(docs: DataFrame, **options) -> DataFrame:
    """Tampered rows (even CRC-32 of the decimal doc_id; a null id counts as empty) lose the line ends of their text."""
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = manifest(docs, carry={"tampered": leaf_digest([text if c == "text" else F.col(c) for c in FIELDS])}, **options)
    proof = F.sha2(F.replace(F.array_join("witness", ""), F.lit("*"), F.lit("")), 256)
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), fold(F.col("tampered"), F.col("witness")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = """
WITH RECURSIVE part AS (
  SELECT *, list_transform(range(256), lambda k: list_reduce(list_prepend(k, range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS steps
  FROM (SELECT doc_id, source, lang, n_chars, text FROM documents)),
told AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1)))),
                lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS crc FROM part),
field AS (
  SELECT doc_id, source, crc, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM told),
leaf AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h, sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS bad,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM field),
node AS (
  SELECT source, 0 AS lvl, idx, h, n FROM leaf
  UNION ALL
  SELECT source, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM node WHERE n > 1 GROUP BY source, lvl, idx // 3, n),
sub AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM node WHERE n = 1),
crown AS (
  SELECT 0 AS lvl, idx, h, n FROM sub
  UNION ALL
  SELECT lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM crown WHERE n > 1 GROUP BY lvl, idx // 3, n),
place AS (SELECT leaf.*, sub.idx AS top, sub.h AS subroot FROM leaf JOIN sub ON leaf.source IS NOT DISTINCT FROM sub.source),
step AS (
  SELECT p.doc_id, 0 AS phase, m.lvl, string_agg(CASE WHEN m.idx = p.idx // CAST(power(3, m.lvl) AS BIGINT) THEN '*' ELSE m.h END, '' ORDER BY m.idx) AS run
  FROM place p JOIN node m ON p.source IS NOT DISTINCT FROM m.source AND m.n > 1 AND m.idx // 3 = p.idx // CAST(power(3, m.lvl + 1) AS BIGINT)
  GROUP BY p.doc_id, m.lvl
  UNION ALL
  SELECT p.doc_id, 1, m.lvl, string_agg(CASE WHEN m.idx = p.top // CAST(power(3, m.lvl) AS BIGINT) THEN '*' ELSE m.h END, '' ORDER BY m.idx)
  FROM place p JOIN crown m ON m.n > 1 AND m.idx // 3 = p.top // CAST(power(3, m.lvl + 1) AS BIGINT) GROUP BY p.doc_id, m.lvl),
path AS (SELECT doc_id, list(run ORDER BY phase, lvl) AS runs FROM step GROUP BY doc_id)
SELECT p.doc_id, p.h AS leaf, p.subroot, crown.h AS root,
       sha256(replace(array_to_string(coalesce(runs, []), ''), '*', '')) AS proof_sha256,
       list_reduce(list_prepend(p.bad, coalesce(runs, [])), lambda h, run: sha256(replace(run, '*', h))) AS folded_root, folded_root = root AS verified
FROM place p JOIN crown ON crown.n = 1 LEFT JOIN path ON p.doc_id = path.doc_id
"""
