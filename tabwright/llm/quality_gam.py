"""Quality classifier: a generalised additive model with pairwise interactions.

Fitting: boosting goes round the features again and again; each visit fits a shallow tree
(up to four leaves) on one binned feature and adds a small step to that feature's lookup
table.  Then the pairs with the largest remaining gain get two-dimensional tables the same
way.  Scoring: bins are looked up and added, vectorised over a batch.

Features come from the text alone (byte classes, words, lines, compressibility).  The
model is fitted on the driver from at most ``fit_rows`` labelled documents, chosen by a
hash of the id (a documented bound); scoring covers every row in Arrow batches.

Defined results: a null text counts as empty and empty texts are scored like any other;
labels that are null or held out are not used; several labels of one id are averaged;
without any usable label nothing is known against a text and every score is 1; repeated
rows score alike; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIT_ROWS, THRESHOLD = 20_000, 0.7
FEATURES = (
    "log_bytes", "log_words", "mean_word", "upper", "digits", "symbols", "marks", "bangs", "stops", "spaces", "non_ascii", "controls",
    "unique_words", "top_word", "short_words", "marked_words", "repeated_lines", "mean_line", "compressed", "unique_pairs",
)
_PIECE = 1 << 22


def _cells(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _LOWER, _DIGIT = (_cells(bytes(range(a, b + 1))) for a, b in ((65, 90), (97, 122), (48, 57)))
_SPACE, _HIGH, _CONTROL = _cells(b" \t\n\r\x0b\x0c"), _cells(bytes(range(128, 256))), _cells(bytes(range(9)) + bytes(range(14, 32)))
_MARK, _BANG, _STOP = _cells(b"#$%&*|<>{}[]@^~=_+\\/`"), _cells(b"!?"), _cells(b".,;:")
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _HIGH | _CONTROL)
_MARKED = tuple(bytes([c]) for c in np.flatnonzero(_MARK | _BANG))


def text_features(text: bytes) -> np.ndarray:
    """The features of one UTF-8 text; memory follows its distinct words, not its length."""
    n = len(text)
    words, lines, pairs = Counter(), Counter(), set()
    count = short = marked = line_count = packed = 0
    cells, at = np.zeros(256, np.int64), 0
    while at < n:
        end = min(n, at + _PIECE)
        while end < n and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        piece = text[at:end]
        cells += np.bincount(np.frombuffer(piece, np.uint8), minlength=256)
        got = piece.split()
        words.update(got)
        pairs.update(map(hash, zip(got, got[1:])))
        count += len(got)
        short += sum(len(w) <= 3 for w in got)
        marked += sum(w.endswith(_MARKED) for w in got)
        split = piece.split(b"\n")
        lines.update(split)
        line_count += len(split)
        packed += len(zlib.compress(piece, 1))
        at = end
    total, w, letters = max(n, 1), max(count, 1), max(int(cells[_UPPER | _LOWER].sum()), 1)
    share = lambda c: cells[c].sum() / total
    return np.array([
        np.log1p(n), np.log1p(count), n / w, cells[_UPPER].sum() / letters, share(_DIGIT), share(_SYMBOL), share(_MARK), share(_BANG),
        share(_STOP), share(_SPACE), share(_HIGH), share(_CONTROL), len(words) / w, max(words.values(), default=0) / w, short / w,
        marked / w, 1 - len(lines) / max(line_count, 1), n / max(line_count, 1), packed / total, len(pairs) / max(count - 1, 1)])


class PairwiseGam:
    """Binned additive model: one table per feature, one per chosen pair."""

    def __init__(self, bins: int = 32, coarse: int = 8, rounds: int = 150, pair_rounds: int = 60, pairs: int = 8, step: float = 0.15,
                 least: float = 5.0):
        self.bins, self.coarse, self.rounds, self.pair_rounds, self.pairs, self.step, self.least = bins, coarse, rounds, pair_rounds, pairs, step, least

    def _binned(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fine = np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], axis=1)
        rough = np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.rough_cuts)], axis=1)
        return fine, rough

    def _leaves(self, g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
        """Leaf values of a tree over ordered bins from gradient and weight sums."""
        gs, hs = np.cumsum(g), np.cumsum(h)
        value = np.full(len(g), gs[-1] / (hs[-1] + 1.0))
        if depth and len(g) > 1:
            gl, hl = gs[:-1], hs[:-1]
            gr, hr = gs[-1] - gl, hs[-1] - hl
            gain = np.where((hl >= self.least / 4) & (hr >= self.least / 4), gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1), -np.inf)
            cut = int(gain.argmax()) + 1
            if gain[cut - 1] > gs[-1] ** 2 / (hs[-1] + 1) + 1e-9:
                value = np.concatenate((self._leaves(g[:cut], h[:cut], depth - 1), self._leaves(g[cut:], h[cut:], depth - 1)))
        return value

    def _grid(self, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        """A tree on two binned features: one cut of the first, then one of the second on each side."""
        best = (-np.inf, np.zeros_like(g))
        total = g.sum() ** 2 / (h.sum() + 1)
        for swap in (False, True):
            gg, hh = (g.T, h.T) if swap else (g, h)
            for cut in range(1, len(gg)):
                out, gain = np.zeros_like(gg), 0.0
                for side in (slice(0, cut), slice(cut, None)):
                    a, b = gg[side].sum(axis=0), hh[side].sum(axis=0)
                    leaf = self._leaves(a, b, 1)
                    out[side] = leaf
                    gain += float((2 * leaf * a - leaf ** 2 * (b + 1e-9)).sum())
                if gain - total > best[0]:
                    best = (gain - total, out.T if swap else out)
        return best[1], best[0]

    def fit(self, x: np.ndarray, y: np.ndarray) -> PairwiseGam:
        quantiles = lambda n: [np.unique(np.quantile(c, np.linspace(0, 1, n + 1)[1:-1])) for c in x.T]
        self.cuts, self.rough_cuts = quantiles(self.bins), quantiles(self.coarse)
        fine, rough = self._binned(x)
        base = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(base / (1 - base)))
        self.tables = np.zeros((x.shape[1], self.bins + 1))
        raw = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for j in range(x.shape[1]):
                p = 1 / (1 + np.exp(-raw))
                g = np.bincount(fine[:, j], y - p, self.bins + 1)
                h = np.bincount(fine[:, j], p * (1 - p), self.bins + 1)
                self.tables[j] += (add := self.step * np.clip(self._leaves(g, h), -4, 4))
                raw += add[fine[:, j]]
        side = self.coarse + 1

        def grids(j: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = rough[:, j] * side + rough[:, k]
            p = 1 / (1 + np.exp(-raw))
            return at, np.bincount(at, y - p, side * side).reshape(side, side), np.bincount(at, p * (1 - p), side * side).reshape(side, side)

        ranked = sorted(((-self._grid(*grids(j, k)[1:])[1], j, k) for j, k in combinations(range(x.shape[1]), 2)))[:self.pairs]
        self.pair_tables = {(j, k): np.zeros(side * side) for _, j, k in ranked}
        for _ in range(self.pair_rounds):
            for (j, k), table in self.pair_tables.items():
                at, g, h = grids(j, k)
                add = self.step * np.clip(self._grid(g, h)[0], -4, 4).ravel()
                table += add
                raw += add[at]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        fine, rough = self._binned(x)
        raw = self.base + self.tables[np.arange(x.shape[1]), fine].sum(axis=1)
        for (j, k), table in self.pair_tables.items():
            raw = raw + table[rough[:, j] * (self.coarse + 1) + rough[:, k]]
        return 1 / (1 + np.exp(-raw))


def held_out(id_col: Column) -> Column:
    """True for ids whose CRC-32 as text leaves 2 modulo 4: never learnt from."""
    return F.coalesce(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2, F.lit(False))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
              fit_rows: int = FIT_ROWS) -> PairwiseGam | None:
    """Model from at most ``fit_rows`` labelled, not held-out documents; None without any."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(id_col).agg(F.avg(label_col).alias("_y"))
    known = known.join(docs.select(id_col).distinct(), id_col, "left_semi")
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(fit_rows).select(F.col(id_col).alias("_known"), "_y")
    rows = _texts(docs, id_col, text_col)
    rows = rows.join(F.broadcast(chosen), rows[id_col] == F.col("_known")).select(id_col, "_y", "_text")  # fit_rows rows at most
    schema = T.StructType([rows.schema[id_col], T.StructField("y", T.DoubleType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([text_features(t.as_py()).tolist() for t in b.column(2)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), x], names=[id_col, "y", "x"])

    got = rows.mapInArrow(run, schema).groupBy(id_col).agg(F.min("y").alias("y"), F.min("x").alias("x"))  # one row an id
    got = sorted((r[0], r[1], r[2]) for r in got.collect())
    if not got:
        return None
    return PairwiseGam().fit(np.array([r[2] for r in got]), np.array([r[1] for r in got]))


def score(docs: DataFrame, model: PairwiseGam | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with ``_score``."""
    names = docs.columns
    rows = docs.select(*names, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    schema = T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if model is None or not b.num_rows:
                got = np.ones(b.num_rows)
            else:
                got = model.score(np.stack([text_features(t.as_py()) for t in b.column(b.num_columns - 1)]))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got)], names=[*names, "_score"])

    return rows.mapInArrow(run, schema)


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    scored = score(docs.select("doc_id", "text"), fit_model(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def quality_filter(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all their columns."""
    return score(docs, fit_model(docs, labels)).filter(F.col("_score") >= threshold).select(*docs.columns)
