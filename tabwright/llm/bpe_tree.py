"""Byte-level BPE encoding and decoding by monoid tree reduction.

The element of the monoid is a text with its ids; joining two elements gives the ids of the two
texts put together without encoding them again.  Only a window around the seam is encoded: it
grows on both sides until it meets a position where the splitting pattern must cut whatever lies
around it (white space after a character that is none, a digit beside a letter).  Such a
position ends a match for the text before it as the end of the text does, and the text behind it is
matched without looking back, so the tokens outside the window are those of the whole.  Where no
such position exists the window grows to the ends of the texts, so the join is always exact.

1. A text is halved until a half has at most ``LEAF`` characters; leaves are encoded by the
   library, halves are joined upwards, in one Arrow pass.
2. A text above ``PART`` characters is cut into parts, each a row of its own: parts are encoded
   in parallel and joined pairwise, one grouping by (text, pair) a level.  Equal long texts are
   encoded once, and no task is given more than two neighbours.
3. Decoding maps id ranges to bytes and concatenates them up the same tree.

Defined results: null and empty texts have no ids; special strings are ordinary text; repeated rows
are results of their own; an empty table gives an empty table; further columns are not kept.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, materialise

VOCABULARY, LEAF, PART = "byte_bpe_multi_50k.tiktoken", 4096, 1 << 16
#: Positions where the pattern cuts in every context.  ``\S`` leaves out more than the pattern's own white space does.
CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")
_CODECS: dict[str, Codec] = {}


class Codec:
    """A ranks file with the pattern that splits text; ids are uint32 arrays."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        import tiktoken

        self.plain = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.leaf = leaf
        by_id = sorted(ranks.items(), key=lambda x: x[1])
        assert [i for _, i in by_id] == list(range(len(by_id))), "ids must be gapless"
        self.entries = pa.array([b for b, _ in by_id], pa.binary())
        self.sizes = np.array([len(b) for b, _ in by_id])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.plain(text), "<u4")

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= self.leaf:
            return self._ids(text)
        half = len(text) // 2
        return self.join(text[:half], self.encode(text[:half]), text[half:], self.encode(text[half:]))

    def join(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
        """The ids of left + right from those of both."""
        a, b = _last_cut(left), _first_cut(right)
        keep = len(left_ids) - _covering(self.sizes, left_ids[::-1], len(left[a:].encode()))
        skip = _covering(self.sizes, right_ids, len(right[:b].encode()))
        return np.concatenate((left_ids[:keep], self._ids(left[a:] + right[:b]), right_ids[skip:]))

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        if len(ids) <= self.leaf:
            found = self.entries.take(pa.array(ids))
            return found.buffers()[2].to_pybytes()[:int(self.sizes[ids].sum())]
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _last_cut(text: str) -> int:
    """The last certain cut inside the text, looked for in growing windows from its end; else 0."""
    reach = 64
    while True:
        start = max(len(text) - reach, 1)
        found = [m.start() for m in CUT.finditer(text, start)]
        if found or start == 1:
            return found[-1] if found else 0
        reach *= 4


def _first_cut(text: str) -> int:
    m = CUT.search(text, 1)
    return m.start() if m else len(text)


def _covering(sizes: np.ndarray, ids: np.ndarray, n: int) -> int:
    """How many of the first ids hold n bytes; the n-th byte ends a token."""
    reach = 64
    while reach < len(ids) and sizes[ids[:reach]].sum() < n:
        reach *= 4
    ends = np.cumsum(sizes[ids[:reach]])
    k = int(np.searchsorted(ends, n)) + 1 if n else 0
    assert not n or ends[k - 1] == n, "the seam's window does not end with a token"
    return k


def codec(vocabulary: str = VOCABULARY) -> Codec:
    """``vocabulary`` is a ranks file: a path, or a name in public_tokenizers."""
    if vocabulary not in _CODECS:
        import public_tokenizers

        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CODECS[vocabulary] = Codec(ranks, public_tokenizers.PATTERN)
    return _CODECS[vocabulary]


def _mapped(rows: DataFrame, keep: int, out: str, start: Callable[[], Callable]) -> DataFrame:
    """The first ``keep`` columns, and the second one through the function that ``start`` makes in the task."""
    names = [*rows.columns[:keep], out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = start()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:keep], pa.array([f(x.as_py()) for x in b.column(1)], pa.binary())], names=names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:keep], T.StructField(out, T.BinaryType())]))


def _long_ids(texts: DataFrame, vocabulary: str, part: int) -> DataFrame:
    """(_key, ids) of texts (_key, _text), one row each, by a tree of parts."""
    parts = "_key string, _node long, _text string, _ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, text in zip(b.column(0), b.column(1)):
                text = text.as_py()
                for node, at in enumerate(range(0, len(text), part)):
                    yield pa.RecordBatch.from_arrays([pa.array([key.as_py()]), pa.array([node], pa.int64()), pa.array([text[at:at + part]])],
                                                     names=["_key", "_node", "_text"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.encode(t.as_py()).tobytes() for t in b.column(2)], pa.binary())],
                                             names=["_key", "_node", "_text", "_ids"])

    def pair(key, rows):
        two = sorted(rows.to_pylist(), key=lambda r: r["_node"])
        text, ids = two[0]["_text"], two[0]["_ids"]
        if len(two) == 2:
            ids = codec(vocabulary).join(text, np.frombuffer(ids, "<u4"), two[1]["_text"], np.frombuffer(two[1]["_ids"], "<u4")).tobytes()
            text += two[1]["_text"]
        return pa.table({"_key": [two[0]["_key"]], "_node": pa.array([two[0]["_node"] // 2], pa.int64()), "_text": [text], "_ids": pa.array([ids], pa.binary())})

    spread = texts.mapInArrow(cut, "_key string, _node long, _text string").repartition("_key", "_node")
    nodes = materialise(spread.mapInArrow(leaves, parts))
    most = nodes.agg(F.max("_node")).first()[0] or 0
    while most:  # one level a turn
        nodes, most = nodes.groupBy("_key", F.floor(F.col("_node") / 2)).applyInArrow(pair, parts), most // 2
    return nodes.select("_key", F.col("_ids").alias("ids"))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, part: int = PART) -> DataFrame:
    """(id, ids binary): the text's ids as little-endian unsigned 32-bit integers."""
    def start():
        c = codec(vocabulary)
        return lambda text: c.encode(text).tobytes()

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    short = _mapped(rows.filter(F.length("_text") <= part), 1, "ids", start)
    long = rows.filter(F.length("_text") > part).withColumn("_key", F.sha2("_text", 256))
    keys = materialise(long.select(id_col, "_key"))
    if keys.isEmpty():
        return short
    found = materialise(_long_ids(long.select("_key", "_text").dropDuplicates(["_key"]), vocabulary, part))
    return short.unionByName(attach(keys, found, ["_key"], [id_col]).select(id_col, "ids"))


def decode(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, ids, bytes binary) of rows as ``encode`` returns them; null ids decode to null."""
    def start():
        c = codec(vocabulary)
        return lambda ids: None if ids is None else c.decode(np.frombuffer(ids, "<u4"))

    return _mapped(coded.select(id_col, F.col(ids_col).alias("ids")), 2, "bytes", start)


def codec_digest(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    back = decode(encode(docs, vocabulary=vocabulary), vocabulary=vocabulary)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))
