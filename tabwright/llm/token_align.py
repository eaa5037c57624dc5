"""Cross-tokenizer alignment by galloping intersection.

Two tokenizers cut the same bytes; their ascending lists of end offsets are intersected, the shorter
list driving an exponential and then binary search into the longer.  Offsets in both lists cut the
tokens into groups; the difference between the ranks of a token's start and end in the other
list is the range of tokens it overlaps.

1. One Arrow pass encodes and aligns a block of documents (``BLOCK`` bytes of text, or one longer
   text in slices) at a time.  Text is cut before a space behind a character that is no white
   space, where both tokenizers must cut (checked for the piece vocabulary when it is read), so each
   distinct word is encoded once per task, and a word's start is a rank known in both lists: the
   searches start there, and a text of any length is aligned slice by slice.
2. A block's row holds its documents' figures, the block's distinct (A id, B id) pairs with the
   number of documents that hold each, and for every document references to its pairs, packed.  The
   table is written once; pairs, not links, are what the shuffles move.
3. Pair counts are summed over blocks, the highest count of an A id is taken over its pairs, and
   both return to the blocks on (pair, salt).
4. Blocks meet their pairs' counts in a cogroup by block and give one row a document.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte by byte,
have no tokens and an empty string for their groups; rows that repeat an id are documents of their
own; an empty table gives an empty table; further columns are not kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, materialise

RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
BLOCK, SLICE, WORDS, IDS_A_WORD = 4 << 20, 1 << 19, 300_000, 16
#: Before a space that follows a character which no tokenizer takes for white space, if a character follows.
WORD = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
_PAIRS: dict[tuple, TokenizerPair] = {}


def gallop(wanted: np.ndarray, ends: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """For each wanted offset the number of ``ends`` (ascending) below it.

    ``start`` holds ranks that are not above the result; from there steps of 1, 2, 4, ... pass the
    offset and the last step is searched by halving, all wanted offsets at a time."""
    low = np.zeros(len(wanted), np.int64) if start is None else start.astype(np.int64)
    high, step, open_ = low.copy(), 1, np.arange(len(wanted))
    while len(open_):
        inside = open_[high[open_] < len(ends)]
        open_ = inside[ends[high[inside]] < wanted[inside]]  # the rank is above high
        low[open_] = high[open_] + 1
        high[open_] = np.minimum(high[open_] + step, len(ends))
        step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        mid = (low[open_] + high[open_]) // 2
        below = ends[mid] < wanted[open_]
        low[open_[below]] = mid[below] + 1
        high[open_[~below]] = mid[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


def overlaps(short: np.ndarray, long: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(common, first, last): which short ends are ends in both lists, and the range of long tokens that each short token overlaps."""
    rank = gallop(short, long, start)
    common = long[rank] == short if len(short) else np.zeros(0, bool)
    first = np.concatenate(([0], (rank + common)[:-1])).astype(np.int64)[:len(short)]
    return common, first, rank


class TokenizerPair:
    """Words to ids of both vocabularies, each distinct word encoded once (about ``WORDS`` of them, and their ids, are held)."""

    def __init__(self, ranks_file: str, pieces_file: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        def place(name: str) -> str:
            return name if "/" in name else public_tokenizers.path(name)

        with open(place(ranks_file), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._b = sentencepiece.SentencePieceProcessor(model_file=place(pieces_file))
        pieces = self._b.id_to_piece(list(range(self._b.get_piece_size())))
        assert not any("▁" in p.lstrip("▁") for p in pieces), "a piece crosses the start of a word"
        self.bytes_a = [b"" for _ in range(max(ranks.values()) + 1)]
        for b, i in ranks.items():
            self.bytes_a[i] = b
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        marked = [f"{i}{mark}" for n in (len(self.bytes_a), len(self.bytes_b)) for i in range(n) for mark in ",;|"]
        self.shown = pa.array([x.encode() for x in marked], pa.binary())
        self._forget()

    def _forget(self) -> None:
        none = np.zeros(0, np.int64)
        self._place: dict[str, int] = {}
        self._good, self._ids, self._counts, self._starts = none.astype(bool), (none, none), (none, none), (none, none)

    def words(self, text: str, slice_chars: int) -> Iterator[list[str]]:
        """Space and text, cut where both vocabularies cut, about ``slice_chars`` characters at a time."""
        text, at = " " + text, 0
        while at < len(text):
            cut = WORD.search(text, at + slice_chars) if len(text) - at > slice_chars else None
            end = cut.start() if cut else len(text)
            yield WORD.split(text[at:end])
            at = end

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, tuple]:
        """(ok by word, counts of A and B ids by word, ids of A and B)."""
        if len(self._place) > WORDS or len(self._ids[0]) > IDS_A_WORD * WORDS:
            self._forget()
        place = self._place
        new = list(dict.fromkeys(w for w in words if w not in place))
        if new:
            found = [self._a(w) for w in new], self._b.encode([w[1:] for w in new], num_threads=1)  # the model adds the space
            good = [b"".join([self.bytes_a[i] for i in a]) == w.encode() == b"".join([self.bytes_b[i] for i in b]) for w, a, b in zip(new, *found)]
            place.update(zip(new, range(len(place), len(place) + len(new))))
            self._good = np.concatenate((self._good, good))
            self._ids = tuple(np.concatenate((old, [i for x in ids for i in x])).astype(np.int64) for old, ids in zip(self._ids, found))
            self._counts = tuple(np.concatenate((old, [len(x) for x in ids])) for old, ids in zip(self._counts, found))
            self._starts = tuple(np.cumsum(c) - c for c in self._counts)
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        good = self._good[at]
        at = at[good]  # a text with other words has no tokens at all
        counts = tuple(c[at] for c in self._counts)
        ids = tuple(flat[_ranges(start[at], n)] for flat, start, n in zip(self._ids, self._starts, counts))
        return good, counts, ids


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count of them) for each element, in one array."""
    end = np.cumsum(count)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - count), count)


def tokenizer_pair(ranks: str = RANKS, pieces: str = PIECES) -> TokenizerPair:
    if (ranks, pieces) not in _PAIRS:
        _PAIRS[ranks, pieces] = TokenizerPair(ranks, pieces)
    return _PAIRS[ranks, pieces]


class Block:
    """The documents of one block row, filled slice by slice."""

    def __init__(self, pair: TokenizerPair):
        self.pair, self.ids, self.bytes = pair, [], 0
        self.figures, self.ok, self.hashes, self._keys, self._times = [], [], [], [], []

    def add(self, texts: list[tuple[object, str]]) -> None:
        """Whole documents (id, text), in slices of about SLICE characters."""
        words, owner, size = [], [], 0  # of the slice
        for doc, text in texts:
            self.ids.append(doc)
            self.bytes += len(text)
            self.figures.append(np.zeros(len(FIGURES), np.int64))
            self.ok.append(bool(text))
            self.hashes.append(None)
            if not text:
                continue
            for cut in self.pair.words(text, SLICE):  # a long text slice by slice
                words += cut
                owner += [len(self.ids) - 1] * len(cut)
                size += sum(map(len, cut))
                if size >= SLICE:
                    self._align(words, np.array(owner))
                    words, owner, size = [], [], 0
        if words:
            self._align(words, np.array(owner))

    def _align(self, words: list[str], owner: np.ndarray) -> None:
        good, counts, ids = self.pair.look_up(words)
        for d in np.unique(owner[~good]):
            self.ok[d] = False
        owner = owner[good]
        ends = [np.cumsum(sizes[x]) for sizes, x in zip((self.pair.size_a, self.pair.size_b), ids)]
        drive = int(len(ends[1]) < len(ends[0]))  # the shorter list drives
        other = 1 - drive
        before = np.cumsum(counts[other]) - counts[other]  # rank of a word's start in the longer list
        common, first, last = overlaps(ends[drive], ends[other], np.repeat(before, counts[drive]))
        # links
        n = last - first + 1
        short, long = np.repeat(ids[drive], n), ids[other][_ranges(first, n)]
        a, b = (short, long) if drive == 0 else (long, short)
        who = np.repeat(np.repeat(owner, counts[drive]), n)
        width = len(self.pair.bytes_b).bit_length()
        keys, times = np.unique((who << 40) | (a << width) | b, return_counts=True)
        self._keys.append(keys)
        self._times.append(times)
        # group of each token, and its place when every group shows its A ids and then its B ids
        cut = np.zeros(len(ends[other]), np.int64)
        cut[last[common]] = 1
        cuts = [common.astype(np.int64), cut] if drive == 0 else [cut, common.astype(np.int64)]
        group = [np.cumsum(c) - c for c in cuts]
        stop = [np.flatnonzero(c) + 1 for c in cuts]  # ids up to the end of each group
        place_a = np.arange(len(ids[0])) + np.concatenate(([0], stop[1]))[group[0]]
        place_b = np.arange(len(ids[1])) + stop[0][group[1]]
        line = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        line[place_a] = 3 * ids[0] + 2 * cuts[0]
        line[place_b] = 3 * (ids[1] + len(self.pair.bytes_a)) + cuts[1]
        shown = self.pair.shown.take(pa.array(line))
        offsets, data = np.frombuffer(shown.buffers()[1], np.int32), memoryview(shown.buffers()[2] or b"")
        # figures of each document's part of the slice
        docs, at = np.unique(owner, return_index=True)
        edge = [np.concatenate((np.cumsum(c) - c, [c.sum()]))[np.concatenate((at, [len(owner)]))] for c in counts]
        links = np.concatenate(([0], np.cumsum(n)))
        groups = np.concatenate(([0], np.cumsum(cuts[0])))
        for k, d in enumerate(docs):
            (a0, a1), (b0, b1) = ((int(e[k]), int(e[k + 1])) for e in edge)
            s0, s1 = ((a0, a1), (b0, b1))[drive]
            self.figures[d] += (a1 - a0, b1 - b0, groups[a1] - groups[a0], links[s1] - links[s0])
            if self.hashes[d]:
                self.hashes[d].update(b";")
            else:
                self.hashes[d] = hashlib.sha256()
            self.hashes[d].update(data[offsets[a0 + b0]:offsets[a1 + b1] - 1])

    def row(self, number: int) -> dict:
        """Columns of the block's row; refs and times run over the documents' pairs, in order."""
        ok = np.array(self.ok, bool)
        keys, times = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self._keys, self._times))
        keep = ok[keys >> 40] if len(keys) else np.zeros(0, bool)
        keys, inverse = np.unique(keys[keep], return_inverse=True)  # a text in several slices
        times = np.bincount(inverse, times[keep], len(keys)).astype(np.int64)
        pairs, refs = np.unique(keys & ((1 << 40) - 1), return_inverse=True)
        held = np.bincount(keys >> 40, minlength=len(ok)) if len(keys) else np.zeros(len(ok), np.int64)
        width = len(self.pair.bytes_b).bit_length()
        figures = np.array(self.figures).reshape(-1, len(FIGURES)) * ok[:, None]
        return {"block": number, "ids": self.ids, **{f: figures[:, i] for i, f in enumerate(FIGURES)},
                "groups_sha256": [h.hexdigest() if h and good else "" for h, good in zip(self.hashes, ok)],
                "held": held, "refs": _pack(refs), "times": _pack(times),
                "a": (pairs >> width).astype(np.int32), "b": (pairs & ((1 << width) - 1)).astype(np.int32),
                "docs": np.bincount(refs, minlength=len(pairs)).astype(np.int32)}


def _pack(x: np.ndarray) -> bytes:
    return pa.compress(x.astype("<u4").tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def _unpack(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(x, 4 * n, codec="zstd", asbytes=True), "<u4").astype(np.int64) if n else np.zeros(0, np.int64)


def _blocks(docs: DataFrame, id_col: str, text_col: str, ranks: str, pieces: str) -> DataFrame:
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    longs = T.ArrayType(T.LongType())
    fields = [("block", T.LongType()), ("ids", T.ArrayType(rows.schema[id_col].dataType)), *[(f, longs) for f in FIGURES],
              ("groups_sha256", T.ArrayType(T.StringType())), ("held", longs), ("refs", T.BinaryType()), ("times", T.BinaryType()),
              *[(c, T.ArrayType(T.IntegerType())) for c in ("a", "b", "docs")]]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        pair, arrow = tokenizer_pair(ranks, pieces), to_arrow_schema(schema)
        number = TaskContext.get().partitionId() << 32

        def shown(block: Block) -> pa.RecordBatch:
            row = block.row(number)
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], names=arrow.names)

        block = Block(pair)
        for b in batches:
            ids, texts, held, size = b.column(0), b.column(1), [], 0
            for i in range(b.num_rows):
                text = texts[i].as_py()
                held.append((ids[i].as_py(), text))
                size += len(text)
                if block.bytes + size >= BLOCK:
                    block.add(held)
                    yield shown(block)
                    number, block, held, size = number + 1, Block(pair), [], 0
            block.add(held)
        if block.ids:
            yield shown(block)

    return rows.mapInArrow(run, schema)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, pieces: str = PIECES) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per input row."""
    blocks = materialise(_blocks(docs, id_col, text_col, ranks, pieces))
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("ref", "p")).select(
        "block", "ref", "p.a", "p.b", "p.docs")
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    counts = materialise(counts)
    # an A id has at most as many pairs as the other vocabulary has ids
    best = counts.groupBy("a").agg(F.max("count").alias("_most"))
    counts = counts.join(best, "a").select("a", "b", "count", (F.col("count") == F.col("_most")).alias("best"))
    found = attach(pairs.select("block", "ref", "a", "b"), counts, ["a", "b"], ["block"]).select(F.col("block").alias("_block"), "ref", "count", "best")
    kind = blocks.schema["ids"].dataType.elementType
    longs = [*FIGURES, "n_best", "count_sum"]
    schema = T.StructType([T.StructField(id_col, kind), *[T.StructField(c, T.LongType()) for c in longs], T.StructField("groups_sha256", T.StringType())])
    rows = blocks.select("block", "ids", *FIGURES, "groups_sha256", "held", "refs", "times")
    return rows.groupBy("block").cogroup(found.groupBy("_block")).applyInArrow(_weighted(id_col), schema)


def _weighted(id_col: str):
    def weighted(rows, found):
        row = {c: rows.column(c)[0] for c in rows.column_names}
        held = np.array(row["held"].as_py(), np.int64)
        refs, times = (_unpack(row[c].as_py(), int(held.sum())) for c in ("refs", "times"))
        count, best = np.zeros((2, found.num_rows), np.int64)
        at = found.column("ref").to_numpy()
        count[at], best[at] = found.column("count").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
        ends = np.cumsum(held)

        def total(x: np.ndarray) -> np.ndarray:
            run = np.concatenate(([0], np.cumsum(x)))
            return run[ends] - run[ends - held]

        return pa.table({id_col: row["ids"].values, **{f: row[f].values for f in FIGURES}, "n_best": total(times * best[refs]),
                         "count_sum": total(times * count[refs]), "groups_sha256": row["groups_sha256"].values})
    return weighted


def align_digest(docs: DataFrame) -> DataFrame:
    return align(docs).select("doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256")
