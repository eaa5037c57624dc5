"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

1. Sources share ``share`` times all words by weight; a target stops at ``max_copies``
   times its source's size and the excess is shared anew by weight until none is above.
2. A document's expected copies are target / source size (times an optional preference,
   normalised).  Whole copies are certain; the fraction is its inclusion probability p.
3. Documents of a source are ranked by Q = (U / (1 - U)) / (p / (1 - p)), U a fixed hash
   of seed, id, text and, among rows that repeat both, their number; they are taken in that
   order while the words still fit the target.  The gap a long document leaves is filled by the
   same rule among the remaining documents that fit, until none fits any gap.

Running sums are built per (source, block of Q), with a block for about ``ROWS_A_BLOCK`` rows:
no task ever holds a whole source.

Defined results: null and empty texts have size 0 and are taken 0 words; the null source
is a source of its own, last; rows that repeat id and text are documents of their own and may
be taken differently often; sources of size 0 have target 0; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.rank import row_number_by
from tabwright.session import ensure_checkpoint_dir

from .common import NOT_SPACE, attach, materialise, prefixed, same, with_block_rank

WEIGHTS, SHARE, MAX_COPIES, ROWS_A_BLOCK, SEED = (5.0, 2.0, 1.0), 1.5, 2, 4096, "mix"
_KEY = ("_id", "source", "size", "_x")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def uniform(seed: str, *parts: Column) -> Column:
    """A fixed U in (0, 1) from 48 bits of a hash; the same in every run and engine."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_copies: float) -> DataFrame:
    """(source, source_size, target) from (source, size).

    The loop reads two sums a round back to the driver, never the sources; it ends when
    no further source reaches its limit, at most once per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = row_number_by(per, [F.col("source").isNull(), F.col("source")], out="_place")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = materialise(per.select("source", F.col("source_size").cast("long"), w.alias("_w")))
    cap = F.col("source_size") * F.lit(float(max_copies))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    goal, level, full = share * total, None, -1
    while True:
        over = F.lit(False) if level is None else cap <= F.lit(level) * F.col("_w")
        n, kept, free = per.agg(F.sum(over.cast("long")), F.sum(F.when(over, cap).otherwise(0.0)),
                                F.sum(F.when(over, 0.0).otherwise(F.col("_w")))).first()
        if not free or n == full:
            break
        full, level = n, (goal - kept) / free
    target = F.lit(0.0) if level is None else F.least(cap, F.lit(level) * F.col("_w"))
    return per.select("source", "source_size", target.alias("target"))


def numbered(base: DataFrame) -> DataFrame:
    """Rows that repeat _KEY (and _pref), numbered from 0: (…, _n, _k), _n of them.

    They are alike, so their number need not be tied to a row; a count of any size unfolds in pieces that are spread."""
    units = base.groupBy(*_KEY, "_pref").agg(F.count(F.lit(1)).alias("_n"))
    cut = units.withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(ROWS_A_BLOCK).cast("long"))))
    cut = cut.repartition("_id", "_x", "_first")
    last = F.least(F.col("_first") + (ROWS_A_BLOCK - 1), F.col("_n") - 1)
    return cut.withColumn("_k", F.explode(F.sequence("_first", last))).drop("_first")


def allocate(rows: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES, rows_a_block: int = ROWS_A_BLOCK) -> DataFrame:
    """rows: (…, source, size, _u, _pref), one a document.  Adds source_size, target and copies."""
    rows = attach(rows, targets, ["source"], ["_id", "_k"])
    if "_mean" not in rows.columns:
        rows = rows.withColumn("_mean", F.lit(1.0))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("_pref") / F.col("_mean")).otherwise(0.0)
    rate = F.least(F.lit(float(max_copies)), rate)
    state = rows.withColumn("copies", F.floor(rate).cast("long")).withColumn("_p", rate - F.floor(rate))
    q = F.when(F.col("_p") > 0, (F.col("_u") / (1 - F.col("_u"))) * ((1 - F.col("_p")) / F.col("_p"))).otherwise(
        F.lit(float("inf")))
    state = materialise(state.withColumn("_q", q))
    blocks = max(64, state.count() // rows_a_block)
    # rows without a fraction come last, in blocks of U: no block holds a whole source
    block = F.when(F.col("_q") == F.lit(float("inf")), blocks + F.floor(F.col("_u") * blocks)).otherwise(
        F.floor(F.col("_q") / (1 + F.col("_q")) * blocks))
    taken = state.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("_taken"))
    t = prefixed(targets.select("source", "target"), ["source"])
    first = materialise(taken.join(t, same(taken, t, ["source"])).select("source", "target", "_taken"))
    # A turn reads the rows that may still be taken and writes them, so plans do not grow with the turns: a checkpoint would
    # carry what is known of its columns (each turn's on the last one's) into every later plan, in the driver.
    spark = state.sparkSession
    folder, turn, left, gaps = f"{ensure_checkpoint_dir(spark)}/mixing-{uuid.uuid4().hex}", 0, state, first
    fits = (F.col("copies") < max_copies) & (F.col("size") > 0) & (F.col("size") <= F.col("_gap"))
    while True:  # each turn takes at least the first row that fits, and the gap falls below the next one
        wanted = attach(left, gaps.select("source", (F.col("target") - F.col("_taken")).alias("_gap")), ["source"], ["_id", "_k"])
        if wanted.filter(fits).isEmpty():
            break
        ranked = with_block_rank(wanted, ["source"], block, ["_q", "_id", "size", "_x", "_k"], "_before", weight=F.when(fits, F.col("size")).otherwise(0))
        new = fits & (F.col("_before") + F.col("size") <= F.col("_gap"))
        # gaps only fall: a row that does not fit now never will
        ranked.select(*state.columns, new.alias("_new"), (fits & ~new).alias("_left")).write.parquet(f"{folder}/turn={turn}")
        left = spark.read.parquet(f"{folder}/turn={turn}").filter("_left").select(*state.columns)
        turn += 1
        more = prefixed(spark.read.parquet(folder).filter("_new").groupBy("source").agg(F.sum("size").alias("_more")), ["source"])
        gaps = materialise(first.join(more, same(first, more, ["source"]), "left").select(
            "source", "target", (F.col("_taken") + F.coalesce("_more", F.lit(0))).alias("_taken")))
    if not turn:
        return state
    done = spark.read.parquet(folder).filter((~F.col("_left")) | (F.col("turn") == turn - 1))
    return done.select(*[c for c in state.columns if c != "copies"], (F.col("copies") + F.col("_new").cast("long")).alias("copies"))


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[float], share: float, max_copies: int,
             prefer: Column | None, seed: str) -> DataFrame:
    """(_id, source, size, _x, _pref, _n, _k, source_size, target, copies), one row per input row."""
    base = materialise(_sized(docs, id_col, text_col, source_col, prefer))
    targets = source_targets(base, weights, share, max_copies)
    if prefer is not None:
        means = base.groupBy("source").agg((F.sum(F.col("size") * F.col("_pref")) / F.sum("size")).alias("_mean"))
        means = prefixed(means, ["source"])
        targets = targets.join(means, same(targets, means, ["source"])).select(
            *targets.columns, F.coalesce("_mean", F.lit(1.0)).alias("_mean"))
    rows = numbered(base).withColumn("_u", uniform(seed, F.col("_id"), F.col("_x"), F.col("_k")))
    return allocate(materialise(rows), materialise(targets), max_copies)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, prefer: Column | None, *more: Column) -> DataFrame:
    pref = F.lit(1.0) if prefer is None else F.coalesce(prefer.cast("double"), F.lit(1.0))
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), words(text).alias("size"), F.xxhash64(text).alias("_x"),
                       pref.alias("_pref"), *more)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES, prefer: Column | None = None,
        seed: str = SEED) -> DataFrame:
    """One row per input row: (id, source, size, source_size, target, copies, taken).

    ``prefer`` is a positive preference per document: its expected copies are the source's
    rate times preference over the source's word-weighted mean preference."""
    plan = _planned(docs, id_col, text_col, source_col, weights, share, max_copies, prefer, seed)
    return plan.select(F.col("_id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies",
                       (F.col("size") * F.col("copies")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES, prefer: Column | None = None,
               seed: str = SEED) -> DataFrame:
    """The mixture itself: rows of ``docs``, each as often as the mix takes it."""
    plan = _planned(docs, id_col, text_col, source_col, weights, share, max_copies, prefer, seed)
    key = [*_KEY, "_pref"]
    plan = plan.select(*[F.col(k).alias("_r_" + k) for k in key], "_n", F.col("_k").alias("_r__k"), F.col("copies").alias("_copies"))
    rows = _sized(docs, id_col, text_col, source_col, prefer, F.struct(*[docs[c] for c in docs.columns]).alias("_row"))

    def as_often(met: DataFrame) -> DataFrame:
        return met.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")

    single = plan.filter("_n = 1 AND _copies > 0")
    out = as_often(rows.join(single, same(rows, single, key)))
    several = plan.filter("_n > 1")
    if several.isEmpty():
        return out
    # rows that repeat the whole key are numbered; they may differ in other columns, equal ones are alike
    again = several.select(*["_r_" + k for k in key]).distinct()
    again = rows.join(again, same(rows, again, key), "left_semi").withColumn("_order", F.sha2(F.to_json("_row"), 256))
    again = row_number_by(again.withColumn("_tie", F.monotonically_increasing_id()), ["_order", "_tie"], group=key, out="_k")
    again, several = again.withColumn("_k", F.col("_k") - 1), several.filter("_copies > 0")
    return out.unionByName(as_often(again.join(several, same(again, several, [*key, "_k"]))))


def mix_digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")
