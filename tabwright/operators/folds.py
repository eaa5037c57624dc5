"""Deterministic fold assignment.

Randomness is an md5 of (id, seed): the same in every engine and every re-run, and a lost task
recomputes the same folds.  Position-based folds use the distributed row number, so a label
value that covers half of the rows is still split over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scalar import hex_digit_parity, md5_key
from tabwright.operators.rank import row_number_by


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, repeats: int = 2,
                     seed: int = 711, seed_step: int = 1000) -> DataFrame:
    """Repeated stratified k-fold.  Per repeat ``i`` (seed ``seed + seed_step·i``) rows of each
    label are ordered by md5(id, seed) and dealt round-robin: ``fold = (rn - 1) % k``."""
    rep = df.select(key, label).withColumn("iter", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    rep = rep.withColumn("_h", md5_key(key, F.lit(seed) + F.col("iter") * seed_step))
    r = row_number_by(rep, ["_h", key], ["iter", label], out="_rn")
    return r.select("iter", key, label, ((F.col("_rn") - 1) % k).cast("int").alias("fold"))


def contiguous_folds(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """Unshuffled k-fold over ``key`` order; the first ``n % k`` folds get one extra row."""
    r = row_number_by(df.select(key), [key], out="_rn")
    n = df.agg(F.count(F.lit(1))).scalar()
    q, rem = F.floor(n / k), n % k
    big = rem * (q + 1)
    fold = F.when(F.col("_rn") <= big, F.floor((F.col("_rn") - 1) / (q + 1))).otherwise(
        rem + F.floor((F.col("_rn") - 1 - big) / q))
    return r.select(key, fold.cast("int").alias("fold"))


def shuffled_folds(df: DataFrame, key: str, k: int = 5, seed: int = 0) -> DataFrame:
    """Shuffled folds of exactly ``n // k`` rows; the remainder gets fold -1 (train only, never validated)."""
    base = df.select(key).withColumn("_h", md5_key(key, F.lit(seed)))
    r = row_number_by(base, ["_h", key], out="_rn")
    size = F.floor(df.agg(F.count(F.lit(1))).scalar() / k)
    f = F.when(size > 0, F.floor(F.try_divide(F.col("_rn") - 1, size)))  # fewer rows than folds: all train-only
    return r.select(key, F.when(f < k, f).otherwise(F.lit(-1)).cast("int").alias("fold"))


def half_split(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """C4: 50/50 split by md5 parity of (id, seed)."""
    return df.select(key, hex_digit_parity(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))
                     .cast("int").alias("half"))


def tail_holdout(df: DataFrame, key: str, fraction: float, from_end: bool = True) -> DataFrame:
    """Positional hold-out of ``floor(n·fraction)`` rows from the end (or the start) of the
    key order."""
    order: Sequence = [F.desc(key)] if from_end else [key]
    r = row_number_by(df, order, out="_rn")
    k = F.floor(df.agg(F.count(F.lit(1))).scalar() * fraction)
    return r.withColumn("split", F.when(F.col("_rn") <= k, F.lit("holdout")).otherwise(F.lit("train"))).drop("_rn")
