"""Combining predictions of several models.

Predictions live in the long table ``submissions(model, row_no, id, pred)``; combining is a
group-by on ``id`` (partial + final), never a positional zip of files.  Ranks inside one
model and the final re-rank are distributed row numbers (a model may hold a large share
of all rows, and the re-rank is global).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.rank import row_number_by


def mean_combine(subs: DataFrame, key: Sequence[str] = ("id",), weights: dict[str, float] | None = None) -> DataFrame:
    """A8 (+Z15/Z24): per key, ``sum(w·pred) / number of models``; ``mean_int`` truncates like ``int()``.

    The divisor is the number of models in the table (a scalar subquery), so a key missing from
    some files is still divided by the full count."""
    n_models = subs.select("model").distinct().agg(F.count(F.lit(1))).scalar()
    w = F.lit(1.0)
    if weights:
        w = F.coalesce(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col("model")], F.lit(0.0))
    s = subs.groupBy(*key).agg(F.sum(w * F.col("pred")).alias("_s"))
    mean = F.col("_s") / n_models
    return s.select(*key, mean.alias("mean_pred"), mean.cast("long").alias("mean_int"))


def vote(subs: DataFrame, key: Sequence[str] = ("id",), label: str = "label") -> DataFrame:
    """A9 (Z16): majority label per key; ties → smallest label.

    Counts are a group-by on (key, label); the winner is picked per key from at most
    (number of models) rows."""
    counts = subs.groupBy(*key, label).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*key).orderBy(F.desc("_n"), F.asc(label))
    return counts.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*key, F.col(label).alias("vote"))


def rank_within(subs: DataFrame, group: Sequence[str], order: Sequence, out: str = "rank0") -> DataFrame:
    """0-based rank inside each group under ``order`` (distributed row number)."""
    r = row_number_by(subs, order, group, out="_rn")
    return r.withColumn(out, F.col("_rn") - 1).drop("_rn")


def rank_average(subs: DataFrame) -> DataFrame:
    """Rank inside each model by (pred, row_no, id); mean rank per (row_no, id); re-rank the
    means by (mean, row_no, id) and scale to [0, 1] by ``n - 1`` (a single row scores 0, Z19)."""
    ranked = rank_within(subs, ["model"], ["pred", "row_no", "id"])
    means = ranked.groupBy("row_no", "id").agg(F.avg("rank0").alias("mean_rank"))
    rr = row_number_by(means, ["mean_rank", "row_no", "id"], out="_rn")
    n = means.agg(F.count(F.lit(1))).scalar()
    scaled = F.coalesce((F.col("_rn") - 1) / F.nullif(n - 1, F.lit(0)), F.lit(0.0))
    return rr.select("row_no", "id", "mean_rank", scaled.alias("rank_score"))


def int_mean(values: Column, n: Column, rounding: str = "floor") -> Column:
    """A10: integer mean with three roundings: ``floor`` (int(sum/n)), ``half_away`` (round), ``half_even``."""
    m = values / n
    if rounding == "floor":
        return F.floor(m).cast("long")
    if rounding == "half_away":
        return F.round(m).cast("long")
    if rounding == "half_even":
        return F.bround(m).cast("long")
    raise ValueError(rounding)


def geo_mean2(a: Column, b: Column) -> Column:
    """Geometric mean of two predictions."""
    return F.sqrt(a * b)


def linear_blend(p1: Column, p2: Column, w: Column | float) -> Column:
    """``w·p1 + (1 - w)·p2``."""
    w = F.lit(w) if not isinstance(w, Column) else w
    return w * p1 + (1 - w) * p2


def power_blend(p1: Column, p2: Column, w: float, a: float, b: float) -> Column:
    """``w·p1^a + (1 - w)·p2^b``."""
    return F.lit(w) * F.pow(p1, a) + F.lit(1 - w) * F.pow(p2, b)


def product_over_sum(p1: Column, p2: Column) -> Column:
    """C11: ``p1·p2 / (p1 + p2)`` (NULL when the sum is 0)."""
    return F.try_divide(p1 * p2, p1 + p2)


def wide(subs: DataFrame, models: Sequence[str], key: Sequence[str] = ("id",), value: str = "pred") -> DataFrame:
    """One column per model (explicit pivot values — never inferred)."""
    return subs.groupBy(*key).pivot("model", list(models)).agg(F.first(value))
