"""Aggregations: rates, rate cubes, frequency/distinct tables, scaling, mode/median repair.

A1–A7, A12, A15–A17, P12–P15.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scalar import col, threshold
from tabwright.operators.rank import row_number_by


def key_grid(spark, keys: Mapping[str, Sequence]) -> DataFrame:
    """Dense grid over literal key lists (size = product of list lengths, known up front)."""
    df = spark.range(1).select()
    for name, values in keys.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def rate_cube(df: DataFrame, keys: Mapping[str, Sequence], label, cut: float = 0.5) -> DataFrame:
    """A3: mean label per key combination over a dense grid; empty cell → rate 0; ``pred`` = rate ≥ cut.

    The group-by is partial+final (map-side combine); the grid is a literal and is the
    only side that is broadcast.
    """
    names = list(keys)
    stats = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(col(label)).alias("rate"))
    grid = key_grid(df.sparkSession, keys)
    return (F.broadcast(grid).join(stats, names, "left")
            .select(*names, F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                    F.coalesce("rate", F.lit(0.0)).alias("rate"))
            .withColumn("pred", threshold("rate", cut)))


def score_by_lookup(df: DataFrame, cube: DataFrame, keys: Sequence[str], pred: str = "pred", dense: bool = False) -> DataFrame:
    """Table-lookup scoring — left join on the cube keys, missing cell → 0.  The cube comes from the
    caller, so its size decides at run time whether it is broadcast; ``dense`` says that it is a grid over literal key
    lists, as ``rate_cube`` makes, and goes to the rows: no task gets all rows of a cell."""
    cells = cube.select(*keys, pred)
    return df.join(F.broadcast(cells) if dense else cells, list(keys), "left").withColumn(
        pred, F.coalesce(F.col(pred), F.lit(0)))


def global_rate(df: DataFrame, label) -> DataFrame:
    """A1: count, positives, proportion."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(col(label)).cast("long").alias("n_pos"),
                  F.avg(col(label)).alias("rate"))


def rate_by(df: DataFrame, by: Sequence, label) -> DataFrame:
    """A2: proportion per side of a predicate / per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(col(label)).alias("rate"))


def freq_table(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """A5: frequency table."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_count(df: DataFrame, by: Sequence[str], what: str, approx: bool = False) -> DataFrame:
    """A4: count distinct per group (two-phase: distinct pairs, then count — no per-group sets)."""
    if approx:
        return df.groupBy(*by).agg(F.approx_count_distinct(what).alias(f"n_{what}"))
    return df.select(*by, what).distinct().groupBy(*by).agg(F.count(what).alias(f"n_{what}"))


def max_scale(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """``v / max(v)``; the maximum is a scalar subquery (one value, broadcast by the planner)."""
    mx = df.agg(F.max(c)).scalar()
    return df.withColumn(out or f"{c}_scaled", F.col(c) / mx)


def mode_value(df: DataFrame, c: str) -> Column:
    """P13 helper: most frequent non-null value, ties → smallest, as a scalar subquery.

    Counting is a partial+final group-by; picking the winner is a distributed top-1.
    """
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), F.asc(c)).limit(1).select(c).scalar()


def fill_mode(df: DataFrame, c: str) -> DataFrame:
    """Fill NULL with the most frequent value."""
    return df.withColumn(c, F.coalesce(F.col(c), mode_value(df, c)))


def exact_median(df: DataFrame, value: str, group: Sequence[str] = (), out: str = "median") -> DataFrame:
    """P14/P15 helper: exact (interpolated) median per group without collecting a group.

    Rows get a distributed row number inside their group; only the one or two middle
    rows per group survive the filter, then a tiny group-by averages them.
    """
    group = list(group)
    base = df.where(F.col(value).isNotNull()).select(*group, value)
    ranked = row_number_by(base, [value], group, out="_rn", size_col="_n")
    lo = F.floor((F.col("_n") + 1) / 2)
    hi = F.ceil((F.col("_n") + 1) / 2)
    mid = ranked.where((F.col("_rn") == lo) | (F.col("_rn") == hi))
    return mid.groupBy(*group).agg(F.avg(value).alias(out))


def fill_median(df: DataFrame, c: str) -> DataFrame:
    """Fill NULL with the global median."""
    med = exact_median(df, c).scalar()
    return df.withColumn(c, F.coalesce(F.col(c), med))


MEDIAN_SLOTS = 64


def fill_group_median(df: DataFrame, c: str, group: Sequence[str]) -> DataFrame:
    """Fill NULL with the median of the row's group (groups may be huge: no per-group collect)."""
    med = exact_median(df, c, group, out="_median")
    # a group of any size meets its median on (group, slot)
    med = med.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_median",
                     F.explode(F.sequence(F.lit(0), F.lit(MEDIAN_SLOTS - 1))).alias("_m_slot"))
    cond = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col("_slot") == F.col("_m_slot")]
    slotted = df.withColumn("_slot", F.pmod(F.xxhash64(*df.columns), F.lit(MEDIAN_SLOTS)).cast("int"))
    return (slotted.join(med, cond, "left")
            .withColumn(c, F.coalesce(F.col(c), F.col("_median")))
            .select(*df.columns))


def mean_std(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean and population standard deviation per group."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def counts_above(df: DataFrame, value: str, thresholds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Number of rows above each threshold (thresholds exploded, one grouped pass)."""
    t = df.withColumn("threshold", F.explode(F.array(*[F.lit(float(x)) for x in thresholds])))
    return t.groupBy(*by, "threshold").agg(F.count_if(F.col(value) > F.col("threshold")).alias("n_above"))
