"""Distributed ranks (W1–W3, W12, M1 support), nearest neighbours (O4) and key ordering.

A window without ``partitionBy`` — or with a partition key that holds a third of the
rows — funnels its rows through one task.  The helpers here rank instead over a
range-partitioned, locally sorted copy:

1. ``repartitionByRange(group…, order…)`` splits even one huge group over many tasks;
2. ``sortWithinPartitions`` + ``monotonically_increasing_id`` give each row its local
   position (the id is ``partition << 33 | position``);
3. one small aggregate per (partition, group) — at most partitions + groups rows —
   yields the number of rows of the same group in earlier partitions.

Order keys must end in a unique tie-breaker so the order, and hence every rank, is
total and reproducible when a lost task is recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | record number


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def _stage_sorted(df: DataFrame, group: Sequence[str], order: Sequence, partitions: int | None,
                  prefix=None) -> DataFrame:
    """Range-partition and sort.  Without an explicit count the range exchange is sized by
    ``spark.sql.shuffle.partitions`` and AQE may coalesce adjacent small ranges; a coalesced
    partition is still one contiguous, locally sorted key range, so positions stay exact.

    ``prefix`` (optional) is a long that is non-decreasing in (group, order) and determines the
    group; sorting on (prefix, order) then equals sorting on (group, order), and the sorter
    settles most comparisons on that one primitive prefix."""
    keys = [prefix, *_cols(order)] if prefix is not None else [*_cols(group), *_cols(order)]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return (
        ranged
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), _POS_BITS))
    )


def row_number_by(
    df: DataFrame,
    order: Sequence,
    group: Sequence[str] = (),
    out: str = "rn",
    size_col: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """1-based row number of each row inside ``group`` under ``order`` (distributed).

    Meant for a global order or for few groups of any size (a model, a label, a fold).  For many
    small groups (per user, per document) a plain window partitioned by the group is the better
    plan: its partitions are bounded by the group size.

    The staged copy is checkpointed to the session's reliable checkpoint directory so the
    per-partition counts and the rows they are joined back to come from one materialisation
    (range bounds are sampled; a second evaluation could cut differently).
    """
    group = list(group)
    staged = _stage_sorted(df, group, order, partitions).checkpoint(eager=True)
    stats = staged.groupBy("_pid", *group).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first")
    )
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if size_col:
        stats = stats.withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*group)))
    # Without group keys the stats table has one row per partition: a proven bound.
    # With group keys it is bounded by partitions + groups; AQE broadcasts it at run
    # time when it is small and keeps a shuffle join otherwise.
    stats = stats.select(*[F.col(g).alias(f"_s_{g}") for g in group], F.col("_pid").alias("_s_pid"),
                         "_before", "_first", *([size_col] if size_col else []))
    stats = F.broadcast(stats) if not group else stats
    cond = [F.col("_pid") == F.col("_s_pid")] + [F.col(g).eqNullSafe(F.col(f"_s_{g}")) for g in group]
    extra = [size_col] if size_col else []
    return staged.join(stats, cond, "inner").select(
        *df.columns, (F.col("_before") + F.col("_pos") - F.col("_first") + 1).alias(out), *extra
    )


def rank_weighted_sum(
    df: DataFrame,
    order: Sequence,
    weight: Column | str,
    group: Sequence[str] = (),
    partitions: int | None = None,
    prefix: Column | None = None,
) -> DataFrame:
    """Per group: ``n``, ``sw`` = Σw and ``swr`` = Σ w·rank, rank 1-based ascending in ``order``.

    Only per-(partition, group) partial sums cross the second shuffle, so the cost is one
    range shuffle of the input, and nothing is joined back to the rows.
    """
    group = list(group)
    w = F.col(weight) if isinstance(weight, str) else weight
    staged = _stage_sorted(df.withColumn("_w", w.cast("double")), group, order, partitions, prefix)
    per = staged.groupBy("_pid", *group).agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.sum("_w").alias("_sw"),
        F.sum(F.col("_w") * F.col("_pos")).alias("_swp"),
        F.min("_pos").alias("_first"),
    )
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    # Σ_local w·(pos − first + 1 + before)
    part = F.col("_swp") + (F.col("_before") - F.col("_first") + 1) * F.col("_sw")
    return per.groupBy(*group).agg(
        F.sum("_cnt").alias("n"), F.sum("_sw").alias("sw"), F.sum(part).alias("swr")
    )


def partition_sort(df: DataFrame, partition_keys: Sequence[str], sort_keys: Sequence[str],
                   partitions: int | None = None) -> DataFrame:
    """Hash-partition on a key prefix, sort each partition on the full composite key
    (the map → sort → reduce contract of a streaming map/reduce job)."""
    n = _partitions(df, partitions)
    return df.repartition(n, *partition_keys).sortWithinPartitions(*sort_keys)
