"""User × type × week × day count panels and their history features.

Events are aggregated to the panel first (partial + final group-by, so a user with a third
of all events is combined map-side); every window below then runs over at most
weeks × days rows per (user, type) partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.scalar import day_of, week_of
from tabwright.operators.encode import ordinal_codes

DAYS = 7
CODE_SLOTS = 64


def event_panel(events: DataFrame, origin: str = "2024-01-01") -> DataFrame:
    """F7 + D8: ``(user_id, type, week, day, cnt)``; ``type`` is the 1-based alphabetical code of
    ``event_type``; week/day count from ``origin``."""
    counts = events.select("user_id", "event_type", week_of("ts", origin).alias("week"), day_of("ts", origin).alias("day")) \
        .groupBy("user_id", "event_type", "week", "day").agg(F.count(F.lit(1)).alias("cnt"))
    # the dictionary meets aggregated rows only, and on (type name, slot of the user): five type
    # names never decide how many tasks do the join
    codes = ordinal_codes(events, "event_type", "type", base=1).withColumn(
        "_slot", F.explode(F.sequence(F.lit(0), F.lit(CODE_SLOTS - 1))))
    counts = counts.withColumn("_slot", F.pmod(F.xxhash64("user_id"), F.lit(CODE_SLOTS)).cast("int"))
    return counts.join(codes, ["event_type", "_slot"]).select("user_id", "type", "week", "day", "cnt")


def n_types(panel: DataFrame):
    """Number of type codes, as a scalar subquery."""
    return panel.agg(F.max("type")).scalar()


def dense_grid(users: DataFrame, types, weeks: Sequence[int] | None = None, days: int = DAYS) -> DataFrame:
    """Every user × type × (week) × day — generated with ``explode(sequence)`` per user,
    no join; ``types`` is a count (literal or scalar subquery)."""
    g = users.select("user_id").distinct().withColumn("type", F.explode(F.sequence(F.lit(1), F.lit(types)
                                                                                   if isinstance(types, int) else types)))
    if isinstance(weeks, (list, tuple)):
        g = g.withColumn("week", F.explode(F.array(*[F.lit(w) for w in weeks])))
    elif weeks is not None:  # a count (scalar subquery): weeks 1..n
        g = g.withColumn("week", F.explode(F.sequence(F.lit(1), weeks)))
    return g.withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(days))))


def align(grid: DataFrame, panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-align observed counts onto the grid; gaps → 0."""
    return grid.join(panel.select(*keys, "cnt"), list(keys), "left").withColumn(
        "cnt", F.coalesce(F.col("cnt"), F.lit(0)).cast("long"))


def dense_week(panel: DataFrame, week: int) -> DataFrame:
    """Dense ``(user_id, type, day, cnt)`` for one week."""
    grid = dense_grid(panel, n_types(panel))
    return align(grid, panel.where(F.col("week") == week), ["user_id", "type", "day"])


def n_weeks(panel: DataFrame):
    """Last week number present, as a scalar subquery."""
    return panel.agg(F.max("week")).scalar()


def history_features(panel: DataFrame, weeks=None) -> DataFrame:
    """W5–W8 on the dense panel: per (user, type, week, day)

    * ``seen_before``        any earlier week with activity (W5)
    * ``history_q``          mean weekly volume over earlier weeks, ``sum / (week - 1)`` (W5, Z8)
    * ``same_day_prev``      total on the same weekday over all earlier weeks (W6)
    * ``last_week_total``    total of the previous week (W7)
    * ``last_week_same_day`` previous week, same day (W8; a range frame, so gaps in weeks are honoured)
    """
    grid = dense_grid(panel, n_types(panel), weeks if weeks is not None else n_weeks(panel))
    dense = align(grid, panel, ["user_id", "type", "week", "day"])
    ut = Window.partitionBy("user_id", "type").orderBy("week")
    utd = Window.partitionBy("user_id", "type", "day").orderBy("week")
    earlier = F.coalesce(F.sum("cnt").over(ut.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last_wk = F.coalesce(F.sum("cnt").over(ut.rangeBetween(-1, -1)), F.lit(0))
    same_day = F.coalesce(F.sum("cnt").over(utd.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last_day = F.coalesce(F.sum("cnt").over(utd.rangeBetween(-1, -1)), F.lit(0))
    return dense.select(
        "user_id", "type", "week", "day", "cnt",
        (earlier > 0).cast("int").alias("seen_before"),
        F.when(F.col("week") > 1, earlier / (F.col("week") - 1)).otherwise(F.lit(0.0)).alias("history_q"),
        same_day.cast("long").alias("same_day_prev"),
        last_wk.cast("long").alias("last_week_total"),
        last_day.cast("long").alias("last_week_same_day"),
    )


def average_forecast(panel: DataFrame, target_week: int, first_week: int = 1) -> DataFrame:
    """Per (user, day, type) the rounded mean count over the *observed* rows of weeks
    ``[first_week, target_week)``; absent → 0; plus the last-week copy."""
    hist = panel.where((F.col("week") >= first_week) & (F.col("week") < target_week))
    means = hist.groupBy("user_id", "type", "day").agg(F.round(F.avg("cnt")).cast("long").alias("avg_forecast"))
    last = panel.where(F.col("week") == target_week - 1).select(
        "user_id", "type", "day", F.col("cnt").alias("last_week_copy"))
    grid = dense_grid(panel, n_types(panel))
    return (grid.join(means, ["user_id", "type", "day"], "left").join(last, ["user_id", "type", "day"], "left")
            .select("user_id", "type", "day",
                    F.coalesce("avg_forecast", F.lit(0)).cast("long").alias("avg_forecast"),
                    F.coalesce("last_week_copy", F.lit(0)).cast("long").alias("last_week_copy")))


def slot(day, type_, types) -> F.Column:
    """0-based vector slot ``(day - 1) * n_types + type - 1``."""
    return (F.col(day) - 1) * types + F.col(type_) - 1


def vector_of(df: DataFrame, keys: Sequence[str], slot_col: str, value: str) -> DataFrame:
    """Ordered value vector per key from a long table (vector length is bounded by the slot range)."""
    return df.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(slot_col).alias("s"), F.col(value).alias("v")))),
                    lambda x: x["v"]).alias("vec"))


def window_features(panel: DataFrame, starts: Sequence[int], length: int = 2, horizon: int = 1) -> DataFrame:
    """Per (user, window start) the ``length × 7 × n_types`` count vector of weeks
    ``[s, s + length)`` and the label "any activity in week ``s + length + horizon - 1``"."""
    types = n_types(panel)
    all_weeks = sorted({s + i for s in starts for i in range(length)})
    grid = dense_grid(panel, types, all_weeks)
    dense = align(grid, panel, ["user_id", "type", "week", "day"])
    win = dense.withColumn("start_week", F.explode(F.array(*[F.lit(s) for s in starts]))).where(
        (F.col("week") >= F.col("start_week")) & (F.col("week") < F.col("start_week") + length))
    win = win.withColumn("slot", ((F.col("week") - F.col("start_week")) * DAYS + F.col("day") - 1) * types
                         + F.col("type") - 1)
    feats = vector_of(win, ["user_id", "start_week"], "slot", "cnt")
    weekly = panel.groupBy("user_id", "week").agg(F.sum("cnt").alias("wk"))
    lab = feats.join(weekly, (feats["user_id"] == weekly["user_id"])
                     & (weekly["week"] == feats["start_week"] + length + horizon - 1), "left")
    return lab.select(feats["user_id"], feats["start_week"], F.col("vec").alias("features"),
                      (F.coalesce(F.col("wk"), F.lit(0)) > 0).cast("int").alias("label"))


def cosine_f1(truth: DataFrame, pred: DataFrame, keys: Sequence[str], slot_keys: Sequence[str]) -> DataFrame:
    """M7: per-user cosine F1.  precision = Σ cos / #predicted users, recall = #common / #true users.

    Per-user sums are one group-by; the global sums a second (one row)."""
    j = truth.select(*keys, *slot_keys, F.col("cnt").alias("t")).join(
        pred.select(*keys, *slot_keys, F.col("cnt").alias("p")), [*keys, *slot_keys], "full")
    j = j.fillna(0, ["t", "p"])
    per = j.groupBy(*keys).agg(F.sum(F.col("t") * F.col("t")).alias("tt"), F.sum(F.col("p") * F.col("p")).alias("pp"),
                               F.sum(F.col("t") * F.col("p")).alias("tp"), F.sum("t").alias("ts"),
                               F.sum("p").alias("ps"))
    common = (F.col("ts") > 0) & (F.col("ps") > 0)
    sim = F.when(common & (F.col("tt") > 0) & (F.col("pp") > 0), F.col("tp") / F.sqrt(F.col("tt") * F.col("pp")))
    g = per.agg(F.sum(F.coalesce(sim, F.lit(0.0))).alias("sim"), F.count_if(F.col("ps") > 0).alias("n_pred_users"),
                F.count_if(F.col("ts") > 0).alias("n_true_users"), F.count_if(common).alias("n_common"))
    p = F.col("sim") / F.col("n_pred_users")
    r = F.col("n_common") / F.col("n_true_users")
    return g.select("n_pred_users", "n_true_users", "n_common", p.alias("precision"), r.alias("recall"),
                    (2 * p * r / (p + r)).alias("f1"))


def vector_lines(vectors: DataFrame, key: str = "user_id", vec: str = "vec") -> DataFrame:
    """K2: ``key \\t v1,v2,…`` lines; keys whose vector sums to 0 are dropped."""
    total = F.aggregate(F.col(vec), F.lit(0).cast("long"), lambda a, x: a + x)
    return vectors.where(total > 0).select(
        key, F.concat(F.col(key).cast("string"), F.lit("\t"),
                      F.array_join(F.transform(F.col(vec), lambda x: x.cast("string")), ",")).alias("line"))
