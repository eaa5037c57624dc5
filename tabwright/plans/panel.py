"""Step 2: weekly view panels on ``events`` (video panel → events; type = alphabetical event_type code,
week/day counted from 2024-01-01).  ``events`` holds weeks 1–4 and two days of week 5, so the
forecast target is week 4 and the supervised windows are (1–2 → 3), (2–3 → 4), (3–4 → 5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import panel as P
from tabwright.sources.tables import Tables

TARGET_WEEK = 4
WINDOW_STARTS = [1, 2, 3]
SWEEP = [0.0, 1.0, 2.0, 5.0, 10.0, 20.0]


def _panel(spark, sf_dir):
    return P.event_panel(Tables(spark, sf_dir).events)


def q_panel_dense(spark, sf_dir):
    return P.dense_week(_panel(spark, sf_dir), TARGET_WEEK).select("user_id", "type", "day", "cnt")


def q_panel_history(spark, sf_dir):
    h = P.history_features(_panel(spark, sf_dir))
    return h.withColumn("history_q", F.round("history_q", 6))


def q_panel_avg_forecast(spark, sf_dir):
    return P.average_forecast(_panel(spark, sf_dir), TARGET_WEEK)


def q_window_features(spark, sf_dir):
    w = P.window_features(_panel(spark, sf_dir), WINDOW_STARTS)
    return w.select("user_id", "start_week", F.array_join("features", ",").alias("features"), "label")


def q_panel_cosine_f1(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    truth = P.dense_week(panel, TARGET_WEEK)
    pred = P.dense_week(panel, TARGET_WEEK - 1)
    m = P.cosine_f1(truth, pred, ["user_id"], ["type", "day"])
    return m.select("n_pred_users", "n_true_users", "n_common",
                    *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def q_panel_vector_lines(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    fc = P.average_forecast(panel, TARGET_WEEK)
    types = P.n_types(panel)
    fc = fc.withColumn("slot", P.slot("day", "type", types))
    vec = P.vector_of(fc, ["user_id"], "slot", "avg_forecast")
    return P.vector_lines(vec)


def q_threshold_sweep(spark, sf_dir):
    """P11 + A17: predict "active in the target week" from last week's volume at several cut-offs."""
    panel = _panel(spark, sf_dir)
    weekly = panel.groupBy("user_id").agg(
        F.sum(F.when(F.col("week") == TARGET_WEEK - 1, F.col("cnt")).otherwise(0)).alias("score"),
        (F.sum(F.when(F.col("week") == TARGET_WEEK, F.col("cnt")).otherwise(0)) > 0).cast("int").alias("truth"))
    swept = weekly.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in SWEEP])))
    pred = (F.col("score") > F.col("threshold")).cast("int")
    return swept.groupBy("threshold").agg(F.count_if(pred == 1).alias("n_above"),
                                          F.count_if(pred == F.col("truth")).alias("n_correct"))


QUERIES = {
    "panel_dense": q_panel_dense,
    "panel_history": q_panel_history,
    "panel_avg_forecast": q_panel_avg_forecast,
    "window_features": q_window_features,
    "panel_cosine_f1": q_panel_cosine_f1,
    "panel_vector_lines": q_panel_vector_lines,
    "threshold_sweep": q_threshold_sweep,
}

PANEL_SQL = """types AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) AS INTEGER) AS type
               FROM (SELECT DISTINCT event_type FROM events)),
ev AS (SELECT user_id, t.type, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS d
       FROM events e JOIN types t USING (event_type)),
panel AS (SELECT user_id, type, CAST(d // 7 + 1 AS INTEGER) AS week, CAST(d % 7 + 1 AS INTEGER) AS day,
                 count(*) AS cnt FROM ev GROUP BY ALL),
users AS (SELECT DISTINCT user_id FROM panel),
tcodes AS (SELECT CAST(unnest(range(1, (SELECT max(type) FROM panel) + 1)) AS INTEGER) AS type),
dcodes AS (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS day),
grid AS (SELECT user_id, type, day FROM users, tcodes, dcodes)"""


def _dense_week(w):
    return f"""SELECT g.user_id, g.type, g.day, CAST(coalesce(p.cnt, 0) AS BIGINT) AS cnt
FROM grid g LEFT JOIN (SELECT * FROM panel WHERE week = {w}) p USING (user_id, type, day)"""


ORACLE = {
    "panel_dense": f"WITH {PANEL_SQL} {_dense_week(TARGET_WEEK)}",
    "panel_history": f"""WITH {PANEL_SQL},
wcodes AS (SELECT CAST(unnest(range(1, (SELECT max(week) FROM panel) + 1)) AS INTEGER) AS week),
dense AS (SELECT g.user_id, g.type, w.week, g.day, CAST(coalesce(p.cnt, 0) AS BIGINT) AS cnt
          FROM grid g CROSS JOIN wcodes w LEFT JOIN panel p USING (user_id, type, week, day)),
f AS (SELECT *,
  coalesce(sum(cnt) OVER (PARTITION BY user_id, type ORDER BY week
                          RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
  coalesce(sum(cnt) OVER (PARTITION BY user_id, type ORDER BY week RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), 0)
    AS last_wk,
  coalesce(sum(cnt) OVER (PARTITION BY user_id, type, day ORDER BY week
                          RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS same_day,
  coalesce(sum(cnt) OVER (PARTITION BY user_id, type, day ORDER BY week
                          RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), 0) AS last_day
  FROM dense)
SELECT user_id, type, week, day, cnt, CAST(earlier > 0 AS INTEGER) AS seen_before,
  round(CASE WHEN week > 1 THEN earlier / (week - 1) ELSE 0.0 END, 6) AS history_q,
  CAST(same_day AS BIGINT) AS same_day_prev, CAST(last_wk AS BIGINT) AS last_week_total,
  CAST(last_day AS BIGINT) AS last_week_same_day
FROM f""",
    "panel_avg_forecast": f"""WITH {PANEL_SQL},
means AS (SELECT user_id, type, day, CAST(round(avg(cnt)) AS BIGINT) AS m FROM panel
          WHERE week >= 1 AND week < {TARGET_WEEK} GROUP BY ALL),
last AS (SELECT user_id, type, day, cnt FROM panel WHERE week = {TARGET_WEEK - 1})
SELECT g.user_id, g.type, g.day, CAST(coalesce(m, 0) AS BIGINT) AS avg_forecast,
       CAST(coalesce(l.cnt, 0) AS BIGINT) AS last_week_copy
FROM grid g LEFT JOIN means USING (user_id, type, day) LEFT JOIN last l USING (user_id, type, day)""",
    "window_features": f"""WITH {PANEL_SQL},
starts AS (SELECT unnest([{', '.join(map(str, WINDOW_STARTS))}]) AS start_week),
ntypes AS (SELECT max(type) AS n FROM panel),
win AS (SELECT g.user_id, s.start_week, g.type, g.day, w.week, coalesce(p.cnt, 0) AS cnt
        FROM grid g CROSS JOIN starts s
        CROSS JOIN (SELECT unnest(range(0, 2)) AS k) kk
        CROSS JOIN LATERAL (SELECT CAST(s.start_week + kk.k AS INTEGER) AS week) w
        LEFT JOIN panel p ON p.user_id = g.user_id AND p.type = g.type AND p.day = g.day AND p.week = w.week),
feats AS (SELECT user_id, start_week,
            string_agg(CAST(cnt AS VARCHAR), ',' ORDER BY ((week - start_week) * 7 + day - 1) * (SELECT n FROM ntypes)
                       + type - 1) AS features
          FROM win GROUP BY user_id, start_week),
weekly AS (SELECT user_id, week, sum(cnt) AS wk FROM panel GROUP BY ALL)
SELECT f.user_id, CAST(f.start_week AS INTEGER) AS start_week, f.features,
       CAST(coalesce(w.wk, 0) > 0 AS INTEGER) AS label
FROM feats f LEFT JOIN weekly w ON w.user_id = f.user_id AND w.week = f.start_week + 2""",
    "panel_cosine_f1": f"""WITH {PANEL_SQL},
t AS ({_dense_week(TARGET_WEEK)}), p AS ({_dense_week(TARGET_WEEK - 1)}),
per AS (SELECT t.user_id, sum(t.cnt * t.cnt) AS tt, sum(p.cnt * p.cnt) AS pp, sum(t.cnt * p.cnt) AS tp,
               sum(t.cnt) AS ts, sum(p.cnt) AS ps
        FROM t JOIN p USING (user_id, type, day) GROUP BY t.user_id),
g AS (SELECT sum(CASE WHEN ts > 0 AND ps > 0 AND tt > 0 AND pp > 0 THEN tp / sqrt(tt * pp) ELSE 0.0 END) AS sim,
             count_if(ps > 0) AS n_pred_users, count_if(ts > 0) AS n_true_users,
             count_if(ts > 0 AND ps > 0) AS n_common FROM per)
SELECT n_pred_users, n_true_users, n_common, round(sim / n_pred_users, 6) AS precision,
       round(n_common / n_true_users, 6) AS recall,
       round(2 * (sim / n_pred_users) * (n_common / n_true_users)
             / (sim / n_pred_users + n_common / n_true_users), 6) AS f1
FROM g""",
    "panel_vector_lines": f"""WITH {PANEL_SQL},
means AS (SELECT user_id, type, day, CAST(round(avg(cnt)) AS BIGINT) AS m FROM panel
          WHERE week >= 1 AND week < {TARGET_WEEK} GROUP BY ALL),
fc AS (SELECT g.user_id, g.type, g.day, coalesce(m, 0) AS v FROM grid g LEFT JOIN means USING (user_id, type, day)),
vec AS (SELECT user_id, sum(v) AS total,
          string_agg(CAST(v AS VARCHAR), ',' ORDER BY (day - 1) * (SELECT max(type) FROM panel) + type - 1) AS s
        FROM fc GROUP BY user_id)
SELECT user_id, CAST(user_id AS VARCHAR) || chr(9) || s AS line FROM vec WHERE total > 0""",
    "threshold_sweep": f"""WITH {PANEL_SQL},
weekly AS (SELECT user_id, sum(CASE WHEN week = {TARGET_WEEK - 1} THEN cnt ELSE 0 END) AS score,
                  CAST(sum(CASE WHEN week = {TARGET_WEEK} THEN cnt ELSE 0 END) > 0 AS INTEGER) AS truth
           FROM panel GROUP BY user_id),
sw AS (SELECT *, CAST(score > threshold AS INTEGER) AS pred
       FROM weekly, (SELECT unnest([{', '.join(map(str, SWEEP))}]) AS threshold))
SELECT threshold, count_if(pred = 1) AS n_above, count_if(pred = truth) AS n_correct FROM sw GROUP BY threshold""",
}
