"""Queries for experiment metrics: E1-E14."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import experiments as ex
from tidemark.operators.sessions import sessionize
from tidemark.plans.oracle_views import with_views
from tidemark.sources import fixtures as fx
from tidemark.sources.tables import load

SALT = "exp-1"
GAP_SECONDS = 300
FUNNEL = ["view", "click", "purchase"]


def _web(spark, sf_dir):
    return fx.web_events(spark, sf_dir)


def _days(spark, sf_dir):
    return ex.active_days(_web(spark, sf_dir), "user_id", "event_time")


def _order_days(spark, sf_dir):
    return fx.activity(spark, sf_dir)


def e01_assign_cells(spark, sf_dir):
    users = _web(spark, sf_dir).where(F.col("user_id").isNotNull())
    return ex.assign_cells(users, "user_id", SALT)


def e02_retention(spark, sf_dir):
    return ex.retention(_days(spark, sf_dir), (1, 7, 28))


def e03_streak_survival(spark, sf_dir):
    return ex.longest_daily_streak(_days(spark, sf_dir), 7)


def e04_feature_usage(spark, sf_dir):
    return ex.feature_usage(_web(spark, sf_dir), "user_id", "event_time", F.col("event_type") == "click")


def e05_revisit_rate(spark, sf_dir):
    return ex.revisit_rate(_web(spark, sf_dir), "user_id", "device_id", "event_time", "event_id", 7)


def _user_sessions(spark, sf_dir, keys, sums=None):
    w = _web(spark, sf_dir).where(F.col("user_id").isNotNull())
    return sessionize(w, keys, "event_time", GAP_SECONDS, sums=sums)


def e06_incremental_duration(spark, sf_dir):
    s = _user_sessions(spark, sf_dir, ["user_id", "host"])
    return ex.incremental_duration(s, F.col("host").contains("view"))


def e07_sessions_with_purchase(spark, sf_dir):
    s = _user_sessions(spark, sf_dir, ["user_id"], {"purchases": F.col("event_type") == "purchase"})
    return ex.sessions_with(s, "purchases")


CHURN_IDLE = 180


def e08_resurrection_rate(spark, sf_dir):
    return ex.resurrection_rate(_order_days(spark, sf_dir).distinct(), 7, 7)


def e09_post_return_activity(spark, sf_dir):
    return ex.post_return_activity(_order_days(spark, sf_dir), 7, 7)


def e10_completion_metrics(spark, sf_dir):
    return ex.completion_metrics(_web(spark, sf_dir), "user_id", "event_time", "event_type",
                                 "view", "purchase", "error")


def e11_funnel(spark, sf_dir):
    return ex.funnel(_web(spark, sf_dir), "user_id", "event_time", "event_type", FUNNEL, 7)


def e12_weekly_engagement(spark, sf_dir):
    return ex.weekly_engagement(_web(spark, sf_dir), "user_id", "event_time", "event_type", "purchase")


def e13_uplift(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_returnflag")
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    cells = ex.assign_cells(c, "user_id", SALT)
    revenue = o.select(F.col("o_custkey").alias("user_id"),
                       F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    refunds = (li.where(F.col("l_returnflag") == "R")
                 .join(o, li.l_orderkey == o.o_orderkey, "inner")
                 .select(F.col("o_custkey").alias("user_id"),
                         F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100)
                          .cast("bigint").alias("cents")))
    return ex.uplift(revenue, refunds, cells)


def e02_retention_after_return(spark, sf_dir):
    days = _order_days(spark, sf_dir).distinct()
    return ex.retention(days, (30, 60, 90), ex.return_days(days, CHURN_IDLE))


def e13_churn_by_cell(spark, sf_dir):
    days = _order_days(spark, sf_dir).distinct()
    return ex.churn_by_cell(days, ex.assign_cells(days, "user_id", SALT), CHURN_IDLE)


def e14_compare_cells(spark, sf_dir):
    w = _web(spark, sf_dir).where(F.col("user_id").isNotNull())
    per_user = (w.groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("purchases"))
                 .withColumn("cell", ex.cell_of(F.col("user_id"), SALT)))
    return ex.compare_cells(per_user, "purchases")


STREAK_MIN, RESUME_WITHIN = 2, 7


def e03_streak_resumption(spark, sf_dir):
    return ex.streak_resumption(_days(spark, sf_dir), STREAK_MIN, RESUME_WITHIN)


RESURRECTED = {"resurrected_dau": 1, "resurrected_wau": 7, "resurrected_mau": 30}
RETURN_IDLE, RETURN_HOLD = 3, 14


def e09_resurrected_users(spark, sf_dir):
    return ex.resurrected_users(_days(spark, sf_dir), RESURRECTED, RETURN_IDLE, RETURN_HOLD)


def e12_engagement_minutes(spark, sf_dir):
    s = _user_sessions(spark, sf_dir, ["user_id"], {"purchases": F.col("event_type") == "purchase"})
    return ex.weekly_minutes(s, "purchases")


QUERIES = {
    "e03_streak_resumption": e03_streak_resumption,
    "e09_resurrected_users": e09_resurrected_users,
    "e12_engagement_minutes": e12_engagement_minutes,
    "e01_assign_cells": e01_assign_cells,
    "e02_retention": e02_retention,
    "e03_streak_survival": e03_streak_survival,
    "e04_feature_usage": e04_feature_usage,
    "e05_revisit_rate": e05_revisit_rate,
    "e06_incremental_duration": e06_incremental_duration,
    "e07_sessions_with_purchase": e07_sessions_with_purchase,
    "e08_resurrection_rate": e08_resurrection_rate,
    "e09_post_return_activity": e09_post_return_activity,
    "e10_completion_metrics": e10_completion_metrics,
    "e11_funnel": e11_funnel,
    "e12_weekly_engagement": e12_weekly_engagement,
    "e13_uplift": e13_uplift,
    "e14_compare_cells": e14_compare_cells,
    "e02_retention_after_return": e02_retention_after_return,
    "e13_churn_by_cell": e13_churn_by_cell,
}


def cell_sql(user: str) -> str:
    return (f"CAST(CAST(('0x' || substr(md5('{SALT}|' || CAST({user} AS VARCHAR)), 1, 8)) AS BIGINT) % 2 "
            f"AS INTEGER)")


_DAYS = """d AS (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS day FROM web_events
             WHERE user_id IS NOT NULL)"""


def _sessions_sql(keys: str, extra: str = "") -> str:
    return f"""
x AS (SELECT {keys}, event_time, event_type,
             lag(event_time) OVER (PARTITION BY {keys} ORDER BY event_time) AS p
      FROM web_events WHERE user_id IS NOT NULL),
y AS (SELECT *, sum(CASE WHEN p IS NULL OR event_time > p + INTERVAL {GAP_SECONDS} SECOND THEN 1 ELSE 0 END)
                  OVER (PARTITION BY {keys} ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS sid FROM x),
s AS (SELECT {keys}, min(event_time) AS session_start,
             max(event_time) + INTERVAL {GAP_SECONDS} SECOND AS session_end{extra}
      FROM y GROUP BY {keys}, sid)"""


ORACLE = {
    "e01_assign_cells": with_views(f"""
SELECT DISTINCT user_id, {cell_sql('user_id')} AS cell FROM web_events WHERE user_id IS NOT NULL""",
                                   "web_events"),
    "e02_retention": with_views(f"""
WITH {_DAYS},
f AS (SELECT user_id, min(day) AS cohort_day FROM d GROUP BY user_id),
pu AS (SELECT f.user_id, f.cohort_day,
              max(CASE WHEN d.day - f.cohort_day = 1 THEN 1 ELSE 0 END) AS d1,
              max(CASE WHEN d.day - f.cohort_day = 7 THEN 1 ELSE 0 END) AS d7,
              max(CASE WHEN d.day - f.cohort_day = 28 THEN 1 ELSE 0 END) AS d28
       FROM f JOIN d ON d.user_id = f.user_id GROUP BY f.user_id, f.cohort_day)
SELECT cohort_day, count(*) AS cohort_size, CAST(sum(d1) AS BIGINT) AS retained_d1,
       CAST(sum(d7) AS BIGINT) AS retained_d7, CAST(sum(d28) AS BIGINT) AS retained_d28
FROM pu GROUP BY cohort_day""", "web_events"),
    "e03_streak_survival": with_views(f"""
WITH {_DAYS},
i AS (SELECT user_id, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS isl
      FROM d),
r AS (SELECT user_id, isl, count(*) AS len FROM i GROUP BY user_id, isl)
SELECT user_id, max(len) AS longest_streak_days, max(len) >= 7 AS survived FROM r GROUP BY user_id""",
                                      "web_events"),
    "e04_feature_usage": with_views("""
SELECT CAST(event_time AS DATE) AS day, count(DISTINCT user_id) AS dau,
       count(DISTINCT CASE WHEN event_type = 'click' THEN user_id END) AS feature_users,
       count(*) AS events,
       count(DISTINCT CASE WHEN event_type = 'click' THEN user_id END) / count(DISTINCT user_id) AS feature_share,
       count(*) / count(DISTINCT user_id) AS events_per_user
FROM web_events WHERE user_id IS NOT NULL GROUP BY 1""", "web_events"),
    "e05_revisit_rate": with_views("""
WITH n AS (
  SELECT CAST(event_time AS DATE) AS day, event_time,
         lead(event_time) OVER (PARTITION BY user_id, device_id ORDER BY event_time, event_id) AS nxt
  FROM web_events WHERE user_id IS NOT NULL AND device_id IS NOT NULL)
SELECT day, count(*) AS visits,
       count(*) FILTER (WHERE nxt IS NOT NULL AND nxt <= event_time + INTERVAL 7 DAY) AS revisits,
       count(*) FILTER (WHERE nxt IS NOT NULL AND nxt <= event_time + INTERVAL 7 DAY) / count(*) AS revisit_rate
FROM n GROUP BY day""", "web_events"),
    "e06_incremental_duration": with_views("WITH " + _sessions_sql("user_id, host") + """
SELECT user_id, CAST(session_start AS DATE) AS day,
       CAST(sum(epoch_us(session_end) - epoch_us(session_start)) AS BIGINT) AS total_us,
       CAST(sum(CASE WHEN host LIKE '%view%' THEN epoch_us(session_end) - epoch_us(session_start) ELSE 0 END)
            AS BIGINT) AS base_us,
       CAST(sum(epoch_us(session_end) - epoch_us(session_start))
            - sum(CASE WHEN host LIKE '%view%' THEN epoch_us(session_end) - epoch_us(session_start) ELSE 0 END)
            AS BIGINT) AS incremental_us
FROM s GROUP BY 1, 2""", "web_events"),
    "e07_sessions_with_purchase": with_views(
        "WITH " + _sessions_sql("user_id", ", count(*) FILTER (WHERE event_type = 'purchase') AS purchases") + """
SELECT CAST(session_start AS DATE) AS day, count(*) AS sessions,
       count(*) FILTER (WHERE purchases > 0) AS sessions_with,
       count(*) FILTER (WHERE purchases > 0) / count(*) AS share
FROM s GROUP BY 1""", "web_events"),
    "e08_resurrection_rate": with_views("""
WITH d AS (SELECT DISTINCT user_id, day FROM activity),
g AS (SELECT a.user_id, a.day, (SELECT min(b.day) FROM d b WHERE b.user_id = a.user_id AND b.day > a.day) AS back FROM d a),
l AS (SELECT back - day <= 14 AS soon FROM g WHERE coalesce(back, (SELECT max(day) FROM d)) - day > 7)
SELECT count(*) AS lapses, count(*) FILTER (WHERE soon) AS returned, count(*) FILTER (WHERE soon) / nullif(count(*), 0) AS resurrection_rate
FROM l""", "activity"),
    "e09_post_return_activity": with_views("""
WITH pd AS (SELECT user_id, day, count(*) AS n FROM activity GROUP BY user_id, day),
g AS (SELECT *, CAST(day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS gap FROM pd)
SELECT user_id, day AS return_day, gap,
       (SELECT CAST(sum(p2.n) AS BIGINT) FROM pd p2
        WHERE p2.user_id = g.user_id AND p2.day BETWEEN g.day AND g.day + 6) AS events_next_days
FROM g WHERE gap > 7""", "activity"),
    "e10_completion_metrics": with_views("""
WITH e AS (SELECT * FROM web_events WHERE user_id IS NOT NULL),
f AS (SELECT user_id, min(CASE WHEN event_type = 'view' THEN event_time END) AS t0 FROM e GROUP BY user_id),
pu AS (SELECT e.user_id, max(f.t0) AS t0,
              min(CASE WHEN e.event_type = 'purchase' AND e.event_time >= f.t0 THEN e.event_time END) AS t1,
              count(*) FILTER (WHERE e.event_type = 'error') AS g
       FROM e JOIN f ON e.user_id = f.user_id GROUP BY e.user_id)
SELECT count(t0) AS starters, count(t1) AS completers, count(t1) / count(t0) AS completion_rate,
       sum(epoch_us(t1) - epoch_us(t0)) / count(t1) / 1e6 AS avg_seconds_to_finish,
       CAST(sum(g) AS BIGINT) AS guardrail_events
FROM pu""", "web_events"),
    "e11_funnel": with_views("""
WITH e AS (SELECT * FROM web_events WHERE user_id IS NOT NULL),
s1 AS (SELECT user_id, min(event_time) AS t1 FROM e WHERE event_type = 'view' GROUP BY user_id),
s2 AS (SELECT s1.user_id, max(s1.t1) AS t1, min(e.event_time) AS tp FROM e JOIN s1 ON e.user_id = s1.user_id
       WHERE e.event_type = 'click' AND e.event_time >= s1.t1 AND e.event_time <= s1.t1 + INTERVAL 7 DAY
       GROUP BY s1.user_id),
s3 AS (SELECT s2.user_id FROM e JOIN s2 ON e.user_id = s2.user_id
       WHERE e.event_type = 'purchase' AND e.event_time >= s2.tp AND e.event_time <= s2.t1 + INTERVAL 7 DAY
       GROUP BY s2.user_id)
SELECT 1 AS step_no, 'view' AS step, count(*) AS users FROM s1
UNION ALL SELECT 2, 'click', count(*) FROM s2
UNION ALL SELECT 3, 'purchase', count(*) FROM s3""", "web_events"),
    "e12_weekly_engagement": with_views("""
SELECT user_id, CAST(date_trunc('week', event_time) AS DATE) AS week_start, count(*) AS events,
       count(DISTINCT CAST(event_time AS DATE)) AS active_days,
       count(*) FILTER (WHERE event_type = 'purchase') AS conversions
FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2""", "web_events"),
    "e13_uplift": f"""
WITH cells AS (SELECT DISTINCT c_custkey AS user_id, {cell_sql('c_custkey')} AS cell FROM customer),
rev AS (SELECT o_custkey AS user_id, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS rev
        FROM orders GROUP BY 1),
ref AS (SELECT o.o_custkey AS user_id,
               sum(CAST(round(l.l_extendedprice * (1 - l.l_discount) * 100) AS BIGINT)) AS ref
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R' GROUP BY 1),
pu AS (SELECT c.user_id, c.cell, coalesce(rev.rev, 0) AS rev, coalesce(ref.ref, 0) AS ref
       FROM cells c LEFT JOIN rev ON rev.user_id = c.user_id LEFT JOIN ref ON ref.user_id = c.user_id),
pc AS (SELECT cell, count(*) AS users, CAST(sum(rev) AS BIGINT) AS revenue_cents,
              CAST(sum(ref) AS BIGINT) AS refund_cents FROM pu GROUP BY cell),
pn AS (SELECT *, revenue_cents - refund_cents AS net_cents,
              (revenue_cents - refund_cents) / users AS net_per_user FROM pc)
SELECT *, net_per_user - (SELECT max(net_per_user) FROM pn WHERE cell = 0) AS uplift_vs_control FROM pn""",
    "e14_compare_cells": with_views(f"""
WITH u AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS v, {cell_sql('user_id')} AS cell
           FROM web_events WHERE user_id IS NOT NULL GROUP BY user_id),
s AS (SELECT cell, count(*) AS n, avg(v) AS m, var_samp(v) AS va FROM u GROUP BY cell),
o AS (SELECT max(CASE WHEN cell = 0 THEN n END) AS n0, max(CASE WHEN cell = 1 THEN n END) AS n1,
             max(CASE WHEN cell = 0 THEN m END) AS m0, max(CASE WHEN cell = 1 THEN m END) AS m1,
             max(CASE WHEN cell = 0 THEN va END) AS v0, max(CASE WHEN cell = 1 THEN va END) AS v1 FROM s)
SELECT n0 AS n_control, n1 AS n_treatment, round(m0, 6) AS mean_control, round(m1, 6) AS mean_treatment,
       round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) AS z_score
FROM o""", "web_events"),
}

ORACLE["e02_retention_after_return"] = with_views(f"""
WITH d AS (SELECT DISTINCT user_id, day FROM activity),
a AS (SELECT user_id, day AS cohort_day FROM d x
      WHERE (SELECT max(y.day) FROM d y WHERE y.user_id = x.user_id AND y.day < x.day) < day - {CHURN_IDLE})
SELECT cohort_day, count(*) AS cohort_size, """ + ", ".join(
    f"count(*) FILTER (WHERE EXISTS (SELECT 1 FROM d WHERE d.user_id = a.user_id AND d.day = a.cohort_day + {n})) AS retained_d{n}" for n in (30, 60, 90)) + """
FROM a GROUP BY cohort_day""", "activity")
ORACLE["e13_churn_by_cell"] = with_views(f"""
WITH l AS (SELECT user_id, {cell_sql('user_id')} AS cell, max(day) AS last_day FROM activity GROUP BY user_id)
SELECT cell, count(*) AS users, count(*) FILTER (WHERE (SELECT max(day) FROM activity) - last_day > {CHURN_IDLE}) AS churned,
       count(*) FILTER (WHERE (SELECT max(day) FROM activity) - last_day > {CHURN_IDLE}) / count(*) AS churn_rate
FROM l GROUP BY cell""", "activity")

# Runs day by day (no islands), each run's resumption looked up among the days after it.
ORACLE["e03_streak_resumption"] = with_views(f"""
WITH {_DAYS},
ends AS (SELECT user_id, day AS run_end,
                (SELECT max(b.day) FROM d b WHERE b.user_id = d.user_id AND b.day <= d.day
                 AND NOT EXISTS (SELECT 1 FROM d c WHERE c.user_id = b.user_id AND c.day = b.day - 1)) AS run_start
         FROM d WHERE NOT EXISTS (SELECT 1 FROM d n WHERE n.user_id = d.user_id AND n.day = d.day + 1)),
r AS (SELECT *, (SELECT min(b.day) FROM d b WHERE b.user_id = ends.user_id AND b.day > run_end) AS nxt, (SELECT max(day) FROM d) AS last FROM ends
      WHERE run_end - run_start + 1 >= {STREAK_MIN}),
m AS (SELECT CAST(date_trunc('month', run_end) AS DATE) AS end_month, run_end = last AS op, coalesce(nxt - run_end - 1 <= {RESUME_WITHIN}, false) AS res,
             run_end < last AND nxt IS NULL AND last - run_end <= {RESUME_WITHIN} AS cen, nxt - run_end - 1 AS idle FROM r)
SELECT end_month, count(*) AS runs, count(*) FILTER (WHERE op) AS open_runs, count(*) FILTER (WHERE NOT op) AS broken_runs,
       count(*) FILTER (WHERE cen) AS censored_runs, count(*) FILTER (WHERE res) AS resumed_runs, avg(idle) FILTER (WHERE res) AS avg_idle_days,
       count(*) FILTER (WHERE res) / nullif(count(*) FILTER (WHERE NOT op) - count(*) FILTER (WHERE cen), 0) AS resumption_rate
FROM m GROUP BY 1""", "web_events")
# Every day asks afresh who was active in its window and had a return shortly before that activity.
ORACLE["e09_resurrected_users"] = with_views(f"""
WITH {_DAYS},
ret AS (SELECT user_id, day FROM d x WHERE (SELECT max(y.day) FROM d y WHERE y.user_id = x.user_id AND y.day < x.day) < day - {RETURN_IDLE}),
act AS (SELECT DISTINCT d.user_id, d.day FROM d JOIN ret ON ret.user_id = d.user_id AND d.day >= ret.day AND d.day < ret.day + {RETURN_HOLD}),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM d), (SELECT max(day) FROM d), INTERVAL 1 DAY)) AS DATE) AS day)
SELECT c.day, (SELECT count(*) FROM ret WHERE ret.day = c.day) AS returns, """ + ", ".join(
    f"(SELECT count(DISTINCT user_id) FROM act WHERE act.day BETWEEN c.day - {n - 1} AND c.day) AS {name}" for name, n in RESURRECTED.items()) + """
FROM cal c""", "web_events")
ORACLE["e12_engagement_minutes"] = with_views(
    "WITH " + _sessions_sql("user_id", ", count(*) FILTER (WHERE event_type = 'purchase') AS purchases") + """,
p AS (SELECT *, CAST(unnest(generate_series(date_trunc('week', session_start), date_trunc('week', session_end - INTERVAL 1 MICROSECOND), INTERVAL 7 DAY)) AS TIMESTAMP) AS w FROM s),
q AS (SELECT user_id, CAST(w AS DATE) AS week_start, w = date_trunc('week', session_start) AS fst, purchases > 0 AS done,
             epoch_us(least(session_end, w + INTERVAL 7 DAY)) - epoch_us(greatest(session_start, w)) AS us FROM p)
SELECT user_id, week_start, count(*) FILTER (WHERE fst) AS sessions, count(*) AS active_sessions, CAST(sum(us) AS BIGINT) AS total_us,
       count(*) FILTER (WHERE fst AND done) AS completed, sum(us) / 60000000 AS minutes, sum(us) / 60000000 / count(*) AS avg_minutes,
       count(*) FILTER (WHERE fst AND done) / nullif(count(*) FILTER (WHERE fst), 0) AS completion_rate
FROM q GROUP BY 1, 2""", "web_events")
