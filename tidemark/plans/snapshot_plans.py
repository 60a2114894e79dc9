"""Queries for snapshots and SCD: C3-C9.

Step operators are queried as the state after every period up to a
period bound, so that a closed-form SQL text can be their oracle; the
tests check that iterating the steps gives the same state.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.arrays import join_text
from tidemark.operators import cumulate as cu
from tidemark.operators import scd
from tidemark.plans.oracle_views import AS_OF, FIRST_DAY, LAST_YEAR, with_views
from tidemark.sources import fixtures as fx

SCD_ATTRS = ["quality_class", "is_active"]


def actor_snapshots(spark, sf_dir, upto=None, with_films=True):
    upto = fx.last_year_of(spark, sf_dir) if upto is None else upto
    return cu.cumulate_actors_backfill(fx.actor_films(spark, sf_dir), upto, with_films=with_films)


def c03_cumulate_actors(spark, sf_dir):
    snap = actor_snapshots(spark, sf_dir)
    return snap.select("actor", "actorid", cu.films_text(F.col("films")).alias("films"),
                       F.size("films").cast("bigint").alias("n_films"),
                       "quality_class", "is_active", "current_year")


def f18_metric_maps(spark, sf_dir):
    """Typed maps built from key and value columns (F18), one per actor and year, and taken apart again."""
    y = fx.actor_films(spark, sf_dir).groupBy("actorid", "year").agg(
        F.count(F.lit(1)).alias("films"), F.sum("votes").alias("votes"), F.max("rating").alias("best"))
    metrics = F.create_map(*[c for n in ("films", "votes", "best") for c in (F.lit(n), F.col(n).cast("double"))])
    maps = y.select("actorid", "year", metrics.alias("metrics"))
    return maps.select("actorid", "year", (F.col("metrics")["votes"] / F.col("metrics")["films"]).alias("votes_per_film"),
                       F.explode("metrics").alias("metric", "value"))


def c04_scd2_backfill(spark, sf_dir):
    return actor_history(spark, sf_dir)


def actor_history(spark, sf_dir):
    last = fx.last_year_of(spark, sf_dir)
    snap = actor_snapshots(spark, sf_dir, last, with_films=False)
    return scd.scd2_backfill(snap, "actorid", SCD_ATTRS, "current_year", last, carry=["actor"])


def c05_scd2_increment(spark, sf_dir):
    last = fx.last_year(spark, sf_dir)
    snap = actor_snapshots(spark, sf_dir, last, with_films=False)
    prev = scd.scd2_backfill(snap, "actorid", SCD_ATTRS, "current_year", last - 1, carry=["actor"])
    return scd.scd2_increment(prev, snap, "actorid", SCD_ATTRS, "current_year", last, carry=["actor"])


def c03_step(spark, sf_dir):
    """The step form of C3: the newest year from the snapshot of the year before."""
    last = fx.last_year(spark, sf_dir)
    prev = actor_snapshots(spark, sf_dir, last - 1).where(F.col("current_year") == last - 1)
    snap = cu.cumulate_actors_step(prev, fx.actor_films(spark, sf_dir), last)
    return snap.select("actor", "actorid", cu.films_text(F.col("films")).alias("films"),
                       F.size("films").cast("bigint").alias("n_films"),
                       "quality_class", "is_active", "current_year")


def c06_step(spark, sf_dir):
    """The step form of C6: the as-of day from the datelists of the day before."""
    keys = ["user_id", "browser_type"]
    _, as_of = fx.event_days(spark, sf_dir)
    prev = user_devices_cumulated(spark, sf_dir, as_of - dt.timedelta(days=1))
    today = cu.daily_active_keys(user_device_events(spark, sf_dir), keys, "event_time", as_of, as_of, not_null=["user_id"])
    s = cu.cumulate_datelist_step(prev, today, keys, as_of, "device_activity_datelist")
    return s.select("user_id", "browser_type",
                    join_text(F.col("device_activity_datelist")).alias("device_activity_datelist"),
                    F.size("device_activity_datelist").cast("bigint").alias("n_dates"), "date")


def user_device_events(spark, sf_dir):
    we = fx.web_events(spark, sf_dir)
    # devices is derived from the events themselves, so a size check would cost a
    # full scan; no hint: AQE broadcasts it from its measured shuffle size.
    dv = fx.devices(spark, sf_dir)
    return (we.join(dv, "device_id", "inner")
              .select(F.col("user_id").cast("string").alias("user_id"), "browser_type", "event_time"))


def user_devices_cumulated(spark, sf_dir, as_of=None):
    active = cu.daily_active_keys(user_device_events(spark, sf_dir), ["user_id", "browser_type"],
                                  "event_time", None, as_of, not_null=["user_id"])
    as_of = fx.event_span(spark, sf_dir)[1] if as_of is None else as_of
    return cu.cumulate_datelist_backfill(active, ["user_id", "browser_type"], as_of,
                                         "device_activity_datelist")


def c06_user_devices_cumulated(spark, sf_dir):
    s = user_devices_cumulated(spark, sf_dir)
    return s.select("user_id", "browser_type",
                    join_text(F.col("device_activity_datelist")).alias("device_activity_datelist"),
                    F.size("device_activity_datelist").cast("bigint").alias("n_dates"), "date")


def hosts_cumulated(spark, sf_dir):
    we = fx.web_events(spark, sf_dir).select(F.col("subhost").alias("host"), "user_id", "event_time")
    active = cu.daily_active_keys(we, ["host"], "event_time", None, None, not_null=["user_id"])
    return cu.cumulate_datelist_backfill(active, ["host"], fx.event_span(spark, sf_dir)[1], "host_activity_datelist")


def c06_hosts_cumulated(spark, sf_dir):
    s = hosts_cumulated(spark, sf_dir)
    return s.select("host", join_text(F.col("host_activity_datelist")).alias("host_activity_datelist"),
                    F.size("host_activity_datelist").cast("bigint").alias("n_dates"), "date")


def c07_datelist_bits(spark, sf_dir):
    s = cu.datelist_bits(user_devices_cumulated(spark, sf_dir), "device_activity_datelist")
    return s.select("user_id", "browser_type", "datelist_int", "days_active",
                    "is_monthly_active", "is_weekly_active", "date")


def host_daily_metrics(spark, sf_dir):
    we = fx.web_events(spark, sf_dir).select(F.col("subhost").alias("host"), "user_id", "event_time")
    return cu.daily_metrics(we, "host", "event_time", "user_id")


def host_activity_reduced(spark, sf_dir):
    return cu.reduced_fact_backfill(host_daily_metrics(spark, sf_dir), "host", fx.event_span(spark, sf_dir)[1])


def c08_host_activity_reduced(spark, sf_dir):
    r = host_activity_reduced(spark, sf_dir)
    return r.select("host", "month_start", join_text(F.col("hits_array")).alias("hits_array"),
                    join_text(F.col("unique_visitors_array")).alias("unique_visitors_array"))


def c09_reduced_fact_daily(spark, sf_dir):
    return cu.reduced_fact_daily(host_activity_reduced(spark, sf_dir))


QUERIES = {
    "c03_cumulate_actors": c03_cumulate_actors,
    "c03_step": c03_step,
    "f18_metric_maps": f18_metric_maps,
    "c06_step": c06_step,
    "c04_scd2_backfill": c04_scd2_backfill,
    "c05_scd2_increment": c05_scd2_increment,
    "c06_user_devices_cumulated": c06_user_devices_cumulated,
    "c06_hosts_cumulated": c06_hosts_cumulated,
    "c07_datelist_bits": c07_datelist_bits,
    "c08_host_activity_reduced": c08_host_activity_reduced,
    "c09_reduced_fact_daily": c09_reduced_fact_daily,
}

# ------------------------------------------------------------------ oracles

_ACTOR_SNAP = f"""
WITH yearly AS (
  SELECT actorid, max(actor) AS actor, year, avg(rating) AS r
  FROM actor_films WHERE year <= {LAST_YEAR} GROUP BY actorid, year),
firsts AS (SELECT actorid, max(actor) AS actor, min(year) AS fy FROM yearly GROUP BY actorid),
grid AS (SELECT actorid, actor, CAST(unnest(range(fy, {LAST_YEAR} + 1)) AS INTEGER) AS current_year FROM firsts),
lastact AS (
  SELECT g.actorid, g.actor, g.current_year, max(y.year) AS ly
  FROM grid g JOIN yearly y ON y.actorid = g.actorid AND y.year <= g.current_year
  GROUP BY g.actorid, g.actor, g.current_year),
snap AS (
  SELECT l.actorid, l.actor, l.current_year, l.ly = l.current_year AS is_active,
         CASE WHEN y.r > 8 THEN 'star' WHEN y.r > 7 THEN 'good'
              WHEN y.r > 6 THEN 'average' WHEN y.r <= 6 THEN 'bad' END AS quality_class
  FROM lastact l JOIN yearly y ON y.actorid = l.actorid AND y.year = l.ly)
"""


# A run's first years have no equal state the year before, its last years none the year
# after; each first year belongs with the nearest last year at or after it.
_SCD = _ACTOR_SNAP + f""",
edge AS (
  SELECT a.*, NOT EXISTS (SELECT 1 FROM snap b WHERE b.actorid = a.actorid AND b.current_year = a.current_year - 1
               AND b.quality_class IS NOT DISTINCT FROM a.quality_class AND b.is_active = a.is_active) AS opens,
         NOT EXISTS (SELECT 1 FROM snap b WHERE b.actorid = a.actorid AND b.current_year = a.current_year + 1
               AND b.quality_class IS NOT DISTINCT FROM a.quality_class AND b.is_active = a.is_active) AS closes
  FROM snap a)
SELECT o.actorid, o.actor, o.quality_class, o.is_active, {LAST_YEAR} AS current_year, o.current_year AS start_year,
       (SELECT min(c.current_year) FROM edge c WHERE c.actorid = o.actorid AND c.closes AND c.current_year >= o.current_year) AS end_year
FROM edge o WHERE o.opens"""


_UD_ACTIVE = f"""
SELECT DISTINCT CAST(e.user_id AS VARCHAR) AS user_id, d.browser_type, CAST(e.event_time AS DATE) AS d
FROM web_events e JOIN devices d ON e.device_id = d.device_id
WHERE e.user_id IS NOT NULL
  AND CAST(e.event_time AS DATE) BETWEEN {FIRST_DAY} AND {AS_OF}"""

_HOST_DAILY = f"""
daily AS (
  SELECT subhost AS host, CAST(event_time AS DATE) AS date, count(*) AS hits,
         count(DISTINCT user_id) AS uv
  FROM web_events
  WHERE user_id IS NOT NULL
    AND CAST(event_time AS DATE) BETWEEN {FIRST_DAY} AND {AS_OF}
  GROUP BY 1, 2),
hm AS (SELECT DISTINCT host, CAST(date_trunc('month', date) AS DATE) AS month_start FROM daily),
slots AS (
  SELECT host, month_start,
         unnest(range(0, least({AS_OF}, last_day(month_start)) - month_start + 1)) AS i
  FROM hm)"""

ORACLE = {
    "c03_cumulate_actors": with_views(_ACTOR_SNAP + f"""
SELECT s.actor, s.actorid, s.quality_class, s.is_active, s.current_year,
       (SELECT string_agg(CAST(f.year AS VARCHAR) || ':' || f.filmid, ',' ORDER BY f.year, f.filmid)
        FROM actor_films f WHERE f.actorid = s.actorid AND f.year <= s.current_year) AS films,
       (SELECT count(*) FROM actor_films f WHERE f.actorid = s.actorid AND f.year <= s.current_year) AS n_films
FROM snap s""", "actor_films"),
    "c04_scd2_backfill": with_views(_SCD, "actor_films"),
    "c05_scd2_increment": with_views(_SCD, "actor_films"),
    "c06_user_devices_cumulated": with_views(f"""
SELECT user_id, browser_type, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d DESC) AS device_activity_datelist,
       count(*) AS n_dates, {AS_OF} AS date
FROM ({_UD_ACTIVE}) GROUP BY user_id, browser_type""", "web_events", "devices"),
    "c06_hosts_cumulated": with_views(f"""
SELECT host, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d DESC) AS host_activity_datelist,
       count(*) AS n_dates, {AS_OF} AS date
FROM (SELECT DISTINCT subhost AS host, CAST(event_time AS DATE) AS d FROM web_events
      WHERE user_id IS NOT NULL
        AND CAST(event_time AS DATE) BETWEEN {FIRST_DAY} AND {AS_OF})
GROUP BY host""", "web_events"),
    "c07_datelist_bits": with_views(f"""
WITH b AS (
  SELECT user_id, browser_type,
         CAST(coalesce(sum(CASE WHEN {AS_OF} - d BETWEEN 0 AND 31
                                THEN CAST(1 AS BIGINT) << CAST(31 - ({AS_OF} - d) AS INTEGER)
                                ELSE 0 END), 0) AS BIGINT) AS datelist_int
  FROM ({_UD_ACTIVE}) GROUP BY user_id, browser_type)
SELECT user_id, browser_type, datelist_int, CAST(bit_count(datelist_int) AS INTEGER) AS days_active,
       datelist_int <> 0 AS is_monthly_active, (datelist_int & 4261412864) <> 0 AS is_weekly_active,
       {AS_OF} AS date
FROM b""", "web_events", "devices"),
    "c08_host_activity_reduced": with_views(f"""
WITH {_HOST_DAILY}
SELECT s.host, s.month_start,
       string_agg(CAST(coalesce(d.hits, 0) AS VARCHAR), ',' ORDER BY s.i) AS hits_array,
       string_agg(CAST(coalesce(d.uv, 0) AS VARCHAR), ',' ORDER BY s.i) AS unique_visitors_array
FROM slots s LEFT JOIN daily d ON d.host = s.host AND d.date = s.month_start + CAST(s.i AS INTEGER)
GROUP BY s.host, s.month_start""", "web_events"),
    "c09_reduced_fact_daily": with_views(f"""
WITH {_HOST_DAILY}
SELECT s.month_start + CAST(s.i AS INTEGER) AS date,
       CAST(sum(coalesce(d.hits, 0)) AS BIGINT) AS hits,
       CAST(sum(coalesce(d.uv, 0)) AS BIGINT) AS sum_of_daily_uniques
FROM slots s LEFT JOIN daily d ON d.host = s.host AND d.date = s.month_start + CAST(s.i AS INTEGER)
GROUP BY 1""", "web_events"),
}
ORACLE["c03_step"] = ORACLE["c03_cumulate_actors"] + f" WHERE s.current_year = {LAST_YEAR}"
ORACLE["c06_step"] = ORACLE["c06_user_devices_cumulated"]

ORACLE["f18_metric_maps"] = with_views("""
WITH y AS (SELECT actorid, year, count(*) AS films, sum(votes) AS votes, max(rating) AS best FROM actor_films GROUP BY 1, 2)
SELECT actorid, year, votes / films AS votes_per_film, 'films' AS metric, CAST(films AS DOUBLE) AS value FROM y
UNION ALL SELECT actorid, year, votes / films, 'votes', CAST(votes AS DOUBLE) FROM y
UNION ALL SELECT actorid, year, votes / films, 'best', best FROM y""", "actor_films")
