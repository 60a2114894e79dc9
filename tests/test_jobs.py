"""Period jobs write one partition per run; N runs equal the one-shot backfill."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.operators import cumulate as cu, growth, scd
from tidemark.plans import snapshot_plans as sp
from tidemark.sources import fixtures as fx


def _set(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def test_actor_and_scd_jobs_equal_backfill(spark, sf_small):
    base = tempfile.mkdtemp(prefix="tidemark-jobs-")
    films = fx.actor_films(spark, sf_small)
    first = films.agg(F.min("year")).first()[0]
    for y in range(first, 2002):
        jobs.actors_year(spark, films, os.path.join(base, "actors"), y)
        jobs.actors_scd_year(spark, os.path.join(base, "actors"), os.path.join(base, "scd"), y, first)
    jobs.actors_year(spark, films, os.path.join(base, "actors"), 2001)      # re-run: same partition
    got = spark.read.parquet(os.path.join(base, "actors")).where("current_year = 2001")
    full = cu.cumulate_actors_backfill(films, 2001).where("current_year = 2001")
    cols = ["actorid", "quality_class", "is_active", "current_year"]
    assert _set(got, cols) == _set(full, cols)
    s_got = spark.read.parquet(os.path.join(base, "scd")).where("current_year = 2001")
    s_full = scd.scd2_backfill(cu.cumulate_actors_backfill(films, 2001).drop("films"),
                               "actorid", sp.SCD_ATTRS, "current_year", 2001, carry=["actor"])
    scols = ["actorid", "quality_class", "is_active", "start_year", "end_year", "current_year"]
    assert _set(s_got, scols) == _set(s_full, scols)


def test_datelist_and_reduced_jobs_equal_backfill(spark, sf_small):
    base = tempfile.mkdtemp(prefix="tidemark-jobs-")
    ev = sp.user_device_events(spark, sf_small)
    daily = sp.host_daily_metrics(spark, sf_small)
    start = dt.date(2024, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(4)]
    for d in days + [days[-1]]:
        jobs.datelist_day(spark, ev, ["user_id", "browser_type"], "event_time", os.path.join(base, "ud"), d)
        jobs.reduced_fact_day(spark, daily, "host", os.path.join(base, "red"), d)
    ud = spark.read.parquet(os.path.join(base, "ud")).where(F.col("date") == F.lit(days[-1]))
    active = cu.daily_active_keys(ev, ["user_id", "browser_type"], "event_time", start, days[-1],
                                  not_null=["user_id"])
    full = cu.cumulate_datelist_backfill(active, ["user_id", "browser_type"], days[-1])
    assert _set(ud, ["user_id", "browser_type", "dates_active"]) == _set(full, ["user_id", "browser_type", "dates_active"])
    red = spark.read.parquet(os.path.join(base, "red"))
    rfull = cu.reduced_fact_backfill(daily, "host", days[-1])
    cols = ["host", "month_start", "hits_array", "unique_visitors_array"]
    assert _set(red, cols) == _set(rfull, cols)


def test_growth_job_equals_backfill(spark, sf_small):
    base = tempfile.mkdtemp(prefix="tidemark-jobs-")
    players = fx.players(spark, sf_small)
    first = players.agg(F.min("current_season")).first()[0]
    for s in range(first, 2002):
        jobs.growth_season(spark, players, "player_name", os.path.join(base, "g"), s)
    got = spark.read.parquet(os.path.join(base, "g"))
    full = growth.growth_backfill(players, "player_name", 2001)
    cols = ["player_name", "first_active_season", "last_active_season", "season_active_state",
            "list_seasons_active", "current_season"]
    assert _set(got, cols) == _set(full, cols)
