"""Laws that need no oracle: steps = backfill, idempotent re-runs, SCD shape."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cumulate as cu
from tidemark.operators import growth, scd
from tidemark.plans import snapshot_plans as sp
from tidemark.sources import fixtures as fx

ATTRS = ["quality_class", "is_active"]


def _set(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def snaps(spark, sf_small):
    return sp.actor_snapshots(spark, sf_small).drop("films").checkpoint()


def test_scd_increment_equals_backfill(snaps):
    cols = ["actorid", "actor", "quality_class", "is_active", "current_year", "start_year", "end_year"]
    for y in range(1997, 2002):
        prev = scd.scd2_backfill(snaps, "actorid", ATTRS, "current_year", y - 1, carry=["actor"])
        inc = scd.scd2_increment(prev, snaps, "actorid", ATTRS, "current_year", y, carry=["actor"])
        full = scd.scd2_backfill(snaps, "actorid", ATTRS, "current_year", y, carry=["actor"])
        assert _set(inc, cols) == _set(full, cols), y


def test_scd_runs_touch_and_never_overlap(snaps):
    s = scd.scd2_backfill(snaps, "actorid", ATTRS, "current_year", 2001, carry=["actor"])
    by_key = {}
    for r in s.collect():
        by_key.setdefault(r.actorid, []).append((r.start_year, r.end_year))
    for runs in by_key.values():
        runs.sort()
        for (s1, e1), (s2, _) in zip(runs, runs[1:]):
            assert s2 == e1 + 1


def test_actor_steps_equal_backfill(spark, sf_small):
    films = fx.actor_films(spark, sf_small).checkpoint()
    first = films.agg(F.min("year")).first()[0]
    prev = None
    for y in range(first, 2002):
        prev = cu.cumulate_actors_step(prev, films, y).checkpoint()
    full = cu.cumulate_actors_backfill(films, 2001).where(F.col("current_year") == 2001)
    cols = ["actorid", "quality_class", "is_active", "current_year"]
    assert _set(prev, cols) == _set(full, cols)
    ft = lambda df: _set(df.select("actorid", cu.films_text(F.col("films")).alias("f")), ["actorid", "f"])
    assert ft(prev) == ft(full)


def test_datelist_steps_equal_backfill(spark, sf_small):
    ev = sp.user_device_events(spark, sf_small)
    keys = ["user_id", "browser_type"]
    start = dt.date(2024, 1, 1)
    prev = None
    for i in range(6):
        day = start + dt.timedelta(days=i)
        today = cu.daily_active_keys(ev, keys, "event_time", day, day, not_null=["user_id"])
        prev = cu.cumulate_datelist_step(prev, today, keys, day).checkpoint()
    active = cu.daily_active_keys(ev, keys, "event_time", start, start + dt.timedelta(days=5),
                                  not_null=["user_id"])
    full = cu.cumulate_datelist_backfill(active, keys, start + dt.timedelta(days=5))
    cols = ["user_id", "browser_type", "dates_active", "date"]
    assert _set(prev, cols) == _set(full.withColumnRenamed("dates_active", "dates_active"), cols)


def test_reduced_fact_steps_equal_backfill_and_rerun_is_noop(spark, sf_small):
    daily = sp.host_daily_metrics(spark, sf_small).checkpoint()
    start = dt.date(2024, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(5)]
    prev = None
    for d in days:
        prev = cu.reduced_fact_step(prev, daily, "host", d).checkpoint()
    full = cu.reduced_fact_backfill(daily, "host", days[-1])
    cols = ["host", "month_start", "hits_array", "unique_visitors_array"]
    assert _set(prev, cols) == _set(full, cols)
    again = cu.reduced_fact_step(prev, daily, "host", days[-1])
    assert _set(again, cols) == _set(prev, cols)
    earlier = cu.reduced_fact_step(prev, daily, "host", days[1])
    assert _set(earlier, cols) == _set(prev, cols)


def test_growth_steps_equal_backfill(spark, sf_small):
    players = fx.players(spark, sf_small).checkpoint()
    first = players.agg(F.min("current_season")).first()[0]
    full = growth.growth_backfill(players, "player_name", 2001).checkpoint()
    prev = None
    cols = ["player_name", "first_active_season", "last_active_season", "season_active_state",
            "list_seasons_active", "current_season"]
    for season in range(first, 2002):
        prev = growth.growth_step(prev, players, "player_name", season).checkpoint()
        assert _set(prev, cols) == _set(full.where(F.col("current_season") == season), cols), season


def test_growth_states_partition_users(spark, sf_small):
    g = growth.growth_backfill(fx.players(spark, sf_small), "player_name", 2001)
    dup = g.groupBy("player_name", "current_season").count().where("count > 1").count()
    assert dup == 0
    states = {r[0] for r in g.select("season_active_state").distinct().collect()}
    assert states <= {growth.NEW, growth.CONTINUED, growth.RETIRED, growth.RETURNED, growth.STAYED_RETIRED}


def test_bit_count_equals_recent_dates(spark, sf_small):
    s = cu.datelist_bits(sp.user_devices_cumulated(spark, sf_small), "device_activity_datelist")
    recent = F.size(F.filter("device_activity_datelist", lambda d: F.datediff(F.col("date"), d).between(0, 31)))
    assert s.where(F.col("days_active") != recent).count() == 0
