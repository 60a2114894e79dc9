"""Histories survive gaps, unreadable tables, NULL keys and neighbour files."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.operators import growth, patterns, scd
from tidemark.operators.periods import PeriodGap
from tidemark.operators.running import next_in_order, running_max
from tidemark.operators.upsert import upsert_partitions
from tidemark.streaming import sessions_stream as st

D = dt.date


def _dir():
    return tempfile.mkdtemp(prefix="tidemark-gaps-")


def test_datelist_runs_skipped_days(spark):
    ts = [dt.datetime(2024, 1, d, 12) for d in (1, 2, 3, 4)]
    events = spark.createDataFrame([("u", t) for t in ts], "user_id string, t timestamp")
    path = os.path.join(_dir(), "t")
    for d in (1, 2, 4):
        out = jobs.datelist_day(spark, events, ["user_id"], "t", path, D(2024, 1, d))
    assert out.collect()[0].dates_active == [D(2024, 1, d) for d in (4, 3, 2, 1)]


def test_growth_runs_skipped_seasons(spark):
    players = spark.createDataFrame([("p", 2000, True), ("p", 2001, True), ("p", 2002, True)],
                                    "player_name string, current_season int, is_active boolean")
    path = os.path.join(_dir(), "t")
    jobs.growth_season(spark, players, "player_name", path, 2000)
    out = jobs.growth_season(spark, players, "player_name", path, 2002).collect()[0]
    assert (out.season_active_state, out.list_seasons_active) == ("Continued Playing", [2000, 2001, 2002])
    table = spark.read.parquet(path).where("current_season = 2000")
    with pytest.raises(PeriodGap):
        growth.growth_step(table, players, "player_name", 2002)


def test_scd_after_a_gap_raises(spark):
    history = spark.createDataFrame([("a", "A", True, 1990, 1990, 2000)], "id string, q string, act boolean, start_year int, end_year int, current_year int")
    snap = spark.createDataFrame([("a", "A", True, 2002)], "id string, q string, act boolean, current_year int")
    with pytest.raises(PeriodGap):
        scd.scd2_increment(history, snap, "id", ["q", "act"], "current_year", 2002)


def test_an_unreadable_table_is_not_a_missing_one(spark):
    path = os.path.join(_dir(), "t")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    players = spark.createDataFrame([("p", 2000, True)], "player_name string, current_season int, is_active boolean")
    with pytest.raises(Exception):
        jobs.growth_season(spark, players, "player_name", path, 2000)


def test_null_keys_and_buckets_keep_their_rows(spark):
    df = spark.createDataFrame([("q", None, 1, 12), ("p", D(2024, 1, 1), 2, 12), ("p", None, 3, 12), (None, D(2024, 1, 2), 4, 12)],
                               "k string, day date, id int, pts int")
    got = {r.k: r.longest_streak for r in patterns.longest_streak(df, "k", "day", ["id"], F.col("pts") > 10).collect()}
    assert got == {"q": 1, "p": 2, None: 1}
    assert {(r.k, r.id): r.n for r in next_in_order(df, ["k"], "day", "id", "pts", "n").collect()} == {("q", 1): None, ("p", 3): 2, ("p", 2): None, (None, 4): None}
    assert {r.id: r.m for r in running_max(df, ["k"], "day", ["id"], F.col("id"), "m").collect()} == {1: 1, 2: 3, 3: 3, 4: 4}


def test_running_totals_shuffle_the_rows_once(spark, sf_small):
    from tidemark.operators.running import running_totals
    from tidemark.sources import fixtures as fx
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = running_totals(patterns.team_games(fx.games(spark, sf_small)), ["team_id"], "game_date_est", ["game_id"], {"n": F.lit(1)})
        plan = r._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    wide = [x for x in plan.splitlines() if "Exchange hashpartitioning(_at" in x]
    assert len(wide) == 3, plan  # the rows, the partial totals, and the offsets back to the join
    assert plan.count("partial_sum") >= 1


def test_upsert_deduplicates_keeps_the_latest_and_prunes(spark):
    path = os.path.join(_dir(), "t")
    rows = [(1, "a", 1, 1), (1, "a", 9, 2), (2, "b", 5, 1)]
    batch = spark.createDataFrame(rows, "p int, k string, v int, version int")
    latest = [F.desc("version")]
    first = upsert_partitions(spark, path, batch, ["p", "k"], "p", latest)
    assert sorted(map(tuple, first.select("p", "k", "v").collect())) == [(1, "a", 9), (2, "b", 5)]
    again = upsert_partitions(spark, path, batch, ["p", "k"], "p", latest, periods=[1, 2])
    assert sorted(map(tuple, again.select("p", "k", "v").collect())) == [(1, "a", 9), (2, "b", 5)]
    with pytest.raises(ValueError):
        upsert_partitions(spark, path, batch, ["k"], "p", latest)
    pruned = spark.read.parquet(path).where(F.col("p").isin(1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p" in pruned.replace("isnotnull(p#", "p") or "PartitionFilters" in pruned


def test_a_stream_reads_its_own_file_only(spark):
    base = _dir()
    one = spark.range(3).withColumn("x", F.lit("own"))
    one.write.parquet(f"{base}/events.parquet")
    spark.range(10).withColumn("x", F.lit("other")).write.parquet(f"{base}/events_archive.parquet")
    q = st.run_to_parquet(st.parquet_source(spark, f"{base}/events.parquet", one.schema), f"{base}/out", f"{base}/ck")
    q.stop()
    assert spark.read.parquet(f"{base}/out").count() == 3


def test_a_stream_that_is_not_drained_raises(spark):
    base = _dir()
    spark.range(1).write.parquet(f"{base}/in")
    src = spark.readStream.schema("id long").parquet(f"{base}/in")
    with pytest.raises(TimeoutError):
        st.run_foreach_batch(src, lambda df, i: __import__("time").sleep(20), f"{base}/ck", timeout_s=1)
