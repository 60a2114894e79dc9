"""Output tables keep their typed schema (S4) and their keys (no PK in Spark)."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from tidemark.operators import growth
from tidemark.operators.upsert import write_period
from tidemark.plans import snapshot_plans as sp
from tidemark.sources import fixtures as fx
from tidemark.sources import schemas as sc
from tidemark.streaming.sessions_stream import decode_json_events
from tidemark.operators import scd


def test_snapshot_outputs_have_schema_and_unique_keys(spark, sf_small):
    actors = sp.actor_snapshots(spark, sf_small)
    assert sc.schema_matches(actors, sc.ACTORS)
    assert sc.duplicate_keys(actors, sc.ACTORS_KEY).count() == 0
    hist = scd.scd2_backfill(actors.drop("films"), "actorid", sp.SCD_ATTRS, "current_year", 2001, carry=["actor"])
    assert sc.schema_matches(hist, sc.ACTORS_HISTORY_SCD)
    assert sc.duplicate_keys(hist, sc.ACTORS_HISTORY_SCD_KEY).count() == 0
    ud = sp.user_devices_cumulated(spark, sf_small)
    assert sc.schema_matches(ud, sc.USER_DEVICES_CUMULATED)
    assert sc.duplicate_keys(ud, sc.USER_DEVICES_CUMULATED_KEY).count() == 0
    red = sp.host_activity_reduced(spark, sf_small)
    assert sc.schema_matches(red, sc.HOST_ACTIVITY_REDUCED)
    assert sc.duplicate_keys(red, sc.HOST_ACTIVITY_REDUCED_KEY).count() == 0
    g = growth.growth_backfill(fx.players(spark, sf_small), "player_name", 2001)
    assert sc.schema_matches(g, sc.PLAYERS_GROWTH_ACCOUNTING)
    assert sc.duplicate_keys(g, sc.PLAYERS_GROWTH_ACCOUNTING_KEY).count() == 0


def test_write_period_replaces_only_that_period(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-period-"), "t")
    df = spark.createDataFrame([(1, 2000), (2, 2000), (3, 2001)], "v int, current_year int")
    write_period(df, path, "current_year")
    write_period(spark.createDataFrame([(9, 2001)], "v int, current_year int"), path, "current_year")
    got = sorted(map(tuple, spark.read.parquet(path).select("v", "current_year").collect()))
    assert got == [(1, 2000), (2, 2000), (9, 2001)]


def test_decode_json_events_parses_iso_time(spark):
    recs = [json.dumps({"ip": "1.2.3.4", "host": "h", "event_time": "2024-03-31T01:30:00.123Z"})]
    raw = spark.createDataFrame([(r,) for r in recs], "value string")
    out = decode_json_events(raw, "ip string, host string, event_time string").collect()[0]
    assert out.ip == "1.2.3.4"
    ts = out.event_timestamp   # session time zone is UTC in tests
    assert (ts.year, ts.month, ts.day, ts.hour, ts.minute, ts.second, ts.microsecond) == \
        (2024, 3, 31, 1, 30, 0, 123000)
