"""Edge cases from the fixture notes, on small in-line frames."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import cumulate as cu
from tidemark.operators import enrich as en
from tidemark.operators import growth, patterns as pt, scd
from tidemark.operators.matches import match_fact, medal_map
from tidemark.operators.running import running_totals
from tidemark.operators.sessions import sessionize
from tidemark.operators.upsert import upsert

D = dt.date
T = dt.datetime


def test_scd_null_class_is_a_state(spark):
    snap = spark.createDataFrame(
        [("a", "A", None, True, 1), ("a", "A", None, True, 2), ("a", "A", "bad", True, 3),
         ("a", "A", None, False, 4), ("b", "B", "star", True, 3)],
        "actorid string, actor string, quality_class string, is_active boolean, current_year int")
    attrs = ["quality_class", "is_active"]
    full = scd.scd2_backfill(snap, "actorid", attrs, "current_year", 4, carry=["actor"])
    got = sorted(((r.actorid, r.quality_class, r.is_active, r.start_year, r.end_year, r.current_year)
                  for r in full.collect()), key=repr)
    assert got == sorted([("a", None, True, 1, 2, 4), ("a", "bad", True, 3, 3, 4),
                          ("a", None, False, 4, 4, 4), ("b", "star", True, 3, 3, 4)], key=repr)
    prev = scd.scd2_backfill(snap, "actorid", attrs, "current_year", 3, carry=["actor"])
    inc = scd.scd2_increment(prev, snap, "actorid", attrs, "current_year", 4, carry=["actor"])
    key = lambda r: (r.actorid, r.start_year)
    assert sorted(map(tuple, inc.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)
    assert {key(r) for r in inc.collect()} == {key(r) for r in full.collect()}


def test_actor_step_prior_only_and_new_only(spark):
    films = spark.createDataFrame(
        [("A", "1", "f1", 2000, 10, 9.0, "f1"), ("B", "2", "f2", 2001, 10, 5.0, "f2")],
        "actor string, actorid string, film string, year int, votes int, rating double, filmid string")
    y0 = cu.cumulate_actors_step(None, films, 2000)
    y1 = {r.actorid: r for r in cu.cumulate_actors_step(y0, films, 2001).collect()}
    assert (y1["1"].is_active, y1["1"].quality_class, len(y1["1"].films)) == (False, "star", 1)
    assert (y1["2"].is_active, y1["2"].quality_class, len(y1["2"].films)) == (True, "bad", 1)


def test_reduced_fact_month_rollover_and_late_host(spark):
    daily = spark.createDataFrame(
        [("h1", D(2024, 1, 30), 3, 2), ("h1", D(2024, 1, 31), 4, 1), ("h2", D(2024, 1, 31), 7, 7),
         ("h1", D(2024, 2, 1), 5, 5)], "host string, date date, hits long, unique_visitors long")
    jan = cu.reduced_fact_step(None, daily, "host", D(2024, 1, 30))
    jan = cu.reduced_fact_step(jan, daily, "host", D(2024, 1, 31))
    rows = {r.host: r for r in jan.collect()}
    assert rows["h1"].hits_array[-2:] == [3, 4] and len(rows["h1"].hits_array) == 31
    assert rows["h2"].hits_array == [0] * 30 + [7]           # new host: zero-padded (D18)
    feb = cu.reduced_fact_step(jan, daily, "host", D(2024, 2, 1)).collect()
    assert [(r.host, r.month_start, r.hits_array) for r in feb] == [("h1", D(2024, 2, 1), [5])]


def test_datelist_drops_null_users_and_rerun_keeps_one_entry(spark):
    ev = spark.createDataFrame([(1, T(2024, 1, 1, 5)), (None, T(2024, 1, 1, 6)), (1, T(2024, 1, 2, 1))],
                               "user_id long, ts timestamp_ntz")
    keys = ["user_id"]
    d1 = cu.daily_active_keys(ev, keys, "ts", D(2024, 1, 1), D(2024, 1, 1), not_null=keys)
    s1 = cu.cumulate_datelist_step(None, d1, keys, D(2024, 1, 1))
    d2 = cu.daily_active_keys(ev, keys, "ts", D(2024, 1, 2), D(2024, 1, 2), not_null=keys)
    s2 = cu.cumulate_datelist_step(s1, d2, keys, D(2024, 1, 2)).collect()
    assert [(r.user_id, r.dates_active, r.date) for r in s2] == [(1, [D(2024, 1, 2), D(2024, 1, 1)], D(2024, 1, 2))]


def test_growth_missing_row_counts_as_inactive(spark):
    p = spark.createDataFrame([("p", 2000, True), ("p", 2002, True)],
                              "player_name string, current_season int, is_active boolean")
    g = {r.current_season: r.season_active_state for r in growth.growth_backfill(p, "player_name", 2003).collect()}
    assert g == {2000: "New", 2001: "Retired", 2002: "Returned from Retirement", 2003: "Retired"}


def test_rolling_wins_short_history_and_unknown_results(spark):
    games = spark.createDataFrame(
        [(1, D(2020, 1, 1), 1, 2, 1), (2, D(2020, 1, 2), 1, 2, None), (3, D(2020, 1, 2), 2, 1, 0)],
        "game_id long, game_date_est date, home_team_id long, visitor_team_id long, home_team_wins int")
    best = {r.team_id: (r.total_number_games, r.max_3_game_wins) for r in pt.rolling_wins(games, 3).collect()}
    assert best == {1: (3, 2), 2: (3, 0)}
    best2 = {r.team_id: r.max_2_game_wins for r in pt.rolling_wins(games, 2).collect()}
    assert best2 == {1: 1, 2: 0}


def test_streak_skips_nulls_and_counts_only_hits(spark):
    rows = [(1, D(2020, 1, i), i, pts) for i, pts in
            enumerate([12, None, 15, 3, 11, 11, 11, None, 2], start=1)]
    df = spark.createDataFrame(rows + [(2, D(2020, 1, 1), 1, 1)], "p long, d date, g long, pts int")
    out = {r.p: r.longest_streak for r in
           pt.longest_streak(df, "p", "d", ["g"], F.col("pts") > 10, skip_null=F.col("pts")).collect()}
    assert out == {1: 3, 2: 0}


def _brute_sessions(events, gap):
    out = {}
    for key in {k for k, _ in events}:
        ts = sorted(t for k, t in events if k == key)
        start = last = ts[0]
        n = 1
        for t in ts[1:]:
            if t - last > gap:
                out.setdefault(key, []).append((start, last + gap, n))
                start, n = t, 0
            last = t
            n += 1
        out.setdefault(key, []).append((start, last + gap, n))
    return {k: sorted(v) for k, v in out.items()}


def test_sessionize_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    base = T(2024, 1, 1)
    events = []
    t = base
    for _ in range(3000):                      # hot key: dense, crossing many hour edges
        t += dt.timedelta(seconds=rnd.choice([1, 30, 120, 299, 300, 301, 900, 3600]))
        events.append(("hot", t))
    for i in range(300):
        events.append((f"k{i % 7}", base + dt.timedelta(seconds=rnd.randint(0, 86400 * 3))))
    events.append(("edge", T(2024, 1, 1, 0, 58)))
    events.append(("edge", T(2024, 1, 1, 1, 3)))           # exactly 5:00 later, across the hour edge
    events.append(("edge", T(2024, 1, 1, 1, 8, 0, 1)))     # 5:00.000001 later: new session
    df = spark.createDataFrame(events, "k string, ts timestamp_ntz")
    got = {}
    for r in sessionize(df, ["k"], "ts", 300).collect():
        got.setdefault(r.k, []).append((r.session_start, r.session_end, r.num_hits))
    got = {k: sorted(v) for k, v in got.items()}
    assert got == _brute_sessions(events, dt.timedelta(seconds=300))
    assert len(got["edge"]) == 2


def test_running_totals_match_plain_window(spark):
    rnd = random.Random(3)
    rows = [("a" if rnd.random() < 0.6 else "b", D(2024, 1, rnd.randint(1, 5)), i, rnd.randint(0, 3))
            for i in range(500)]
    df = spark.createDataFrame(rows, "k string, d date, i long, v int")
    r = running_totals(df, ["k"], "d", ["i"], {"s": F.col("v").cast("bigint")}, totals=True)
    got = {(x.k, x.i): (x.s, x.s_total) for x in r.collect()}
    for k in ("a", "b"):
        seq = sorted((d, i, v) for kk, d, i, v in rows if kk == k)
        acc, tot = 0, sum(v for _, _, v in seq)
        for d, i, v in seq:
            acc += v
            assert got[(k, i)] == (acc, tot)


def test_asof_weekend_carried_and_frozen_before_first_rate(spark):
    rates = spark.createDataFrame([("EUR", D(2024, 1, 5), 1.1), ("EUR", D(2024, 1, 8), 1.2)],
                                  "ccy string, rate_date date, rate double")
    facts = spark.createDataFrame([(1, "EUR", D(2024, 1, 4), 10.0), (2, "EUR", D(2024, 1, 6), 10.0),
                                   (3, "EUR", D(2024, 1, 8), 10.0), (4, "USD", D(2024, 1, 8), 1.0)],
                                  "id long, ccy string, day date, amount double")
    out = {r.id: (r.fx_status, r.rate_date) for r in en.convert_fx(facts, rates, "amount").collect()}
    assert out == {1: ("frozen", None), 2: ("carried", D(2024, 1, 5)), 3: ("converted", D(2024, 1, 8)),
                   4: ("frozen", None)}


def test_ip_range_straddles_blocks_and_bad_ip(spark):
    ranges = spark.createDataFrame([(167837000, 167968000, "X"), (167968001, 167968001, "Y")],
                                   "ip_start long, ip_end long, country string")
    facts = spark.createDataFrame([(1, "10.1.0.200"), (2, "10.2.255.255"), (3, "10.3.0.1"),
                                   (4, "not-an-ip"), (5, "10.1.3.72")], "id long, ip string")
    got = {r.id: r.country for r in en.ip_range_join(facts, "ip", ranges).collect()}
    # 10.1.0.200 = 167837896 (X); 10.2.255.255 = 168034303 (none); 10.3.0.1 none; 10.1.3.72 = 167838536 (X)
    assert got == {1: "X", 2: None, 3: None, 4: None, 5: "X"}
    assert en.ip_range_join(facts, "ip", ranges).count() == 5


def test_upsert_latest_wins_and_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    upd = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k long, v string, ver int")
    once = upsert(old, upd, ["k"], [F.desc("ver")])
    twice = upsert(once, upd, ["k"], [F.desc("ver")])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "y"), (3, "z")]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_player_without_medals_is_kept_and_duplicate_medals_summed(spark):
    matches = spark.createDataFrame([(1, D(2020, 1, 1), 0, "p1")],
                                    "match_id long, completion_date date, mapid long, playlist_id string")
    details = spark.createDataFrame([(1, 10, 5), (1, 11, 7)], "match_id long, player_gamertag long, player_total_kills long")
    mmp = spark.createDataFrame([(1, 10, "m", 1), (1, 10, "m", 2)],
                                "match_id long, player_gamertag long, medal_id string, medal_count long")
    medals = spark.createDataFrame([("m", "Spree"), ("m", "Spree")], "medal_id string, name string")
    maps = spark.createDataFrame([(0, "Map0")], "mapid long, name string")
    f = {r.player_gamertag: r.medals_count_map for r in
         match_fact(matches, details, medal_map(mmp, medals), maps).collect()}
    assert f == {10: {"Spree": 3}, 11: None}


def test_bit_or_of_day_bits_equals_array_bits_and_is_idempotent(spark):
    from tidemark.functions.bits import datelist_to_bits, day_bit
    rows = [(1, D(2024, 1, 30)), (1, D(2024, 1, 24)), (1, D(2024, 1, 24)), (1, D(2023, 12, 1)), (2, D(2024, 1, 1))]
    df = spark.createDataFrame(rows, "u long, d date")
    as_of = F.lit("2024-01-30").cast("date")
    agg = {r.u: r.b for r in df.groupBy("u").agg(F.bit_or(day_bit(F.col("d"), as_of)).alias("b")).collect()}
    arr = {r.u: r.b for r in df.groupBy("u").agg(F.collect_list("d").alias("ds"))
           .select("u", datelist_to_bits(F.col("ds"), as_of).alias("b")).collect()}
    assert agg == arr == {1: (1 << 31) | (1 << 25), 2: 1 << 2}
