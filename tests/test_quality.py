"""Edge semantics of the quality / KPI operators on small in-line frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import quality as qa

D = dt.date
T = dt.datetime


def test_business_day_dst_and_weekend_roll(spark):
    df = spark.createDataFrame([(T(2024, 3, 30, 23, 30),),      # Sat 23:30 UTC -> Sun 00:30 local -> Monday
                                (T(2024, 3, 31, 1, 30),),       # DST jump: 03:30 local, Sunday -> Monday
                                (T(2024, 4, 1, 21, 59),),       # Mon 23:59 local
                                (T(2024, 4, 1, 22, 0),)],       # Tue 00:00 local
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(qa.business_day(F.col("ts"), "Europe/Madrid", roll_weekend=True)).collect()]
    assert got == [D(2024, 4, 1), D(2024, 4, 1), D(2024, 4, 1), D(2024, 4, 2)]


def test_round_money_half_up_vs_half_even(spark):
    df = spark.createDataFrame([(0.10,), (0.30,), (1.00,)], "amount double")
    up, even = qa.round_money(F.col("amount"), "0.025")
    got = [(float(a), float(b)) for a, b in df.select(up, even).collect()]
    # 0.10*0.025 = 0.0025 -> 0.00 (even) / 0.00 (up at 2dp); 0.30*0.025 = 0.0075 -> 0.01 both
    assert got == [(0.0, 0.0), (0.01, 0.01), (0.03, 0.02)]


def test_fiscal_calendar_starts_in_february(spark):
    days = spark.createDataFrame([(D(2024, 1, 31),), (D(2024, 2, 1),), (D(2024, 4, 30),), (D(2025, 1, 15),)],
                                 "day date")
    got = {r.day: (r.fiscal_year, r.fiscal_quarter) for r in qa.fiscal_calendar(days, "day", 2).collect()}
    assert got == {D(2024, 1, 31): (2024, 4), D(2024, 2, 1): (2025, 1), D(2024, 4, 30): (2025, 1),
                   D(2025, 1, 15): (2025, 4)}


def test_period_complete_leap_february(spark):
    feb = [(D(2024, 2, d),) for d in range(1, 30)]
    mar = [(D(2024, 3, d),) for d in range(1, 31)]                  # March 31 missing
    df = spark.createDataFrame(feb + mar + feb[:1], "d date")
    got = {r.month_start: (r.days_seen, r.days_expected, r.is_complete)
           for r in qa.period_complete(df, F.col("d")).collect()}
    assert got == {D(2024, 2, 1): (29, 29, True), D(2024, 3, 1): (30, 31, False)}


def test_missing_business_days_skips_weekends(spark):
    df = spark.createDataFrame([("X", D(2024, 1, 5)), ("X", D(2024, 1, 10))], "ccy string, day date")
    got = sorted(r.missing_day for r in qa.missing_business_days(df, "ccy", "day").collect())
    assert got == [D(2024, 1, 8), D(2024, 1, 9)]                   # Sat 6 / Sun 7 are not expected


def test_snapshot_fallback_carries_last_value(spark):
    daily = spark.createDataFrame([("h", D(2024, 1, 1), 5), ("h", D(2024, 1, 3), 7)],
                                  "host string, date date, hits long")
    got = [(r.date, r.hits, r.source_day, r.is_provisional)
           for r in qa.snapshot_or_fallback(daily, "host", "date", "hits", "2024-01-04").orderBy("date").collect()]
    assert got == [(D(2024, 1, 1), 5, D(2024, 1, 1), False), (D(2024, 1, 2), 5, D(2024, 1, 1), True),
                   (D(2024, 1, 3), 7, D(2024, 1, 3), False), (D(2024, 1, 4), 7, D(2024, 1, 3), True)]


def test_attribution_window_edges(spark):
    ev = spark.createDataFrame(
        [(1, 1, T(2024, 1, 1, 10), "click"), (2, 1, T(2024, 1, 2, 10), "purchase"),        # exactly 1 day: credited
         (3, 2, T(2024, 1, 1, 10), "click"), (4, 2, T(2024, 1, 2, 10, 0, 1), "purchase"),  # 1 day + 1 s: not
         (5, 3, T(2024, 1, 2, 9), "purchase"),                                               # no touch
         (6, 4, T(2024, 1, 2, 8), "click"), (7, 4, T(2024, 1, 2, 8), "purchase")],          # same instant, id order
        "event_id long, user_id long, event_time timestamp_ntz, event_type string")
    r = qa.attribute_last_touch(ev, "user_id", "event_time", "event_id", F.col("event_type") == "click",
                                F.col("event_type") == "purchase", 86400).collect()
    assert [(x.day, x.conversions, x.attributed) for x in r] == [(D(2024, 1, 2), 4, 2)]


def test_dominant_sources_dropped_per_day(spark):
    rows = [(D(2024, 1, 1), 1)] * 8 + [(D(2024, 1, 1), 2)] * 2 + [(D(2024, 1, 2), 1), (D(2024, 1, 2), 2)]
    df = spark.createDataFrame(rows, "day date, src int")
    got = {r.day: (r.rows, r.dropped, r.kept, r.sources_dropped)
           for r in qa.drop_dominant_sources(df, F.col("day"), "src", 0.6).collect()}
    assert got == {D(2024, 1, 1): (10, 8, 2, 1), D(2024, 1, 2): (2, 0, 2, 0)}


def test_active_users_spans_match_brute_force(spark):
    acts = [(1, D(2024, 1, 1)), (1, D(2024, 1, 5)), (2, D(2024, 1, 3)), (3, D(2024, 1, 9)), (1, D(2024, 1, 12))]
    df = spark.createDataFrame(acts, "user_id long, day date")
    got = {r.day: (r.dau, r.wau) for r in
           qa.active_users(df, {"dau": 1, "wau": 7}, "2024-01-01", "2024-01-12").collect()}
    for i in range(12):
        d = D(2024, 1, 1) + dt.timedelta(days=i)
        dau = len({u for u, a in acts if a == d})
        wau = len({u for u, a in acts if d - dt.timedelta(days=6) <= a <= d})
        assert got[d] == (dau, wau), d


def test_run_diff_keys_in_one_run_only(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("c", 4)], "k string, v long")
    got = sorted((r.k, r.old_value, r.new_value, r.delta) for r in qa.run_diff(old, new, ["k"], "v").collect())
    assert got == [("b", 2, 3, 1), ("c", None, 4, 4)]


def test_rule_report_counts_null_as_failing(spark):
    df = spark.createDataFrame([(1,), (None,), (200,)], "v long")
    got = {r.rule: (r.failed_rows, r.total_rows) for r in
           qa.rule_report(df, {"in_range": F.col("v").between(0, 100)}).collect()}
    assert got == {"in_range": (2, 3)}
