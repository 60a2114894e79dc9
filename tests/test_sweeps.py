"""Spans, runs of days, returns and funnels against day-by-day brute force."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tests.test_plans import plan_text
from tidemark.operators import experiments as ex
from tidemark.operators import intervals as iv
from tidemark.operators import quality as qa

D, T = dt.date, dt.datetime
START = D(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def test_unite_joins_overlapping_touching_and_nested_spans(spark):
    rows = [("a", 0, 3), ("a", 2, 5), ("a", 5, 6), ("a", 8, 20), ("a", 9, 10), ("a", 19, 21), ("a", 0, 3), ("b", 1, 2), (None, 4, 6), (None, 5, 9)]
    got = iv.unite(spark.createDataFrame(rows, "k string, start int, end int"), ["k"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("a", 0, 6), ("a", 8, 21), ("b", 1, 2), (None, 4, 9)], key=repr)


def test_sessions_are_cut_at_midnight_and_at_the_week(spark):
    rows = [(1, T(2024, 1, 7, 23, 30), T(2024, 1, 8, 0, 45)),          # over Sunday midnight
            (1, T(2024, 1, 8, 10, 0), T(2024, 1, 9, 0, 0)),            # ends at midnight: one day
            (2, T(2024, 1, 5, 12, 0), T(2024, 1, 20, 12, 0)),          # three weeks
            (3, T(2024, 1, 5, 12, 0), T(2024, 1, 5, 12, 0))]           # no length
    s = spark.createDataFrame(rows, "user_id long, session_start timestamp_ntz, session_end timestamp_ntz")
    days = iv.split_spans(s, "session_start", "session_end", "day", "day")
    got = {(r.user_id, r.day): (r.part_us // 60_000_000, r.is_first) for r in days.collect() if r.user_id != 2}
    assert got == {(1, D(2024, 1, 7)): (30, True), (1, D(2024, 1, 8)): (45, False), (3, D(2024, 1, 5)): (0, True)} | {(1, D(2024, 1, 8)): got[1, D(2024, 1, 8)]}
    assert sorted(r.part_us // 60_000_000 for r in days.collect() if r.user_id == 1) == [30, 45, 840]
    total = days.groupBy("user_id").agg(F.sum("part_us").alias("us")).collect()
    want = {u: sum(int((b - a).total_seconds()) * 1_000_000 for v, a, b in rows if v == u) for u in (1, 2, 3)}
    assert {r.user_id: r.us for r in total} == want
    weeks = ex.weekly_minutes(s.withColumn("done", F.col("user_id").cast("long") - 1), "done")
    got = {(r.user_id, r.week_start): (r.sessions, r.active_sessions, r.minutes, r.completed, r.completion_rate) for r in weeks.collect()}
    assert got[1, D(2024, 1, 1)] == (1, 1, 30.0, 0, 0.0)
    assert got[1, D(2024, 1, 8)] == (1, 2, 45.0 + 840.0, 0, 0.0)
    assert got[2, D(2024, 1, 1)][:2] == (1, 1) and got[2, D(2024, 1, 8)] == (0, 1, 7 * 1440.0, 0, None)
    assert got[3, D(2024, 1, 1)] == (1, 1, 0.0, 1, 1.0)


def _activity(seed, users=12, span=90, p=0.25):
    rng = random.Random(seed)
    rows, on = [], False
    for u in range(users):
        for n in range(span):
            on = rng.random() < (0.8 if on else p)
            if on:
                rows.append((u, day(n)))
    return rows


def test_streak_resumption_by_hand(spark):
    rows = [(1, d) for d in (0, 1, 2)] + [(1, 6)] + [(1, d) for d in (20, 21)]        # resumed after 3 idle days; then after 13: not
    rows += [(2, d) for d in (0, 1)]                                                   # never resumed
    rows += [(3, d) for d in (38, 39, 40)]                                             # still open on the last day
    rows += [(4, d) for d in (35, 36)]                                                 # over, the data end too early
    days = spark.createDataFrame([(u, day(d)) for u, d in rows], "user_id long, day date")
    got = {r.end_month: r.asDict() for r in ex.streak_resumption(days, 2, 7).collect()}
    jan, feb = got[D(2024, 1, 1)], got[D(2024, 2, 1)]
    assert (jan["runs"], jan["open_runs"], jan["broken_runs"], jan["censored_runs"], jan["resumed_runs"]) == (3, 0, 3, 0, 1)
    assert (jan["avg_idle_days"], jan["resumption_rate"]) == (3.0, 1 / 3)
    assert (feb["runs"], feb["open_runs"], feb["broken_runs"], feb["censored_runs"], feb["resumption_rate"]) == (2, 1, 1, 1, None)
    assert ex.streak_resumption(days.limit(0), 2, 7).count() == 0


def test_resurrected_users_equal_day_by_day_counts(spark):
    rows = _activity(3)
    got = {r.day: (r.returns, r.dau, r.wau) for r in
           ex.resurrected_users(spark.createDataFrame(rows, "user_id long, day date"), {"dau": 1, "wau": 7}, idle=3, hold=10).collect()}
    per = {u: sorted(d for v, d in rows if v == u) for u in {u for u, _ in rows}}
    returns = {u: [b for a, b in zip(ds, ds[1:]) if (b - a).days > 3] for u, ds in per.items()}
    assert any((b - a).days < 10 for r in returns.values() for a, b in zip(r, r[1:]))      # windows that overlap
    kept = {u: [d for d in ds if any(0 <= (d - r).days < 10 for r in returns[u])] for u, ds in per.items()}
    first, last = min(d for _, d in rows), max(d for _, d in rows)
    for n in range((last - first).days + 1):
        d = first + dt.timedelta(days=n)
        want = (sum(d in r for r in returns.values()), *(sum(any(0 <= (d - k).days < w for k in ks) for ks in kept.values()) for w in (1, 7)))
        assert got.pop(d) == want
    assert not got


def _funnel(rows, steps, within):
    """users per step, one event after the other."""
    reached = [0] * len(steps)
    for u in {r[0] for r in rows if r[0] is not None}:
        mine = sorted((t, k) for v, t, k in rows if v == u and t is not None)
        times = []
        for i, s in enumerate(steps):
            ok = [t for t, k in mine if k == s and (not times or (t >= times[-1] and t <= times[0] + within))]
            if not ok:
                break
            times.append(min(ok))
            reached[i] += 1
    return reached


def test_funnel_equals_brute_force_over_buckets(spark):
    rng = random.Random(5)
    steps = ["a", "b", "c", "d"]
    rows = [(rng.randrange(60), T(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(0, 4 * 1440, 10)), rng.choice(steps + ["x"])) for _ in range(900)]
    rows += [(None, T(2024, 1, 1), "a"), (1, None, "a"), (99, T(2024, 1, 1), "b"), (99, T(2024, 1, 1), "a"), (99, T(2024, 1, 2), "c")]
    ev = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, kind string")
    for n in (1, 2, 3, 4):
        for bucket in ("hour", "day"):
            got = {r.step_no: r.users for r in ex.funnel(ev, "user_id", "ts", "kind", steps[:n], 1, bucket).collect()}
            assert [got[i + 1] for i in range(n)] == _funnel(rows, steps[:n], dt.timedelta(days=1))


def test_funnel_gathers_cells_and_not_events(spark):
    ev = spark.createDataFrame([(1, T(2024, 1, 1), "a")], "user_id long, ts timestamp_ntz, kind string")
    plan = plan_text(ex.funnel(ev, "user_id", "ts", "kind", ["a", "b"], 7))
    # the events go through the (user, hour) shuffle; the per-user one comes after their cells are aggregated
    assert "collect_set" not in plan and plan.index("hashpartitioning(_u") < plan.index("collect_list")
    first = plan[plan.index("hashpartitioning("):].split(")")[0]
    assert "_u" in first and "_b" in first


def test_kpi_days_without_orders_and_sessions_are_there(spark):
    orders = spark.createDataFrame([("x", day(0), 100, 40, 5), ("x", day(4), 50, 10, 0), ("y", day(4), 30, 0, 0), ("z", None, 1, 1, 1)],
                                   "customer string, day date, revenue long, cogs long, refund long")
    s = spark.createDataFrame([(1, T(2024, 1, 2, 23, 0), T(2024, 1, 3, 1, 0)), (2, T(2024, 1, 3, 5, 0), T(2024, 1, 3, 5, 30))],
                              "user_id long, session_start timestamp_ntz, session_end timestamp_ntz")
    got = {r.day: r.asDict() for r in qa.kpi_daily(orders, s).collect()}
    assert sorted(got) == [day(i) for i in range(5)]
    assert (got[day(0)]["profit_cents"], got[day(0)]["new_customers"], got[day(0)]["minutes_per_user"]) == (55, 1, None)
    assert (got[day(1)]["orders"], got[day(1)]["sessions"], got[day(1)]["active_users"], got[day(1)]["minutes_per_user"]) == (0, 1, 1, 60.0)
    assert (got[day(2)]["sessions"], got[day(2)]["active_users"], got[day(2)]["minutes_per_user"]) == (1, 2, 45.0)
    assert (got[day(3)]["orders"], got[day(3)]["session_us"], got[day(3)]["revenue_cents"]) == (0, 0, 0)
    assert (got[day(4)]["orders"], got[day(4)]["revenue_cents"], got[day(4)]["new_customers"]) == (2, 80, 1)
