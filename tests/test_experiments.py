"""Edge semantics of the experiment metrics on small in-line frames."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

from pyspark.sql import functions as F

from tidemark.operators import experiments as ex

D = dt.date
T = dt.datetime


def test_cells_are_md5_prefix_mod_2(spark):
    users = spark.createDataFrame([(u,) for u in range(50)], "user_id long")
    got = {r.user_id: r.cell for r in ex.assign_cells(users, "user_id", "salt").collect()}
    for u, c in got.items():
        assert c == int(hashlib.md5(f"salt|{u}".encode()).hexdigest()[:8], 16) % 2
    assert 10 < sum(got.values()) < 40


def test_retention_counts_exact_day_offsets(spark):
    days = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 1, 2)), (1, D(2024, 1, 8)),
                                  (2, D(2024, 1, 1)), (2, D(2024, 1, 9)),
                                  (3, D(2024, 1, 2)), (3, D(2024, 1, 3))], "user_id long, day date")
    got = {r.cohort_day: (r.cohort_size, r.retained_d1, r.retained_d7)
           for r in ex.retention(days, (1, 7)).collect()}
    assert got == {D(2024, 1, 1): (2, 1, 1), D(2024, 1, 2): (1, 1, 0)}


def test_longest_daily_streak_breaks_on_missing_day(spark):
    days = spark.createDataFrame([(1, D(2024, 1, d)) for d in (1, 2, 3, 5, 6, 7, 8, 9, 10, 11)] +
                                 [(2, D(2024, 1, 1))], "user_id long, day date")
    got = {r.user_id: (r.longest_streak_days, r.survived) for r in ex.longest_daily_streak(days, 7).collect()}
    assert got == {1: (7, True), 2: (1, False)}


def test_funnel_requires_order_and_window(spark):
    ev = spark.createDataFrame(
        [(1, T(2024, 1, 1), "view"), (1, T(2024, 1, 2), "click"), (1, T(2024, 1, 3), "purchase"),
         (2, T(2024, 1, 2), "click"), (2, T(2024, 1, 3), "view"), (2, T(2024, 1, 4), "purchase"),   # click before view
         (3, T(2024, 1, 1), "view"), (3, T(2024, 1, 9), "click")],                                 # click after 7 days
        "user_id long, ts timestamp_ntz, kind string")
    got = [(r.step_no, r.step, r.users) for r in
           ex.funnel(ev, "user_id", "ts", "kind", ["view", "click", "purchase"], 7).orderBy("step_no").collect()]
    assert got == [(1, "view", 3), (2, "click", 1), (3, "purchase", 1)]


def test_resurrection_and_post_return_activity(spark):
    act = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 1, 12)), (1, D(2024, 1, 12)),
                                 (1, D(2024, 1, 15)), (1, D(2024, 1, 30)), (2, D(2024, 1, 1))],
                                "user_id long, day date")
    r = ex.resurrection_rate(act.distinct(), 7, 7).collect()[0]
    assert (r.lapses, r.returned) == (3, 1)                        # gaps 11 (returned) and 15 (not), user 2 never came back
    none = ex.resurrection_rate(act.where("user_id = 9"), 7, 7).collect()[0]
    assert (none.lapses, none.resurrection_rate) == (0, None)
    got = sorted((x.return_day, x.gap, x.events_next_days) for x in ex.post_return_activity(act, 7, 7).collect())
    assert got == [(D(2024, 1, 12), 11, 3), (D(2024, 1, 30), 15, 1)]


def test_compare_cells_z_score(spark):
    vals = [(0, v) for v in (1, 2, 3, 4)] + [(1, v) for v in (3, 4, 5, 6, 7)]
    df = spark.createDataFrame(vals, "cell int, v long")
    r = ex.compare_cells(df, "v").collect()[0]
    m0, m1 = 2.5, 5.0
    v0, v1 = 5 / 3, 2.5
    z = (m1 - m0) / math.sqrt(v1 / 5 + v0 / 4)
    assert (r.n_control, r.n_treatment, r.mean_control, r.mean_treatment) == (4, 5, 2.5, 5.0)
    assert abs(r.z_score - z) < 1e-6


def test_uplift_against_control(spark):
    cells = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "user_id long, cell int")
    rev = spark.createDataFrame([(1, 100), (2, 300), (3, 500)], "user_id long, cents long")
    ref = spark.createDataFrame([(3, 100)], "user_id long, cents long")
    got = {r.cell: (r.users, r.net_cents, r.net_per_user, r.uplift_vs_control)
           for r in ex.uplift(rev, ref, cells).collect()}
    assert got == {0: (2, 400, 200.0, 0.0), 1: (1, 400, 400.0, 200.0)}


def test_revisit_across_day_boundary(spark):
    ev = spark.createDataFrame([(1, 7, T(2024, 1, 1, 23, 0), 1), (1, 7, T(2024, 1, 8, 22, 0), 2),
                                (1, 7, T(2024, 1, 20, 0, 0), 3), (2, 7, T(2024, 1, 1, 1, 0), 4)],
                               "user_id long, item long, ts timestamp_ntz, id long")
    got = {r.day: (r.visits, r.revisits) for r in ex.revisit_rate(ev, "user_id", "item", "ts", "id", 7).collect()}
    assert got == {D(2024, 1, 1): (2, 1), D(2024, 1, 8): (1, 0), D(2024, 1, 20): (1, 0)}


def test_ratios_without_a_base_are_null(spark):
    flat = spark.createDataFrame([(0, 1), (0, 1), (1, 1), (1, 1)], "cell int, v long")
    assert ex.compare_cells(flat, "v").collect()[0].z_score is None


def test_salt_and_user_do_not_run_together(spark):
    users = spark.createDataFrame([(u,) for u in range(300)], "user_id long")
    one = {r.user_id: r.cell for r in ex.assign_cells(users, "user_id", "exp-1", 97).collect()}
    two = {r.user_id: r.cell for r in ex.assign_cells(users, "user_id", "exp-12", 97).collect()}
    assert any(one[20 + u] != two[u] for u in range(10))
