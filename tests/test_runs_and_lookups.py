"""Versioned runs, re-run periods, late rows over restarts, nested ranges and rates in the row."""

from __future__ import annotations

import datetime as dt
import os
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan_text
from tidemark import jobs
from tidemark.functions.ip import long_to_ipv4
from tidemark.functions.sizing import is_small
from tidemark.operators import cumulate as cu
from tidemark.operators import enrich as en
from tidemark.operators import growth, periods, runs
from tidemark.operators.upsert import remove_path
from tidemark.plans import enrich_plans
from tidemark.streaming import late_rows as lr
from tidemark.streaming import sessions_stream as st

D, T = dt.date, dt.datetime


# ---------------------------------------------------------------- Q17

def test_diff_reads_changed_buckets_only(spark):
    path = tempfile.mkdtemp(prefix="tidemark-runs-") + "/t"
    old = [(h, D(2024, m, 1), m * 10 + h) for h in range(20) for m in (1, 2, 3)]
    new = [r for r in old if r[:2] != (3, D(2024, 2, 1))] + [(77, D(2024, 2, 9), 1)]
    new = [(h, d, v + 5) if (h, d) == (4, D(2024, 2, 1)) else (h, d, v) for h, d, v in new]
    schema = "host long, date date, hits long"
    bucket = F.date_format("date", "yyyy-MM")
    runs.publish(spark.createDataFrame(old, schema), path, "v1", bucket)
    runs.publish(spark.createDataFrame(list(reversed(new)), schema).repartition(7), path, "v2", bucket)
    runs.publish(spark.createDataFrame(list(reversed(old)), schema).repartition(5), path, "v1-again", bucket)
    assert runs.changed_buckets(spark, path, "v1", "v1-again") == []                     # order and tasks don't matter
    assert runs.diff(spark, path, "v1", "v1-again", ["host", "date"], ["hits"]).count() == 0
    assert runs.changed_buckets(spark, path, "v1", "v2") == ["2024-02"]
    # the files of the other buckets can be gone: the diff does not touch them
    for run in ("v1", "v2"):
        for month in ("2024-01", "2024-03"):
            remove_path(spark, f"{path}/rows/run_id={run}/bucket={month}")
    got = sorted(map(tuple, runs.diff(spark, path, "v1", "v2", ["host", "date"], ["hits"]).collect()))
    assert got == [(3, D(2024, 2, 1), "removed", 23, None, -23), (4, D(2024, 2, 1), "moved", 24, 29, 5), (77, D(2024, 2, 9), "added", None, 1, 1)]
    plan = plan_text(runs.diff(spark, path, "v1", "v2", ["host", "date"], ["hits"]))
    assert len(re.findall(r"PartitionFilters: \[.*bucket#\d+ = 2024-02", plan)) == 2


def test_runs_are_replaced_read_back_and_named(spark):
    path = tempfile.mkdtemp(prefix="tidemark-runs-") + "/t"
    rows = spark.createDataFrame([(1, 5), (None, None)], "k long, v long")
    runs.publish(rows, path, "a", F.lit(None).cast("string"))
    runs.publish(rows.limit(1), path, "a", runs.hash_bucket(["k"], 3))
    assert sorted(map(tuple, runs.read_run(spark, path, "a").collect())) == [(1, 5)]
    runs.publish(rows.limit(0), path, "empty", runs.hash_bucket(["k"], 3))
    assert [tuple(r) for r in runs.diff(spark, path, "empty", "a", ["k"], ["v"]).collect()] == [(1, "added", None, 5, 5)]
    with pytest.raises(runs.UnknownRun):
        runs.diff(spark, path, "a", "never", ["k"], ["v"])
    with pytest.raises(ValueError):
        runs.publish(rows, path, "../x", F.lit("b"))


# ---------------------------------------------------------------- Q6

def _table(df, *columns):
    return sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))


def test_mending_an_early_day_changes_all_later_snapshots(spark):
    path = tempfile.mkdtemp(prefix="tidemark-refresh-") + "/t"
    day = lambda n: D(2024, 1, n)
    events = spark.createDataFrame([(u, T(2024, 1, n, 12)) for u, n in ((1, 1), (1, 3), (2, 2), (3, 4), (1, 5))], "u long, ts timestamp_ntz")
    late = spark.createDataFrame([(9, T(2024, 1, 2, 12)), (1, T(2024, 1, 2, 12))], "u long, ts timestamp_ntz")
    for n in range(1, 6):
        jobs.datelist_day(spark, events, ["u"], "ts", path, day(n))
    mended = events.unionByName(late)
    jobs.datelist_day(spark, mended, ["u"], "ts", path, day(2))
    for n in range(1, 6):
        want = cu.cumulate_datelist_backfill(cu.daily_active_keys(mended, ["u"], "ts", day(1), day(n)), ["u"], day(n))
        got = spark.read.parquet(path).where(F.col("date") == F.lit(day(n)))
        assert _table(got, "u", "dates_active") == _table(want, "u", "dates_active")
    assert periods.stale_from(spark, path) is None


def test_unfinished_refresh_is_marked_and_taken_up_by_the_next_run(spark):
    path = tempfile.mkdtemp(prefix="tidemark-refresh-") + "/t"
    rows = [(p, y, p % 2 == 0 or y != 2001) for p in range(6) for y in range(2000, 2005)]
    schema = "player string, current_season int, is_active boolean"
    first = spark.createDataFrame([(str(p), y, a and not (p == 3 and y == 2001)) for p, y, a in rows], schema)
    full = spark.createDataFrame([(str(p), y, True) for p, y, _ in rows], schema)
    for y in range(2000, 2005):
        jobs.growth_season(spark, first, "player", path, y)
    jobs.growth_season(spark, full, "player", path, 2001, propagate=False)
    assert periods.stale_from(spark, path) == "2002"                    # later seasons still rest on the old one
    jobs.growth_season(spark, full, "player", path, 2004)               # starts from the mark
    assert periods.stale_from(spark, path) is None
    jobs.growth_season(spark, full, "player", path, 2000)
    columns = ["player", "season_active_state", "list_seasons_active", "current_season"]
    assert _table(spark.read.parquet(path), *columns) == _table(growth.growth_backfill(full, "player", 2004), *columns)

    def dies(y):
        if y == 2003:
            raise RuntimeError("lost")
        jobs.write_period(growth.growth_step(jobs._prior(spark, path, "current_season", y), first, "player", y), path, "current_season")

    with pytest.raises(RuntimeError):
        periods.refresh(spark, path, "current_season", 2001, lambda y: y + 1, dies)
    assert periods.stale_from(spark, path) == "2003"


def test_steps_refuse_a_gap(spark):
    films = spark.createDataFrame([("a", "1", "f", y, 1, 8.0, f"f{y}") for y in (2003, 2005)], "actor string, actorid string, film string, year int, votes int, rating double, filmid string")
    one = cu.cumulate_actors_step(None, films, 2003)
    with pytest.raises(periods.PeriodGap):
        cu.cumulate_actors_step(one, films, 2005)
    two = cu.cumulate_actors_step(one.unionByName(cu.cumulate_actors_step(one, films, 2004)), films, 2005).first()
    assert len(two.films) == 2 and two.is_active and two.quality_class == "good"
    today = spark.createDataFrame([(1, D(2024, 1, 1))], "u long, date_active date")
    state = cu.cumulate_datelist_step(None, today, ["u"], D(2024, 1, 1))
    with pytest.raises(periods.PeriodGap):
        cu.cumulate_datelist_step(state, today, ["u"], D(2024, 1, 3))


# ---------------------------------------------------------------- T6

def test_late_rows_over_more_than_a_hundred_batches_and_a_restart(spark):
    src = tempfile.mkdtemp(prefix="tidemark-late-src-")
    one = os.path.join(src, "one")
    schema = "ip string, host string, event_time timestamp_ntz"

    def put(first, last):
        """One file per batch: an event that moves the watermark on, and (from the third) one far behind it."""
        for i in range(first, last):
            rows = [("1.1.1.1", "h", T(2024, 1, 2) + dt.timedelta(minutes=10 * i))] + ([("2.2.2.2", "h", T(2024, 1, 1))] if i > 1 else [])
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{one}/{i:04d}")
            name = next(f for f in os.listdir(f"{one}/{i:04d}") if f.endswith(".parquet"))
            with open(f"{one}/{i:04d}/{name}", "rb") as a, open(f"{src}/{i:04d}.parquet", "wb") as b:
                b.write(a.read())
            os.utime(f"{src}/{i:04d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))

    def run():
        stream = st.parquet_source(spark, f"{src}/*.parquet", spark.createDataFrame([], schema).schema, 1)
        stream = stream.withColumn("event_timestamp", F.col("event_time").cast("timestamp"))
        return st.run_to_parquet(st.session_counts(stream), f"{src}-out/o", f"{src}-out/c")

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert lr.late_rows(spark, f"{src}-out/c") == (0, 0, -1)
        put(0, 106)
        q = run()
        got = lr.late_rows(spark, f"{src}-out/c")
        assert len(q.recentProgress) <= 100 and got.batches >= 106
        assert got.rows == 104
        put(106, 110)
        run()
        again = lr.late_rows(spark, f"{src}-out/c")
        assert again.rows == 108 and again.batches >= got.batches + 4
        assert len(os.listdir(f"{src}-out/c/late_rows")) <= 2 * (lr.FOLD + 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ledger_replaces_a_repeated_batch_and_ignores_idle_reports(spark):
    folder = tempfile.mkdtemp(prefix="tidemark-ledger-")
    ledger = lr.LateRowLedger(spark, folder, "x")
    for batch, rows in ((0, 1), (1, 5), (1, 7), (1, 0), (2, 0)):
        ledger.write(batch, rows)
    assert lr.late_rows(spark, folder) == (8, 3, 2)
    for batch in range(3, 3 * lr.FOLD):
        ledger.write(batch, 1)
    ledger.write(1, 100)                                                # folded already
    assert lr.late_rows(spark, folder) == (8 + 3 * lr.FOLD - 3, 3 * lr.FOLD, 3 * lr.FOLD - 1)


# ---------------------------------------------------------------- J14, J15

def _nested(rng, n):
    out = [(0, 2 ** 32 - 1, "all"), (5, 5, "one"), (2 ** 32 - 1, 2 ** 32 - 1, "last"), (7, 3, "upside down")]
    for i in range(n):
        a = rng.randrange(0, 70000)
        out.append((a, a + rng.choice([0, 1, 15, 16, 255, 300, 4096, 65535]), f"r{i:03d}"))
    return out


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_addresses_get_their_narrowest_range(spark, max_bytes):
    rng = random.Random(4)
    ranges = _nested(rng, 60)
    ips = [rng.randrange(0, 140000) for _ in range(300)] + [0, 3, 5, 7, 2 ** 32 - 1, 2 ** 32 - 2]
    facts = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id long, n long").select("id", long_to_ipv4(F.col("n")).alias("ip"))
    facts = facts.unionByName(spark.createDataFrame([(1000, "no address"), (1001, None)], "id long, ip string"))
    r = spark.createDataFrame(ranges, "ip_start long, ip_end long, name string")
    got = {x.id: x.name for x in en.ip_most_specific(facts, "ip", r, max_bytes=max_bytes).collect()}
    for i, ip in enumerate(ips):
        holds = [(b - a, -a, name) for a, b, name in ranges if a <= ip <= b]
        narrow = min(holds, key=lambda h: (h[0], h[1]))[:2]
        assert got[i] == max(h[2] for h in holds if h[:2] == narrow)
    assert got[1000] is None and got[1001] is None and len(got) == len(ips) + 2
    bare = en.ip_most_specific(facts, "ip", r.limit(0), max_bytes=max_bytes)
    assert bare.where("name IS NULL").count() == len(ips) + 2


def test_blocks_partition_a_range_and_stay_few(spark):
    ranges = [(1, 2 ** 32 - 2, "wide"), (0, 2 ** 32 - 1, "all"), (17, 17, "one"), (15, 16, "edge"), (1000, 70000, "mid")]
    cells = en.range_blocks(spark.createDataFrame(ranges, "ip_start long, ip_end long, name string")).collect()
    for a, b, name in ranges:
        spans = sorted((c["_block"] << c["_bits"], (c["_block"] + 1) << c["_bits"]) for c in cells if c["name"] == name)
        assert spans[0][0] == a and spans[-1][1] == b + 1 and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert len(spans) <= 240


def test_rates_are_picked_in_the_row(spark, sf_small):
    rates = spark.createDataFrame([("e", D(2024, 1, 5), 1.0), ("e", D(2024, 1, 8), 2.0), ("e", D(2024, 1, 8), 1.5), ("g", D(2024, 1, 3), None), ("h", None, 3.0)], "ccy string, rate_date date, rate double")
    facts = spark.createDataFrame([(i, c, d) for i, (c, d) in enumerate([("e", D(2024, 1, 4)), ("e", D(2024, 1, 5)), ("e", D(2024, 1, 7)), ("e", D(2024, 1, 8)), ("e", D(2030, 1, 1)),
                                   ("g", D(2024, 1, 9)), ("x", D(2024, 1, 9)), ("e", None), (None, D(2024, 1, 9))])], "id long, ccy string, day date")
    for limit in (1 << 26, 0):
        got = [(r.rate_date, r.rate) for r in en.join_asof_rate_in_row(facts, rates, max_bytes=limit).orderBy("id").collect()]
        assert got[:5] == [(None, None), (D(2024, 1, 5), 1.0), (D(2024, 1, 5), 1.0), (D(2024, 1, 8), 2.0), (D(2024, 1, 8), 2.0)]
        assert got[6:] == [(None, None)] * 3 and got[5][1] is None
    plan = plan_text(enrich_plans.j14_asof_rate(spark, sf_small))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_size_checks_count_bytes(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert is_small(wide, 10, 100_000) and not is_small(wide, 9, 100_000) and not is_small(wide, 10, 5_000)
