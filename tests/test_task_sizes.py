"""A task's share of a shuffle is set by the rows, so its memory doesn't grow with the input."""

from __future__ import annotations

from tests.conftest import rows
from tests.test_plans import plan_text
from tidemark.functions import sizing
from tidemark.operators import enrich as en
from tidemark.plans import dedup_plans, pattern_plans
from tidemark.sources import fixtures as fx


def test_tasks_follow_the_rows(spark):
    least = spark.sparkContext.defaultParallelism
    assert sizing.tasks_for(spark, 0) == sizing.tasks_for(spark, 1000) == least
    assert [sizing.tasks_for(spark, n * 36_000_000) for n in (1, 6)] == [144, 864]
    assert sizing.tasks_for(spark, 10 ** 12) == sizing.MAX_TASKS


def test_game_lines_are_dealt_once_by_their_number(spark, sf_small, monkeypatch):
    queries = (dedup_plans.c02_duplicate_report, dedup_plans.c01_dedup_game_details, pattern_plans.c11_game_rollup, pattern_plans.c14_longest_streak)
    want = [rows(q(spark, sf_small)) for q in queries]
    monkeypatch.setattr(fx, "tasks_for", lambda spark, n: 1 + n // 200)
    for query, expected in zip(queries, want):
        df = query(spark, sf_small)
        text = plan_text(df)
        assert "hashpartitioning(l_orderkey" in text and f", {fx.game_tasks(spark, sf_small)}), REPARTITION_BY_NUM" in text
        assert rows(df) == expected


def test_many_range_blocks_are_not_broadcast(spark, sf_small):
    facts, ranges = fx.client_events(spark, sf_small), fx.nested_ip_ranges(spark, sf_small)
    df = en.ip_most_specific(facts, "ip", ranges, max_bytes=0)
    text = plan_text(df)
    joins = text[text.index("\n(1) "):].split("\n\n")
    by_block = [x for x in joins if "Join" in x and "_bits#" in x]
    assert by_block and all("SortMergeJoin" in x for x in by_block)
    broadcast = [x for x in joins if "BroadcastHashJoin" in x]   # the coarse lengths: at most 69,905 blocks
    assert len(broadcast) <= (en.ADDRESS_BITS - en.COARSE_BITS) // en.STEP_BITS + 1
    assert rows(df) == rows(en.ip_most_specific(facts, "ip", ranges))


def test_rows_of_a_match_leave_the_fact_side_by_side(spark, sf_small):
    import itertools

    from tidemark.plans import match_plans
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}   # as on large tables
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = [r["match_id"] for r in match_plans.fact(spark, sf_small).select("match_id", "medals_count_map").collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(set(got)) < len(got) and len(list(itertools.groupby(got))) == len(set(got))
