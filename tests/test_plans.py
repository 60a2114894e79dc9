"""Physical-plan shape: the strategies the operators rely on are really chosen."""

from __future__ import annotations

import contextlib
import io

from tidemark.plans import dedup_plans, match_plans, pattern_plans, snapshot_plans


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_bucketed_join_has_no_exchange_on_match_id(spark, sf_small):
    p = plan_text(match_plans.j12_bucketed_match_fact(spark, sf_small))
    assert "SortMergeJoin" in p
    assert "Exchange hashpartitioning(match_id" not in p


def test_dimensions_are_broadcast(spark, sf_small):
    p = plan_text(match_plans.c18_match_fact(spark, sf_small))
    assert "BroadcastHashJoin" in p
    assert "BroadcastExchange" in p


def test_dedup_limits_rows_per_key_before_sorting(spark, sf_small):
    p = plan_text(dedup_plans.c01_dedup_lineitem(spark, sf_small))
    assert "WindowGroupLimit" in p


def test_scans_are_pruned_and_filtered(spark, sf_small):
    p = plan_text(snapshot_plans.c08_host_activity_reduced(spark, sf_small))
    # only the needed columns of events are read, and the date range reaches the scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    assert "PushedFilters: [IsNotNull(ts)" in p


def test_rolling_window_is_split_by_day_and_computed_once(spark, sf_small):
    import re
    p = plan_text(pattern_plans.c13_rolling_wins(spark, sf_small))
    # the row-level window runs per (team, day); only day totals are windowed per team
    # (the struct of both)
    row_level = re.findall(r"\], \[_at#\d+\], \[game_id#\d+L ASC", p)
    assert len(row_level) == 1
    assert not re.search(r"\], \[team_id#\d+L\], \[game_id", p)


def test_no_registered_query_plans_a_cartesian_or_nested_loop_join(spark, sf_small):
    import __spark_entry__ as ent
    from scripts.plan_report import audit
    rep = audit(spark, sf_small, ent.queries())
    assert {k: r["forbidden"] for k, r in rep.items() if r["forbidden"]} == {}


def test_sql_ddl_bucketed_tables_join_without_exchange(spark, sf_small):
    import os
    import tempfile
    import uuid

    from tidemark.operators.layout import append_by_name, create_bucketed_table
    from tidemark.sources import fixtures as fx
    base = tempfile.mkdtemp(prefix="tidemark-ddl-")
    tag = uuid.uuid4().hex[:6]
    create_bucketed_table(spark, f"m_{tag}", "match_id BIGINT, completion_date DATE, mapid BIGINT, playlist_id STRING",
                          "match_id", 4, os.path.join(base, "m"))
    create_bucketed_table(spark, f"d_{tag}", "match_id BIGINT, player_gamertag BIGINT, player_total_kills BIGINT",
                          "match_id", 4, os.path.join(base, "d"))
    append_by_name(fx.matches(spark, sf_small), f"m_{tag}")
    append_by_name(fx.match_details(spark, sf_small), f"d_{tag}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as the reference job does
    try:
        j = spark.table(f"m_{tag}").join(spark.table(f"d_{tag}"), "match_id")
        assert j.count() == fx.match_details(spark, sf_small).count()
        p = plan_text(j)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in p and "Exchange hashpartitioning(match_id" not in p


def test_broadcast_only_behind_the_size_check(spark):
    from tidemark.functions.sizing import small_side
    big = spark.range(1000).withColumnRenamed("id", "k")
    dim = spark.range(50).withColumnRenamed("id", "k")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = plan_text(big.join(small_side(dim, max_rows=100), "k"))
        refused = plan_text(big.join(small_side(dim, max_rows=10), "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in hinted
    assert "BroadcastHashJoin" not in refused and "SortMergeJoin" in refused


def test_sessionize_shuffles_events_by_key_and_hour(spark, sf_small):
    import re
    from tidemark.plans import session_plans
    p = plan_text(session_plans.c15_sessionize(spark, sf_small))
    parts = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", p)
    by_hour = [x for x in parts if "_b#" in x]
    per_key = [x for x in parts if "_b#" not in x]
    # raw events go through the (ip, host, hour) shuffle; the per-key one is the edge-session stitch
    assert by_hour and len(per_key) == 1


def test_bounds_of_the_data_cost_no_job_while_a_query_is_built(spark, sf_small):
    from tidemark.plans import all_queries
    queries = all_queries()
    names = ["c03_cumulate_actors", "c04_scd2_backfill", "c06_user_devices_cumulated", "c06_hosts_cumulated", "c07_datelist_bits", "c08_host_activity_reduced",
             "c09_reduced_fact_daily", "c10_growth_accounting", "e03_streak_resumption", "e08_resurrection_rate", "e09_resurrected_users", "e11_funnel",
             "e12_engagement_minutes", "e13_churn_by_cell", "q05_snapshot_fallback", "q08_join_as_of_scd", "q14_active_users"]
    sc, started = spark.sparkContext, {}
    tracker = sc.statusTracker()
    for name in names:
        sc.setJobGroup(f"build-{name}", name)
        queries[name](spark, sf_small)
        stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup(f"build-{name}") for i in tracker.getJobInfo(j).stageIds]
        started[name] = [s.name for s in stages if s is not None and not s.name.startswith("parquet at")]  # files' schemas are read
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert {n: j for n, j in started.items() if j} == {}


def test_rollup_shuffles_sums_and_not_the_details(spark, sf_small):
    p = plan_text(pattern_plans.c11_game_rollup(spark, sf_small))
    nodes = p[p.index("\n(1) "):]  # listed from the scans on
    # the details are added up per (game, team, player) before anything multiplies them by the grouping sets
    assert "Expand" not in p and nodes.index("partial_sum") < nodes.index(") Generate")


def test_completion_and_funnel_shuffle_events_by_user_and_hour(spark, sf_small):
    import re
    from tidemark.plans import experiment_plans
    for query in (experiment_plans.e10_completion_metrics, experiment_plans.e11_funnel):
        keys = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan_text(query(spark, sf_small)))
        assert sum("_b#" in k for k in keys) == 1 and len(keys) == 2
