"""Queries for data-quality checks and table upkeep: Q1-Q6, Q8, Q10-Q17, Q19-Q23."""

from __future__ import annotations

import datetime as dt

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sizing import small_side
from tidemark.jobs import growth_season
from tidemark.operators import growth
from tidemark.operators import quality as qa
from tidemark.operators import runs, scd
from tidemark.operators.experiments import cell_of
from tidemark.operators.sessions import sessionize
from tidemark.operators.upsert import upsert_partitions, write_period
from tidemark.plans import pattern_plans, snapshot_plans as sp
from tidemark.plans.experiment_plans import SALT, cell_sql
from tidemark.plans.oracle_views import AS_OF, FIRST_DAY, with_views
from tidemark.session import shared_path
from tidemark.sources import fixtures as fx
from tidemark.sources import schemas as sc
from tidemark.sources.tables import load

EVENT_CONTRACT = [("event_id", "bigint", False), ("ts", "timestamp", False), ("user_id", "bigint", False),
                  ("event_type", "string", False), ("value", "double", True), ("props", "string", True),
                  ("session_id", "string", True)]
EVENT_TYPES = ("view", "click", "purchase", "signup", "error")
# Event type -> KPI mapping (unmapped types are reported).
KPI_MAPPING = [("view", "exposure"), ("click", "engagement"), ("purchase", "conversion")]
LOCAL_TZ = "Europe/Madrid"
DOMINANT_SHARE = 0.08
ATTRIBUTION_SECONDS = 86400
TAX_RATE = "0.0725"
FISCAL_START_MONTH = 2
PROVISIONAL_DAYS = 3


def q01_schema_contract(spark, sf_dir):
    return qa.schema_contract(load(spark, sf_dir, "events"), EVENT_CONTRACT)


def q02_rule_report(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    rules = {
        "user_id_present": F.col("user_id").isNotNull(),
        "value_in_range": F.col("value").between(0, 100),
        "known_event_type": F.col("event_type").isin(*EVENT_TYPES),
        "props_has_k": F.get_json_object("props", "$.k").isNotNull(),
    }
    return qa.rule_report(e, rules)


def q03_volume_anomaly(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_shipdate")
    return qa.volume_anomaly(li, F.to_date("l_shipdate"), 7, 0.5)


def q04_missing_rate_days(spark, sf_dir):
    return qa.missing_business_days(fx.fx_rates(spark, sf_dir), "ccy", "rate_date")


def q05_snapshot_fallback(spark, sf_dir):
    daily = sp.host_daily_metrics(spark, sf_dir).select("host", "date", "hits")
    return qa.snapshot_or_fallback(daily, "host", "date", "hits", fx.event_span(spark, sf_dir)[1])


def q06_reprocess_days(spark, sf_dir):
    """Daily host hits kept as a date-partitioned table: the last days are
    first published ``provisional``; a later run recomputes exactly those
    day partitions (dynamic overwrite) and marks them ``final``."""
    path = shared_path(spark, "daily_host_hits")
    daily = sp.host_daily_metrics(spark, sf_dir).select("host", "date", "hits")
    as_of = fx.event_days(spark, sf_dir)[1]
    cut = F.lit(as_of - dt.timedelta(days=PROVISIONAL_DAYS - 1)).cast("date")
    first = daily.withColumn("status", F.when(F.col("date") >= cut, "provisional").otherwise("final"))
    upsert_partitions(spark, path, first, ["host", "date"], "date", order_by=[])
    redo = daily.where(F.col("date") >= cut).withColumn("status", F.lit("final"))
    days = [as_of - dt.timedelta(days=i) for i in range(PROVISIONAL_DAYS)]
    return upsert_partitions(spark, path, redo, ["host", "date"], "date", order_by=[], periods=days).select("host", "date", "hits", "status")


def s04_key_report(spark, sf_dir):
    """The typed tables (S4) as they are built: schema, rows and keys, one row a table."""
    tables = [("actors", sp.actor_snapshots(spark, sf_dir), sc.ACTORS, sc.ACTORS_KEY),
              ("actors_history_scd", sp.actor_history(spark, sf_dir), sc.ACTORS_HISTORY_SCD, sc.ACTORS_HISTORY_SCD_KEY),
              ("user_devices_cumulated", sp.user_devices_cumulated(spark, sf_dir), sc.USER_DEVICES_CUMULATED, sc.USER_DEVICES_CUMULATED_KEY),
              ("hosts_cumulated", sp.hosts_cumulated(spark, sf_dir), sc.HOSTS_CUMULATED, sc.HOSTS_CUMULATED_KEY),
              ("host_activity_reduced", sp.host_activity_reduced(spark, sf_dir), sc.HOST_ACTIVITY_REDUCED, sc.HOST_ACTIVITY_REDUCED_KEY),
              ("players_growth_accounting", growth.growth_backfill(fx.players(spark, sf_dir), "player_name", fx.last_year_of(spark, sf_dir)),
               sc.PLAYERS_GROWTH_ACCOUNTING, sc.PLAYERS_GROWTH_ACCOUNTING_KEY)]
    return reduce(DataFrame.unionByName, [sc.key_report(*t) for t in tables])


LATE_SEASONS = 3


def q06_restated_seasons(spark, sf_dir):
    """Growth table whose season before the last ones was first published without a part of the
    players' activity; running that season again with all rows refreshes every later season too."""
    path = shared_path(spark, "restated_seasons")
    players = fx.players(spark, sf_dir)
    last = fx.last_year(spark, sf_dir)
    first = last - LATE_SEASONS
    late = (F.col("current_season") == first) & (F.pmod(F.crc32(F.col("player_name").cast("binary")), F.lit(3)) == 0)
    early = players.withColumn("is_active", F.col("is_active") & ~late)
    write_period(growth.growth_backfill(early, "player_name", last).repartition("current_season"), path, "current_season")
    growth_season(spark, players, "player_name", path, first)
    return pattern_plans.growth_columns(spark.read.parquet(path))


def q08_join_as_of_scd(spark, sf_dir):
    s = sp.actor_history(spark, sf_dir)
    films = fx.actor_films(spark, sf_dir).select("filmid", "actorid", "year")
    j = scd.join_as_of_scd(films, s, "actorid", "year")
    return j.select("f.filmid", "f.actorid", "f.year", "s.quality_class", "s.is_active")


def q10_dominant_sources(spark, sf_dir):
    return qa.drop_dominant_sources(fx.web_events(spark, sf_dir), F.to_date("event_time"), "device_id",
                                    DOMINANT_SHARE)


def q10_filtered_traffic(spark, sf_dir):
    rows = qa.filter_dominant_sources(fx.web_events(spark, sf_dir), F.to_date("event_time"), "device_id", DOMINANT_SHARE)
    return rows.select("event_id", "device_id", F.to_date("event_time").alias("day"))


def q11_stitch_identity(spark, sf_dir):
    return qa.stitch_identity(fx.web_events(spark, sf_dir), "user_id", "device_id", "event_time")


def q12_map_events(spark, sf_dir):
    mapping = spark.createDataFrame(KPI_MAPPING, "event_type string, kpi string")
    return qa.map_events(load(spark, sf_dir, "events"), "event_type", mapping, "kpi")


def q13_business_day(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("ts")
    return (e.groupBy(qa.business_day(F.col("ts"), LOCAL_TZ).alias("business_day"))
             .agg(F.count(F.lit(1)).alias("n_events")))


def q14_active_users(spark, sf_dir):
    days = fx.web_events(spark, sf_dir).where(F.col("user_id").isNotNull()) \
        .select("user_id", F.to_date("event_time").alias("day"))
    return qa.active_users(days, {"dau": 1, "wau": 7, "mau": 30}, *fx.event_span(spark, sf_dir))


def _order_lines(spark, sf_dir):
    """Per order: COGS (quantity x part retail price) and refunds (returned
    lines, net of discount), in cents; lines are summed per order before the
    join with orders."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                                                "l_discount", "l_returnflag")
    p = small_side(load(spark, sf_dir, "part").select("p_partkey", "p_retailprice"))
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return (j.groupBy("l_orderkey")
             .agg(F.sum(F.round(F.col("l_quantity") * F.col("p_retailprice") * 100).cast("bigint")).alias("cogs"),
                  F.sum(F.when(F.col("l_returnflag") == "R",
                               F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100)
                                .cast("bigint")).otherwise(F.lit(0))).alias("refund")))


def _orders_kpi(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    o = o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"),
                 F.round(F.col("o_totalprice") * 100).cast("bigint").alias("revenue"))
    return o.join(_order_lines(spark, sf_dir), o.o_orderkey == F.col("l_orderkey"), "left") \
            .fillna(0, ["cogs", "refund"])


def q15_kpi_daily(spark, sf_dir):
    k = _orders_kpi(spark, sf_dir)
    first = k.groupBy("o_custkey").agg(F.min("day").alias("day")).groupBy("day") \
             .agg(F.count(F.lit(1)).alias("new_customers"))
    daily = (k.groupBy("day")
              .agg(F.count(F.lit(1)).alias("orders"),
                   F.sum("revenue").cast("bigint").alias("revenue_cents"),
                   F.sum("cogs").cast("bigint").alias("cogs_cents"),
                   F.sum("refund").cast("bigint").alias("refund_cents")))
    return (daily.join(first, "day", "left").fillna(0, ["new_customers"])
                 .withColumn("profit_cents", F.col("revenue_cents") - F.col("cogs_cents") - F.col("refund_cents")))


SESSION_GAP = 300


def q15_kpi_with_engagement(spark, sf_dir):
    """Every day from the first to the last of orders and sessions, with or without any."""
    k = _orders_kpi(spark, sf_dir).select(F.col("o_custkey").alias("customer"), "day", "revenue", "cogs", "refund")
    w = fx.web_events(spark, sf_dir).where(F.col("user_id").isNotNull())
    return qa.kpi_daily(k, sessionize(w, ["user_id"], "event_time", SESSION_GAP))


def q16_kpi_by_cell(spark, sf_dir):
    k = _orders_kpi(spark, sf_dir).withColumn("cell", cell_of(F.col("o_custkey"), SALT))
    return (k.groupBy("cell", F.year("day").alias("year"))
             .agg(F.countDistinct("o_custkey").alias("customers"),
                  F.sum("revenue").cast("bigint").alias("revenue_cents"),
                  F.sum("cogs").cast("bigint").alias("cogs_cents"),
                  F.sum("refund").cast("bigint").alias("refund_cents"))
             .withColumn("profit_cents", F.col("revenue_cents") - F.col("cogs_cents") - F.col("refund_cents")))


def q17_run_diff(spark, sf_dir):
    w = fx.web_events(spark, sf_dir).select(F.col("subhost").alias("host"), "user_id",
                                            F.to_date("event_time").alias("date"))
    old = w.groupBy("host", "date").agg(F.count(F.lit(1)).alias("hits"))
    new = w.where(F.col("user_id").isNotNull()).groupBy("host", "date").agg(F.count(F.lit(1)).alias("hits"))
    return qa.run_diff(old, new, ["host", "date"], "hits")


RESTATED_DAYS = 3
RUN_BUCKETS = 4


def _published_runs(spark, sf_dir):
    """Two published runs of the daily host hits: the second was computed after anonymous rows
    of the last days had been taken out.  Buckets are month and hash, so only the last month's differ."""
    path = shared_path(spark, "published_runs")
    w = fx.web_events(spark, sf_dir).select(F.col("subhost").alias("host"), "user_id", F.to_date("event_time").alias("date"))
    restated = F.col("date") > F.date_sub(w.agg(F.max("date")).scalar(), RESTATED_DAYS)
    hits = w.groupBy("host", "date").agg(F.count(F.lit(1)).alias("all_hits"), F.count("user_id").alias("known"))
    first = hits.select("host", "date", F.col("all_hits").alias("hits"), F.col("known").alias("known_hits"))
    second = hits.select("host", "date", F.when(restated, F.col("known")).otherwise(F.col("all_hits")).alias("hits"), F.col("known").alias("known_hits"))
    bucket = F.concat_ws("-", F.date_format("date", "yyyy-MM-dd"), runs.hash_bucket(["host"], RUN_BUCKETS))
    runs.publish(first, path, "first", bucket)
    runs.publish(second.where((F.col("hits") > 0)), path, "second", bucket)
    return path


def q17_versioned_diff(spark, sf_dir):
    path = _published_runs(spark, sf_dir)
    return runs.diff(spark, path, "first", "second", ["host", "date"], ["hits", "known_hits"])


def q19_attribution(spark, sf_dir):
    return qa.attribute_last_touch(fx.web_events(spark, sf_dir), "user_id", "event_time", "event_id",
                                   F.col("event_type") == "click", F.col("event_type") == "purchase",
                                   ATTRIBUTION_SECONDS)


def q20_double_count(spark, sf_dir):
    return qa.double_count(fx.web_events(spark, sf_dir), "subhost", F.to_date("event_time"), "user_id")


def q21_round_money(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_totalprice")
    up, even = qa.round_money(F.col("o_totalprice"), TAX_RATE)
    t = o.select((up * 100).cast("bigint").alias("u"), (even * 100).cast("bigint").alias("e"))
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("u").cast("bigint").alias("half_up_cents"),
                 F.sum("e").cast("bigint").alias("half_even_cents"),
                 F.count_if(F.col("u") != F.col("e")).alias("n_differ"))


def q22_fiscal_period(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"),
                                             F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    daily = o.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    return (qa.with_fiscal(daily, "day", FISCAL_START_MONTH).where(F.col("day").isNotNull())
              .groupBy("fiscal_year", "fiscal_quarter")
              .agg(F.sum("n").alias("n_orders"), F.sum("cents").cast("bigint").alias("revenue_cents")))


def q23_period_complete(spark, sf_dir):
    return qa.period_complete(load(spark, sf_dir, "orders"), F.to_date("o_orderdate"))


QUERIES = {
    "q01_schema_contract": q01_schema_contract,
    "q02_rule_report": q02_rule_report,
    "q03_volume_anomaly": q03_volume_anomaly,
    "q04_missing_rate_days": q04_missing_rate_days,
    "q05_snapshot_fallback": q05_snapshot_fallback,
    "q06_reprocess_days": q06_reprocess_days,
    "q06_restated_seasons": q06_restated_seasons,
    "s04_key_report": s04_key_report,
    "q08_join_as_of_scd": q08_join_as_of_scd,
    "q10_dominant_sources": q10_dominant_sources,
    "q10_filtered_traffic": q10_filtered_traffic,
    "q11_stitch_identity": q11_stitch_identity,
    "q12_map_events": q12_map_events,
    "q13_business_day": q13_business_day,
    "q14_active_users": q14_active_users,
    "q15_kpi_daily": q15_kpi_daily,
    "q15_kpi_with_engagement": q15_kpi_with_engagement,
    "q16_kpi_by_cell": q16_kpi_by_cell,
    "q17_run_diff": q17_run_diff,
    "q17_versioned_diff": q17_versioned_diff,
    "q19_attribution": q19_attribution,
    "q20_double_count": q20_double_count,
    "q21_round_money": q21_round_money,
    "q22_fiscal_period": q22_fiscal_period,
    "q23_period_complete": q23_period_complete,
}

_ORDER_KPI = """
ol AS (SELECT l.l_orderkey,
              sum(CAST(round(l.l_quantity * p.p_retailprice * 100) AS BIGINT)) AS cogs,
              sum(CASE WHEN l.l_returnflag = 'R'
                       THEN CAST(round(l.l_extendedprice * (1 - l.l_discount) * 100) AS BIGINT) ELSE 0 END) AS refund
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey),
k AS (SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS day,
             CAST(round(o.o_totalprice * 100) AS BIGINT) AS revenue,
             coalesce(ol.cogs, 0) AS cogs, coalesce(ol.refund, 0) AS refund
      FROM orders o LEFT JOIN ol ON ol.l_orderkey = o.o_orderkey)"""

_HOST_DAILY = f"""
daily AS (SELECT subhost AS host, CAST(event_time AS DATE) AS date, count(*) AS hits FROM web_events
          WHERE user_id IS NOT NULL
            AND CAST(event_time AS DATE) BETWEEN {FIRST_DAY} AND {AS_OF}
          GROUP BY 1, 2)"""


def _contract_sql() -> str:
    actual = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
              "value": "double", "props": "string"}
    parts = []
    for name, typ, nullable in EVENT_CONTRACT:
        if name not in actual:
            parts.append(f"SELECT '{name}' AS column_name, '{typ}' AS expected_type, "
                         f"CAST(NULL AS VARCHAR) AS actual_type, 'missing' AS status, "
                         f"CAST(NULL AS BIGINT) AS violations")
            continue
        status = "ok" if actual[name] == typ else "retyped"
        cond = "false" if nullable else f"{name} IS NULL"
        parts.append(f"SELECT '{name}' AS column_name, '{typ}' AS expected_type, "
                     f"'{actual[name]}' AS actual_type, '{status}' AS status, "
                     f"(SELECT count(*) FILTER (WHERE {cond}) FROM events) AS violations")
    return "\nUNION ALL ".join(parts)


ORACLE = {
    "q01_schema_contract": _contract_sql(),
    "q02_rule_report": f"""
WITH a AS (SELECT count(*) AS n,
                  count(*) FILTER (WHERE user_id IS NULL) AS r0,
                  count(*) FILTER (WHERE NOT coalesce(value BETWEEN 0 AND 100, false)) AS r1,
                  count(*) FILTER (WHERE NOT coalesce(event_type IN {EVENT_TYPES!r}, false)) AS r2,
                  count(*) FILTER (WHERE json_extract_string(props, '$.k') IS NULL) AS r3
           FROM events)
SELECT 'user_id_present' AS rule, r0 AS failed_rows, n AS total_rows FROM a
UNION ALL SELECT 'value_in_range', r1, n FROM a
UNION ALL SELECT 'known_event_type', r2, n FROM a
UNION ALL SELECT 'props_has_k', r3, n FROM a""",
    "q03_volume_anomaly": """
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1),
c AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM d), (SELECT max(day) FROM d), INTERVAL 1 DAY)) AS DATE) AS day),
f AS (SELECT day, coalesce(d.n, 0) AS n FROM c LEFT JOIN d USING (day)),
b AS (SELECT *, avg(n) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline FROM f)
SELECT day, n, baseline, abs(n - baseline) > baseline * 0.5 AS is_anomaly FROM b""",
    "q04_missing_rate_days": with_views("""
WITH span AS (SELECT ccy, min(rate_date) AS a, max(rate_date) AS b FROM fx_rates GROUP BY ccy),
cal AS (SELECT ccy, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
SELECT ccy, d AS missing_day FROM cal
WHERE isodow(d) <= 5 AND NOT EXISTS (SELECT 1 FROM fx_rates r WHERE r.ccy = cal.ccy AND r.rate_date = cal.d)""",
                                        "fx_rates"),
    "q05_snapshot_fallback": with_views(f"""
WITH {_HOST_DAILY},
f AS (SELECT host, min(date) AS a FROM daily GROUP BY host),
grid AS (SELECT host, CAST(unnest(generate_series(a, {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS date
         FROM f)
SELECT g.host, g.date, d.hits, d.date AS source_day, d.date <> g.date AS is_provisional
FROM grid g ASOF JOIN daily d ON g.host = d.host AND g.date >= d.date""", "web_events"),
    "q06_reprocess_days": with_views(f"""
WITH {_HOST_DAILY}
SELECT host, date, hits, 'final' AS status FROM daily""", "web_events"),
    "q10_dominant_sources": with_views(f"""
WITH d AS (SELECT CAST(event_time AS DATE) AS day, device_id FROM web_events),
per AS (SELECT day, device_id, count(*) AS n FROM d GROUP BY day, device_id),
fl AS (SELECT day, device_id, true AS b FROM (SELECT *, n / sum(n) OVER (PARTITION BY day) AS share FROM per)
       WHERE share > {DOMINANT_SHARE}),
j AS (SELECT d.day, d.device_id, fl.b IS NOT NULL AS bot
      FROM d LEFT JOIN fl ON fl.day = d.day AND fl.device_id IS NOT DISTINCT FROM d.device_id)
SELECT day, count(*) AS rows, count(*) FILTER (WHERE bot) AS dropped, count(*) FILTER (WHERE NOT bot) AS kept,
       count(DISTINCT CASE WHEN bot THEN device_id END) AS sources_dropped
FROM j GROUP BY day""", "web_events"),
    "q10_filtered_traffic": with_views(f"""
WITH d AS (SELECT event_id, device_id, CAST(event_time AS DATE) AS day FROM web_events)
SELECT event_id, device_id, day FROM (
  SELECT *, count(*) OVER (PARTITION BY day, device_id) / count(*) OVER (PARTITION BY day) AS share FROM d)
WHERE share <= {DOMINANT_SHARE}""", "web_events"),
    "q11_stitch_identity": with_views("""
WITH links AS (SELECT device_id, arg_max(user_id, event_time) AS linked FROM web_events
               WHERE user_id IS NOT NULL GROUP BY device_id),
j AS (SELECT w.*, l.linked FROM web_events w LEFT JOIN links l ON l.device_id = w.device_id)
SELECT CAST(event_time AS DATE) AS day, count(DISTINCT user_id) AS users_before,
       count(DISTINCT coalesce(user_id, linked)) AS users_after,
       count(*) FILTER (WHERE user_id IS NULL) AS anonymous_rows,
       count(*) FILTER (WHERE user_id IS NULL AND linked IS NOT NULL) AS stitched_rows
FROM j GROUP BY 1""", "web_events"),
    "q12_map_events": "SELECT event_type, CASE " + " ".join(
        f"WHEN event_type = '{a}' THEN '{b}'" for a, b in KPI_MAPPING) +
        " END AS kpi, count(*) AS n_rows FROM events GROUP BY event_type",
    "q13_business_day": f"""
WITH l AS (SELECT CAST(timezone('{LOCAL_TZ}', ts AT TIME ZONE 'UTC') AS DATE) AS d FROM events)
SELECT d AS business_day, count(*) AS n_events
FROM l GROUP BY 1""",
    "q14_active_users": with_views(f"""
WITH d AS (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS day FROM web_events WHERE user_id IS NOT NULL),
cal AS (SELECT CAST(unnest(generate_series({FIRST_DAY}, {AS_OF}, INTERVAL 1 DAY))
                       AS DATE) AS day)
SELECT c.day,
       (SELECT count(DISTINCT user_id) FROM d WHERE d.day = c.day) AS dau,
       (SELECT count(DISTINCT user_id) FROM d WHERE d.day BETWEEN c.day - 6 AND c.day) AS wau,
       (SELECT count(DISTINCT user_id) FROM d WHERE d.day BETWEEN c.day - 29 AND c.day) AS mau
FROM cal c""", "web_events"),
    "q15_kpi_daily": f"""
WITH {_ORDER_KPI},
nc AS (SELECT day, count(*) AS new_customers FROM (SELECT o_custkey, min(day) AS day FROM k GROUP BY 1) GROUP BY day)
SELECT k.day, count(*) AS orders, CAST(sum(revenue) AS BIGINT) AS revenue_cents,
       CAST(sum(cogs) AS BIGINT) AS cogs_cents, CAST(sum(refund) AS BIGINT) AS refund_cents,
       coalesce(max(nc.new_customers), 0) AS new_customers,
       CAST(sum(revenue) - sum(cogs) - sum(refund) AS BIGINT) AS profit_cents
FROM k LEFT JOIN nc ON nc.day = k.day GROUP BY k.day""",
    "q16_kpi_by_cell": f"""
WITH {_ORDER_KPI}
SELECT {cell_sql('o_custkey')} AS cell, CAST(year(day) AS INTEGER) AS year,
       count(DISTINCT o_custkey) AS customers, CAST(sum(revenue) AS BIGINT) AS revenue_cents,
       CAST(sum(cogs) AS BIGINT) AS cogs_cents, CAST(sum(refund) AS BIGINT) AS refund_cents,
       CAST(sum(revenue) - sum(cogs) - sum(refund) AS BIGINT) AS profit_cents
FROM k GROUP BY 1, 2""",
    "q17_run_diff": with_views("""
WITH w AS (SELECT subhost AS host, user_id, CAST(event_time AS DATE) AS date FROM web_events),
o AS (SELECT host, date, count(*) AS old_value FROM w GROUP BY 1, 2),
n AS (SELECT host, date, count(*) AS new_value FROM w WHERE user_id IS NOT NULL GROUP BY 1, 2)
SELECT coalesce(o.host, n.host) AS host, coalesce(o.date, n.date) AS date, o.old_value, n.new_value,
       coalesce(n.new_value, 0) - coalesce(o.old_value, 0) AS delta
FROM o FULL OUTER JOIN n ON o.host = n.host AND o.date = n.date
WHERE o.old_value IS DISTINCT FROM n.new_value""", "web_events"),
    "q19_attribution": with_views(f"""
WITH e AS (SELECT * FROM web_events WHERE user_id IS NOT NULL),
p AS (SELECT event_id, user_id, event_time, CAST(event_time AS DATE) AS day FROM e WHERE event_type = 'purchase'),
a AS (SELECT p.day, p.event_time,
             (SELECT max(c.event_time) FROM e c WHERE c.user_id = p.user_id AND c.event_type = 'click'
                AND (c.event_time < p.event_time OR (c.event_time = p.event_time AND c.event_id <= p.event_id)))
               AS last_click
      FROM p)
SELECT day, count(*) AS conversions,
       count(*) FILTER (WHERE last_click >= event_time - INTERVAL {ATTRIBUTION_SECONDS} SECOND) AS attributed,
       count(*) FILTER (WHERE last_click >= event_time - INTERVAL {ATTRIBUTION_SECONDS} SECOND) / count(*)
         AS attributed_share
FROM a GROUP BY day""", "web_events"),
    "q20_double_count": with_views("""
WITH d AS (SELECT subhost, CAST(event_time AS DATE) AS day, user_id FROM web_events WHERE user_id IS NOT NULL),
a AS (SELECT subhost, CAST(sum(u) AS BIGINT) AS sum_daily_uniques
      FROM (SELECT subhost, day, count(DISTINCT user_id) AS u FROM d GROUP BY 1, 2) GROUP BY 1),
b AS (SELECT subhost, count(DISTINCT user_id) AS distinct_users FROM d GROUP BY 1)
SELECT a.subhost, a.sum_daily_uniques, b.distinct_users, a.sum_daily_uniques - b.distinct_users AS overcount
FROM a JOIN b ON a.subhost = b.subhost""", "web_events"),
    "q21_round_money": f"""
WITH t AS (SELECT CAST(o_totalprice AS DECIMAL(18,2)) * CAST('{TAX_RATE}' AS DECIMAL(6,4)) AS x FROM orders),
r AS (SELECT CAST(round(x, 2) * 100 AS BIGINT) AS u, CAST(round_even(x, 2) * 100 AS BIGINT) AS e FROM t)
SELECT count(*) AS n_rows, CAST(sum(u) AS BIGINT) AS half_up_cents, CAST(sum(e) AS BIGINT) AS half_even_cents,
       count(*) FILTER (WHERE u <> e) AS n_differ
FROM r""",
    "q22_fiscal_period": f"""
SELECT CAST(year(CAST(o_orderdate AS DATE) + INTERVAL {13 - FISCAL_START_MONTH} MONTH) AS INTEGER) AS fiscal_year,
       CAST(quarter(CAST(o_orderdate AS DATE) + INTERVAL {13 - FISCAL_START_MONTH} MONTH) AS INTEGER)
         AS fiscal_quarter,
       count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents
FROM orders GROUP BY 1, 2""",
    "q23_period_complete": """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT CAST(date_trunc('month', d) AS DATE) AS month_start, count(*) AS days_seen,
       CAST(day(last_day(CAST(date_trunc('month', d) AS DATE))) AS BIGINT) AS days_expected,
       count(*) = CAST(day(last_day(CAST(date_trunc('month', d) AS DATE))) AS BIGINT) AS is_complete
FROM d GROUP BY 1""",
}

ORACLE["q08_join_as_of_scd"] = with_views(
    "WITH scd AS (" + sp._SCD.strip() + """)
SELECT f.filmid, f.actorid, f.year, s.quality_class, s.is_active
FROM actor_films f LEFT JOIN scd s ON s.actorid = f.actorid AND f.year BETWEEN s.start_year AND s.end_year""",
    "actor_films")

ORACLE["q15_kpi_with_engagement"] = with_views(f"""
WITH {_ORDER_KPI},
x AS (SELECT user_id, event_time, lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time) AS p FROM web_events WHERE user_id IS NOT NULL),
y AS (SELECT *, sum(CASE WHEN p IS NULL OR event_time > p + INTERVAL {SESSION_GAP} SECOND THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS sid FROM x),
s AS (SELECT user_id, min(event_time) AS a, max(event_time) + INTERVAL {SESSION_GAP} SECOND AS b FROM y GROUP BY user_id, sid),
cal AS (SELECT CAST(unnest(generate_series(least((SELECT min(day) FROM k), (SELECT CAST(min(a) AS DATE) FROM s)),
                                           greatest((SELECT max(day) FROM k), (SELECT CAST(max(b - INTERVAL 1 MICROSECOND) AS DATE) FROM s)), INTERVAL 1 DAY)) AS DATE) AS day),
o AS (SELECT day, count(*) AS orders, sum(revenue) AS revenue, sum(cogs) AS cogs, sum(refund) AS refund FROM k GROUP BY day),
nc AS (SELECT day, count(*) AS n FROM (SELECT o_custkey, min(day) AS day FROM k GROUP BY 1) GROUP BY day),
st AS (SELECT CAST(a AS DATE) AS day, count(*) AS n FROM s GROUP BY 1),
e AS (SELECT c.day, count(DISTINCT s.user_id) AS users, sum(epoch_us(least(s.b, c.day + INTERVAL 1 DAY)) - epoch_us(greatest(s.a, CAST(c.day AS TIMESTAMP)))) AS us
      FROM cal c JOIN s ON s.a < c.day + INTERVAL 1 DAY AND s.b > CAST(c.day AS TIMESTAMP) GROUP BY c.day)
SELECT cal.day, coalesce(o.orders, 0) AS orders, CAST(coalesce(o.revenue, 0) AS BIGINT) AS revenue_cents, CAST(coalesce(o.cogs, 0) AS BIGINT) AS cogs_cents,
       CAST(coalesce(o.refund, 0) AS BIGINT) AS refund_cents, CAST(coalesce(o.revenue - o.cogs - o.refund, 0) AS BIGINT) AS profit_cents,
       coalesce(nc.n, 0) AS new_customers, coalesce(st.n, 0) AS sessions, coalesce(e.users, 0) AS active_users, CAST(coalesce(e.us, 0) AS BIGINT) AS session_us,
       e.us / 60000000 / e.users AS minutes_per_user
FROM cal LEFT JOIN o USING (day) LEFT JOIN nc USING (day) LEFT JOIN st USING (day) LEFT JOIN e USING (day)""", "web_events")
ORACLE["q17_versioned_diff"] = with_views(f"""
WITH w AS (SELECT subhost AS host, user_id, CAST(event_time AS DATE) AS date FROM web_events),
h AS (SELECT host, date, count(*) AS a, count(user_id) AS k FROM w GROUP BY 1, 2)
SELECT host, date, CASE WHEN k = 0 THEN 'removed' ELSE 'moved' END AS status, a AS old_hits, CASE WHEN k > 0 THEN k END AS new_hits, k - a AS delta_hits,
       k AS old_known_hits, CASE WHEN k > 0 THEN k END AS new_known_hits, CAST(0 AS BIGINT) AS delta_known_hits
FROM h WHERE date > (SELECT max(date) FROM w) - {RESTATED_DAYS} AND a <> k""", "web_events")
ORACLE["q06_restated_seasons"] = pattern_plans.ORACLE["c10_growth_accounting"]
ORACLE["s04_key_report"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, true AS schema_ok, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, count(*) FILTER (WHERE n > 1) AS duplicate_keys, "
    f"CAST(coalesce(sum(n) FILTER (WHERE {' OR '.join(k + ' IS NULL' for k in keys)}), 0) AS BIGINT) AS null_keys "
    f"FROM (SELECT {', '.join(keys)}, count(*) AS n FROM ({sql}) GROUP BY ALL)"
    for name, keys, sql in (
        ("actors", sc.ACTORS_KEY, sp.ORACLE["c03_cumulate_actors"]), ("actors_history_scd", sc.ACTORS_HISTORY_SCD_KEY, sp.ORACLE["c04_scd2_backfill"]),
        ("user_devices_cumulated", sc.USER_DEVICES_CUMULATED_KEY, sp.ORACLE["c06_user_devices_cumulated"]),
        ("hosts_cumulated", sc.HOSTS_CUMULATED_KEY, sp.ORACLE["c06_hosts_cumulated"]),
        ("host_activity_reduced", sc.HOST_ACTIVITY_REDUCED_KEY, sp.ORACLE["c08_host_activity_reduced"]),
        ("players_growth_accounting", sc.PLAYERS_GROWTH_ACCOUNTING_KEY, pattern_plans.ORACLE["c10_growth_accounting"])))
