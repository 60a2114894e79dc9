"""Queries for enrichment, upserts and primitives: J14, Q7, J15, S11, Q9, S1/F10, F20, Q18/J7."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.arrays import join_text
from tidemark.operators import cumulate as cu
from tidemark.operators import enrich as en
from tidemark.operators.quality import orphan_keys
from tidemark.operators.upsert import upsert, upsert_partitions
from tidemark.plans import snapshot_plans as sp
from tidemark.plans.oracle_views import with_views
from tidemark.session import shared_path
from tidemark.sources import fixtures as fx
from tidemark.sources.tables import load, read_csv

TRUE_UP_FROM = "2000-01-01"


def _orders_fx(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.col("o_orderpriority").alias("ccy"),
                    F.to_date("o_orderdate").alias("day"), "o_totalprice")


def j14_asof_rate(spark, sf_dir):
    j = en.join_asof_rate_in_row(_orders_fx(spark, sf_dir), fx.fx_rates(spark, sf_dir))
    return j.select("o_orderkey", "ccy", "day", "rate_date", "rate")


def q07_convert_fx(spark, sf_dir):
    c = en.convert_fx(_orders_fx(spark, sf_dir), fx.fx_rates(spark, sf_dir), "o_totalprice")
    return (c.groupBy("day")
             .agg(F.count(F.lit(1)).alias("n_orders"),
                  F.count_if(F.col("fx_status") == "frozen").alias("n_frozen"),
                  F.count_if(F.col("fx_status") == "carried").alias("n_carried"),
                  F.sum("converted_cents").cast("bigint").alias("converted_cents"))
             .withColumn("is_publishable", F.col("n_frozen") == 0))


def j15_ip_enrich(spark, sf_dir):
    return en.ip_range_join(fx.client_events(spark, sf_dir), "ip", fx.ip_ranges(spark, sf_dir))


def j15_nested_ranges(spark, sf_dir):
    return en.ip_most_specific(fx.client_events(spark, sf_dir), "ip", fx.nested_ip_ranges(spark, sf_dir))


def s11_upsert_reduced_fact(spark, sf_dir):
    """C8 kept as a Parquet table: a backfill up to three days before the
    as-of date, then the last days applied one by one as keyed upserts of the
    month partition, the last day twice (idempotent)."""
    path = shared_path(spark, "host_activity_reduced")
    daily = sp.host_daily_metrics(spark, sf_dir)
    as_of = fx.event_days(spark, sf_dir)[1]
    cut = as_of - dt.timedelta(days=3)
    keys = ["host", "month_start"]
    upsert_partitions(spark, path, cu.reduced_fact_backfill(daily, "host", cut), keys, "month_start", order_by=[])
    for i in (1, 2, 3, 3):
        table = spark.read.parquet(path)
        day = cut + dt.timedelta(days=i)
        step = cu.reduced_fact_step(table, daily, "host", day)
        upsert_partitions(spark, path, step, keys, "month_start", order_by=[], periods=[day.replace(day=1)])
    r = spark.read.parquet(path)
    return r.select("host", "month_start", join_text(F.col("hits_array")).alias("hits_array"),
                    join_text(F.col("unique_visitors_array")).alias("unique_visitors_array"))


def customer_totals(orders):
    return (orders.groupBy("o_custkey")
                  .agg(F.count(F.lit(1)).alias("n_orders"),
                       F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total_cents"),
                       F.max(F.to_date("o_orderdate")).alias("last_order_day")))


def q09_upsert_customer_totals(spark, sf_dir):
    """Late true-up: totals computed before a cut-off, then the customers with
    later orders recomputed in full and upserted, twice (idempotent)."""
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    cut = F.lit(TRUE_UP_FROM).cast("date")
    existing = customer_totals(o.where(F.to_date("o_orderdate") < cut))
    touched = o.where(F.to_date("o_orderdate") >= cut).select("o_custkey").distinct()
    updates = customer_totals(o.join(touched, "o_custkey", "left_semi"))
    once = upsert(existing, updates, ["o_custkey"])
    return upsert(once, updates, ["o_custkey"])


def s01_csv_match_details(spark, sf_dir):
    """CSV round trip: written with a header, read back untyped (every column
    text, as a header-only CSV read gives) and typed with try_cast / try_to_number."""
    path = shared_path(spark, "csv", "match_details")
    fx.match_details(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    raw = read_csv(spark, path)
    return raw.select(F.col("match_id").try_cast("bigint").alias("match_id"),
                      F.col("player_gamertag").try_cast("bigint").alias("player_gamertag"),
                      F.try_to_number(F.col("player_total_kills"), F.lit("999999999999999999"))
                       .cast("bigint").alias("player_total_kills"))


def f20_json_events(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "event_type", "props")
    parsed = e.withColumn("p", F.from_json("props", "k int"))
    return parsed.select("event_id", F.col("p.k").alias("k"),
                         F.to_json(F.struct("event_type", F.col("p.k").alias("k"))).alias("payload"))


def q18_orphan_keys(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf_dir, "customer").select("c_custkey")
    return (orphan_keys(li, "l_orderkey", o, "o_orderkey",
                        "lineitem.l_orderkey -> orders", "orders without lineitem")
            .unionByName(orphan_keys(o, "o_custkey", c, "c_custkey",
                                     "orders.o_custkey -> customer", "customer without orders")))


QUERIES = {
    "j14_asof_rate": j14_asof_rate,
    "q07_convert_fx": q07_convert_fx,
    "j15_ip_enrich": j15_ip_enrich,
    "j15_nested_ranges": j15_nested_ranges,
    "s11_upsert_reduced_fact": s11_upsert_reduced_fact,
    "q09_upsert_customer_totals": q09_upsert_customer_totals,
    "s01_csv_match_details": s01_csv_match_details,
    "f20_json_events": f20_json_events,
    "q18_orphan_keys": q18_orphan_keys,
}

_ASOF = """
f AS (SELECT o_orderkey, o_orderpriority AS ccy, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders),
j AS (SELECT f.*, r.rate_date, r.rate FROM f ASOF LEFT JOIN fx_rates r ON f.ccy = r.ccy AND f.day >= r.rate_date)
"""

ORACLE = {
    "j14_asof_rate": with_views("WITH " + _ASOF + "SELECT o_orderkey, ccy, day, rate_date, rate FROM j",
                                "fx_rates"),
    "q07_convert_fx": with_views("WITH " + _ASOF + """
SELECT day, count(*) AS n_orders,
       count(*) FILTER (WHERE rate IS NULL) AS n_frozen,
       count(*) FILTER (WHERE rate IS NOT NULL AND rate_date <> day) AS n_carried,
       CAST(sum(CAST(round(o_totalprice * rate * 100) AS BIGINT)) AS BIGINT) AS converted_cents,
       count(*) FILTER (WHERE rate IS NULL) = 0 AS is_publishable
FROM j GROUP BY day""", "fx_rates"),
    "j15_ip_enrich": with_views("""
SELECT e.event_id, e.ip, r.country, r.region_key
FROM client_events e LEFT JOIN ip_ranges r ON e.ip_num BETWEEN r.ip_start AND r.ip_end""",
                                "client_events", "ip_ranges"),
    "s11_upsert_reduced_fact": sp.ORACLE["c08_host_activity_reduced"],
    "q09_upsert_customer_totals": """
SELECT o_custkey, count(*) AS n_orders,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents,
       max(CAST(o_orderdate AS DATE)) AS last_order_day
FROM orders GROUP BY o_custkey""",
    "s01_csv_match_details": with_views("SELECT * FROM match_details", "match_details"),
    "f20_json_events": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(json_object('event_type', event_type, 'k', CAST(json_extract_string(props, '$.k') AS INTEGER))
            AS VARCHAR) AS payload
FROM events""",
    "q18_orphan_keys": """
SELECT 'lineitem.l_orderkey -> orders' AS "check",
       count(*) AS orphan_keys FROM (SELECT DISTINCT l_orderkey FROM lineitem
                                     WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL
SELECT 'orders without lineitem', count(*) FROM (SELECT DISTINCT o_orderkey FROM orders
                                     WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
UNION ALL
SELECT 'orders.o_custkey -> customer', count(*) FROM (SELECT DISTINCT o_custkey FROM orders
                                     WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL
SELECT 'customer without orders', count(*) FROM (SELECT DISTINCT c_custkey FROM customer
                                     WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))""",
}

ORACLE["j15_nested_ranges"] = with_views("""
SELECT e.event_id, e.ip, r.network, r.level
FROM client_events e LEFT JOIN nested_ip_ranges r ON e.ip_num BETWEEN r.ip_start AND r.ip_end
QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY r.ip_end - r.ip_start, r.ip_start DESC, r.network DESC) = 1""",
                                         "client_events", "nested_ip_ranges")
