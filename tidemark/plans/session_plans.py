"""Queries for sessions: C15 (batch and stream), C16 KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import sessions as ss
from tidemark.plans.oracle_views import with_views
from tidemark.session import shared_path
from tidemark.sources import fixtures as fx
from tidemark.sources.tables import load, table_path
from tidemark.streaming.sessions_stream import decode_json_events, foreach_batch_append, run_foreach_batch, stream_sessions

GAP_SECONDS = 300
LATENESS_SECONDS = 10
HOST_PATTERN = "click"
HOST_GROUPS = [("click", "click"), ("view", "view"), ("purchase", "purchase")]
FALLBACK = "N/A"


def batch_sessions(spark, sf_dir):
    s = ss.sessionize(fx.web_events(spark, sf_dir), ["ip", "host"], "event_time", GAP_SECONDS,
                      count_col="host")
    return s.select("ip", "host", F.col("session_start").alias("event_hour"), "session_end", "num_hits")


def c15_sessionize(spark, sf_dir):
    return batch_sessions(spark, sf_dir)


def c15_stream_sessions(spark, sf_dir):
    schema = load(spark, sf_dir, "events").schema
    out = stream_sessions(spark, table_path(sf_dir, "events"), fx.web_events_from, schema)
    return out.select("ip", "host", F.col("event_hour").cast("timestamp_ntz").alias("event_hour"),
                      F.col("session_end").cast("timestamp_ntz").alias("session_end"), "num_hits")


def c16_avg_hits_for_host(spark, sf_dir):
    return ss.avg_hits_for_hosts(batch_sessions(spark, sf_dir), HOST_PATTERN)


def c16_avg_hits_from_stream_table(spark, sf_dir):
    """The KPI as a batch query over the table the streaming job wrote
    (closed sessions only, as the stream emits them)."""
    return ss.avg_hits_for_hosts(c15_stream_sessions(spark, sf_dir), HOST_PATTERN)


def c16_host_group_compare(spark, sf_dir):
    return ss.compare_host_groups(batch_sessions(spark, sf_dir), HOST_GROUPS, FALLBACK)


def t01_text_events(spark, sf_dir):
    """Events as JSON text with an ISO time, streamed, decoded and
    appended raw batch by batch; read back with the event time as a timestamp."""
    base = shared_path(spark, "text_events")
    e = fx.web_events(spark, sf_dir)
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    e.select(F.to_json(F.struct("event_id", "ip", "host", iso.alias("event_time"))).alias("value")).write.text(f"{base}/in")
    raw = spark.readStream.schema("value string").text(f"{base}/in")
    decoded = decode_json_events(raw, StructType.fromDDL("event_id long, ip string, host string, event_time string"))
    run_foreach_batch(decoded, foreach_batch_append(f"{base}/out"), f"{base}/checkpoint").stop()
    out = spark.read.schema(decoded.schema).parquet(f"{base}/out/batch=*")
    return out.select("event_id", "ip", "host", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"))


QUERIES = {
    "t01_text_events": t01_text_events,
    "c15_sessionize": c15_sessionize,
    "c15_stream_sessions": c15_stream_sessions,
    "c16_avg_hits_for_host": c16_avg_hits_for_host,
    "c16_avg_hits_from_stream_table": c16_avg_hits_from_stream_table,
    "c16_host_group_compare": c16_host_group_compare,
}

_SESSIONS = f"""
WITH x AS (
  SELECT ip, host, event_time,
         lag(event_time) OVER (PARTITION BY ip, host ORDER BY event_time) AS p
  FROM web_events WHERE event_time IS NOT NULL),
y AS (
  SELECT *, sum(CASE WHEN p IS NULL OR event_time > p + INTERVAL {GAP_SECONDS} SECOND THEN 1 ELSE 0 END)
              OVER (PARTITION BY ip, host ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS sid
  FROM x),
s AS (
  SELECT ip, host, min(event_time) AS event_hour,
         max(event_time) + INTERVAL {GAP_SECONDS} SECOND AS session_end,
         count(host) AS num_hits
  FROM y GROUP BY ip, host, sid)
"""

_GROUP_CASE = " ".join(f"WHEN host LIKE '%{p}%' THEN '{label}'" for p, label in HOST_GROUPS)

ORACLE = {
    "t01_text_events": with_views("SELECT event_id, ip, host, date_trunc('millisecond', event_time) AS event_timestamp FROM web_events", "web_events"),
    "c15_sessionize": with_views(_SESSIONS + "SELECT * FROM s", "web_events"),
    "c15_stream_sessions": with_views(_SESSIONS + f"""
SELECT * FROM s
WHERE session_end <= (SELECT max(event_time) FROM web_events) - INTERVAL {LATENESS_SECONDS} SECOND""",
                                      "web_events"),
    "c16_avg_hits_for_host": with_views(_SESSIONS + f"""
SELECT round(avg(num_hits), 2) AS avg_web_events FROM s WHERE host LIKE '%{HOST_PATTERN}%'""",
                                        "web_events"),
    "c16_avg_hits_from_stream_table": with_views(_SESSIONS + f"""
SELECT round(avg(num_hits), 2) AS avg_web_events FROM s
WHERE host LIKE '%{HOST_PATTERN}%'
  AND session_end <= (SELECT max(event_time) FROM web_events) - INTERVAL {LATENESS_SECONDS} SECOND""",
                                                 "web_events"),
    "c16_host_group_compare": with_views(_SESSIONS + f"""
SELECT CASE {_GROUP_CASE} ELSE '{FALLBACK}' END AS host_group,
       avg(num_hits) AS avg_web_events, count(*) AS sessions
FROM s GROUP BY 1""", "web_events"),
}
