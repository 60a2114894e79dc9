"""C15 sessionization (batch) and C16 session KPIs.

A session is a run of a key's events whose successive gaps are at most
``gap`` (an event exactly ``gap`` after the previous one joins the
session, as Spark's ``session_window`` does); it ends ``gap`` after its
last event.

Batch sessions do not put a whole key into one task: events are cut into
time buckets (an hour by default) and sessionized per (key, bucket)
window partition; only the first and last session of each bucket can
continue across a bucket edge, so only those (at most two per key and
bucket, a number bounded by the time span, not by the data) are stitched
in a second, per-key pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.bands import label_by_contains


def _interval(seconds: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def sessionize(events: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int = 300,
               bucket: str = "hour", count_col: str | None = None,
               sums: dict | None = None) -> DataFrame:
    """keys..., session_start, session_end, num_hits for every session.

    ``count_col``: count non-NULL values of this column (default: rows);
    ``sums``: extra per-session sums, name -> Column (e.g. flags)."""
    sums = dict(sums or {})
    keys = list(keys)
    gap = _interval(gap_seconds)
    hit = F.col(count_col).isNotNull().cast("bigint") if count_col else F.lit(1).cast("bigint")
    ev = (events.where(F.col(ts).isNotNull())
                .select(*keys, F.col(ts).alias("_ts"), hit.alias("_hit"),
                        *[c.cast("bigint").alias(f"_s_{n}") for n, c in sums.items()])
                .withColumn("_b", F.date_trunc(bucket, F.col("_ts"))))
    w = Window.partitionBy(*keys, "_b").orderBy("_ts")
    prev = F.lag("_ts").over(w)
    # run ids and the bucket's last run id come from windows over one
    # (key, bucket) shuffle; the group-by below reuses that partitioning
    sid = (ev.withColumn("_new", (prev.isNull() | (F.col("_ts") > prev + gap)).cast("int"))
             .withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("_nsid", F.max("_sid").over(Window.partitionBy(*keys, "_b"))))
    local = (sid.groupBy(*keys, "_b", "_sid")
                .agg(F.min("_ts").alias("_start"), F.max("_ts").alias("_last"),
                     F.sum("_hit").alias("_hits"), F.max("_nsid").alias("_nsid"),
                     *[F.sum(f"_s_{n}").alias(f"_s_{n}") for n in sums])
                .withColumn("_edge", (F.col("_sid") == 1) | (F.col("_sid") == F.col("_nsid"))))
    extra = [f"_s_{n}" for n in sums]
    inner = local.where(~F.col("_edge")).select(*keys, "_start", "_last", "_hits", *extra)
    edges = local.where(F.col("_edge"))
    we = Window.partitionBy(*keys).orderBy("_start")
    prev_last = F.lag("_last").over(we)
    stitched = (edges.withColumn("_new", (prev_last.isNull() | (F.col("_start") > prev_last + gap)).cast("int"))
                     .withColumn("_gid", F.sum("_new").over(we.rowsBetween(Window.unboundedPreceding, 0)))
                     .groupBy(*keys, "_gid")
                     .agg(F.min("_start").alias("_start"), F.max("_last").alias("_last"),
                          F.sum("_hits").alias("_hits"), *[F.sum(c).alias(c) for c in extra])
                     .select(*keys, "_start", "_last", "_hits", *extra))
    return (inner.unionByName(stitched)
                 .select(*keys, F.col("_start").alias("session_start"),
                         (F.col("_last") + gap).alias("session_end"),
                         F.col("_hits").cast("bigint").alias("num_hits"),
                         *[F.col(f"_s_{n}").cast("bigint").alias(n) for n in sums]))


def avg_hits_for_hosts(sessions: DataFrame, host_pattern: str) -> DataFrame:
    """Mean hits per session over hosts containing ``host_pattern`` (2 dp)."""
    return (sessions.where(F.col("host").contains(host_pattern))
                    .agg(F.round(F.avg("num_hits"), 2).alias("avg_web_events")))


def compare_host_groups(sessions: DataFrame, labels: list[tuple[str, str]], fallback: str) -> DataFrame:
    """Mean hits per session by host group (first matching pattern wins)."""
    g = label_by_contains(F.col("host"), labels, fallback)
    return (sessions.groupBy(g.alias("host_group"))
                    .agg(F.avg("num_hits").alias("avg_web_events"),
                         F.count(F.lit(1)).alias("sessions")))
