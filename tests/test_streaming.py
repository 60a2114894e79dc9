"""Streaming sessions: late rows behind the watermark are dropped, sessions are
emitted once closed, and the foreachBatch upsert sink is idempotent."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tidemark.streaming import sessions_stream as st

T = dt.datetime
SCHEMA = "ip string, host string, event_time timestamp_ntz"


def _stream(spark, files):
    src = tempfile.mkdtemp(prefix="tidemark-stream-src-")
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
    paths = sorted(os.path.join(src, d) for d in os.listdir(src))
    # one folder per micro-batch, replayed in order
    flat = tempfile.mkdtemp(prefix="tidemark-stream-flat-")
    for i, p in enumerate(paths):
        for f in os.listdir(p):
            if f.endswith(".parquet"):
                dst = os.path.join(flat, f"{i:03d}-{f}")
                with open(os.path.join(p, f), "rb") as a, open(dst, "wb") as b:
                    b.write(a.read())
                # the file source orders files by modification time
                os.utime(dst, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = st.parquet_source(spark, flat, schema, max_files_per_trigger=1)
    return stream.withColumn("event_timestamp", F.col("event_time").cast("timestamp"))


def test_late_rows_dropped_and_open_sessions_not_emitted(spark):
    batch1 = [("1.1.1.1", "h", T(2024, 1, 1, 10, 0)), ("1.1.1.1", "h", T(2024, 1, 1, 10, 2)),
              ("1.1.1.1", "h", T(2024, 1, 1, 10, 20))]
    batch2 = [("1.1.1.1", "h", T(2024, 1, 1, 10, 40))]
    # Spark drops a row once it is behind the watermark of the previous micro-batch
    batch3 = [("1.1.1.1", "h", T(2024, 1, 1, 9, 0)),          # late: dropped
              ("1.1.1.1", "h", T(2024, 1, 1, 10, 41))]
    s = _stream(spark, [batch1, batch2, batch3])
    out = tempfile.mkdtemp(prefix="tidemark-stream-out-")
    q = st.run_to_parquet(st.session_counts(s), os.path.join(out, "o"), os.path.join(out, "c"))
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p.get("stateOperators"))
    q.stop()
    rows = sorted((r.event_hour.replace(tzinfo=None), r.num_hits)
                  for r in spark.read.parquet(os.path.join(out, "o")).collect())
    assert rows == [(T(2024, 1, 1, 10, 0), 2), (T(2024, 1, 1, 10, 20), 1)]
    assert dropped >= 1


def test_foreach_batch_upsert_sink_is_idempotent(spark):
    rows = [("1.1.1.1", "h", T(2024, 1, 1, 10, 0)), ("1.1.1.1", "h", T(2024, 1, 1, 11, 0)),
            ("2.2.2.2", "h", T(2024, 1, 1, 12, 0))]
    s = _stream(spark, [rows])
    sess = st.session_counts(s).withColumn("day", F.to_date("event_hour"))
    base = tempfile.mkdtemp(prefix="tidemark-sink-")
    table = os.path.join(base, "t")
    sink = st.foreach_batch_upsert(table, ["ip", "host", "event_hour", "day"], "day", [F.desc("num_hits")])
    st.run_foreach_batch(sess, sink, os.path.join(base, "c")).stop()
    first = sorted(map(tuple, spark.read.parquet(table).select("ip", "event_hour", "num_hits").collect()))
    # replay the same rows as a batch: nothing changes
    again = spark.read.parquet(table)
    sink(again.select(*again.columns), 99)
    second = sorted(map(tuple, spark.read.parquet(table).select("ip", "event_hour", "num_hits").collect()))
    assert first == second
    assert len(first) == 2   # the 12:00 session is still open when the stream ends


def test_long_running_job_emits_closed_sessions_and_resumes(spark):
    rows = [("1.1.1.1", "h", T(2024, 1, 1, 10, 0)), ("1.1.1.1", "h", T(2024, 1, 1, 11, 0))]
    s = _stream(spark, [rows])
    base = tempfile.mkdtemp(prefix="tidemark-live-")
    out, ck = os.path.join(base, "o"), os.path.join(base, "c")
    q = st.start_session_job(s, out, ck, interval="1 second")
    q.processAllAvailable()
    q.stop()
    first = spark.read.parquet(out).count()
    # restart on the same checkpoint: nothing is re-emitted
    q2 = st.start_session_job(s, out, ck, interval="1 second")
    q2.processAllAvailable()
    q2.stop()
    assert first == 1 and spark.read.parquet(out).count() == 1
