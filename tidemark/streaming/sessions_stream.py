"""C15 on a stream: event-time sessions with a watermark.

readStream -> event-time column -> withWatermark -> session_window
aggregate -> append sink.  A session is emitted once, when the watermark
passes its end; rows behind the watermark are dropped (T6) and counted batch
by batch in a ledger beside the checkpoint (``late_rows``).  Spark applies the
late-row rule with the watermark of the previous micro-batch (the current
one decides eviction), so a row is dropped once it is older than that.

Kafka is the production source (``kafka_source``); the jar is not on this
image, so tests and the registered query stream the Parquet event files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tidemark.session import shared_path
from tidemark.streaming.late_rows import LateRowLedger

GAP = "5 minutes"
LATENESS = "10 seconds"
# Fixed value: the source's timestamp text pattern (ISO-8601 with millis and a literal Z).
TS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def parquet_source(spark: SparkSession, path: str, schema: StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if not path.endswith("/") and path.endswith(".parquet"):
        # a single file (or a folder of that name): stream the folder above it, that name only
        folder, name = path.rsplit("/", 1)
        reader = reader.option("basePath", folder)
        path = f"{folder}/{{{name}}}"
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def decode_json_events(raw: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """JSON records -> columns, with the event-time column parsed from its ISO
    text (T1, F5, F20).  Works on a batch frame or a stream alike."""
    return (raw.select(F.from_json(F.col(value_col).cast("string"), schema).alias("r")).select("r.*")
               .withColumn("event_timestamp", F.to_timestamp("event_time", TS_PATTERN)))


def kafka_source(spark: SparkSession, servers: str, topic: str, schema: StructType,
                 options: dict | None = None) -> DataFrame:
    """JSON records from a Kafka topic (needs the spark-sql-kafka package)."""
    raw = (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", servers)
                .option("subscribe", topic)
                .option("startingOffsets", "latest")
                .options(**(options or {}))
                .load())
    return decode_json_events(raw, schema)


def session_counts(stream: DataFrame, ts: str = "event_timestamp", gap: str = GAP,
                   lateness: str = LATENESS) -> DataFrame:
    """event_hour (session start), ip, host, num_hits per closed session."""
    return (stream.withWatermark(ts, lateness)
                  .groupBy(F.session_window(F.col(ts), gap).alias("w"), "ip", "host")
                  .agg(F.count("host").alias("num_hits"))
                  .select(F.col("w.start").alias("event_hour"), F.col("w.end").alias("session_end"),
                          "ip", "host", "num_hits"))


def run_to_parquet(df: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                   processing_time: str | None = None, timeout_s: float | None = None):
    """Append sink to Parquet with a checkpoint folder (exactly-once file sink).

    ``available_now`` drains what is there and stops (batch-like runs);
    otherwise a processing-time trigger keeps the query running.  Late rows are
    entered in the checkpoint's ledger (``late_rows.late_rows``)."""
    w = df.writeStream.outputMode("append").format("parquet").option("path", out_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return _start(df, w, checkpoint, available_now, timeout_s)


def _start(df: DataFrame, writer, checkpoint: str, available_now: bool, timeout_s: float | None):
    """Start ``writer`` with a late-row ledger; with ``available_now`` wait for its end."""
    name = f"tidemark-{uuid.uuid4().hex[:12]}"
    ledger = LateRowLedger(df.sparkSession, checkpoint, name)
    df.sparkSession.streams.addListener(ledger)
    q = writer.queryName(name).option("checkpointLocation", checkpoint).start()
    if available_now:
        try:
            _drain(q, timeout_s)
        finally:
            ledger.settle(q)
    return q


def _drain(q, timeout_s: float | None) -> None:
    """Wait until the query ends by itself; stop it and raise if it does not in time."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream was not drained within {timeout_s} s; its sink is incomplete")


def start_session_job(stream: DataFrame, out_path: str, checkpoint: str,
                      interval: str = "10 seconds"):
    """The long-running form (T5, T7): sessions of a live source (e.g.
    ``kafka_source``) appended to a Parquet table, micro-batch and
    checkpoint every ``interval``.  Restarting with the same checkpoint
    resumes where the query stopped (exactly-once file sink)."""
    return run_to_parquet(session_counts(stream), out_path, checkpoint, available_now=False,
                          processing_time=interval)


def stream_sessions(spark: SparkSession, events_path: str, to_web_events, schema: StructType,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the session job over ``events_path`` to completion; return the sink.

    Sessions of one key merge inside each task before the shuffle, so a busy
    key sends one row per open session and task, not one per event."""
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    base = shared_path(spark, "stream_sessions")
    src = parquet_source(spark, events_path, schema, max_files_per_trigger)
    web = to_web_events(src).withColumn("event_timestamp", F.col("event_time").cast("timestamp"))
    q = run_to_parquet(session_counts(web), f"{base}/out", f"{base}/checkpoint")
    q.stop()
    return spark.read.schema(_SINK_SCHEMA).parquet(f"{base}/out")


_SINK_SCHEMA = StructType([
    StructField("event_hour", TimestampType()), StructField("session_end", TimestampType()),
    StructField("ip", StringType()), StructField("host", StringType()),
    StructField("num_hits", LongType())])


def foreach_batch_append(path: str, partition_col: str | None = None):
    """A ``foreachBatch`` sink that appends the raw rows of each batch into a
    folder of its own (``batch=<id>``); a replayed batch replaces its folder."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        (w.partitionBy(partition_col) if partition_col else w).parquet(f"{path}/batch={batch_id}")

    return sink


def foreach_batch_upsert(path: str, keys: list[str], partition_col: str, order_by):
    """A ``foreachBatch`` sink that merges each micro-batch into a keyed
    Parquet table (of duplicate keys the first by ``order_by`` wins, touched
    partitions rewritten).

    A replayed batch (after a failure) merges the same rows again and leaves
    the table unchanged, so the sink is idempotent."""
    from tidemark.operators.upsert import upsert_partitions

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        upsert_partitions(batch.sparkSession, path, batch, keys, partition_col, order_by)

    return sink


def run_foreach_batch(df: DataFrame, sink, checkpoint: str, available_now: bool = True,
                      timeout_s: float | None = None):
    w = df.writeStream.outputMode("append").foreachBatch(sink).trigger(availableNow=available_now)
    return _start(df, w, checkpoint, available_now, timeout_s)
