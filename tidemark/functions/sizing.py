"""Size-checked broadcast.

A broadcast hint is only placed on a side whose size is checked to be under
a bound; beyond the bound the side is returned as is and the
planner keeps a shuffle join (AQE may still convert it at runtime from
the measured shuffle size).

``small_side`` reads at most ``max_rows + 1`` rows for its check, so it stays cheap
for the dimension-sized frames it is meant for; do not call it on a frame
that needs a full fact scan to produce.  ``small_by_bytes`` is for those: it
writes the side once and sizes what it wrote.

``tasks_for`` deals a shuffle by the rows that go through it, so that what a task sorts and
adds up in memory stays the same when the input grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_path

# Default bounds: a million narrow dimension rows, and what they may take in an executor's memory.
DEFAULT_MAX_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of a shuffle that one task should hold, and the most tasks of a shuffle (beyond, tasks grow and spill).
ROWS_A_TASK = 250_000
MAX_TASKS = 20_000


def tasks_for(spark: SparkSession, rows: int, rows_a_task: int = ROWS_A_TASK) -> int:
    """Partitions for ``repartition(n, key)`` of ``rows`` rows; a number that is given is not coalesced again."""
    return max(spark.sparkContext.defaultParallelism, min(MAX_TASKS, -(-rows // rows_a_task)))


def _bytes(df: DataFrame):
    """Bytes of the rows as text, a bound in step with what a broadcast holds."""
    return F.sum(F.octet_length(F.to_json(F.struct(*[df[c] for c in df.columns])))) if df.columns else F.lit(0)


def is_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """At most ``max_rows`` rows of at most ``max_bytes`` bytes; reads no more than ``max_rows + 1`` rows."""
    head = df.limit(max_rows + 1)
    n, size = head.agg(F.count(F.lit(1)), _bytes(head)).first()
    return n <= max_rows and (size or 0) <= max_bytes


def small_side(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if it is small by both bounds, else ``df``."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as written once to the shared folder."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_bytes: int) -> bool:
    """The rows take at most ``max_bytes``."""
    return (df.agg(_bytes(df)).first()[0] or 0) <= max_bytes


def small_by_bytes(df: DataFrame, max_bytes: int, name: str) -> DataFrame | None:
    """``df`` as written once to the shared folder if its rows take at most ``max_bytes``, else None."""
    kept = written(df, name)
    return kept if fits(kept, max_bytes) else None
