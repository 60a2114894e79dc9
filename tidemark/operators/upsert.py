"""Keyed upserts into Parquet tables.

Parquet has no MERGE, so an upsert is: new rows for updated keys, old rows
for the rest (an anti join), written back with dynamic partition
overwrite so only the touched partitions are replaced.  Re-running the
same update gives the same table (idempotent).  Before overwriting a path
it reads from, the merged frame is checkpointed into the shared folder so
the write no longer depends on the files it replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup
from tidemark.session import shared_path


def upsert(existing: DataFrame, updates: DataFrame, keys: Sequence[str],
           order_by: Sequence = ()) -> DataFrame:
    """Latest-wins merge: one row per key, taken from ``updates`` when present.

    Duplicate keys inside ``updates`` are resolved by ``order_by`` (first wins),
    then by the remaining columns, so a retried task picks the same row."""
    keys = list(keys)
    upd = dedup(updates, keys, order_by)
    kept = existing.join(upd.select(*keys), keys, "left_anti")
    return kept.unionByName(upd.select(*existing.columns))


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop's file system, for local and remote paths alike
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def stage(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet under the shared folder and read it back, with its
    path: the result depends on those files only (lineage cut, like
    ``checkpoint()``), and later reads are columnar scans."""
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                      partition_col: str, order_by: Sequence, periods: Sequence | None = None) -> DataFrame:
    """Merge ``updates`` into the Parquet table at ``path`` (partitioned by
    ``partition_col``, which must be one of the keys: a key that moved
    partitions would otherwise stay twice).  Returns the table.

    Duplicate keys in ``updates`` are resolved by ``order_by`` (first wins; give
    ``F.desc`` of the version for latest-wins), on the first write too.  Only the
    partitions in ``periods`` are read and rewritten: a literal filter that
    prunes the scan.  Without ``periods`` they are taken from the staged updates
    (one value per touched partition).  The merged rows are staged before the
    overwrite, so the write no longer reads the files it replaces; both
    staging folders are removed afterwards."""
    if partition_col not in keys:
        raise ValueError(f"{partition_col} must be one of the keys {list(keys)}")
    upd, upd_path = stage(dedup(updates, list(keys), order_by), "upsert_updates")
    if not path_exists(spark, path):
        upd.write.mode("overwrite").partitionBy(partition_col).parquet(path)
        remove_path(spark, upd_path)
        return spark.read.parquet(path)
    table = spark.read.parquet(path)
    if periods is None:
        periods = [r[0] for r in upd.select(partition_col).distinct().collect()]
    current = table.where(F.col(partition_col).isin(*periods)) if periods else table.limit(0)
    merged, merged_path = stage(upsert(current, upd.select(*table.columns), keys, order_by), "upsert_merged")
    write_period(merged, path, partition_col)
    for p in (upd_path, merged_path):
        remove_path(spark, p)
    return spark.read.parquet(path)


def write_period(df: DataFrame, path: str, period_col: str) -> None:
    """Write one (or more) period partitions of a snapshot table,
    replacing only those periods (INSERT ... SELECT of the next snapshot,
    re-runnable)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(period_col).parquet(path))
