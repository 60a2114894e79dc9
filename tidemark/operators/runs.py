"""Q17: published runs kept by version, and what moved between two of them.

A run is written once under its ``run_id``, its rows dealt to buckets that the
caller names (a period, a hash of the keys, or both).  Beside the rows a small
table holds per bucket the number of rows and two sums of row hashes.
Sums do not depend on the order of rows or tasks, so two runs of the same
rows have the same ones.  A diff compares the small tables first and reads only the
buckets whose sums differ: the files of the others are not listed in its scan.

    <path>/rows/run_id=.../bucket=.../     the run's rows
    <path>/sums/run_id=.../                bucket, n_rows, sum_a, sum_b
    <path>/types/run_id=.../               no rows, the columns' types (a run may be empty)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.upsert import path_exists, remove_path


class UnknownRun(ValueError):
    """A run id that was never published."""


def hash_bucket(keys: Sequence[str], n: int) -> Column:
    """One of ``n`` buckets by the keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("string")


def publish(df: DataFrame, path: str, run_id: str, bucket: Column) -> None:
    """Write ``df`` as the run ``run_id``; publishing it again replaces it.

    The sums are written last, from the rows as they were written: a run without sums is not
    published, and a failed attempt leaves nothing that a diff would read."""
    spark = df.sparkSession
    rows, sums = _run_path(path, "rows", run_id), _run_path(path, "sums", run_id)
    if path_exists(spark, sums):
        remove_path(spark, sums)
    df.withColumn("bucket", F.coalesce(bucket.cast("string"), F.lit(""))).hint("rebalance", "bucket") \
      .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(rows)  # no bucket of an earlier attempt stays
    df.limit(0).write.mode("overwrite").parquet(_run_path(path, "types", run_id))
    kept = _rows(spark, path, run_id, df.columns)
    digest = lambda seed: F.sum(F.xxhash64(F.lit(seed), *sorted(df.columns)).cast("decimal(38,0)"))
    kept.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"), digest(1).alias("sum_a"), digest(2).alias("sum_b")) \
        .coalesce(1).write.mode("overwrite").parquet(sums)


def _run_path(path: str, kind: str, run_id: str) -> str:
    if not run_id or any(c in run_id for c in "/\\=:"):
        raise ValueError(f"a run id is a plain name, not {run_id!r}")
    return f"{path}/{kind}/run_id={run_id}"


def _rows(spark: SparkSession, path: str, run_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A run's rows with their bucket as the text that it is (Spark would guess a type from its values)."""
    fields = spark.read.parquet(_run_path(path, "types", run_id)).schema.fields
    df = spark.read.schema(StructType([*fields, StructField("bucket", StringType())])).parquet(_run_path(path, "rows", run_id))
    return df if columns is None else df.select(*columns, "bucket")


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The rows of a run as they were published."""
    _sums(spark, path, run_id)
    return _rows(spark, path, run_id).drop("bucket")


def _sums(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    where = _run_path(path, "sums", run_id)
    if not path_exists(spark, where):
        raise UnknownRun(f"run {run_id!r} is not published under {path}")
    return spark.read.parquet(where)


def changed_buckets(spark: SparkSession, path: str, old: str, new: str) -> list[str]:
    """The buckets whose rows differ between two runs (one name per bucket reaches the driver)."""
    a = _sums(spark, path, old).select("bucket", F.struct("n_rows", "sum_a", "sum_b").alias("_a"))
    b = _sums(spark, path, new).select("bucket", F.struct("n_rows", "sum_a", "sum_b").alias("_b"))
    differ = a.join(b, "bucket", "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select("bucket")
    return sorted(r["bucket"] for r in differ.collect())


def diff(spark: SparkSession, path: str, old: str, new: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """keys, status (added, removed, moved) and per value ``old_v``, ``new_v`` and ``delta_v``
    of the keys that differ between two runs; keys must be unique within a run.

    Both sides become tagged records of one shape that meet in one aggregate per key."""
    buckets = changed_buckets(spark, path, old, new)
    keys, values = list(keys), list(values)

    def side(run_id: str, tag: str, other: str) -> DataFrame:
        df = _rows(spark, path, run_id).where(F.col("bucket").isin(buckets) if buckets else F.lit(False))
        value = F.struct(*[F.col(v) for v in values])
        return df.select(*keys, value.alias(tag), F.lit(None).cast(df.select(value.alias("v")).schema["v"].dataType).alias(other))

    records = side(old, "_old", "_new").unionByName(side(new, "_new", "_old"))
    one = records.groupBy(*keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    status = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("moved")
    out = [F.col(k) for k in keys] + [status.alias("status")]
    for v in values:
        out += [F.col(f"_old.{v}").alias(f"old_{v}"), F.col(f"_new.{v}").alias(f"new_{v}"),
                (F.coalesce(f"_new.{v}", F.lit(0)) - F.coalesce(f"_old.{v}", F.lit(0))).alias(f"delta_{v}")]
    return one.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(*out)
