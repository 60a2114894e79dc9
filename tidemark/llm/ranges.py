"""Positions in a global order without a single ordered task: rows are dealt by
ranges of the order, numbered inside each range, and each range starts where
those before it end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.staging import staged


def numbered(spark: SparkSession, df: DataFrame, group: str, order: list[str], facts: DataFrame | None = None) -> DataFrame:
    """``df`` with ``position``: the 0-based place of the row within its ``group``
    by ``order`` (ascending, nulls first; rows that tie take any places of theirs).
    ``facts`` (one row per group, with the column ``group``) adds its other columns.

    The rows are range-partitioned by (group, *order), so a group with a third
    of all rows spreads over as many ranges as its rows fill.  What each range
    holds of each group is counted; those counts, one per range and group in
    it, give the ranges' starts and carry the facts, so that no join meets more
    rows of a group than one range holds.
    """
    table = staged(spark, df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = table.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    if facts is not None:
        facts = facts.withColumnRenamed(group, "_f")
        starts = starts.join(facts, F.col("_g").eqNullSafe(F.col("_f"))).drop("_f")
    own = table.withColumn("_own", F.row_number().over(Window.partitionBy("_part", group).orderBy(*order)) - 1)
    met = own.join(starts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return met.withColumn("position", (F.col("_start") + F.col("_own")).cast("long")).drop("_g", "_p", "_start", "_own", "_part")
