"""Running totals along an ordered sequence per key, without one task per key.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to
one task; with few keys (teams, hosts) or a hot key that is one huge
task.  Here the order is split into buckets (e.g. the day) that are
monotone with it:

1. totals per (key, bucket)            - aggregate of the input, combined on the map side
2. running totals of (1) per key       - window over buckets only: its size is
                                          the number of buckets, not of rows
3. running totals within (key, bucket) - window partitions split by bucket; the one
                                          shuffle of the rows
4. result = (2) before the bucket + (3)

Step (4) joins on (key, bucket) packed into one struct: structs compare with
NULL fields equal, so rows with a NULL key or bucket keep their place (a NULL
bucket sorts first), and the window of step (3) has the join's partitioning already.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_AT = "_at"


def _with_place(df: DataFrame, keys: Sequence[str], bucket: str) -> DataFrame:
    """Adds the struct of keys and bucket that windows and joins share."""
    return df.withColumn(_AT, F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(bucket).alias("b")))


def _place_windows(n_keys: int):
    """Windows over one row per place: the key's earlier buckets, and all of them."""
    key = [F.col(f"{_AT}.k{i}") for i in range(n_keys)]
    order = Window.partitionBy(*key).orderBy(F.col(f"{_AT}.b").asc_nulls_first())
    return order, order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*key)


def running_totals(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str],
                   sums: Mapping[str, Column], totals: bool = False) -> DataFrame:
    """Add ``<name>`` = running sum of each ``sums[name]`` over the rows of the
    key ordered by (bucket, *order), current row included; with ``totals``
    also ``<name>_total`` = the key's grand total.

    (bucket, *order) must be a total order within the key for the result to
    be deterministic."""
    keys = list(keys)
    base = _with_place(df.select("*", *[expr.alias(f"_v_{n}") for n, expr in sums.items()]), keys, bucket)
    within = Window.partitionBy(_AT).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = base.select(*df.columns, _AT, *[F.sum(f"_v_{n}").over(within).alias(f"_w_{n}") for n in sums])
    _, before, whole = _place_windows(len(keys))
    offsets = base.groupBy(_AT).agg(*[F.sum(f"_v_{n}").alias(f"_b_{n}") for n in sums]).select(
        _AT, *[F.coalesce(F.sum(f"_b_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_b_{n}").over(whole).alias(f"{n}_total") for n in (sums if totals else [])])
    return rows.join(offsets, _AT, "inner").select(
        *df.columns,
        *[(F.col(f"_o_{n}") + F.col(f"_w_{n}")).alias(n) for n in sums],
        *[F.col(f"{n}_total") for n in (sums if totals else [])])


def running_max(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str],
                value: Column, name: str) -> DataFrame:
    """Add ``name`` = max of ``value`` over the key's rows up to the current one
    (order (bucket, *order)), split by bucket like ``running_totals``.  NULL
    values are ignored; the result is NULL until a value is seen."""
    keys = list(keys)
    base = _with_place(df.select("*", value.alias("_v")), keys, bucket)
    within = Window.partitionBy(_AT).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = base.select(*df.columns, _AT, F.max("_v").over(within).alias("_w"))
    _, before, _ = _place_windows(len(keys))
    offsets = base.groupBy(_AT).agg(F.max("_v").alias("_b")).select(_AT, F.max("_b").over(before).alias("_o"))
    return rows.join(offsets, _AT, "inner").select(*df.columns, F.greatest(F.col("_o"), F.col("_w")).alias(name))


def next_in_order(df: DataFrame, keys: Sequence[str], bucket: str, ts: str, tie: str,
                  name: str) -> DataFrame:
    """Add ``name`` = ``ts`` of the key's next row in (bucket, ts, tie) order
    (NULL for the last).  Within a bucket it is ``lead``; the last row of a
    bucket takes the first ``ts`` of the key's next non-empty bucket."""
    keys = list(keys)
    base = _with_place(df, keys, bucket)
    rows = base.select(*df.columns, _AT, F.lead(ts).over(Window.partitionBy(_AT).orderBy(ts, tie)).alias("_lead"))
    order, _, _ = _place_windows(len(keys))
    nxt = base.groupBy(_AT).agg(F.min(ts).alias("_first")).select(_AT, F.lead("_first").over(order).alias("_next_first"))
    return rows.join(nxt, _AT, "inner").select(*df.columns, F.coalesce(F.col("_lead"), F.col("_next_first")).alias(name))
