"""Spans of time: united per key, cut at calendar edges, counted per day.

Spans are half-open, [start, end).  Windows are partitioned by the span's key,
so one holds the spans of one user; the only ordered pass over everything
runs over a calendar of days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def unite(spans: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """keys, start, end of the union of each key's spans (overlapping and touching ones become one).

    A sweep by start: a span opens a new piece when it starts after everything before it has ended."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reached = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.select(*keys, start, end, (reached.isNull() | (F.col(start) > reached)).cast("int").alias("_new"))
    pieces = opened.withColumn("_piece", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return pieces.groupBy(*keys, "_piece").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_piece")


def split_spans(spans: DataFrame, start: str, end: str, unit: str, period: str) -> DataFrame:
    """Every span cut at the edges of ``unit`` (``day`` or ``week``, Monday first): adds ``period``
    (its first day), ``part_us`` (microseconds of the span in it) and ``is_first`` (the part
    that holds the span's start).  A span without length has one part."""
    step = {"day": 1, "week": 7}[unit]
    first_of = lambda c: F.to_date(F.date_trunc(unit, c))
    last_moment = F.greatest(F.col(start), F.col(end) - F.expr("INTERVAL '0.000001' SECOND"))
    cut = spans.withColumn(period, F.explode(F.sequence(first_of(F.col(start)), first_of(last_moment), F.expr(f"INTERVAL {step} DAY"))))
    kind = spans.schema[start].dataType
    begin = F.greatest(F.col(start), F.col(period).cast(kind))
    stop = F.least(F.col(end), F.date_add(period, step).cast(kind))
    return cut.withColumn("part_us", F.timestamp_diff("MICROSECOND", begin, stop)).withColumn("is_first", F.col(period) == first_of(F.col(start)))


def calendar(days: DataFrame, day: str = "day") -> DataFrame:
    """One row per day from the first to the last ``day`` of the data (none without data)."""
    edges = days.agg(F.min(day).alias("_a"), F.max(day).alias("_b")).where(F.col("_a").isNotNull())
    return edges.select(F.explode(F.sequence("_a", "_b")).alias(day))


def open_per_day(steps: DataFrame, days: DataFrame, names: Sequence[str]) -> DataFrame:
    """day and, per name, how many are open that day, for the days of ``days`` (day).

    ``steps`` (day, and per name the change on that day) holds +1 where a span starts and -1 where it
    ends; it is summed per day on the map side, and one running sum goes over the calendar."""
    per_day = steps.groupBy("day").agg(*[F.sum(n).alias(n) for n in names])
    zero = days.select("day", F.lit(True).alias("_in"), *[F.lit(0).cast("long").alias(n) for n in names])
    both = per_day.select("day", F.lit(False).alias("_in"), *names).unionByName(zero)
    one = both.groupBy("day").agg(F.max("_in").alias("_in"), *[F.sum(n).alias(n) for n in names])
    run = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)  # one row per calendar day
    return one.select("day", "_in", *[F.sum(n).over(run).cast("long").alias(n) for n in names]).where("_in").drop("_in")
