"""Periods of snapshot tables: the newest one before a run, gaps, and the refresh of
those that rest on a period that is run again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import hadoop_path, path_exists, remove_path

#: Folder of the marks inside a table; Spark's readers skip names with an underscore.
STALE = "_stale"


class PeriodGap(ValueError):
    """A run was asked for although the period right before it is missing."""


def newest_before(table: DataFrame, period: str, value):
    """The newest period of ``table`` before ``value``; None if there is none."""
    return table.where(F.col(period) < F.lit(value)).agg(F.max(period)).first()[0]


def require_prior(table: DataFrame, period: str, value) -> None:
    """Raise ``PeriodGap`` if ``table`` has earlier periods but not the one right before ``value``
    (a number or a day)."""
    one = dt.timedelta(days=1) if isinstance(value, dt.date) else 1
    newest = newest_before(table, period, value)
    if newest is not None and newest != value - one:
        raise PeriodGap(f"period {value} follows {newest}: run {newest + one} to {value - one} first")


def stale_from(spark: SparkSession, path: str) -> str | None:
    """The first period of the table at ``path`` that is marked stale, as text: it and the later ones
    rest on a period that was run again since.  None: all are up to date."""
    folder = f"{path}/{STALE}"
    if not path_exists(spark, folder):
        return None
    fs, p = hadoop_path(spark, folder)
    return min((s.getPath().getName() for s in fs.listStatus(p)), key=lambda n: (len(n), n), default=None)


def mark_stale(spark: SparkSession, path: str, period) -> None:
    """Mark ``period`` and the later ones stale; the earlier mark goes after the new one stands."""
    fs, p = hadoop_path(spark, f"{path}/{STALE}/{period}")
    fs.create(p, True).close()
    for other in fs.listStatus(p.getParent()):
        if other.getPath().getName() != str(period):
            fs.delete(other.getPath(), False)


def clear_stale(spark: SparkSession, path: str) -> None:
    remove_path(spark, f"{path}/{STALE}")


def refresh(spark: SparkSession, path: str, period: str, value, after: Callable, run_one: Callable, propagate: bool = True) -> None:
    """Bring a cumulative table to ``value``: ``run_one`` writes one period from the one before it.

    Periods skipped since the newest are run first.  Where ``value`` is in the table
    already, every later period rests on it and is run again too, in order; with
    ``propagate=False`` they are only marked.  The mark stands until its period is rewritten, so a job
    that dies on the way leaves the rest marked, and the next run starts from the mark."""
    newest = spark.read.parquet(path).agg(F.max(period)).first()[0] if path_exists(spark, path) else None
    start = end = value
    if newest is not None:
        start = min(value, after(newest))
        end = max(value, newest) if propagate else value
        marked = stale_from(spark, path)
        if marked is not None and propagate:
            start = min(start, type(value).fromisoformat(marked) if hasattr(value, "isoformat") else type(value)(marked))
    while start <= end:
        if newest is not None and start <= newest:
            mark_stale(spark, path, start)
        run_one(start)
        start = after(start)
    if newest is not None and start <= newest:
        mark_stale(spark, path, start)
    elif newest is not None:
        clear_stale(spark, path)
