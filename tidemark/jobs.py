"""Incremental period jobs: the production form of the step operators.

Each job reads the previous period's partition of its table (partition
pruning keeps that read to one period), applies one step and writes the new
period partition with dynamic overwrite.  A period's run only depends on
files, not on the previous run's plan, so lineage never grows; re-running a
period rewrites the same partition (idempotent) and then the later ones, which
rest on it (``periods.refresh``).  Tables live under a
shared path (e.g. below ``spark.checkpoint.dir`` or a warehouse folder).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cumulate as cu
from tidemark.operators import growth, scd
from tidemark.operators.periods import newest_before, refresh
from tidemark.operators.upsert import path_exists, upsert_partitions, write_period


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None only if the path does not exist (any other failure surfaces)."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def _prior(spark: SparkSession, path: str, period_col: str, value) -> DataFrame | None:
    """The partition of the newest period before ``value`` (None: there is none)."""
    table = _table(spark, path)
    newest = None if table is None else newest_before(table, period_col, value)
    return None if newest is None else table.where(F.col(period_col) == F.lit(newest))


def _next_year(year: int) -> int:
    return year + 1


def _next_day(day: dt.date) -> dt.date:
    return day + dt.timedelta(days=1)


def actors_year(spark: SparkSession, films: DataFrame, path: str, year: int, propagate: bool = True) -> DataFrame:
    """C3 for one year into the ``actors`` table (partitioned by current_year).

    Skipped years are run first, and where the year is in the table already the later
    ones are run again after it (``periods.refresh``)."""
    def run(y: int) -> None:
        write_period(cu.cumulate_actors_step(_prior(spark, path, "current_year", y), films, y), path, "current_year")

    refresh(spark, path, "current_year", year, _next_year, run, propagate)
    return spark.read.parquet(path).where(F.col("current_year") == year)


def actors_scd_year(spark: SparkSession, actors_path: str, scd_path: str, year: int,
                    first_year: int, propagate: bool = True) -> DataFrame:
    """C4 on the first run, then C5 for each later year (table partitioned by
    current_year); skipped years are run first, later ones again."""
    snaps = spark.read.parquet(actors_path).drop("films")
    attrs = ["quality_class", "is_active"]

    def run(y: int) -> None:
        prev = _prior(spark, scd_path, "current_year", y) if y != first_year else None
        if prev is None:
            out = scd.scd2_backfill(snaps, "actorid", attrs, "current_year", y, carry=["actor"])
        else:
            out = scd.scd2_increment(prev, snaps, "actorid", attrs, "current_year", y, carry=["actor"])
        write_period(out, scd_path, "current_year")

    refresh(spark, scd_path, "current_year", year, _next_year, run, propagate)
    return spark.read.parquet(scd_path).where(F.col("current_year") == year)


def datelist_day(spark: SparkSession, events: DataFrame, keys: list[str], ts_col: str, path: str,
                 day: dt.date, list_col: str = "dates_active", propagate: bool = True) -> DataFrame:
    """C6 for one day into a datelist table (partitioned by date); skipped days
    are run first, so that their activity is in the lists, later ones again."""
    def run(d: dt.date) -> None:
        today = cu.daily_active_keys(events, keys, ts_col, d, d, not_null=keys)
        write_period(cu.cumulate_datelist_step(_prior(spark, path, "date", d), today, keys, d, list_col), path, "date")

    refresh(spark, path, "date", day, _next_day, run, propagate)
    return spark.read.parquet(path).where(F.col("date") == F.lit(day))


def reduced_fact_day(spark: SparkSession, daily: DataFrame, key: str, path: str, day: dt.date) -> DataFrame:
    """C8 for one day: keyed upsert of the month partition (S11).  Slots of skipped
    days are set to zero by the step; run those days to fill them."""
    step = cu.reduced_fact_step(_table(spark, path), daily, key, day)
    return upsert_partitions(spark, path, step, [key, "month_start"], "month_start", order_by=[],
                             periods=[day.replace(day=1)])


def growth_season(spark: SparkSession, players: DataFrame, key: str, path: str, season: int, propagate: bool = True) -> DataFrame:
    """C10 for one season into the growth table (partitioned by current_season);
    skipped seasons are run first, later ones again."""
    def run(s: int) -> None:
        write_period(growth.growth_step(_prior(spark, path, "current_season", s), players, key, s), path, "current_season")

    refresh(spark, path, "current_season", season, _next_year, run, propagate)
    return spark.read.parquet(path).where(F.col("current_season") == season)
