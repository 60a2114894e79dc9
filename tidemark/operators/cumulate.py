"""Cumulative snapshot operators: C3 entity snapshots, C6 datelists, C7 bit
histories, C8/C9 reduced monthly facts.

Each comes in two forms that must agree:

* ``*_step``: one period from the prior snapshot and the new period's rows (what a
  daily/yearly job runs; the output is written as the next
  period partition, so lineage never grows across periods);
* ``*_backfill``: all periods up to ``upto`` in one pass of aggregates and
  windows, without iterating over periods on the driver.

Windows are always partitioned by the entity key and ordered by period, so
a window partition holds one entity's periods (bounded by the number of
periods, not by data volume).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.arrays import dense_from_map, set_or_extend
from tidemark.functions.bands import quality_class
from tidemark.functions.bits import active_in_mask, datelist_to_bits, days_active, WEEK_MASK
from tidemark.operators.periods import require_prior

FILM_STRUCT = "struct<year:int,film:string,votes:int,rating:double,filmid:string>"


def _films_of_year(films: DataFrame, with_films: bool = True) -> DataFrame:
    """Per (actorid, year): name, mean rating, film count and (optionally) the
    year's films sorted by filmid."""
    film = F.struct(F.col("year").cast("int").alias("year"), "film",
                    F.col("votes").cast("int").alias("votes"),
                    F.col("rating").cast("double").alias("rating"), "filmid")
    aggs = [F.max("actor").alias("actor"), F.avg("rating").alias("mean_rating"),
            F.count(F.lit(1)).alias("n_year_films")]
    if with_films:
        aggs.append(F.array_sort(F.collect_list(film),
                                 lambda a, b: F.when(a.filmid < b.filmid, -1)
                                               .when(a.filmid > b.filmid, 1).otherwise(0))
                     .alias("year_films"))
    return films.groupBy("actorid", "year").agg(*aggs)


# ---------------------------------------------------------------- C3 actors

def cumulate_actors_step(prev: DataFrame | None, films: DataFrame, year: int) -> DataFrame:
    """One year of the actors snapshot: ``prev`` is the table so far (or None in the
    first year), ``films`` the actor_films rows.

    Snapshot rows and the year's films become records of one shape and meet in one
    aggregate per actor: a snapshot record carries the history, film records the year.
    An actor without a film keeps the history and the class and is inactive.
    Raises ``PeriodGap`` if ``prev`` holds earlier years but not ``year - 1``."""
    film_type, text = f"array<{FILM_STRUCT}>", "string"
    added = _films_of_year(films.where(F.col("year") == year)).select(
        "actorid", "actor", F.lit(1).alias("_rank"), F.col("year_films").alias("_films"), quality_class(F.col("mean_rating")).alias("_class"))
    records = added
    if prev is not None:
        require_prior(prev, "current_year", year)
        kept = prev.where(F.col("current_year") == year - 1)
        records = added.unionByName(kept.select(
            "actorid", "actor", F.lit(0).alias("_rank"), F.col("films").cast(film_type).alias("_films"), F.col("quality_class").cast(text).alias("_class")))
    # at most two records an actor: history (0), then the year (1); the later one names the class
    one = records.groupBy("actorid").agg(F.min_by("actor", "_rank").alias("actor"), F.max("_rank").alias("_newest"),
                                         F.max_by("_class", "_rank").alias("quality_class"),
                                         F.array_sort(F.collect_list(F.struct("_rank", "_films"))).alias("_parts"))
    return one.select("actor", "actorid", F.flatten(F.transform("_parts", lambda p: p["_films"])).alias("films"), "quality_class",
                      (F.col("_newest") == 1).alias("is_active"), F.lit(year).cast("int").alias("current_year"))


def cumulate_actors_backfill(films: DataFrame, upto: int, first: int | None = None,
                             with_films: bool = True) -> DataFrame:
    """Every yearly snapshot up to ``upto`` in one pass.

    Per actor: a row for each year from its first film year to ``upto``;
    films = all films up to that year (year, then filmid); class = band of
    the latest active year; is_active = has films that year.

    Two shuffles: the per-(actor, year) partial aggregate, then one per actor
    that gathers the actor's year summaries (one entry per year, so bounded
    by the calendar) into a map.  The year grid is exploded from that map and
    the windows run on the same actor partitioning, with no join back.

    The films array holds an actor's whole history (the table's data model),
    so one actor's row grows with that actor's films; ``with_films=False``
    (the SCD path) collects no films at all.
    """
    f = films.where(F.col("year") <= upto)
    if first is not None:
        f = f.where(F.col("year") >= first)
    yearly = _films_of_year(f, with_films)
    summary = F.struct("mean_rating", "n_year_films", *(["year_films"] if with_films else []))
    per_actor = (yearly.groupBy("actorid")
                       .agg(F.max("actor").alias("actor"), F.min("year").alias("first_year"),
                            F.map_from_entries(F.collect_list(F.struct("year", summary))).alias("_by_year")))
    grid = (per_actor.select("actorid", "actor", "_by_year",
                             F.explode(F.sequence(F.col("first_year"), F.lit(upto))).alias("current_year"))
                     .select("actorid", "actor", "current_year",
                             F.try_element_at(F.col("_by_year"), F.col("current_year")).alias("_y")))
    w = (Window.partitionBy("actorid").orderBy("current_year")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    active = F.col("_y.n_year_films").isNotNull()
    # struct wrapper so that an active year with a NULL band still overrides
    band = F.when(active, F.struct(quality_class(F.col("_y.mean_rating")).alias("q")))
    films_col = [F.flatten(F.collect_list(F.col("_y.year_films")).over(w)).alias("films")] if with_films else []
    return grid.select(
        "actor", "actorid", *films_col,
        F.last(band, ignorenulls=True).over(w)["q"].alias("quality_class"),
        active.alias("is_active"),
        F.col("current_year").cast("int").alias("current_year"),
    )


def films_text(films: Column) -> Column:
    """``year:filmid`` list, comma separated: a flat rendering of the films array."""
    return F.array_join(F.transform(films, lambda x: F.concat(x.year.cast("string"), F.lit(":"), x.filmid)), ",")


# ---------------------------------------------------------------- C6 datelists

def _between(events: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Events with a time, of the days from ``start`` to ``end`` (None: open)."""
    d, ev = F.to_date(F.col(ts_col)), events.where(F.col(ts_col).isNotNull())
    ev = ev if start is None else ev.where(d >= F.lit(start).cast("date"))
    return ev if end is None else ev.where(d <= F.lit(end).cast("date"))


def daily_active_keys(events: DataFrame, keys: Sequence[str], ts_col: str,
                      start, end, not_null: Sequence[str] = ()) -> DataFrame:
    """Distinct (keys, date) active in [start, end]; the date filter becomes a
    pushed range on the timestamp column.  A bound of None leaves that side open."""
    d = F.to_date(F.col(ts_col))
    ev = _between(events, ts_col, start, end)
    for c in not_null:
        ev = ev.where(F.col(c).isNotNull())
    return ev.select(*[F.col(k) for k in keys], d.alias("date_active")).distinct()


def cumulate_datelist_step(prev: DataFrame | None, today: DataFrame, keys: Sequence[str],
                           day, list_col: str = "dates_active") -> DataFrame:
    """The datelists of ``day`` from those of the day before (``prev``, the table so far) and
    today's (keys, date_active) rows, repeated ones counting once.

    Both are records with a list of dates; per key the lists are joined, newest first.
    Every row is stamped with ``day`` (D17), keys may be NULL.  Raises ``PeriodGap`` if
    ``prev`` holds earlier days but not the one before ``day``."""
    records = today.select(*keys, F.array("date_active").alias("_dates"))
    if prev is not None:
        require_prior(prev, "date", day)
        records = records.unionByName(prev.where(F.col("date") == F.date_sub(F.lit(day).cast("date"), 1)).select(*keys, F.col(list_col).alias("_dates")))
    dates = F.sort_array(F.array_distinct(F.flatten(F.collect_list("_dates"))), asc=False)
    return records.groupBy(*keys).agg(dates.alias(list_col)).withColumn("date", F.lit(day).cast("date"))


def cumulate_datelist_backfill(active: DataFrame, keys: Sequence[str], as_of,
                               list_col: str = "dates_active") -> DataFrame:
    """State after running the step every day up to ``as_of``: newest-first
    active dates per key (one entry per day)."""
    return (active.where(F.col("date_active") <= F.lit(as_of).cast("date"))
                  .groupBy(*keys)
                  .agg(F.sort_array(F.collect_set("date_active"), asc=False).alias(list_col))
                  .withColumn("date", F.lit(as_of).cast("date")))


# ---------------------------------------------------------------- C7 bits

def datelist_bits(df: DataFrame, list_col: str, as_of_col: str = "date") -> DataFrame:
    """32-day bit history from a datelist, with days active and monthly/
    weekly flags.  ``datelist_int`` holds the bits, ``days_active`` the count
    (D22); the as-of day itself is bit 31 (D21)."""
    bits = datelist_to_bits(F.col(list_col), F.col(as_of_col))
    return (df.withColumn("datelist_int", bits)
              .withColumn("days_active", days_active(F.col("datelist_int")))
              .withColumn("is_monthly_active", F.col("datelist_int") != 0)
              .withColumn("is_weekly_active", active_in_mask(F.col("datelist_int"), WEEK_MASK)))


# ---------------------------------------------------------------- C8/C9 reduced facts

def daily_metrics(events: DataFrame, key: str, ts_col: str, user_col: str, start=None, end=None) -> DataFrame:
    """Per (key, date): hits and distinct visitors, NULL users excluded."""
    d = F.to_date(F.col(ts_col))
    ev = _between(events, ts_col, start, end).where(F.col(user_col).isNotNull())
    return (ev.groupBy(F.col(key).alias(key), d.alias("date"))
              .agg(F.count(F.lit(1)).alias("hits"),
                   F.countDistinct(user_col).alias("unique_visitors")))


def reduced_fact_step(prev: DataFrame | None, daily: DataFrame, key: str, day) -> DataFrame:
    """C8 one day: per (key, month) set slot ``day - month_start`` of the hit and
    visitor arrays, zero-padding gaps.  Setting a slot (not appending) makes a
    re-run of the same day a no-op (D18, D19).  Returns the whole month partition."""
    day_c = F.lit(day).cast("date")
    month = F.trunc(day_c, "MM")
    offset = F.datediff(day_c, month)
    t = daily.where(F.col("date") == day_c).select(key, "hits", "unique_visitors").alias("t")
    if prev is None:
        y = None
    else:
        y = prev.where(F.col("month_start") == month).alias("y")
    if y is None:
        j = t.select(F.col(key), F.lit(None).cast("array<bigint>").alias("hits_array"),
                     F.lit(None).cast("array<bigint>").alias("unique_visitors_array"),
                     "hits", "unique_visitors")
        k = F.col(key)
        ya, yv = F.col("hits_array"), F.col("unique_visitors_array")
        th, tv = F.col("hits"), F.col("unique_visitors")
    else:
        j = t.join(y, F.col(f"t.{key}") == F.col(f"y.{key}"), "full_outer")
        k = F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}"))
        ya, yv = F.col("y.hits_array"), F.col("y.unique_visitors_array")
        th, tv = F.col("t.hits"), F.col("t.unique_visitors")
    return j.select(
        k.alias(key),
        month.alias("month_start"),
        set_or_extend(ya, offset, F.coalesce(th, F.lit(0)).cast("bigint")).alias("hits_array"),
        set_or_extend(yv, offset, F.coalesce(tv, F.lit(0)).cast("bigint")).alias("unique_visitors_array"),
    )


def reduced_fact_backfill(daily: DataFrame, key: str, as_of) -> DataFrame:
    """State after running the step every day up to ``as_of``: per (key, month),
    arrays covering the month's days up to min(as_of, month end)."""
    as_of_c = F.lit(as_of).cast("date")
    d = daily.where(F.col("date") <= as_of_c)
    month = F.trunc(F.col("date"), "MM")
    g = (d.groupBy(F.col(key), month.alias("month_start"))
          .agg(F.map_from_entries(F.collect_list(F.struct(F.datediff(F.col("date"), month), F.col("hits")))).alias("h"),
               F.map_from_entries(F.collect_list(F.struct(F.datediff(F.col("date"), month),
                                                          F.col("unique_visitors")))).alias("u")))
    length = F.datediff(F.least(as_of_c, F.last_day(F.col("month_start"))), F.col("month_start")) + 1
    g = g.withColumn("_days", length)
    return g.select(key, "month_start",
                    dense_from_map(F.col("h"), F.col("_days")).alias("hits_array"),
                    dense_from_map(F.col("u"), F.col("_days")).alias("unique_visitors_array"))


def reduced_fact_daily(reduced: DataFrame) -> DataFrame:
    """Position-wise sums over keys, back to (date, hits, sum_of_daily_uniques).

    Daily uniques are not additive across keys, hence the name (D20)."""
    z = reduced.select("month_start",
                       F.posexplode(F.arrays_zip("hits_array", "unique_visitors_array")).alias("pos", "v"))
    return (z.groupBy("month_start", "pos")
             .agg(F.sum(F.col("v.hits_array")).cast("bigint").alias("hits"),
                  F.sum(F.col("v.unique_visitors_array")).cast("bigint").alias("sum_of_daily_uniques"))
             .select(F.date_add(F.col("month_start"), F.col("pos")).alias("date"),
                     "hits", "sum_of_daily_uniques"))
