"""C10 growth accounting: New / Continued Playing / Retired /
Returned from Retirement / Stayed Retired per entity and season.

``growth_step`` folds one season into the prior season's table (the
reference's yearly INSERT); ``growth_backfill`` gives every season in one
pass.  A season with no input row for a known entity counts as inactive
(D31) and every output row carries the run season (D30).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.arrays import empty_array
from tidemark.operators.periods import require_prior

# The five state labels.
NEW = "New"
CONTINUED = "Continued Playing"
RETIRED = "Retired"
RETURNED = "Returned from Retirement"
STAYED_RETIRED = "Stayed Retired"


def growth_step(prev: DataFrame | None, current: DataFrame, key: str, season: int,
                period: str = "current_season", active: str = "is_active") -> DataFrame:
    """One season folded into the prior season's table.

    Both sides become records of one shape and meet in one aggregate per key:
    a prior record carries the history, a current one whether the entity plays.
    Raises ``PeriodGap`` if ``prev`` holds earlier seasons but not ``season - 1``."""
    this = F.lit(season).cast("int")
    plays = current.where(F.col(period) == season).groupBy(key).agg(F.coalesce(F.max(active), F.lit(False)).alias("_act"))
    blank = F.lit(None).cast("int")
    records = plays.select(key, "_act", blank.alias("_first"), blank.alias("_last"), F.lit(None).cast("array<int>").alias("_list"))
    if prev is not None:
        require_prior(prev, period, season)
        records = records.unionByName(prev.where(F.col(period) == season - 1).select(
            key, F.lit(None).cast("boolean").alias("_act"), F.col("first_active_season").cast("int").alias("_first"),
            F.col("last_active_season").cast("int").alias("_last"), F.col("list_seasons_active").cast("array<int>").alias("_list")))
    one = records.groupBy(key).agg(F.coalesce(F.max("_act"), F.lit(False)).alias("_act"), F.max("_first").alias("_first"),
                                   F.max("_last").alias("_last"), F.max("_list").alias("_list"))
    known, played_last = F.col("_first").isNotNull(), F.col("_last") == season - 1
    state = F.when(~known, F.lit(NEW)).when(F.col("_act"), F.when(played_last, F.lit(CONTINUED)).otherwise(RETURNED)) \
             .otherwise(F.when(played_last, F.lit(RETIRED)).otherwise(STAYED_RETIRED))
    added = F.when(F.col("_act"), F.array(this)).otherwise(empty_array("int"))
    return one.where(known | F.col("_act")).select(
        key, F.coalesce("_first", this).alias("first_active_season"),
        F.when(F.col("_act"), this).otherwise(F.col("_last")).alias("last_active_season"),
        state.alias("season_active_state"),
        F.concat(F.coalesce("_list", empty_array("int")), added).alias("list_seasons_active"), this.alias(period))


def growth_backfill(current: DataFrame, key: str, upto: int,
                    period: str = "current_season", active: str = "is_active") -> DataFrame:
    """Every season up to ``upto`` in one pass.

    Two shuffles: (key, season) to fold duplicate input rows, then per key to
    gather its season -> active map (one entry per season, bounded by the
    calendar).  The season grid from the first active season is exploded
    from that map, so missing seasons count as inactive (D31), and the
    windows run on the same key partitioning."""
    per_season = (current.where(F.col(period) <= upto)
                         .groupBy(key, period).agg(F.max(F.col(active)).alias("_a")))
    per_key = (per_season.groupBy(key)
                         .agg(F.min(F.when(F.col("_a"), F.col(period))).alias("first_active_season"),
                              F.map_from_entries(F.collect_list(F.struct(period, "_a"))).alias("_m"))
                         .where(F.col("first_active_season").isNotNull()))
    g = (per_key.select(key, "first_active_season", "_m",
                        F.explode(F.sequence(F.col("first_active_season"), F.lit(upto))).alias(period))
                .select(key, "first_active_season", period,
                        F.coalesce(F.try_element_at(F.col("_m"), F.col(period)), F.lit(False)).alias("_act")))
    w = Window.partitionBy(key).orderBy(period)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    act_season = F.when(F.col("_act"), F.col(period))
    prev_act = F.lag("_act").over(w)
    prev_last = F.max(act_season).over(w.rowsBetween(Window.unboundedPreceding, -1))
    state = (F.when(prev_act.isNull(), F.lit(NEW))
              .when(prev_act & F.col("_act"), F.lit(CONTINUED))
              .when(prev_act, F.lit(RETIRED))
              .when(F.col("_act") & prev_last.isNotNull(), F.lit(RETURNED))
              .otherwise(F.lit(STAYED_RETIRED)))
    return g.select(
        key,
        F.col("first_active_season").cast("int").alias("first_active_season"),
        F.max(act_season).over(run).cast("int").alias("last_active_season"),
        state.alias("season_active_state"),
        F.collect_list(act_season.cast("int")).over(run).alias("list_seasons_active"),
        F.col(period).cast("int").alias(period))
