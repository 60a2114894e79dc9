"""Match analytics: C17 medal map, C18 match fact, C19 questions.

Dimensions (deduplicated medals, maps) are broadcast behind a row-count
check; the medal map is fact-sized and is joined by key, never broadcast
(D34).  Players without medals are kept with a NULL map (D14).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sizing import small_side

# Medal ids repaired by medal name before use.
MEDAL_ID_REPAIRS = {
    "Team Takedown": "2896365521",
    "Perfect Kill": "1080468863",
}


def dedup_medals(medals: DataFrame, repairs: Mapping[str, str] = MEDAL_ID_REPAIRS) -> DataFrame:
    """One (name, medal_id) per medal name: lowest raw id wins, then ids are
    repaired by name; NULL names dropped.

    "Lowest id per name" is a ``min`` aggregate, not a window: it combines on
    the map side, so a name repeated on millions of rows costs no hot task."""
    firsts = (medals.where(F.col("name").isNotNull())
                    .groupBy("name").agg(F.min("medal_id").alias("medal_id")))
    repaired = F.col("medal_id")
    for name, mid in repairs.items():
        repaired = F.when(F.col("name") == name, F.lit(mid)).otherwise(repaired)
    return firsts.select("name", repaired.alias("medal_id"))


def medal_counts(medals_players: DataFrame, medals: DataFrame,
                 repairs: Mapping[str, str] = MEDAL_ID_REPAIRS, prepartition: bool = True) -> DataFrame:
    """match_id, player_gamertag, medal_name, medal_count: counts summed per
    name (so duplicate keys cannot reach ``map_from_entries``, D13).

    Rows are hash-partitioned on (match, player) once; both this sum and the
    per-(match, player) map built from it are satisfied by that partitioning,
    so the two aggregations share one shuffle.  Pass ``prepartition=False``
    when the input is already bucketed on match_id: that layout satisfies
    both aggregations with no shuffle at all."""
    dm = small_side(dedup_medals(medals, repairs))
    j = medals_players.join(dm, "medal_id", "inner")
    if prepartition:
        j = j.repartition("match_id", "player_gamertag")
    return (j.groupBy("match_id", "player_gamertag", F.col("name").alias("medal_name"))
             .agg(F.sum("medal_count").cast("bigint").alias("medal_count")))


def medal_map(medals_players: DataFrame, medals: DataFrame,
              repairs: Mapping[str, str] = MEDAL_ID_REPAIRS, prepartition: bool = True) -> DataFrame:
    """C17: per (match, player) a map medal name -> count."""
    c = medal_counts(medals_players, medals, repairs, prepartition)
    return (c.groupBy("match_id", "player_gamertag")
             .agg(F.map_from_entries(F.collect_list(F.struct("medal_name", "medal_count")))
                   .alias("medals_count_map")))


def match_fact(matches: DataFrame, details: DataFrame, medal_map_df: DataFrame,
               maps: DataFrame) -> DataFrame:
    """Date, match, player, playlist, map name, kills, medal map.

    The medal map joins the details on (match, player) as a left join, then both join
    matches on match_id (sort-merge, co-located when all are bucketed on match_id); maps is
    a checked broadcast.  Matches come last so that the rows of a match leave side by side:
    a later shuffle or file holds what they share in a few bytes."""
    mp = small_side(maps.where(F.col("mapid").isNotNull())
                        .select("mapid", F.col("name").alias("map_name")))
    m = matches.select("match_id", "completion_date", "mapid", "playlist_id")
    j = (details.join(medal_map_df, ["match_id", "player_gamertag"], "left")
          .join(m, "match_id", "inner")
          .join(mp, "mapid", "inner"))
    return j.select(F.col("completion_date").alias("match_completion_date"), "match_id",
                    "player_gamertag", "playlist_id", "map_name", "player_total_kills",
                    "medals_count_map")


def medals_text(m) -> F.Column:
    """``name:count`` entries sorted by name, comma separated (flat rendering)."""
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e.key, F.lit(":"), e.value.cast("string"))), ",")


def avg_kills_per_player(fact: DataFrame) -> DataFrame:
    """Most kills per match first; equal means by tag."""
    return (fact.groupBy("player_gamertag")
                .agg((F.sum("player_total_kills") / F.count("match_id")).alias("avg_kills"))
                .orderBy(F.desc("avg_kills"), "player_gamertag"))


def matches_per(fact: DataFrame, dim: str) -> DataFrame:
    """Most matches first; equal counts by name."""
    return fact.groupBy(dim).agg(F.countDistinct("match_id").alias("matches")).orderBy(F.desc("matches"), dim)


def medal_per_map(fact: DataFrame, medal_name: str) -> DataFrame:
    """Per map: medals of one kind earned (summed counts, D15) and player-match
    rows holding it; most medals first, equal counts by map."""
    e = fact.select("map_name", F.try_element_at("medals_count_map", F.lit(medal_name)).alias("value"))
    return (e.where(F.col("value").isNotNull())
             .groupBy("map_name")
             .agg(F.sum("value").cast("bigint").alias("medals"),
                  F.count(F.lit(1)).alias("rows_with_medal"))
             .orderBy(F.desc("medals"), "map_name"))
