"""Queries for match analytics: C17-C20, J11/J12 (bucketed + broadcast joins)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import layout
from tidemark.operators import matches as mt
from tidemark.operators.upsert import write_period
from tidemark.plans.oracle_views import with_views
from tidemark.session import shared_path
from tidemark.sources import fixtures as fx

MEDAL_OF_INTEREST = "Brand#7"   # stands in for the reference's 'Killing Spree'
BUCKETS = 16
LAYOUTS = [("sorted_map_only", 5, ["match_completion_date", "map_name"]),
           ("sorted_map_only", 10, ["match_completion_date", "map_name"]),
           ("sorted_map_playlist", 5, ["match_completion_date", "map_name", "playlist_id"]),
           ("sorted_map_playlist", 10, ["match_completion_date", "map_name", "playlist_id"])]


def _medal_map(spark, sf_dir):
    return mt.medal_map(fx.medals_matches_players(spark, sf_dir), fx.medals(spark, sf_dir))


def fact(spark, sf_dir):
    return mt.match_fact(fx.matches(spark, sf_dir), fx.match_details(spark, sf_dir),
                         _medal_map(spark, sf_dir), fx.maps(spark, sf_dir))


def _flat(f):
    return f.select("match_completion_date", "match_id", "player_gamertag", "playlist_id", "map_name",
                    "player_total_kills", mt.medals_text(F.col("medals_count_map")).alias("medals"))


def c17_medal_map(spark, sf_dir):
    m = _medal_map(spark, sf_dir)
    return m.select("match_id", "player_gamertag",
                    F.explode("medals_count_map").alias("medal_name", "medal_count"))


def c18_match_fact(spark, sf_dir):
    return _flat(fact(spark, sf_dir))


def c19_avg_kills_per_player(spark, sf_dir):
    return mt.avg_kills_per_player(fact(spark, sf_dir))


def c19_matches_per_playlist(spark, sf_dir):
    return mt.matches_per(fact(spark, sf_dir), "playlist_id")


def c19_matches_per_map(spark, sf_dir):
    return mt.matches_per(fact(spark, sf_dir), "map_name")


def c19_medal_per_map(spark, sf_dir):
    return mt.medal_per_map(fact(spark, sf_dir), MEDAL_OF_INTEREST)


def _layouts(spark, sf_dir):
    """The experiment's folder; both of its reports read the same layouts."""
    return layout.written_once(spark, "layout", (sf_dir,), lambda base: layout.write_layouts(fact(spark, sf_dir), LAYOUTS, base))


def c20_layout_experiment(spark, sf_dir):
    """Rows written per layout and whether it kept to its file count; the sizes
    depend on the encoder, so ``c20_layout_sizes`` has them."""
    out = layout.layout_report(spark, LAYOUTS, _layouts(spark, sf_dir))
    return out.select("layout", "n_partitions", "rows", (F.col("num_files") <= F.col("n_partitions")).alias("files_within"))


def c20_layout_sizes(spark, sf_dir):
    """The measured sizes and file counts of the layouts, smallest first; no oracle, as they depend on the encoder."""
    out = layout.layout_report(spark, LAYOUTS, _layouts(spark, sf_dir))
    return out.select("layout", "n_partitions", "rows", "size_bytes", "num_files").orderBy("size_bytes", "layout", "n_partitions")


def s05_ddl_table(spark, sf_dir):
    """Typed DDL, partitioned and bucketed; rows appended by name from another column order, then read back."""
    path, table = shared_path(spark, "ddl"), f"matches_ddl_{uuid.uuid4().hex[:8]}"
    layout.create_bucketed_table(spark, table, "match_id BIGINT, completion_date DATE, mapid BIGINT, playlist_id STRING",
                                 "match_id", BUCKETS, path, "playlist_id")
    layout.append_by_name(fx.matches(spark, sf_dir).select("playlist_id", "mapid", "match_id", "completion_date"), table)
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    return spark.read.parquet(path).select("match_id", "completion_date", "mapid", "playlist_id")


def s06_period_table(spark, sf_dir):
    """A season-partitioned table; every season is written, the newest one twice."""
    path = shared_path(spark, "seasons")
    games = fx.games(spark, sf_dir)
    write_period(games, path, "season")
    write_period(games.where(F.col("season") == fx.last_year(spark, sf_dir)), path, "season")
    return spark.read.parquet(path).groupBy("season").agg(F.count(F.lit(1)).alias("games"), F.sum("home_team_id").cast("bigint").alias("home_sum"))


def bucketed_tables(spark, sf_dir, buckets=BUCKETS):
    """Names of the bucketed matches, details and medal tables, written once per application.

    The bucket count is the joins' parallelism: choose it by the size of the largest table, about
    1 GB a bucket; 16 is what the reference asks for."""
    def write(base):
        tag = base.rstrip("/").rsplit("/", 1)[-1]
        for name, source in (("matches", fx.matches), ("match_details", fx.match_details), ("medals_players", fx.medals_matches_players)):
            layout.write_bucketed(source(spark, sf_dir), f"{name}_b{tag}", "match_id", buckets, f"{base}/{name}")

    tag = layout.written_once(spark, "bucketed", (sf_dir, buckets), write).rstrip("/").rsplit("/", 1)[-1]
    return [f"{name}_b{tag}" for name in ("matches", "match_details", "medals_players")]


def j12_bucketed_match_fact(spark, sf_dir):
    """The match fact over tables bucketed on match_id: the joins on match_id read
    co-located buckets without an Exchange."""
    m, d, p = (spark.table(t) for t in bucketed_tables(spark, sf_dir))
    mm = mt.medal_map(p, fx.medals(spark, sf_dir), prepartition=False)
    return _flat(mt.match_fact(m, d, mm, fx.maps(spark, sf_dir)))


QUERIES = {
    "c17_medal_map": c17_medal_map,
    "c18_match_fact": c18_match_fact,
    "c19_avg_kills_per_player": c19_avg_kills_per_player,
    "c19_matches_per_playlist": c19_matches_per_playlist,
    "c19_matches_per_map": c19_matches_per_map,
    "c19_medal_per_map": c19_medal_per_map,
    "c20_layout_experiment": c20_layout_experiment,
    "c20_layout_sizes": c20_layout_sizes,
    "j12_bucketed_match_fact": j12_bucketed_match_fact,
    "s05_ddl_table": s05_ddl_table,
    "s06_period_table": s06_period_table,
}

_REPAIR = " ".join(f"WHEN name = '{n}' THEN '{i}'" for n, i in mt.MEDAL_ID_REPAIRS.items())

_FACT = f"""
WITH dm AS (
  SELECT name, fixed AS medal_id FROM (
    SELECT name, CASE {_REPAIR} ELSE medal_id END AS fixed,
           row_number() OVER (PARTITION BY name ORDER BY medal_id NULLS LAST) AS rn
    FROM medals WHERE name IS NOT NULL) WHERE rn = 1),
mc AS (
  SELECT mmp.match_id, mmp.player_gamertag, dm.name AS medal_name,
         CAST(sum(mmp.medal_count) AS BIGINT) AS medal_count
  FROM medals_matches_players mmp JOIN dm ON mmp.medal_id = dm.medal_id
  GROUP BY 1, 2, 3),
mm AS (
  SELECT match_id, player_gamertag,
         string_agg(medal_name || ':' || CAST(medal_count AS VARCHAR), ',' ORDER BY medal_name) AS medals
  FROM mc GROUP BY 1, 2),
fact AS (
  SELECT m.completion_date AS match_completion_date, m.match_id, md.player_gamertag, m.playlist_id,
         mp.name AS map_name, md.player_total_kills, mm.medals
  FROM matches m JOIN match_details md ON m.match_id = md.match_id
  LEFT JOIN mm ON mm.match_id = m.match_id AND mm.player_gamertag = md.player_gamertag
  JOIN maps mp ON m.mapid = mp.mapid)
"""

_VIEWS = ("medals", "medals_matches_players", "matches", "match_details", "maps")

ORACLE = {
    "c17_medal_map": with_views(_FACT + "SELECT * FROM mc", *_VIEWS),
    "c18_match_fact": with_views(_FACT + "SELECT * FROM fact", *_VIEWS),
    "j12_bucketed_match_fact": with_views(_FACT + "SELECT * FROM fact", *_VIEWS),
    "c19_avg_kills_per_player": with_views(_FACT + """
SELECT player_gamertag, sum(player_total_kills) / count(match_id) AS avg_kills
FROM fact GROUP BY player_gamertag""", *_VIEWS),
    "c19_matches_per_playlist": with_views(_FACT + """
SELECT playlist_id, count(DISTINCT match_id) AS matches FROM fact GROUP BY playlist_id""", *_VIEWS),
    "c19_matches_per_map": with_views(_FACT + """
SELECT map_name, count(DISTINCT match_id) AS matches FROM fact GROUP BY map_name""", *_VIEWS),
    "c19_medal_per_map": with_views(_FACT + f"""
SELECT f.map_name, CAST(sum(mc.medal_count) AS BIGINT) AS medals, count(*) AS rows_with_medal
FROM fact f JOIN mc ON mc.match_id = f.match_id AND mc.player_gamertag = f.player_gamertag
WHERE mc.medal_name = '{MEDAL_OF_INTEREST}'
GROUP BY f.map_name""", *_VIEWS),
}

ORACLE["c20_layout_experiment"] = with_views(_FACT + """
SELECT l.layout, l.n AS n_partitions, (SELECT count(*) FROM fact) AS rows, true AS files_within
FROM (VALUES """ + ", ".join(f"('{label}', {n})" for label, n, _ in LAYOUTS) + ") AS l(layout, n)", *_VIEWS)
ORACLE["s05_ddl_table"] = with_views("SELECT match_id, completion_date, mapid, playlist_id FROM matches", "matches")
ORACLE["s06_period_table"] = with_views(
    "SELECT season, count(*) AS games, CAST(sum(home_team_id) AS BIGINT) AS home_sum FROM games GROUP BY season", "games")
