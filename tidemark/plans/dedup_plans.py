"""Queries for C1 (dedup) and C2 (duplicate report)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup, duplicate_report
from tidemark.plans.oracle_views import with_views
from tidemark.sources import fixtures as fx
from tidemark.sources.tables import load

LINEITEM_GRAIN = ["l_orderkey", "l_linenumber"]


def lineitem_order():
    return [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def c01_dedup_lineitem(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return dedup(li, LINEITEM_GRAIN, lineitem_order())


def c01_dedup_game_details(spark, sf_dir):
    """Latest game per (game, team, player), as in the reference's dedup,
    with the remaining columns as tie-break (D9).  The game date comes with
    the details (their derivation already joins games)."""
    joined = fx.game_details(spark, sf_dir, with_game_date=True)
    return dedup(joined, ["game_id", "team_id", "player_id"],
                 [F.desc("game_date_est")])


def c02_duplicate_report(spark, sf_dir):
    gd = fx.game_details(spark, sf_dir)
    return duplicate_report(gd, ["game_id", "team_id", "player_id"])


QUERIES = {
    "c01_dedup_lineitem": c01_dedup_lineitem,
    "c01_dedup_game_details": c01_dedup_game_details,
    "c02_duplicate_report": c02_duplicate_report,
}

GAME_DETAILS_DEDUP_SQL = """
        SELECT * EXCLUDE (rn) FROM (
          SELECT gd.game_id, gd.team_id, gd.player_id, gd.player_name, gd.start_position, gd.pts,
                 g.game_date_est,
                 row_number() OVER (PARTITION BY gd.game_id, gd.team_id, gd.player_id
                    ORDER BY g.game_date_est DESC, gd.player_name NULLS FIRST,
                             gd.start_position NULLS FIRST, gd.pts NULLS FIRST) AS rn
          FROM game_details gd JOIN games g ON gd.game_id = g.game_id) WHERE rn = 1"""

ORACLE = {
    "c01_dedup_lineitem": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                      l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST,
                      l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
          FROM lineitem) WHERE rn = 1""",
    "c01_dedup_game_details": with_views(GAME_DETAILS_DEDUP_SQL, "game_details", "games"),
    "c02_duplicate_report": with_views("""
        SELECT game_id, team_id, player_id, count(*) AS n_rows
        FROM game_details GROUP BY game_id, team_id, player_id HAVING count(*) > 1""",
        "game_details"),
}
