"""Analytical patterns: C11 grouping-set roll-up, C12 top-k, C13 rolling
n-game wins, C14 longest streak.

C13 and C14 need the order of games within a team/player.  They are built
on ``running_totals`` (per-day window partitions + day-level offsets)
rather than one window partition per team, so a team or player holding a
large share of the rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup
from tidemark.operators.running import running_totals

# The labels of a missing name and a missing season.
OVERALL = "OVERALL"
UNKNOWN_SEASON = 9999


# ---------------------------------------------------------------- C11

def winners(games: DataFrame) -> DataFrame:
    """game_id, season, won_team_id (NULL when the result is unknown)."""
    return games.select(
        "game_id", "season",
        F.when(F.col("home_team_wins") == 1, F.col("home_team_id"))
         .when(F.col("home_team_wins") == 0, F.col("visitor_team_id")).alias("won_team_id"))


ROLLUP_SETS = (("player_name", "team_name"), ("player_name", "season"), ("team_name",))


def game_rollup(details: DataFrame, games: DataFrame, teams: DataFrame, sets=ROLLUP_SETS) -> DataFrame:
    """Points and wins by GROUPING SETS (player, team), (player, season), (team);
    ``sets`` limits the work to the groupings that are asked for.

    wins = distinct games won (D23); ``grouping_set`` = grouping_id over
    (player_name, team_name, season) tells subtotal rows from real values (D24).

    The details are summed per (game, team, player) first, on the map side: what is joined with
    the games and multiplied by the sets are those sums.  A sum's win flag counts once
    per set and game in a second level (set, game), so no set of game ids is
    built, and names and seasons that are missing are labelled only at the end."""
    part = details.groupBy("game_id", "team_id", "player_name").agg(F.sum(F.coalesce("pts", F.lit(0))).alias("_pts"))
    named = teams.groupBy("team_id").agg(F.min("nickname").alias("_team"))  # one row a team
    won = F.col("won_team_id").eqNullSafe(F.col("team_id"))
    facts = part.join(winners(games), "game_id").join(named, "team_id").select(
        "game_id", F.coalesce("player_name", F.lit(OVERALL)).alias("player_name"), F.coalesce("_team", F.lit(OVERALL)).alias("team_name"),
        F.coalesce("season", F.lit(UNKNOWN_SEASON)).alias("season"), "_pts", won.cast("int").alias("_won"))
    columns = ("player_name", "team_name", "season")

    def member(names: Sequence[str]) -> Column:
        rolled = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in names)
        return F.struct(*[F.when(F.lit(c in names), F.col(c)).alias(c) for c in columns], F.lit(rolled).cast("bigint").alias("grouping_set"))

    spread = facts.select("game_id", "_pts", "_won", F.explode(F.array(*[member(s) for s in sets])).alias("_set"))
    per_game = spread.groupBy("_set", "game_id").agg(F.sum("_pts").alias("_pts"), F.max("_won").alias("_won"))
    total = per_game.groupBy("_set").agg(F.sum("_pts").cast("bigint").alias("total_points"), F.sum("_won").cast("bigint").alias("total_wins"))
    return total.select("_set.player_name", "_set.team_name", "_set.season", "total_points", "total_wins", "_set.grouping_set")


# grouping_id bits (player_name, team_name, season): 1 = rolled up
SET_PLAYER_TEAM = 1     # season rolled up
SET_PLAYER_SEASON = 2   # team rolled up
SET_TEAM = 5            # player and season rolled up


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """ORDER BY ... LIMIT k with a total order (plans as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


# ---------------------------------------------------------------- C13

def team_games(games: DataFrame) -> DataFrame:
    """Each game as two team rows: team_id, game_date_est, game_id, is_win.
    Unknown results count as no win for either side (D26)."""
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team_id"),
                 F.coalesce((F.col("home_team_wins") == 1).cast("int"), F.lit(0)).alias("is_win")),
        F.struct(F.col("visitor_team_id").alias("team_id"),
                 F.coalesce((F.col("home_team_wins") == 0).cast("int"), F.lit(0)).alias("is_win")))
    return (games.select("game_id", "game_date_est", F.inline(sides)))


def rolling_wins(games: DataFrame, n: int = 90) -> DataFrame:
    """Per team: games played and the most wins in any n-game stretch
    (frame current row .. n-1 following, ordered by date then game id).

    The frame sum is a difference of prefix sums: wins(i..j) = W(j) - W(i-1),
    with j = min(i + n - 1, games of the team).  Each row emits itself twice:
    as a frame start (key i, W(i-1)) and as a frame end (key j - n + 1, W(j));
    one aggregate on (team, key) pairs them, so the running totals are
    computed once and no key is hot.  Starts with no end row are the team's
    last n-1 frames, which end at the team total.
    """
    tg = team_games(games)
    r = running_totals(tg, ["team_id"], "game_date_est", ["game_id"],
                       {"ordinal": F.lit(1).cast("bigint"), "cum_wins": F.col("is_win").cast("bigint")},
                       totals=True)
    roles = F.array(
        F.struct(F.col("ordinal").alias("k"), (F.col("cum_wins") - F.col("is_win")).alias("before"),
                 F.lit(None).cast("bigint").alias("upto")),
        F.struct((F.col("ordinal") - (n - 1)).alias("k"), F.lit(None).cast("bigint").alias("before"),
                 F.col("cum_wins").alias("upto")))
    e = r.select("team_id", "ordinal_total", "cum_wins_total", F.inline(roles))
    frames = (e.groupBy("team_id", "k")
               .agg(F.max("before").alias("before"), F.max("upto").alias("upto"),
                    F.max("ordinal_total").alias("games"), F.max("cum_wins_total").alias("wins"))
               .where(F.col("before").isNotNull()))
    return (frames.groupBy("team_id")
                  .agg(F.max("games").alias("total_number_games"),
                       F.max(F.coalesce(F.col("upto"), F.col("wins")) - F.col("before"))
                        .alias(f"max_{n}_game_wins")))


def rank_teams(best: DataFrame, teams: DataFrame, metric: str, top: int = 5) -> DataFrame:
    """Name teams (deduplicated, D25), dense-rank by ``metric`` and keep rank <= top.

    The rank is a global window over one row per team: its size is the
    number of teams, not of games."""
    td = dedup(teams, ["team_id"], ["nickname"])
    named = best.join(td, "team_id", "inner")
    w = Window.orderBy(F.desc(metric))
    return (named.withColumn("ranking", F.dense_rank().over(w).cast("bigint"))
                 .where(F.col("ranking") <= top))


# ---------------------------------------------------------------- C14

def longest_streak(df: DataFrame, key: str, bucket: str, order: Sequence[str],
                   predicate: Column, skip_null: Column | None = None,
                   out: str = "longest_streak") -> DataFrame:
    """Per key: longest run of consecutive rows (in (bucket, *order) order)
    where ``predicate`` holds; 0 when it never holds (D28).

    Rows where ``skip_null`` is NULL are left out first, so they neither
    break nor extend a run.  Islands: for rows where the predicate holds,
    (position among all rows) - (position among matching rows) is constant
    along a run.
    """
    rows = df if skip_null is None else df.where(skip_null.isNotNull())
    rows = rows.withColumn("_hit", F.coalesce(predicate, F.lit(False)))
    r = running_totals(rows, [key], bucket, order,
                       {"_pos": F.lit(1).cast("bigint"), "_pos_hit": F.col("_hit").cast("bigint")})
    # one group per run of hits (plus one per key holding its misses, summing to 0)
    runs = (r.groupBy(key, F.when(F.col("_hit"), F.col("_pos") - F.col("_pos_hit")).alias("_island"))
             .agg(F.sum(F.col("_hit").cast("bigint")).alias("_len")))
    return runs.groupBy(key).agg(F.max("_len").cast("bigint").alias(out))
