"""Derived input views (the reference's source tables) built from the base tables.

Each builder is a lazy DataFrame over the Parquet scans, so column pruning
and filter pushdown reach the files.  The DuckDB text of the same views
lives in ``tidemark.plans.oracle_views``; the two must stay in step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ip import long_to_ipv4
from tidemark.functions.sizing import tasks_for
from tidemark.sources.tables import load


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """actor s, actorid s, film s, year int, votes int, rating double, filmid s."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select(F.col("c_name").alias("actor"),
                    F.col("o_custkey").cast("string").alias("actorid"),
                    F.concat(F.lit("film-"), F.col("o_orderkey").cast("string")).alias("film"),
                    F.year("o_orderdate").cast("int").alias("year"),
                    (F.col("o_orderkey") % 1000).cast("int").alias("votes"),
                    F.floor(F.col("o_totalprice") / 50000).cast("double").alias("rating"),
                    F.col("o_orderkey").cast("string").alias("filmid")))


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id (NULL when event_id % 20 = 0), device_id (NULL when event_id % 11 = 0), host, subhost, ip,
    event_time (timestamp_ntz, wall clock as stored), event_type."""
    return web_events_from(load(spark, sf_dir, "events"))


def web_events_from(events: DataFrame) -> DataFrame:
    """The web_events projection of an events frame (batch or stream)."""
    e = events.select("event_id", "ts", "user_id", "event_type", "props")
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 20 == 0, F.lit(None).cast("long"))
         .otherwise(F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 11 != 0, (_k() % 16).cast("int")).alias("device_id"),
        F.concat(F.col("event_type"), F.lit(".example.com")).alias("host"),
        F.concat((F.col("user_id") % 25).cast("string"), F.lit("."), F.col("event_type")).alias("subhost"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 2).cast("string")).alias("ip"),
        F.col("ts").alias("event_time"),
        "event_type",
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """device_id int, browser_type s: one row per distinct device."""
    return (web_events(spark, sf_dir).select("device_id").where(F.col("device_id").isNotNull())
            .distinct()
            .select("device_id",
                    F.concat(F.lit("browser-"), (F.col("device_id") % 4).cast("string")).alias("browser_type")))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    home = (F.col("o_custkey") % 25)
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").cast("int").alias("season"),
        home.cast("long").alias("home_team_id"),
        ((home + 1 + F.col("o_orderkey") % 24) % 25).cast("long").alias("visitor_team_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1))
         .when(F.col("o_orderstatus") == "O", F.lit(0))
         .when(F.col("o_orderkey") % 10 == 0, F.lit(None).cast("int"))
         .otherwise((F.col("o_orderkey") % 2).cast("int")).cast("int").alias("home_team_wins"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """team_id, nickname; n_nationkey < 5 appear twice (duplicates on purpose)."""
    n = load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("team_id"), F.col("n_name").alias("nickname"))
    return n.unionByName(n.where(F.col("team_id") < 5))


def game_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for a shuffle of the lines by game; the count reads the files' footers only."""
    return tasks_for(spark, load(spark, sf_dir, "lineitem").count())


def game_details(spark: SparkSession, sf_dir: str, with_game_date: bool = False) -> DataFrame:
    """game_details; with ``with_game_date`` also the game's date, taken from the
    same join with games that derives the teams (no second join with games).

    Lines and games are dealt by game into as many tasks as the lines need (``game_tasks``); what
    groups by game afterwards runs in the same tasks."""
    n = game_tasks(spark, sf_dir)
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber",
                                                "l_linestatus", "l_quantity").repartition(n, "l_orderkey")
    g = games(spark, sf_dir).select("game_id", "home_team_id", "visitor_team_id", "game_date_est").repartition(n, "game_id")
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = (li.join(g, li.l_orderkey == g.game_id, "inner")
           .join(s, li.l_suppkey == s.s_suppkey, "inner"))
    return j.select(
        F.col("game_id"),
        F.when(F.col("l_linenumber") % 2 == 1, F.col("visitor_team_id"))
         .otherwise(F.col("home_team_id")).alias("team_id"),
        F.col("l_suppkey").alias("player_id"),
        F.col("s_name").alias("player_name"),
        F.col("l_linestatus").alias("start_position"),
        F.when(F.col("l_quantity") > 45, F.lit(None).cast("int"))
         .otherwise((F.col("l_quantity") % 25).cast("int")).alias("pts"),
        *([F.col("game_date_est")] if with_game_date else []),
    )


def last_year(spark: SparkSession, sf_dir: str) -> int:
    """The newest order year of the data: the last actor-film year and season."""
    return load(spark, sf_dir, "orders").agg(F.max(F.year("o_orderdate"))).first()[0]


def event_days(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """The first and the last (as-of) day of the events."""
    day = F.to_date("ts")
    return tuple(load(spark, sf_dir, "events").agg(F.min(day), F.max(day)).first())


def last_year_of(spark: SparkSession, sf_dir: str) -> Column:
    """``last_year`` as a scalar subquery: computed inside the plan that uses it."""
    return load(spark, sf_dir, "orders").agg(F.max(F.year("o_orderdate"))).scalar()


def event_span(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    """``event_days`` as scalar subqueries."""
    day, events = F.to_date("ts"), load(spark, sf_dir, "events")
    return events.agg(F.min(day)).scalar(), events.agg(F.max(day)).scalar()


def players(spark: SparkSession, sf_dir: str, last_season: int | Column | None = None) -> DataFrame:
    """player_name, current_season, is_active: every season from a customer's
    first order up to ``last_season`` (default: the data's newest); active
    when it ordered that year."""
    last_season = last_year_of(spark, sf_dir) if last_season is None else last_season
    o = load(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("int").alias("y"))
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    seasons = (o.groupBy("o_custkey")
                .agg(F.min("y").alias("first_y"),
                     F.collect_set("y").alias("active_years"))
                .where(F.col("first_y") <= last_season)
                .select("o_custkey", "active_years",
                        F.explode(F.sequence(F.col("first_y"), F.lit(last_season))).alias("current_season")))
    return (seasons.join(c, seasons.o_custkey == c.c_custkey, "inner")
            .select(F.col("c_name").alias("player_name"),
                    F.col("current_season").cast("int").alias("current_season"),
                    F.array_contains("active_years", F.col("current_season")).alias("is_active")))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return o.select(F.col("o_orderkey").alias("match_id"),
                    F.to_date("o_orderdate").alias("completion_date"),
                    (F.col("o_custkey") % 25).cast("long").alias("mapid"),
                    F.col("o_orderpriority").alias("playlist_id"))


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per match and player; each match also has a host player (a negative
    tag) without kills, who never wins a medal."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    played = (li.groupBy(F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("player_gamertag"))
                .agg(F.sum("l_quantity").cast("long").alias("player_total_kills")))
    hosts = o.select(F.col("o_orderkey").alias("match_id"), (-F.col("o_custkey") - 1).alias("player_gamertag"),
                     F.lit(0).cast("long").alias("player_total_kills"))
    return played.unionByName(hosts)


# Brand -> (medal name, id that players' rows carry): the two repaired medals.
REPAIRED_BRANDS = {"Brand#3": ("Team Takedown", "2896365521"), "Brand#5": ("Perfect Kill", "1080468863")}
NAMELESS_BRAND = "Brand#9"


def _medal_id() -> Column:
    out = F.col("p_brand")
    for brand, (_, medal_id) in REPAIRED_BRANDS.items():
        out = F.when(F.col("p_brand") == brand, F.lit(medal_id)).otherwise(out)
    return out


def medals_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey, "inner")
              .select(F.col("l_orderkey").alias("match_id"),
                      F.col("l_suppkey").alias("player_gamertag"),
                      _medal_id().alias("medal_id"),
                      F.col("l_linenumber").cast("long").alias("medal_count")))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part: many duplicate (medal_id, name) rows.  Two brands carry the
    names whose ids are repaired (their raw id is wrong), one has no name."""
    p = load(spark, sf_dir, "part").select("p_brand")
    name = F.col("p_brand")
    for brand, (medal, _) in REPAIRED_BRANDS.items():
        name = F.when(F.col("p_brand") == brand, F.lit(medal)).otherwise(name)
    return p.select(F.col("p_brand").alias("medal_id"), F.when(F.col("p_brand") != NAMELESS_BRAND, name).alias("name"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("mapid"), F.col("n_name").alias("name"))


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ccy, rate_date, rate: Monday-Friday only (weekends missing by construction)."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    d = F.to_date("o_orderdate")
    return (o.where(F.weekday(d) < 5)
             .groupBy(F.col("o_orderpriority").alias("ccy"), d.alias("rate_date"))
             .agg((F.sum(F.col("o_orderkey") % 100) + 100).cast("double").alias("rate")))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, day: one row per customer order day (duplicates kept)."""
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    return o.select(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day"))


# Fixed value: first address of the synthetic client block (10.0.0.0).
IP_BASE = 167772160
IP_RANGE_SIZE = 600000


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ip_start, ip_end, country, region_key: one address range per nation;
    ranges are deliberately not aligned to /16 blocks."""
    n = load(spark, sf_dir, "nation")
    start = F.lit(IP_BASE).cast("bigint") + F.col("n_nationkey").cast("bigint") * IP_RANGE_SIZE
    return n.select(start.alias("ip_start"), (start + (IP_RANGE_SIZE - 1)).alias("ip_end"),
                    F.col("n_name").alias("country"), F.col("n_regionkey").cast("int").alias("region_key"))


def nested_ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ip_start, ip_end, network, level: ranges that nest and overlap, none aligned: one over
    everything (level 0), one per nation (1), per customer a network of 1 to 4,000 addresses
    (2) and per supplier one that straddles its neighbours (3)."""
    base = F.lit(IP_BASE).cast("bigint")
    n = load(spark, sf_dir, "nation").select((base + F.col("n_nationkey") * IP_RANGE_SIZE).alias("ip_start"), F.lit(IP_RANGE_SIZE).cast("bigint").alias("_n"),
                                             F.col("n_name").alias("network"), F.lit(1).alias("level"))
    c = load(spark, sf_dir, "customer").select((base + F.col("c_custkey") * 10007 % 16000000).alias("ip_start"), (F.col("c_custkey") % 4000 + 1).alias("_n"),
                                               F.col("c_name").alias("network"), F.lit(2).alias("level"))
    s = load(spark, sf_dir, "supplier").select((base + F.col("s_suppkey") * 40009 % 16000000).alias("ip_start"), (F.col("s_suppkey") % 3 * 30000 + 700).alias("_n"),
                                               F.col("s_name").alias("network"), F.lit(3).alias("level"))
    top = load(spark, sf_dir, "region").where("r_regionkey = 0").select(F.lit(0).cast("bigint").alias("ip_start"), F.lit(1 << 32).cast("bigint").alias("_n"),
                                                                        F.col("r_name").alias("network"), F.lit(0).alias("level"))
    both = n.unionByName(c).unionByName(s).unionByName(top)
    return both.select("ip_start", (F.col("ip_start") + F.col("_n") - 1).alias("ip_end"), "network", "level")


def client_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ip (text): a client address per event spread over 10.0.0.0/8;
    addresses past the last nation range have no location."""
    e = load(spark, sf_dir, "events").select("event_id", "user_id")
    num = F.lit(IP_BASE).cast("bigint") + (F.col("event_id") * 7919 +
                                           F.coalesce(F.col("user_id"), F.lit(0)) * 104729) % 16777216
    return e.select("event_id", long_to_ipv4(num).alias("ip"))
