"""Unit cases of the cumulation and the deduplication, with rows of our own."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import types as T

from tidemark.operators.cumulate import cumulate_actors_step
from tidemark.operators.dedup import dedup, drop_exact_duplicates


def test_cumulate_one_actor_year(spark):
    films = spark.createDataFrame(
        [("Mira Sol", "a7", "Night Ferry", 2003, 120, 7.5, "f30"), ("Mira Sol", "a7", "Paper Kites", 2003, 15, 5.5, "f10"),
         ("Mira Sol", "a7", "Low Tide", 2003, 900, 8.0, "f20"), ("Mira Sol", "a7", "Salt Road", 2005, 40, 9.0, "f40")],
        "actor string, actorid string, film string, year int, votes int, rating double, filmid string")
    first = cumulate_actors_step(None, films, 2003)
    one, = first.collect()
    assert (one.actor, one.actorid, one.is_active, one.current_year) == ("Mira Sol", "a7", True, 2003)
    assert one.quality_class == "average"  # the mean of 7.5, 5.5 and 8.0 is exactly 7
    assert [(f.filmid, f.rating) for f in one.films] == [("f10", 5.5), ("f20", 8.0), ("f30", 7.5)]

    # a year without films: inactive, class and films kept
    idle = cumulate_actors_step(first, films, 2004)
    two, = idle.collect()
    assert (two.is_active, two.quality_class, two.current_year, two.films) == (False, "average", 2004, one.films)

    # back again: the class comes from the new year alone
    three, = cumulate_actors_step(idle, films, 2005).collect()
    assert (three.is_active, three.quality_class, [f.filmid for f in three.films]) == (True, "star", ["f10", "f20", "f30", "f40"])


def test_dedup_game_details(spark):
    schema = T.StructType([
        T.StructField("game_id", T.LongType()), T.StructField("team_id", T.LongType()),
        T.StructField("player_id", T.LongType()), T.StructField("player_name", T.StringType()),
        T.StructField("start_position", T.StringType()), T.StructField("pts", T.DoubleType())])
    guard, bench, other = (7, 1, 70, "Ada Lund", "G", 11.0), (7, 1, 71, "Bo Ek", None, 2.5), (8, 1, 70, "Ada Lund", "G", 11.0)
    df = spark.createDataFrame([guard, bench, guard, other, bench, guard], schema)
    for out in (dedup(df, ["game_id", "team_id", "player_id"], [F_desc("game_id")]),
                drop_exact_duplicates(df)):
        assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted([guard, bench, other], key=repr)
        assert out.schema == schema


def F_desc(c):
    from pyspark.sql import functions as F
    return F.desc(c)


def test_dedup_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([Row(k=1, t=5, v="b"), Row(k=1, t=5, v="a"), Row(k=2, t=1, v=None)])
    out = {r.k: r.v for r in dedup(df, ["k"], [F_desc("t")]).collect()}
    assert out == {1: "a", 2: None}
