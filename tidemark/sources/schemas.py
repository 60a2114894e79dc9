"""Typed schemas of the output tables (S4) and their key checks.

Spark has no primary keys; the key is kept as a checked invariant
(``duplicate_keys`` must be empty) and the schema is compared by name and
type, ignoring nullability.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

FILM = StructType([StructField("year", IntegerType()), StructField("film", StringType()),
                   StructField("votes", IntegerType()), StructField("rating", DoubleType()),
                   StructField("filmid", StringType())])

ACTORS = StructType([
    StructField("actor", StringType()), StructField("actorid", StringType()),
    StructField("films", ArrayType(FILM)), StructField("quality_class", StringType()),
    StructField("is_active", BooleanType()), StructField("current_year", IntegerType())])
ACTORS_KEY = ("actorid", "current_year")

ACTORS_HISTORY_SCD = StructType([
    StructField("actorid", StringType()), StructField("actor", StringType()),
    StructField("quality_class", StringType()), StructField("is_active", BooleanType()),
    StructField("current_year", IntegerType()), StructField("start_year", IntegerType()),
    StructField("end_year", IntegerType())])
ACTORS_HISTORY_SCD_KEY = ("actorid", "start_year")

USER_DEVICES_CUMULATED = StructType([
    StructField("user_id", StringType()), StructField("browser_type", StringType()),
    StructField("device_activity_datelist", ArrayType(DateType())), StructField("date", DateType())])
USER_DEVICES_CUMULATED_KEY = ("user_id", "browser_type", "date")

HOSTS_CUMULATED = StructType([
    StructField("host", StringType()), StructField("host_activity_datelist", ArrayType(DateType())),
    StructField("date", DateType())])
HOSTS_CUMULATED_KEY = ("host", "date")

HOST_ACTIVITY_REDUCED = StructType([
    StructField("host", StringType()), StructField("month_start", DateType()),
    StructField("hits_array", ArrayType(LongType())),
    StructField("unique_visitors_array", ArrayType(LongType()))])
HOST_ACTIVITY_REDUCED_KEY = ("host", "month_start")

PLAYERS_GROWTH_ACCOUNTING = StructType([
    StructField("player_name", StringType()), StructField("first_active_season", IntegerType()),
    StructField("last_active_season", IntegerType()), StructField("season_active_state", StringType()),
    StructField("list_seasons_active", ArrayType(IntegerType())), StructField("current_season", IntegerType())])
PLAYERS_GROWTH_ACCOUNTING_KEY = ("player_name", "current_season")


def _strip(dt):
    """Data type with nullability removed, for comparison."""
    if isinstance(dt, StructType):
        return tuple((f.name, _strip(f.dataType)) for f in dt.fields)
    if isinstance(dt, ArrayType):
        return ("array", _strip(dt.elementType))
    return dt.simpleString()


def schema_matches(df: DataFrame, schema: StructType) -> bool:
    return _strip(df.select(*schema.fieldNames()).schema) == _strip(schema) and \
        set(df.columns) == set(schema.fieldNames())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row (empty when the key holds)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def key_report(name: str, df: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """One row about a table: whether its columns are the schema's, its rows, the key values that more
    than one row holds, and the rows with a NULL in the key.  One shuffle, on the key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    has_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"), F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
                       F.coalesce(F.sum(F.when(has_null, F.col("_n"))), F.lit(0)).cast("bigint").alias("null_keys")) \
                  .select(F.lit(name).alias("table_name"), F.lit(schema_matches(df, schema)).alias("schema_ok"), "rows", "duplicate_keys", "null_keys")
