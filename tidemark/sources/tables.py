"""Scans of the base tables (S1, S2) and temp-view registration (S3).

Scans are lazy: Catalyst prunes columns and pushes filters into the
Parquet reader, so callers should select/filter directly on the result.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one base table (the default source)."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header row.  With a schema the columns are typed and no
    inference pass runs; without one every column is a string, as the
    header-only read gives."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return spark.table(name)


def register(df: DataFrame, name: str) -> DataFrame:
    """S3: create-or-replace temp view (idempotent, unlike createTempView)."""
    df.createOrReplaceTempView(name)
    return df
