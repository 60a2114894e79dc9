"""Shared helpers of the operators: written intermediate tables, row identity
and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor recomputes nothing that was written) and
    keeps a costly result from being computed twice.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*columns: str) -> Column:
    """64-bit identity of a row by the given columns; rows that repeat share it."""
    return F.xxhash64(*columns)


def packed_rows(docs: DataFrame) -> DataFrame:
    """_row (all columns as a struct, so none can clash), _k (row identity), _d (doc_id)."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), row_key("doc_id", "text").alias("_k"), F.col("doc_id").alias("_d"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b: long): root
    is the component's smallest node.

    Alternates the large-star and small-star steps.  Each step is one
    map-side combined minimum and one join on the node; the edge list never
    grows, nothing is collected but two sums per round.  An edge list without
    rows gives no rows; self edges give their node.
    """
    now = staged(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(now.where("a = b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(spark, moved.union(lowest.select("a", F.col("m").alias("b"))), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    # every edge now joins a node to its root
    return now.union(now.select(F.col("b").alias("a"), "b")).select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
