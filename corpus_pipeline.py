"""The corpus pipeline: ``run`` applies STAGES to ``documents`` in order.

Each stage takes (spark, docs, sf_dir), calls one operator of ``tidemark.llm``
and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, line_winnow, pattern_packing, quality_fm, simhash_grid
from tidemark.llm.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_fm.keep_good(docs, quality_fm.train(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs, and of single lines of a few words, go from the texts."""
    return line_winnow.dedup_lines(docs, single_words=line_winnow.SINGLE_WORDS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash_grid.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.drop(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return pattern_packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: The classifier and the tokeniser have no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
