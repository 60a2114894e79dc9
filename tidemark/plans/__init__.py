"""Query registry: every implemented operator as ``(spark, sf_dir) -> DataFrame``
plus, where SQL can express it, the DuckDB oracle text of the same result."""

from __future__ import annotations

import importlib

MODULES = (
    "dedup_plans",
    "snapshot_plans",
    "pattern_plans",
    "match_plans",
    "session_plans",
    "enrich_plans",
    "experiment_plans",
    "quality_plans",
)


def _collect():
    queries, oracle = {}, {}
    for name in MODULES:
        mod = importlib.import_module(f"tidemark.plans.{name}")
        for k, fn in mod.QUERIES.items():
            if k in queries:
                raise ValueError(f"duplicate query key {k}")
            queries[k] = fn
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def all_queries():
    return _collect()[0]


def all_oracles():
    return _collect()[1]
