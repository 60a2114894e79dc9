"""Operators of a training-data pipeline.  Nothing else in the library imports
this subpackage; ``registry()`` gathers its queries and oracle texts."""

from __future__ import annotations

import importlib
import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODULES = (
    "quality_fm",
    "line_winnow",
    "simhash_grid",
    "decontaminate",
    "substring_dedup",
    "runlength_index",
    "spot_signatures",
    "url_templates",
    "page_template",
    "pattern_packing",
    "collocations",
    "whitening",
    "source_mixing",
)


def registry():
    """(queries, oracle SQL) of every module."""
    queries, oracle = {}, {}
    for name in MODULES:
        mod = importlib.import_module(f"tidemark.llm.{name}")
        queries.update(mod.QUERIES)
        oracle.update(mod.ORACLE)
    return queries, oracle
