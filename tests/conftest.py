from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="tidemark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def rows(df, *order):
    """Collected rows as sorted tuples (order-insensitive compare)."""
    cols = list(order) or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
