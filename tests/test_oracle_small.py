"""Every registered query with an oracle, against DuckDB at sf0.001."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as ent
from tidemark.plans import all_oracles, all_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def _render(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("key", sorted(all_oracles()))
def test_query_matches_oracle(spark, con, key):
    sdf = all_queries()[key](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted("|".join(_render(r[c]) for c in cols) for r in sdf.collect())
    rel = con.sql(all_oracles()[key])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted("|".join(_render(r[i]) for i in idx) for r in rel.fetchall())
    assert got == exp


def test_every_oracle_has_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() >= 0
    assert "start_year" in df.columns
