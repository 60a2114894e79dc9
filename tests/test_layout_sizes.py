from __future__ import annotations

from tidemark.plans import all_queries
from tidemark.plans.match_plans import LAYOUTS


def test_layout_sizes_leave_the_query(spark, sf_small):
    got = all_queries()["c20_layout_sizes"](spark, sf_small).collect()
    assert sorted((r["layout"], r["n_partitions"]) for r in got) == sorted((label, n) for label, n, _ in LAYOUTS)
    assert [r["size_bytes"] for r in got] == sorted(r["size_bytes"] for r in got)
    n = all_queries()["c18_match_fact"](spark, sf_small).count()
    for r in got:
        assert r["rows"] == n and r["size_bytes"] > 0 and 1 <= r["num_files"] <= r["n_partitions"]
