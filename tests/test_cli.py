"""The command-line entry lists queries and writes a query's result."""

from __future__ import annotations

import os
import tempfile

from tidemark.__main__ import main


def test_cli_list_and_run(spark, sf_small, capsys):
    assert main(["list"]) == 0
    assert "c04_scd2_backfill" in capsys.readouterr().out.split()
    out = os.path.join(tempfile.mkdtemp(prefix="tidemark-cli-"), "r")
    assert main(["run", "c02_duplicate_report", "--sf", sf_small, "--out", out]) == 0
    assert spark.read.parquet(out).count() > 0
    assert main(["run", "no_such_query", "--sf", sf_small, "--out", out]) == 2
