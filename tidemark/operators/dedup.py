"""C1 dedup and C2 duplicate report.

``dedup`` keeps one row per grain using ``row_number`` over a *total*
order (the grain keys plus the caller's order plus every remaining column
as tie-break), so the pick is deterministic.  Catalyst turns the
``row_number() = 1`` filter into a WindowGroupLimit, which drops losers
before the full sort.  The shuffle is one hash exchange on the grain keys;
a hot key only ever meets its own duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence = (),
          tie_break_all: bool = True) -> DataFrame:
    """One row per ``keys``: the first by ``order_by``.

    ``order_by`` takes column names (ascending) or Columns (``F.desc(...)``).
    With ``tie_break_all`` the remaining columns are appended ascending so
    exact ties resolve the same way on every run (D9).
    """
    order = [_as_col(c) for c in order_by]
    if tie_break_all:
        named = {c if isinstance(c, str) else None for c in order_by}
        orderable = {f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()}
        order += [F.col(c).asc_nulls_first() for c in df.columns
                  if c not in keys and c not in named and c in orderable]
    if not order:
        # only key columns: duplicates are identical rows
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed (the reference's dedup test case).

    A hash aggregate on all columns: partial aggregation removes copies on
    the map side before the shuffle."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their row count (GROUP BY ... HAVING)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))
