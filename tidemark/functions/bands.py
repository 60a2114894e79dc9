"""Labels computed from values (searched CASE, P3/P4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quality bands of an actor-year by mean rating.
# star: > 8; good: > 7 and <= 8; average: > 6 and <= 7; bad: <= 6.
QUALITY_BANDS = (("star", 8.0), ("good", 7.0), ("average", 6.0))
QUALITY_FLOOR = "bad"


def quality_class(mean_rating: Column) -> Column:
    """Band of a mean rating; NULL mean gives NULL."""
    expr = None
    for label, lower in QUALITY_BANDS:
        cond = mean_rating > F.lit(lower)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(mean_rating <= F.lit(QUALITY_BANDS[-1][1]), F.lit(QUALITY_FLOOR))


def label_by_contains(value: Column, labels: list[tuple[str, str]], fallback: str) -> Column:
    """First label whose pattern occurs in ``value`` (LIKE '%p%'), else ``fallback``."""
    expr = None
    for pattern, label in labels:
        cond = value.contains(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(fallback) if expr is None else expr.otherwise(F.lit(fallback))
