"""Array helpers built from Spark higher-order functions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_array(element_type: str) -> Column:
    """Typed empty array."""
    return F.array().cast(f"array<{element_type}>")


def set_or_extend(arr: Column, pos: Column, value: Column, element_type: str = "bigint") -> Column:
    """``arr`` with 0-based ``pos`` set to ``value``; zero-padded when ``arr`` is shorter.

    Used for day-indexed metric arrays: setting the same day twice gives the
    same array (idempotent), and a day may be re-run after later days.
    """
    base = F.coalesce(arr, empty_array(element_type))
    n = F.size(base)
    replaced = F.transform(base, lambda x, i: F.when(i == pos, value).otherwise(x))
    padded = F.concat(base,
                      F.array_repeat(F.lit(0).cast(element_type), (pos - n).cast("int")),
                      F.array(value.cast(element_type)))
    return F.when(n > pos, replaced).otherwise(padded)


def dense_from_map(m: Column, length: Column, default=0, element_type: str = "bigint") -> Column:
    """Array of ``length`` slots where slot i is ``m[i]`` or ``default``."""
    return F.transform(F.sequence(F.lit(0), length - 1),
                       lambda i: F.coalesce(F.try_element_at(m, i), F.lit(default)).cast(element_type))


def join_text(arr: Column, sep: str = ",") -> Column:
    """Array rendered as text (for flat reports and oracle comparison)."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)
