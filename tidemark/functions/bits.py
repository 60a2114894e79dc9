"""32-day activity bit histories.

Bit ``31 - k`` is set when the entity was active ``k`` days before the
as-of date (k = 0..31), so the as-of day is the most significant bit of the
32-bit word.  Values are held in a bigint.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_DAYS = 32
# Fixed value: mask of the seven most recent days (bits 31..25) = 0xFE000000.
WEEK_MASK = 4261412864


def _one_shifted(n: Column) -> Column:
    """``1L << n`` for a column shift (``F.shiftleft`` takes only a literal)."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int"))


def datelist_to_bits(dates: Column, as_of: Column) -> Column:
    """OR of ``1 << (31 - (as_of - d))`` over dates within 0..31 days of ``as_of``.

    ``aggregate`` over the array replaces the reference's cross join with a
    date series: no row multiplication, and OR makes repeated dates harmless.
    """
    recent = F.filter(dates, lambda d: F.datediff(as_of, d).between(0, WINDOW_DAYS - 1))
    return F.aggregate(recent, F.lit(0).cast("bigint"),
                       lambda acc, d: acc.bitwiseOR(_one_shifted((WINDOW_DAYS - 1) - F.datediff(as_of, d))))


def day_bit(day: Column, as_of: Column) -> Column:
    """Bit of one date as a bigint (0 outside the window): for ``bit_or`` aggregation."""
    k = F.datediff(as_of, day)
    return F.when(k.between(0, WINDOW_DAYS - 1),
                  _one_shifted((WINDOW_DAYS - 1) - k)).otherwise(F.lit(0).cast("bigint"))


def days_active(bits: Column) -> Column:
    return F.bit_count(bits).cast("int")


def active_in_mask(bits: Column, mask: int) -> Column:
    return bits.bitwiseAND(F.lit(mask).cast("bigint")) != 0
