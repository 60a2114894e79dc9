"""IPv4 text <-> number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ipv4_to_long(ip: Column) -> Column:
    """'a.b.c.d' -> a*2^24 + b*2^16 + c*2^8 + d (NULL for malformed text)."""
    parts = F.split(ip, r"\.")
    octet = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("bigint")
    value = octet(1) * 16777216 + octet(2) * 65536 + octet(3) * 256 + octet(4)
    return F.when(F.size(parts) == 4, value)


def long_to_ipv4(n: Column) -> Column:
    return F.concat_ws(".", *[(F.floor(n / (256 ** k)) % 256).cast("string") for k in (3, 2, 1, 0)])
