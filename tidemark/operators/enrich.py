"""Enrichment joins: J14 as-of (last known) rate, Q7 FX conversion with a
freeze gate, J15 IP-range lookup.

Neither is a join Spark has as a primitive; both are reduced to equi joins
so no nested-loop join and no per-key hot window is planned:

* as-of: the last known rate is resolved on the *rate side* over the set of
  (ccy, day) keys the facts need (bounded by currencies x calendar days);
  the facts then take it by an equi join on (ccy, day);
  ``join_asof_rate_in_row`` does without: one row per currency holds its rates day by day in
  an array, and each fact picks its entry;
* IP ranges: each range is split into the /16 prefixes it covers, the join
  is equi on the prefix with a range residual.  ``ip_most_specific`` takes ranges that nest
  and overlap: they are cut into aligned blocks of a few sizes, each kept under its own
  prefix length, and an address looks its prefixes up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ip import ipv4_to_long
from tidemark.functions.sizing import MAX_BROADCAST_BYTES, fits, small_by_bytes, small_side, tasks_for, written


def asof_rates(rates: DataFrame, keys_needed: DataFrame, key: str = "ccy", day: str = "day",
               rate_day: str = "rate_date", rate: str = "rate") -> DataFrame:
    """(key, day) -> last known (rate_day, rate) on or before ``day``.

    ``keys_needed`` holds the (key, day) pairs to resolve (distinct).  The
    window runs per currency over days only (rates plus needed days), which
    is bounded by the calendar, not by the fact volume."""
    r = rates.select(F.col(key), F.col(rate_day).alias(day),
                     F.struct(F.col(rate_day).alias("rate_day"), F.col(rate).alias("rate")).alias("_r"))
    need = keys_needed.select(key, day).distinct().select(key, day, F.lit(None).alias("_r"))
    both = r.unionByName(need.withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType)))
    both = (both.groupBy(key, day)
                .agg(F.max("_r").alias("_r")))   # one row per (key, day): the day's own rate if any
    w = (Window.partitionBy(key).orderBy(day)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return both.select(key, day, F.last("_r", ignorenulls=True).over(w).alias("_r")) \
               .select(key, day, F.col("_r.rate_day").alias(rate_day), F.col("_r.rate").alias(rate))


def join_asof_rate(facts: DataFrame, rates: DataFrame, key: str = "ccy", day: str = "day") -> DataFrame:
    """Facts with the last known rate for their (key, day); NULL when none yet."""
    table = asof_rates(rates, facts.select(key, day), key, day)
    return facts.join(table, [key, day], "left")


def rate_arrays(rates: DataFrame, key: str = "ccy", rate_day: str = "rate_date", rate: str = "rate") -> DataFrame:
    """key, first_day, known: per key one struct (rate_day, rate) for every day from the key's first
    to its last rate, the last known one on each day.  An array is as long as the calendar."""
    one = rates.where(F.col(rate_day).isNotNull()).groupBy(key, F.col(rate_day).alias("rate_day")).agg(F.max(rate).alias("rate"))
    after = F.lead("rate_day").over(Window.partitionBy(key).orderBy("rate_day"))
    held = one.withColumn("_days", F.coalesce(F.datediff(after, "rate_day"), F.lit(1)))  # days until the next rate
    runs = held.groupBy(key).agg(F.min("rate_day").alias("first_day"), F.array_sort(F.collect_list(F.struct("rate_day", "rate", "_days"))).alias("_runs"))
    entry = lambda r: F.array_repeat(F.struct(r["rate_day"].alias("rate_day"), r["rate"].alias("rate")), r["_days"])
    return runs.select(key, "first_day", F.flatten(F.transform("_runs", entry)).alias("known"))


def join_asof_rate_in_row(facts: DataFrame, rates: DataFrame, key: str = "ccy", day: str = "day", rate_day: str = "rate_date",
                          rate: str = "rate", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Facts with the last known rate for their (key, day), like ``join_asof_rate``, without a shuffle of the facts.

    The arrays of all keys are written once to the shared folder and their size is
    checked; up to ``max_bytes`` they are broadcast and each fact takes the entry of its day
    (days after the last rate take the last one, days before the first none).  Beyond,
    the facts are joined by (key, day)."""
    arrays = small_by_bytes(rate_arrays(rates, key, rate_day, rate), max_bytes, "rate_arrays")
    if arrays is None:
        table = asof_rates(rates, facts.select(key, day), key, day, rate_day, rate)
        return facts.join(table, [key, day], "left")
    at = F.least(F.datediff(day, "first_day"), F.size("known") - 1)
    found = F.when(F.col(day).isNotNull() & (at >= 0), F.get("known", at))  # least() passes over a NULL day
    joined = facts.join(F.broadcast(arrays), key, "left").withColumn("_r", found)
    return joined.select(*facts.columns, F.col("_r.rate_day").alias(rate_day), F.col("_r.rate").alias(rate))


def convert_fx(facts: DataFrame, rates: DataFrame, amount: str, key: str = "ccy",
               day: str = "day") -> DataFrame:
    """Q7: amount x rate, with a status per row: ``converted`` (rate of that day),
    ``carried`` (last earlier rate, e.g. weekends) or ``frozen`` (no rate yet:
    held back, amount NULL)."""
    j = join_asof_rate_in_row(facts, rates, key, day)
    status = (F.when(F.col("rate").isNull(), F.lit("frozen"))
               .when(F.col("rate_date") == F.col(day), F.lit("converted"))
               .otherwise(F.lit("carried")))
    return j.withColumn("fx_status", status) \
            .withColumn("converted_cents",
                        F.round(F.col(amount) * F.col("rate") * 100).cast("bigint"))


# ---------------------------------------------------------------- J15

def ip_range_join(facts: DataFrame, ip_col: str, ranges: DataFrame, start: str = "ip_start",
                  end: str = "ip_end", prefix_bits: int = 16, max_range_rows: int = 5_000_000) -> DataFrame:
    """Left-join each fact to the range holding its IP (ranges must not overlap).

    Ranges are exploded into the ``/prefix_bits`` blocks they touch; the join
    is equi on (block) plus ``start <= ip <= end``.  The exploded range table
    is broadcast when its row count is under ``max_range_rows``."""
    shift = 32 - prefix_bits
    blocks = ranges.withColumn(
        "_blk", F.explode(F.sequence(F.shiftright(F.col(start), shift), F.shiftright(F.col(end), shift))))
    f = facts.withColumn("_ip", ipv4_to_long(F.col(ip_col))) \
             .withColumn("_blk", F.shiftright(F.col("_ip"), shift))
    b = small_side(blocks, max_range_rows).alias("r")
    cond = ((f["_blk"] == F.col("r._blk")) &
            (F.col("r." + start) <= f["_ip"]) & (f["_ip"] <= F.col("r." + end)))
    out = f.alias("f").join(b, cond, "left")
    keep = [F.col(f"f.{c}") for c in facts.columns]
    extra = [F.col(f"r.{c}") for c in ranges.columns if c not in (start, end)]
    return out.select(*keep, *extra)


#: Bits of a prefix length step: blocks hold 1, 16, 256, ... addresses.
STEP_BITS = 4
ADDRESS_BITS = 32
#: Blocks of 2**16 addresses and more number 69,905 at most: they are always broadcast.
COARSE_BITS = 16
#: Ranges that one task cuts into blocks, and block look-ups of one task.
RANGES_A_TASK, LOOKUPS_A_TASK = 10_000, 500_000


def range_blocks(ranges: DataFrame, start: str = "ip_start", end: str = "ip_end") -> DataFrame:
    """``ranges`` cut into the largest aligned blocks of 16**k addresses that fit: adds ``_bits``
    (address bits of the block) and ``_block`` (its prefix).

    A size gives a range at most 15 blocks on each side of those of the next size,
    so a range has at most 30 * 8 blocks, however wide it is."""
    parts, inner = [], None  # inner: what the blocks of the next larger size cover
    none = F.array().cast("array<bigint>")
    for bits in range(ADDRESS_BITS, -1, -STEP_BITS):
        first, last = F.shiftright(F.col(start) + ((1 << bits) - 1), bits), F.shiftright(F.col(end) + 1, bits)  # blocks [first, last)
        blocks = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(none)
        found = blocks(first, last)
        if inner is not None:
            left, right = (F.shiftleft(c, STEP_BITS) for c in inner)
            found = F.when(inner[0] < inner[1], F.concat(blocks(first, left), blocks(right, last))).otherwise(found)
        inner = (first, last)
        parts.append(F.transform(found, lambda b: F.struct(F.lit(bits).alias("_bits"), b.alias("_block"))))  # noqa: B023
    valid = ranges.where((F.col(start) <= F.col(end)) & (F.col(start) >= 0) & (F.col(end) < 1 << ADDRESS_BITS))
    return valid.withColumn("_cells", F.flatten(F.array(*parts))).select("*", F.inline("_cells")).drop("_cells")


def ip_most_specific(facts: DataFrame, ip_col: str, ranges: DataFrame, start: str = "ip_start", end: str = "ip_end",
                     max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Left-join each fact to the narrowest range that holds its address; ranges may nest and overlap
    (equally narrow ones: the larger start wins, then the larger columns).

    Blocks are kept once per (prefix length, prefix) with their narrowest range and written.  If they are
    small (checked by bytes) each prefix length is a broadcast equi-join and the facts stay where
    they are.  Beyond, only the coarse lengths are; the distinct addresses look the finer ones up by
    one shuffled equi-join on (length, prefix), where a prefix stands for at most 4,096 addresses, and the
    facts are joined by address."""
    spark = facts.sparkSession
    extra = [c for c in ranges.columns if c not in (start, end)]
    rank = F.struct((F.col(start) - F.col(end)).alias("narrow"), F.col(start).alias("start"), *[F.col(c) for c in extra])
    dealt = ranges.repartition(tasks_for(spark, ranges.count(), RANGES_A_TASK))
    cells = written(range_blocks(dealt, start, end).groupBy("_bits", "_block").agg(F.max(rank).alias("_range")), "ip_blocks")
    number = ipv4_to_long(F.col(ip_col))
    shifted = lambda ip, bits: F.shiftrightunsigned(ip, bits)
    j, found, near = facts.withColumn("_ip", number), [], cells
    if not fits(cells, max_bytes):
        near, fine = cells.where(F.col("_bits") >= COARSE_BITS), cells.where(F.col("_bits") < COARSE_BITS)
        sizes = range(0, COARSE_BITS, STEP_BITS)
        n = tasks_for(spark, fine.count() + len(sizes) * facts.count(), LOOKUPS_A_TASK)
        asked = facts.select(number.alias("_ip")).where("_ip IS NOT NULL").distinct().withColumn("_bits", F.explode(F.array(*[F.lit(b) for b in sizes])))
        asked = asked.withColumn("_block", F.expr("shiftrightunsigned(_ip, _bits)")).repartition(n, "_bits", "_block")
        best = asked.join(fine.repartition(n, "_bits", "_block").hint("merge"), ["_bits", "_block"]).groupBy("_ip").agg(F.max("_range").alias("_fine"))
        j, found = j.join(best.hint("merge"), "_ip", "left"), [F.col("_fine")]
    for bits in sorted(r["_bits"] for r in near.select("_bits").distinct().collect()):  # at most 9
        side = near.where(F.col("_bits") == bits).select(F.col("_block").alias(f"_b{bits}"), F.col("_range").alias(f"_r{bits}"))
        j = j.join(F.broadcast(side), shifted(F.col("_ip"), bits) == F.col(f"_b{bits}"), "left")
        found.append(F.col(f"_r{bits}"))
    if not found:
        return facts.select("*", *[F.lit(None).cast(ranges.schema[c].dataType).alias(c) for c in extra])
    best = F.greatest(*found) if len(found) > 1 else found[0]
    return j.withColumn("_best", best).select(*facts.columns, *[F.col(f"_best.{c}").alias(c) for c in extra])
