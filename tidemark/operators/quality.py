"""Data-quality checks and table upkeep (Q1-Q6, Q10-Q23).

The reference describes these in prose only; formulas are our own and are
stated per function.  Each check is one or two aggregate passes; results
are small report frames (one row per rule / day / key).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.sizing import small_side
from tidemark.operators.intervals import MICROS_PER_MINUTE, calendar, split_spans
from tidemark.operators.running import running_max


# ---------------------------------------------------------------- Q1, Q2

def schema_contract(df: DataFrame, contract: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """Q1: compare ``df`` with a contract of (column, type, nullable).

    One row per contract column and per unexpected column: status ``ok`` /
    ``retyped`` / ``missing`` / ``unexpected``, and ``violations`` = rows that
    break the contract (NULL in a non-nullable column, or a value that does
    not cast to the contract type), counted in one pass over the data."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    checks, meta = [], []
    for name, typ, nullable in contract:
        if name not in actual:
            meta.append((name, typ, None, "missing"))
            checks.append(F.lit(None).cast("bigint"))
            continue
        bad = F.lit(False) if nullable else F.col(name).isNull()
        if actual[name] != typ:
            bad = bad | (F.col(name).isNotNull() & F.col(name).try_cast(typ).isNull())
        meta.append((name, typ, actual[name], "ok" if actual[name] == typ else "retyped"))
        checks.append(F.count_if(bad))
    known = {c[0] for c in contract}
    for name, typ in actual.items():
        if name not in known:
            meta.append((name, None, typ, "unexpected"))
            checks.append(F.lit(None).cast("bigint"))
    counts = df.agg(*[c.alias(f"_c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(n).cast("string").alias("column_name"),
                              F.lit(t).cast("string").alias("expected_type"),
                              F.lit(a).cast("string").alias("actual_type"),
                              F.lit(s).alias("status"),
                              F.col(f"_c{i}").cast("bigint").alias("violations"))
                     for i, (n, t, a, s) in enumerate(meta)])
    return counts.select(F.inline(rows))


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Q2: for each named rule (a condition rows must meet), rows failing it and
    total rows, in one aggregate pass.  A NULL condition counts as failing."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"_r{i}") for i, c in enumerate(rules.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("failed_rows"),
                              F.col("_n").alias("total_rows"))
                     for i, name in enumerate(rules)])
    return agg.select(F.inline(rows))


# ---------------------------------------------------------------- Q3, Q4, Q5

def volume_anomaly(df: DataFrame, day: Column, lookback: int = 7, tol: float = 0.5) -> DataFrame:
    """Q3: daily row count against the mean of the previous ``lookback`` calendar
    days; anomaly when it differs by more than ``tol`` of the baseline.  A day
    without rows, between the first and the last, counts 0.

    The window runs over the calendar (one row per day), not over rows."""
    daily = df.where(day.isNotNull()).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    span = daily.agg(F.min("day").alias("a"), F.max("day").alias("b")).where(F.col("a").isNotNull())
    full = span.select(F.explode(F.sequence("a", "b")).alias("day")).join(daily, "day", "left").fillna(0, ["n"])
    w = Window.orderBy("day").rowsBetween(-lookback, -1)
    return (full.withColumn("baseline", F.avg("n").over(w))
                .withColumn("is_anomaly", F.abs(F.col("n") - F.col("baseline")) > F.col("baseline") * tol))


def missing_business_days(df: DataFrame, key: str, day: str) -> DataFrame:
    """Q4: (key, day) weekdays between a key's first and last day with no row."""
    span = df.groupBy(key).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    cal = (span.select(key, F.explode(F.sequence("_a", "_b")).alias(day))
               .where(F.weekday(F.col(day)) < 5))
    return cal.join(df.select(key, day).distinct(), [key, day], "left_anti") \
              .select(key, F.col(day).alias("missing_day"))


def snapshot_or_fallback(daily: DataFrame, key: str, day: str, value: str, end) -> DataFrame:
    """Q5: a row per key and day from its first day to ``end`` (a key that starts
    later has none); a missing day carries the last earlier value forward, flagged ``is_provisional``."""
    until = F.lit(end).cast("date")
    w = Window.partitionBy(key).orderBy(day)
    # every known value (and a key's first day, known or not) holds until the next one: no grid, no join
    known = daily.where(F.col(day) <= until).select(key, day, value, (F.row_number().over(w) == 1).alias("_first")) \
                 .where(F.col(value).isNotNull() | F.col("_first"))
    g = known.withColumn("_until", F.coalesce(F.date_sub(F.lead(day).over(w), 1), until)) \
             .select(key, F.col(day).alias("_source"), value, F.explode(F.sequence(day, "_until")).alias(day))
    return g.select(key, day, value, F.when(F.col(value).isNotNull(), F.col("_source")).alias("source_day"),
                    (F.col(value).isNull() | (F.col("_source") != F.col(day))).alias("is_provisional"))


# ---------------------------------------------------------------- Q10-Q12

#: At this share no more than a hundred sources a day are flagged.
BROADCAST_SHARE = 0.01


def _source_shares(df: DataFrame, day: Column, source: str, share: float) -> DataFrame:
    """_day, source, _n, _bot: does the source (NULL is one) hold more than ``share`` of the day?"""
    per = df.groupBy(day.alias("_day"), F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    return per.withColumn("_bot", F.col("_n") / F.sum("_n").over(Window.partitionBy("_day")) > share)


def drop_dominant_sources(df: DataFrame, day: Column, source: str, share: float) -> DataFrame:
    """Q10 report: per day, sources holding more than ``share`` of the day's rows
    are treated as bot/QA traffic; rows, dropped, kept, sources dropped (named ones).

    Everything follows from one (day, source) count; no row is joined."""
    per = _source_shares(df, day, source, share)
    return (per.groupBy(F.col("_day").alias("day"))
               .agg(F.sum("_n").alias("rows"),
                    F.sum(F.when(F.col("_bot"), F.col("_n")).otherwise(0)).alias("dropped"),
                    F.sum(F.when(F.col("_bot"), 0).otherwise(F.col("_n"))).alias("kept"),
                    F.count_if(F.col("_bot") & F.col("_source").isNotNull()).alias("sources_dropped")))


def filter_dominant_sources(df: DataFrame, day: Column, source: str, share: float) -> DataFrame:
    """Q10: the rows of ``df`` without the dominant sources of their day.

    At most 1 / share sources a day can be dominant.  From ``BROADCAST_SHARE`` on the flagged
    side is broadcast and the rows are not shuffled; below, the planner chooses by measured size."""
    bots = _source_shares(df, day, source, share).where("_bot").select("_day", "_source")
    rows = df.withColumn("_at", day)
    same = rows["_at"].eqNullSafe(bots["_day"]) & rows[source].eqNullSafe(bots["_source"])
    return rows.join(F.broadcast(bots) if share >= BROADCAST_SHARE else bots, same, "left_anti").drop("_at")


def stitch_identity(events: DataFrame, user: str, device: str, ts: str) -> DataFrame:
    """Q11: anonymous rows (NULL user) take the latest user seen on their device
    (max_by over authenticated rows: a partial aggregate, so a busy device
    is not one task).  Only the anonymous rows are joined, reduced to one per
    (day, device).  Per day: distinct users before and after stitching."""
    day = F.to_date(F.col(ts)).alias("day")
    known = events.where(F.col(user).isNotNull())
    links = known.groupBy(device).agg(F.max_by(F.col(user), F.struct(F.col(ts), F.col(user))).alias("_linked"))
    anonymous = events.where(F.col(user).isNull()).groupBy(day, device).agg(F.count(F.lit(1)).alias("_n"))
    blank = anonymous.join(links, device, "left").select(
        "day", F.lit(None).alias("_user"), F.col("_linked").alias("_after"), "_n", F.when(F.col("_linked").isNotNull(), F.col("_n")).otherwise(0).alias("_m"))
    named = known.select(day, F.col(user).alias("_user"), F.col(user).alias("_after")).distinct().select("*", F.lit(0).alias("_n"), F.lit(0).alias("_m"))
    return (named.unionByName(blank).groupBy("day")
                 .agg(F.countDistinct("_user").alias("users_before"), F.countDistinct("_after").alias("users_after"),
                      F.sum("_n").cast("bigint").alias("anonymous_rows"), F.sum("_m").cast("bigint").alias("stitched_rows")))


def map_events(df: DataFrame, col: str, mapping: DataFrame, target: str) -> DataFrame:
    """Q12: rows per ``col`` value with its mapped ``target`` (NULL = unmapped,
    reported rather than dropped).  The mapping is a checked broadcast."""
    m = small_side(mapping)
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
              .join(m, col, "left")
              .select(col, target, "n_rows"))


# ---------------------------------------------------------------- Q13, Q14

def business_day(ts_ntz: Column, tz: str, roll_weekend: bool = False) -> Column:
    """Q13: local date of a UTC wall-clock timestamp in ``tz`` (DST aware); with
    ``roll_weekend`` a Saturday or Sunday moves to Monday."""
    local = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts_ntz))
    if not roll_weekend:
        return local
    ahead = F.when(F.weekday(local) == 5, 2).when(F.weekday(local) == 6, 1).otherwise(0)  # Monday = 0
    return F.date_add(local, ahead)


def active_users(days: DataFrame, windows: Mapping[str, int], start, end) -> DataFrame:
    """Q14: per day in [start, end], distinct users active in the trailing
    window of each length (e.g. dau=1, wau=7, mau=30).

    A user active on day a, next active on day b, counts for days
    [a, min(a + n - 1, b - 1)]; these spans never overlap, so the count per
    day is a running sum of +1/-1 span edges over the calendar: no per-day
    re-scan and no distinct over a moving window."""
    w = Window.partitionBy("user_id").orderBy("day")
    d = days.select("user_id", "day").distinct().withColumn("_next", F.lead("day").over(w))
    cols = []
    for name, n in windows.items():
        stop = F.least(F.date_add("day", n), F.coalesce("_next", F.date_add("day", n)))
        cols.append(F.struct(F.lit(name).alias("m"), F.col("day").alias("d"), F.lit(1).alias("v")))
        cols.append(F.struct(F.lit(name).alias("m"), stop.alias("d"), F.lit(-1).alias("v")))
    edges = d.select(F.inline(F.array(*cols)))
    deltas = edges.groupBy("d").pivot("m", list(windows)).agg(F.sum("v"))
    cal = (F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
    calendar = deltas.sparkSession.range(1).select(F.explode(cal).alias("d"))
    wc = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    # calendar is one row per day; the running sum spans the calendar only
    full = (calendar.join(deltas, "d", "full_outer").fillna(0, list(windows))
                    .select("d", *[F.sum(F.col(m)).over(wc).cast("bigint").alias(m) for m in windows]))
    return full.where(F.col("d").between(F.lit(start).cast("date"), F.lit(end).cast("date"))) \
               .withColumnRenamed("d", "day")


# ---------------------------------------------------------------- Q15

def kpi_daily(orders: DataFrame, sessions: DataFrame) -> DataFrame:
    """Q15: profit, growth and engagement per day, for every day from the first to the last of
    either source: orders, revenue, COGS, refunds and profit in cents, new customers (by first
    order), sessions started, active users, time in sessions and minutes per active user (NULL without one).

    ``orders``: customer, day, revenue, cogs, refund per order; ``sessions``: user_id,
    session_start, session_end.  Sessions are cut at midnight, so each day gets its own
    part of a long one.  Orders, first orders, session parts and the users of a day
    become records of one shape, and one aggregate by day sums them: no join, and no
    source's missing day loses another's."""
    names = ["orders", "revenue_cents", "cogs_cents", "refund_cents", "new_customers", "sessions", "active_users", "session_us"]

    def records(df: DataFrame, **found: Column) -> DataFrame:
        return df.select("day", *[found.get(n, F.lit(0)).cast("bigint").alias(n) for n in names])

    parts = split_spans(sessions, "session_start", "session_end", "day", "day")
    per_user = parts.groupBy("user_id", "day").agg(F.sum("part_us").alias("us"), F.count_if("is_first").alias("started"))
    first = orders.groupBy("customer").agg(F.min("day").alias("day"))
    all_ = [records(orders, orders=F.lit(1), revenue_cents=F.col("revenue"), cogs_cents=F.col("cogs"), refund_cents=F.col("refund")),
            records(first, new_customers=F.lit(1)),
            records(per_user, sessions=F.col("started"), active_users=F.lit(1), session_us=F.col("us"))]
    per_day = reduce(DataFrame.unionByName, all_).where(F.col("day").isNotNull()).groupBy("day").agg(*[F.sum(n).alias(n) for n in names])
    full = per_day.unionByName(records(calendar(per_day))).groupBy("day").agg(*[F.sum(n).cast("bigint").alias(n) for n in names])
    return (full.withColumn("profit_cents", F.col("revenue_cents") - F.col("cogs_cents") - F.col("refund_cents"))
                .withColumn("minutes_per_user", F.try_divide(F.col("session_us") / MICROS_PER_MINUTE, F.col("active_users"))))


# ---------------------------------------------------------------- Q17, Q19, Q20

def run_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Q17: keys whose value moved between two runs (present in either run)."""
    o, n = old.select(*keys, F.col(value).alias("old_value")), new.select(*keys, F.col(value).alias("new_value"))
    j = o.join(n, list(keys), "full_outer")
    return (j.withColumn("delta", F.coalesce("new_value", F.lit(0)) - F.coalesce("old_value", F.lit(0)))
             .where(~F.col("old_value").eqNullSafe(F.col("new_value"))))


def attribute_last_touch(events: DataFrame, user: str, ts: str, tie: str, is_touch: Column,
                         is_conversion: Column, within_seconds: int) -> DataFrame:
    """Q19: each conversion is credited to the user's latest touch at or before
    it, if that touch is at most ``within_seconds`` old.

    "Latest touch so far" is a running max of (ts, id) over the user's rows
    (split by day), not a join of every conversion with every touch."""
    e = (events.where(F.col(user).isNotNull())
               .select(user, ts, tie, is_touch.alias("_touch"), is_conversion.alias("_conv"))
               .withColumn("_day", F.to_date(F.col(ts))))
    touch = F.when(F.col("_touch"), F.struct(F.col(ts).alias("t"), F.col(tie).alias("id")))
    r = running_max(e, [user], "_day", [ts, tie], touch, "_last")
    conv = r.where(F.col("_conv"))
    ok = (F.col("_last").isNotNull() &
          (F.col("_last.t") >= F.col(ts) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(within_seconds))))
    return (conv.groupBy(F.col("_day").alias("day"))
                .agg(F.count(F.lit(1)).alias("conversions"), F.count_if(ok).alias("attributed"))
                .withColumn("attributed_share", F.col("attributed") / F.col("conversions")))


def double_count(df: DataFrame, key: str, day: Column, user: str) -> DataFrame:
    """Q20: per key, the sum of daily distinct users against the distinct users
    of the whole period; the difference is the double count."""
    days = df.where(F.col(user).isNotNull()).select(key, day.alias("_day"), F.col(user).alias("_user")).distinct()
    per_user = days.groupBy(key, "_user").agg(F.count(F.lit(1)).alias("_days"))
    return (per_user.groupBy(key).agg(F.sum("_days").cast("bigint").alias("sum_daily_uniques"), F.count(F.lit(1)).alias("distinct_users"))
                    .withColumn("overcount", F.col("sum_daily_uniques") - F.col("distinct_users")))


# ---------------------------------------------------------------- Q21-Q23

def round_money(amount: Column, rate: str, scale: int = 2) -> tuple[Column, Column]:
    """Q21: ``amount x rate`` as a decimal, rounded half-up and half-even."""
    x = amount.cast("decimal(18,2)") * F.lit(rate).cast("decimal(6,4)")
    return F.round(x, scale), F.bround(x, scale)


def with_fiscal(df: DataFrame, day: str, start_month: int = 2) -> DataFrame:
    """Q22: ``df`` with the fiscal year and quarter of ``day``, for a fiscal year starting in
    ``start_month`` (named by the calendar year it ends in)."""
    shifted = F.add_months(F.col(day), 13 - start_month)
    return df.withColumn("fiscal_year", F.year(shifted)).withColumn("fiscal_quarter", F.quarter(shifted))


def fiscal_calendar(days: DataFrame, day: str, start_month: int = 2) -> DataFrame:
    """Q22: calendar rows (day, fiscal_year, fiscal_quarter) of the given days."""
    return with_fiscal(days.select(day).distinct(), day, start_month)


def period_complete(df: DataFrame, day: Column) -> DataFrame:
    """Q23: per month, days with data against days in the month; publishable
    only when complete."""
    d = df.select(day.alias("_d")).distinct()
    return (d.groupBy(F.trunc("_d", "MM").alias("month_start"))
             .agg(F.count(F.lit(1)).alias("days_seen"))
             .withColumn("days_expected", F.dayofmonth(F.last_day("month_start")).cast("bigint"))
             .withColumn("is_complete", F.col("days_seen") == F.col("days_expected")))


# ---------------------------------------------------------------- Q18

def orphan_keys(a: DataFrame, a_key: str, b: DataFrame, b_key: str, a_label: str, b_label: str) -> DataFrame:
    """Q18: keys of ``a`` missing from ``b`` and keys of ``b`` missing from ``a``.

    Both distinct key sets come out hash-partitioned on the key, so the full
    outer join between them adds no shuffle; one pass counts both sides."""
    ka = a.select(F.col(a_key).alias("_k")).distinct().withColumn("_in_a", F.lit(True))
    kb = b.select(F.col(b_key).alias("_k")).distinct().withColumn("_in_b", F.lit(True))
    j = ka.join(kb, "_k", "full_outer")
    counts = j.agg(F.count_if(F.col("_in_b").isNull()).alias("_a"), F.count_if(F.col("_in_a").isNull()).alias("_b"))
    return counts.select(F.inline(F.array(
        F.struct(F.lit(a_label).alias("check"), F.col("_a").alias("orphan_keys")),
        F.struct(F.lit(b_label).alias("check"), F.col("_b").alias("orphan_keys")))))
