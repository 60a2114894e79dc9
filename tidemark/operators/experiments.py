"""Experiment and KPI metrics.

The reference names these metrics in prose only; the formulas here are our
own, stated in each docstring.  All are aggregates, joins and windows over
per-user (or per user-day) data; windows never span more than one user's
calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.intervals import MICROS_PER_MINUTE, calendar, open_per_day, split_spans, unite
from tidemark.operators.running import next_in_order


# ---------------------------------------------------------------- E1

def cell_of(user: Column, salt: str, n_cells: int = 2) -> Column:
    """Deterministic test cell: first 32 bits of md5(salt || '|' || user) modulo n_cells
    (md5 exists in Spark and in SQL engines, so any engine can re-derive it)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(salt + "|"), user.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return (h % n_cells).cast("int")


def assign_cells(users: DataFrame, user_col: str, salt: str, n_cells: int = 2) -> DataFrame:
    return users.select(user_col).distinct().withColumn("cell", cell_of(F.col(user_col), salt, n_cells))


# ---------------------------------------------------------------- E2, E3

def active_days(events: DataFrame, user: str, ts: str) -> DataFrame:
    """Distinct (user, day) of activity; NULL users dropped."""
    return (events.where(F.col(user).isNotNull())
                  .select(F.col(user).alias("user_id"), F.to_date(F.col(ts)).alias("day")).distinct())


def retention(days: DataFrame, offsets: Sequence[int] = (1, 7, 28), anchors: DataFrame | None = None) -> DataFrame:
    """Per cohort day: cohort size and users active exactly N days later, for
    each N.  The cohort starts at the user's first active day, or at the days
    in ``anchors`` (user_id, cohort_day: returns, upgrades, ...; a user may have several)."""
    first = days.groupBy("user_id").agg(F.min("day").alias("cohort_day")) if anchors is None else anchors.select("user_id", "cohort_day").distinct()
    j = days.join(first, "user_id", "inner").withColumn("_off", F.datediff("day", "cohort_day"))
    per_user = j.groupBy("user_id", "cohort_day").agg(
        *[F.max((F.col("_off") == n).cast("int")).alias(f"d{n}") for n in offsets])
    return per_user.groupBy("cohort_day").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[F.sum(f"d{n}").cast("bigint").alias(f"retained_d{n}") for n in offsets])


def return_days(days: DataFrame, idle: int = 7) -> DataFrame:
    """Anchors of E2: (user_id, cohort_day) of each active day after more than ``idle`` idle days."""
    return _gaps(days).where(F.col("gap") > idle).select("user_id", F.col("day").alias("cohort_day"))


def churn_by_cell(days: DataFrame, cells: DataFrame, idle: int, as_of=None) -> DataFrame:
    """Per cell, users with any activity and those of them without any in the
    last ``idle`` days up to ``as_of`` (default: the newest day)."""
    if as_of is None:
        as_of = days.agg(F.max("day")).scalar()
    last = days.groupBy("user_id").agg(F.max("day").alias("_last"))
    gone = F.datediff(F.lit(as_of).cast("date"), F.col("_last")) > idle
    return (cells.join(last, "user_id", "inner").groupBy("cell")
                 .agg(F.count(F.lit(1)).alias("users"), F.count_if(gone).alias("churned"))
                 .withColumn("churn_rate", F.try_divide("churned", "users")))


def longest_daily_streak(days: DataFrame, min_run: int = 7) -> DataFrame:
    """Per user the longest run of consecutive active days and whether it
    reaches ``min_run`` (streak survival)."""
    w = Window.partitionBy("user_id").orderBy("day")
    isl = days.withColumn("_isl", F.date_sub(F.col("day"), F.row_number().over(w).cast("int")))
    runs = isl.groupBy("user_id", "_isl").agg(F.count(F.lit(1)).alias("_len"))
    return (runs.groupBy("user_id").agg(F.max("_len").alias("longest_streak_days"))
                .withColumn("survived", F.col("longest_streak_days") >= min_run))


def daily_runs(days: DataFrame) -> DataFrame:
    """user_id, run_start, run_end, run_days of each run of consecutive active days (days: distinct user_id, day)."""
    w = Window.partitionBy("user_id").orderBy("day")
    numbered = days.select("user_id", "day", F.date_sub("day", F.row_number().over(w)).alias("_island"))
    return numbered.groupBy("user_id", "_island").agg(
        F.min("day").alias("run_start"), F.max("day").alias("run_end"), F.count(F.lit(1)).alias("run_days")).drop("_island")


def streak_resumption(days: DataFrame, min_run: int = 2, within: int = 7) -> DataFrame:
    """Per month in which runs of at least ``min_run`` days ended, how many were resumed.

    Each run is linked to the user's next one (of any length).  A run that reaches
    the newest day of the data is still open.  The others are broken; a broken run is
    resumed when the next one starts after at most ``within`` idle days, and
    censored when it is not but the data end before those days are over: it is
    in no rate.  resumption_rate = resumed / (broken - censored), NULL without such a run;
    avg_idle_days is the mean of the resumed ones."""
    w = Window.partitionBy("user_id").orderBy("run_start")
    linked = daily_runs(days).withColumn("_next", F.lead("run_start").over(w)).where(F.col("run_days") >= min_run)
    last = days.agg(F.max("day")).scalar()
    idle = F.datediff("_next", "run_end") - 1
    is_open = F.col("run_end") >= last
    resumed = F.coalesce(idle <= within, F.lit(False))
    censored = ~is_open & ~resumed & F.col("_next").isNull() & (F.datediff(last, "run_end") <= within)
    marked = linked.select(F.trunc("run_end", "MM").alias("end_month"), is_open.alias("_open"), resumed.alias("_resumed"),
                           censored.alias("_censored"), F.when(resumed, idle).alias("_idle"))
    return (marked.groupBy("end_month")
                  .agg(F.count(F.lit(1)).alias("runs"), F.count_if("_open").alias("open_runs"), F.count_if(~F.col("_open")).alias("broken_runs"),
                       F.count_if("_censored").alias("censored_runs"), F.count_if("_resumed").alias("resumed_runs"),
                       F.avg("_idle").alias("avg_idle_days"))
                  .withColumn("resumption_rate", F.try_divide("resumed_runs", F.col("broken_runs") - F.col("censored_runs"))))


# ---------------------------------------------------------------- E4, E5

def feature_usage(events: DataFrame, user: str, ts: str, feature: Column) -> DataFrame:
    """Per day: DAU, users of the feature, share, events per active user."""
    e = events.where(F.col(user).isNotNull()).withColumn("day", F.to_date(F.col(ts)))
    return (e.groupBy("day")
             .agg(F.countDistinct(user).alias("dau"),
                  F.countDistinct(F.when(feature, F.col(user))).alias("feature_users"),
                  F.count(F.lit(1)).alias("events"))
             .withColumn("feature_share", F.col("feature_users") / F.col("dau"))
             .withColumn("events_per_user", F.col("events") / F.col("dau")))


def revisit_rate(events: DataFrame, user: str, item: str, ts: str, tie: str, days: int = 7) -> DataFrame:
    """E5: per day: visits, visits followed by another visit to the same item by
    the same user within ``days`` days, and the rate."""
    e = (events.where(F.col(user).isNotNull() & F.col(item).isNotNull())
               .select(user, item, ts, tie).withColumn("day", F.to_date(F.col(ts))))
    n = next_in_order(e, [user, item], "day", ts, tie, "_next")
    within = F.col("_next").isNotNull() & (F.col("_next") <= F.col(ts) + F.expr(f"INTERVAL {days} DAYS"))
    return (n.groupBy("day")
             .agg(F.count(F.lit(1)).alias("visits"), F.count_if(within).alias("revisits"))
             .withColumn("revisit_rate", F.col("revisits") / F.col("visits")))


# ---------------------------------------------------------------- E6, E7

def session_micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def incremental_duration(sessions: DataFrame, base: Column) -> DataFrame:
    """Per (user, session start day): total session time, time in ``base``
    sessions, and the increment (total - base), in microseconds."""
    d = session_micros(F.col("session_start"), F.col("session_end"))
    s = sessions.withColumn("_us", d).withColumn("day", F.to_date("session_start"))
    return (s.groupBy("user_id", "day")
             .agg(F.sum("_us").cast("bigint").alias("total_us"),
                  F.sum(F.when(base, F.col("_us")).otherwise(F.lit(0))).cast("bigint").alias("base_us"))
             .withColumn("incremental_us", F.col("total_us") - F.col("base_us")))


def sessions_with(sessions: DataFrame, flag: str) -> DataFrame:
    """Per day: sessions and sessions where ``flag`` (a per-session count) > 0."""
    s = sessions.withColumn("day", F.to_date("session_start"))
    return (s.groupBy("day")
             .agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col(flag) > 0).alias("sessions_with"))
             .withColumn("share", F.col("sessions_with") / F.col("sessions")))


# ---------------------------------------------------------------- E8, E9

def _gaps(days: DataFrame) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("day")
    return (days.withColumn("prev_day", F.lag("day").over(w))
                .withColumn("gap", F.datediff("day", "prev_day")))


def resurrection_rate(days: DataFrame, idle: int = 7, within: int = 7, as_of=None) -> DataFrame:
    """lapses = times a user stayed away for more than ``idle`` days after an
    active day, up to ``as_of`` (default: the newest day), whether they came
    back or not; returned = lapses that ended within ``within`` days of becoming
    one (idle < gap <= idle + within).  The rate is NULL without lapses."""
    if as_of is None:
        as_of = days.agg(F.max("day")).scalar()
    w = Window.partitionBy("user_id").orderBy("day")
    away = days.select(F.lead("day").over(w).alias("_back"), "day").select(
        F.datediff(F.coalesce("_back", F.lit(as_of).cast("date")), F.col("day")).alias("_gap"), F.col("_back").isNotNull().alias("_came"))
    return away.agg(F.count_if(F.col("_gap") > idle).alias("lapses"),
                    F.count_if(F.col("_came") & (F.col("_gap") > idle) & (F.col("_gap") <= idle + within)).alias("returned")) \
               .withColumn("resurrection_rate", F.try_divide("returned", "lapses"))


def post_return_activity(activity: DataFrame, idle: int = 7, days: int = 7) -> DataFrame:
    """For each return (active day after more than ``idle`` idle days):
    activity rows in the ``days`` days from the return day."""
    per_day = activity.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))
    g = _gaps(per_day).withColumn("_dn", F.datediff("day", F.lit("1970-01-01").cast("date")))
    w = Window.partitionBy("user_id").orderBy("_dn").rangeBetween(0, days - 1)
    a = g.withColumn("events_next_days", F.sum("n").over(w).cast("bigint"))
    return a.where(F.col("gap") > idle).select("user_id", F.col("day").alias("return_day"),
                                               "gap", "events_next_days")


def resurrected_users(days: DataFrame, windows: Mapping[str, int], idle: int = 7, hold: int = 30) -> DataFrame:
    """Per calendar day: returns (users back after more than ``idle`` idle days) and,
    for each trailing window (e.g. resurrected_wau=7), the distinct users with an
    active day in it on which they counted as resurrected.

    A return makes a user resurrected for ``hold`` days; a user's windows are united
    (a second return inside the first one's window prolongs it), and the active days
    inside them are kept.  Such a day counts for the trailing windows of the next n
    days, up to the user's next kept day: these spans never overlap, so the
    users of a day are a running sum of +1/-1 steps over the calendar.  No user
    is multiplied by days, and nothing is counted twice."""
    back = _gaps(days.select("user_id", "day").distinct())
    returned = F.col("gap") > idle
    windows_of = back.where(returned).select("user_id", F.col("day").alias("start"), F.date_add("day", hold).alias("end"))
    spans = unite(windows_of, ["user_id"])
    # a span's row stands before the days that it covers; a day is kept while the last span is open
    marks = spans.select("user_id", F.col("start").alias("day"), F.lit(0).alias("_rank"), F.col("end").alias("_end"), F.lit(False).alias("_back"))
    rows = marks.unionByName(back.select("user_id", "day", F.lit(1).alias("_rank"), F.lit(None).cast("date").alias("_end"),
                                         F.coalesce(returned, F.lit(False)).alias("_back")))
    upto = Window.partitionBy("user_id").orderBy("day", "_rank").rowsBetween(Window.unboundedPreceding, 0)
    kept = rows.withColumn("_open", F.max("_end").over(upto)).where((F.col("_rank") == 1) & (F.col("day") < F.col("_open")))
    following = kept.withColumn("_next", F.lead("day").over(Window.partitionBy("user_id").orderBy("day")))
    names = ["returns", *windows]

    def step(day: Column, **changes: Column) -> Column:
        return F.struct(day.alias("day"), *[changes.get(n, F.lit(0)).cast("long").alias(n) for n in names])

    came, one = F.col("_back").cast("int"), F.lit(1)
    changes = [step(F.col("day"), returns=came, **{n: one for n in windows}), step(F.date_add("day", 1), returns=-came)]
    for name, n in windows.items():
        changes.append(step(F.least(F.date_add("day", n), F.coalesce("_next", F.date_add("day", n))), **{name: -one}))
    steps = following.select(F.inline(F.array(*changes)))
    return open_per_day(steps, calendar(days), names)


# ---------------------------------------------------------------- E10, E11, E12

def completion_metrics(events: DataFrame, user: str, ts: str, kind: str,
                       start: str, finish: str, guardrail: str) -> DataFrame:
    """Starters (users with a ``start`` event), completers (a ``finish`` at
    or after their first start), completion rate, mean seconds from first
    start to first finish, and guardrail event count.

    The events are shuffled once, by (user, hour); what is grouped per user are the
    hours' first times."""
    e = events.where(F.col(user).isNotNull()).select(F.col(user).alias("_u"), F.col(ts).alias("_t"), F.col(kind).alias("_kind"), F.date_trunc("hour", F.col(ts)).alias("_b"))
    cell = Window.partitionBy("_u", "_b")
    e = e.withColumn("_start", F.min(F.when(F.col("_kind") == start, F.col("_t"))).over(cell))
    is_finish = F.col("_kind") == finish
    cells = e.groupBy("_u", "_b").agg(
        F.max("_start").alias("_start"), F.min(F.when(is_finish, F.col("_t"))).alias("_finish"),
        F.min(F.when(is_finish & (F.col("_t") >= F.col("_start")), F.col("_t"))).alias("_after"), F.count_if(F.col("_kind") == guardrail).alias("_g"))
    # one row per user and hour from here on
    placed = cells.withColumn("_t0", F.min("_start").over(Window.partitionBy("_u")))
    first_cell = F.date_trunc("hour", "_t0")
    done = F.when(F.col("_b") == first_cell, F.col("_after")).when(F.col("_b") > first_cell, F.col("_finish"))
    per_user = placed.groupBy("_u").agg(F.max("_t0").alias("_t0"), F.min(done).alias("_t1"), F.sum("_g").alias("_g"))
    us = F.timestamp_diff("MICROSECOND", F.col("_t0"), F.col("_t1"))
    return per_user.agg(
        F.count(F.col("_t0")).alias("starters"),
        F.count(F.col("_t1")).alias("completers"),
        F.try_divide(F.count(F.col("_t1")), F.count(F.col("_t0"))).alias("completion_rate"),
        (F.try_divide(F.sum(us), F.count(F.col("_t1"))) / 1e6).alias("avg_seconds_to_finish"),
        F.sum("_g").cast("bigint").alias("guardrail_events"))


def funnel(events: DataFrame, user: str, ts: str, kind: str, steps: Sequence[str],
           within_days: int, bucket: str = "hour") -> DataFrame:
    """Users reaching each step in order; step 1 is the first ``steps[0]``
    event, each later step is the first such event at or after the previous
    step and within ``within_days`` of step 1.

    A user's events are never gathered.  They are cut into time buckets; per (user,
    bucket) a fixed number of times tells, for each step i that may be the next
    one on entry, when steps i, i+1, ... are first reached inside the bucket.  Only the
    buckets in reach of a user's first step are kept, at most ``within_days`` of them, and folded in
    order into one time per step.  A user with a third of all events is
    spread over as many tasks as the user has buckets."""
    k = len(steps)
    number = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col(kind)) - 1
    e = events.where(F.col(user).isNotNull() & F.col(kind).isin(list(steps)) & F.col(ts).isNotNull()) \
              .select(F.col(user).alias("_u"), F.col(ts).alias("_t"), number.alias("_step"), F.date_trunc(bucket, F.col(ts)).alias("_b"))
    cell = Window.partitionBy("_u", "_b")
    for width in range(k):
        firsts = []
        for i in range(k - width):
            at = F.col("_step") == i + width
            after = at & (F.col("_t") >= F.col(f"_r{i}_{i + width - 1}")) if width else at
            firsts.append(F.min(F.when(after, F.col("_t"))).over(cell).alias(f"_r{i}_{i + width}"))
        e = e.select("*", *firsts)
    reach = [f"_r{i}_{j}" for i in range(k) for j in range(i, k)]
    cells = e.groupBy("_u", "_b").agg(*[F.max(c).alias(c) for c in reach])
    limit = F.expr(f"INTERVAL {within_days} DAYS")
    near = (cells.withColumn("_t0", F.min("_r0_0").over(Window.partitionBy("_u")))
                 .where((F.col("_b") >= F.date_trunc(bucket, "_t0")) & (F.col("_b") <= F.col("_t0") + limit)))
    per_user = near.groupBy("_u").agg(F.max("_t0").alias("_t0"), F.array_sort(F.collect_list(F.struct("_b", *reach))).alias("_cells"))
    kind_of = events.schema[ts].dataType.simpleString()
    start = F.array(F.col("_t0"), *[F.lit(None).cast(kind_of)] * (k - 1))

    def fold(state: Column, c: Column) -> Column:
        """The first open step on entry decides which chain of the bucket is taken."""
        times = [state[i] for i in range(k)]
        after = list(times)
        for i in range(1, k):  # step i is the first open one on entry
            opens = times[i].isNull() & times[i - 1].isNotNull()
            first_cell = F.date_trunc(bucket, times[0]) == c["_b"]
            for j in range(i, k):
                own = F.when(first_cell & F.lit(i == 1), c[f"_r0_{j}"]).otherwise(c[f"_r{i}_{j}"])
                after[j] = F.when(opens, F.when(own <= times[0] + limit, own)).otherwise(after[j])
        return F.array(*after)

    reached = per_user.select(F.aggregate("_cells", start, fold).alias("_times"))
    counts = reached.agg(*[F.count(F.col("_times")[i]).alias(f"_n{i}") for i in range(k)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(s).alias("step"), F.col(f"_n{i}").alias("users")) for i, s in enumerate(steps)])))


def weekly_engagement(events: DataFrame, user: str, ts: str, kind: str, conversion: str) -> DataFrame:
    """Per (user, ISO week): events, active days, conversions."""
    e = events.where(F.col(user).isNotNull())
    return (e.groupBy(F.col(user).alias("user_id"),
                      F.to_date(F.date_trunc("week", F.col(ts))).alias("week_start"))
             .agg(F.count(F.lit(1)).alias("events"),
                  F.countDistinct(F.to_date(F.col(ts))).alias("active_days"),
                  F.count_if(F.col(kind) == conversion).alias("conversions")))


def weekly_minutes(sessions: DataFrame, completed: str) -> DataFrame:
    """Per (user, week from Monday): sessions started, sessions active, time and minutes in
    the week, mean minutes per active session, sessions started that completed
    (``completed``, a per-session count, above 0) and their share (NULL without a started one).

    Sessions over the week's edge are cut there: each week gets its own
    minutes, the start and the completion belong to the first part's week."""
    parts = split_spans(sessions, "session_start", "session_end", "week", "week_start")
    done = F.col("is_first") & (F.col(completed) > 0)
    per = parts.groupBy("user_id", "week_start").agg(
        F.count_if("is_first").alias("sessions"), F.count(F.lit(1)).alias("active_sessions"),
        F.sum("part_us").cast("bigint").alias("total_us"), F.count_if(done).alias("completed"))
    return (per.withColumn("minutes", F.col("total_us") / MICROS_PER_MINUTE)
               .withColumn("avg_minutes", F.col("minutes") / F.col("active_sessions"))
               .withColumn("completion_rate", F.try_divide("completed", "sessions")))


# ---------------------------------------------------------------- E13, E14

def uplift(revenue: DataFrame, refunds: DataFrame, cells: DataFrame, user: str = "user_id") -> DataFrame:
    """Per cell: users, revenue, refunds, net (cents) and net per user;
    ``uplift_vs_control`` = net per user minus that of cell 0.

    ``revenue``/``refunds``: (user, cents) rows; ``cells``: (user, cell)."""
    r = revenue.groupBy(user).agg(F.sum("cents").alias("rev"))
    f = refunds.groupBy(user).agg(F.sum("cents").alias("ref"))
    per_user = (cells.join(r, user, "left").join(f, user, "left")
                     .fillna(0, ["rev", "ref"]))
    per_cell = (per_user.groupBy("cell")
                        .agg(F.count(F.lit(1)).alias("users"),
                             F.sum("rev").cast("bigint").alias("revenue_cents"),
                             F.sum("ref").cast("bigint").alias("refund_cents"))
                        .withColumn("net_cents", F.col("revenue_cents") - F.col("refund_cents"))
                        .withColumn("net_per_user", F.col("net_cents") / F.col("users")))
    # the window spans one row per cell
    control = F.max(F.when(F.col("cell") == 0, F.col("net_per_user"))).over(Window.partitionBy())
    return per_cell.withColumn("uplift_vs_control", F.col("net_per_user") - control)


def compare_cells(metric: DataFrame, value: str, digits: int = 6) -> DataFrame:
    """Per-cell n, mean and sample variance of ``value`` and the two-sample
    z score of treatment (cell 1) against control (cell 0), rounded."""
    s = metric.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"),
                                   F.var_samp(value).alias("v"))
    pick = lambda c, k: F.max(F.when(F.col("cell") == k, F.col(c)))
    one = s.agg(pick("n", 0).alias("n_control"), pick("n", 1).alias("n_treatment"),
                pick("m", 0).alias("mean_control"), pick("m", 1).alias("mean_treatment"),
                pick("v", 0).alias("var_control"), pick("v", 1).alias("var_treatment"))
    spread = F.sqrt(F.try_divide("var_treatment", "n_treatment") + F.try_divide("var_control", "n_control"))
    z = F.try_divide(F.col("mean_treatment") - F.col("mean_control"), spread)  # NULL without spread
    return one.select("n_control", "n_treatment",
                      F.round("mean_control", digits).alias("mean_control"),
                      F.round("mean_treatment", digits).alias("mean_treatment"),
                      F.round(z, digits).alias("z_score"))
