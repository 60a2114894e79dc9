"""SCD type 2: C4 backfill, C5 increment, J13/Q8 point-in-time join.

Change detection is null-safe (D3): a NULL class next to a NULL class is
"unchanged", a NULL next to a value is a change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.periods import require_prior


def _same_state(a_prefix: str, b_prefix: str, attrs: Sequence[str]) -> Column:
    cond = F.lit(True)
    for a in attrs:
        cond = cond & F.col(f"{a_prefix}.{a}").eqNullSafe(F.col(f"{b_prefix}.{a}"))
    return cond


def scd2_backfill(snapshots: DataFrame, key: str, attrs: Sequence[str], period: str,
                  upto: int, carry: Sequence[str] = (), start_col: str = "start_year",
                  end_col: str = "end_year") -> DataFrame:
    """Whole history to SCD-2 rows in one pass.

    lag over the entity's periods -> change flag -> running sum = run id ->
    min/max period per run.  ``carry`` columns (e.g. the name) are taken
    from the run's rows.  Every row is stamped ``period = upto`` (D35).
    """
    snap = snapshots.where(F.col(period) <= upto)
    w = Window.partitionBy(key).orderBy(period)
    changed = F.lag(F.col(period)).over(w).isNull()
    for a in attrs:
        changed = changed | ~F.col(a).eqNullSafe(F.lag(F.col(a)).over(w))
    runs = (snap.withColumn("_chg", changed.cast("int"))
                .withColumn("_run", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return (runs.groupBy(key, "_run")
                .agg(*[F.first(F.col(a)).alias(a) for a in attrs],
                     *[F.max(F.col(c)).alias(c) for c in carry],
                     F.min(period).cast("int").alias(start_col),
                     F.max(period).cast("int").alias(end_col))
                .select(key, *carry, *attrs, F.lit(upto).cast("int").alias(period),
                        start_col, end_col))


def scd2_increment(scd: DataFrame, snapshot: DataFrame, key: str, attrs: Sequence[str],
                   period: str, year: int, carry: Sequence[str] = (),
                   start_col: str = "start_year", end_col: str = "end_year") -> DataFrame:
    """Fold the ``year`` snapshot into the SCD stamped ``year - 1``.

    closed runs (end < year-1) stay; open runs (end = year-1) are extended
    when the state is unchanged, else kept as they are and a new (year, year)
    run opens; new keys open a run.  All rows stamped ``year`` (D1, D35).

    The newest period before ``year`` in ``scd`` must be ``year - 1``: after a gap
    there is no open run to extend, so a ``PeriodGap`` is raised instead of
    losing the history (run the years between first).
    """
    require_prior(scd, period, year)
    prev = scd.where(F.col(period) == year - 1)
    closed = prev.where(F.col(end_col) < year - 1)
    open_ = prev.where(F.col(end_col) == year - 1).alias("o")
    ty = snapshot.where(F.col(period) == year).alias("t")
    j = open_.join(ty, F.col(f"o.{key}") == F.col(f"t.{key}"), "full_outer")
    same = _same_state("o", "t", attrs)
    has_o, has_t = F.col(f"o.{key}").isNotNull(), F.col(f"t.{key}").isNotNull()

    def run(src: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{src}.{c}").alias(c) for c in carry],
                        *[F.col(f"{src}.{a}").alias(a) for a in attrs],
                        start.cast("int").alias(start_col), end.cast("int").alias(end_col))

    extended = F.when(has_o & has_t & same, run("o", F.col(f"o.{start_col}"), F.lit(year)))
    kept_old = F.when(has_o & ~(has_t & same), run("o", F.col(f"o.{start_col}"), F.col(f"o.{end_col}")))
    opened = F.when(has_t & ~(has_o & same), run("t", F.lit(year), F.lit(year)))
    rows = (j.select(F.coalesce(F.col(f"o.{key}"), F.col(f"t.{key}")).alias(key),
                     F.filter(F.array(extended, kept_old, opened), lambda x: x.isNotNull()).alias("_r"))
             .select(key, F.inline("_r")))
    cols = [key, *carry, *attrs, start_col, end_col]
    return (closed.select(*cols)
            .unionByName(rows.select(*cols))
            .withColumn(period, F.lit(year).cast("int"))
            .select(key, *carry, *attrs, period, start_col, end_col))


def join_as_of_scd(facts: DataFrame, scd: DataFrame, key: str, at: str,
                   start_col: str = "start_year", end_col: str = "end_year",
                   how: str = "left") -> DataFrame:
    """Each fact row gets the SCD run valid at its time ``at``.

    Plans as an equi join on ``key`` with a range residual; runs of one key
    never overlap, so at most one run matches and no fact row is duplicated.
    """
    s = scd.alias("s")
    f = facts.alias("f")
    cond = ((F.col(f"f.{key}") == F.col(f"s.{key}")) &
            (F.col(f"s.{start_col}") <= F.col(f"f.{at}")) & (F.col(f"f.{at}") <= F.col(f"s.{end_col}")))
    return f.join(s, cond, how)
