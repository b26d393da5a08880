"""Lot-level operators of the daily jobs: pivot, event de-duplication, tester-step resolution.

Every function takes the scoped event rows of a run and an optional tuple ``by`` of extra key
columns. A single run passes ``by=()``; the backfill passes ``("run_date",)`` so that every
grouping and join key carries the run date and many runs execute as one job.

Shape of the plans: each de-duplication and each MIN/MAX is an aggregate that Spark runs
partially before its shuffle (map-side combine), so a lot holding a large share of the rows is
collapsed before it is moved, and that is dealt by all its keys (``session.JOB_CONF``). So each join
has shuffles of its own on both sides and AQE splits a hot (lot, job) or (lot, step). Joins are on
(lot, job) first; rows are made distinct on all their columns, and the one-row-per-lot attribute
pivot is attached last (``skew.attach_per_lot``); the pivot being unique per lot keeps the result
distinct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import event_epoch
from ..functions.workweek import work_week
from ..params import (
    ATTRIBUTE_COLUMNS,
    ATTRIBUTE_IDS,
    GENEALOGY_EVENT,
    QTY_ATTRIBUTE,
    TESTER_ROLE,
    TESTER_STARTED,
    VARIANCE_REASONS,
)
from ..schemas import TOTALLOT_COLUMNS, VARIANCE_COLUMNS
from .skew import attach_per_lot

Keys = Sequence[str]


def _k(by: Keys) -> list[str]:
    return list(by)


def _on(left: DataFrame, right: DataFrame, by: Keys, pairs: Sequence[tuple[str, str]]):
    cond = None
    for a, b in [(c, c) for c in by] + list(pairs):
        term = left[a] == right[b]
        cond = term if cond is None else cond & term
    return cond


# ---- A1: attribute pivot ------------------------------------------------------------------


def attribute_pivot(scoped: DataFrame, by: Keys = (), columns: Sequence[str] = ATTRIBUTE_COLUMNS) -> DataFrame:
    """One row per lot: lexicographic MAX of each listed attribute's value (NULL if absent).

    Lots with none of the listed attributes in the window do not appear (they drop out of the
    inner joins downstream, as in the reference). MAX of text is a sort-based aggregate; copies of
    a value are collapsed by hash first (A4), so only a lot's distinct values are sorted. The filter
    on their number keeps Catalyst from dropping that step, which changes no MAX. The rows carry an
    attribute's number in place of its name. A reader of some ``columns`` gets those only; of the other
    attributes it needs which lots have any, and so one row of a lot without a value.
    """
    wanted = [(a, c) for a, c in zip(ATTRIBUTE_IDS, ATTRIBUTE_COLUMNS) if c in columns]
    number = F.array_position(F.array(*[F.lit(a) for a, _ in wanted]), F.col("attribute_id")).cast("int")
    rows = scoped.where(F.col("attribute_id").isin(*ATTRIBUTE_IDS)).select(
        *_k(by), F.col("ma_id").alias("LOT_ID"), number.alias("number"),
        F.when(F.col("attribute_id").isin(*[a for a, _ in wanted]), F.col("attribute_value")).alias("attribute_value"),
    )
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")).where("copies > 0").drop("copies")
    return rows.groupBy(*_k(by), "LOT_ID").agg(*[
        F.max(F.when(F.col("number") == i, F.col("attribute_value"))).alias(c) for i, (_, c) in enumerate(wanted, 1)
    ])


# ---- A5, A6: distinct events --------------------------------------------------------------


def variance_events(scoped: DataFrame, by: Keys = (),
                    reasons: Sequence[str] = VARIANCE_REASONS) -> DataFrame:
    """Distinct variance events of the current job, with the step job they belong to."""
    return (
        scoped.where(F.col("reason").isin(*reasons))
        .select(*_k(by), F.col("ma_id").alias("LOT_ID"), "reason", "action",
                F.col("location").alias("STEP_ID"), "quantity", "step_job_oid")
        .distinct()
    )


def lot_quantity(scoped: DataFrame, by: Keys = (), with_time: bool = True) -> DataFrame:
    """Distinct CURRENT QTY rows that carry a prior value (the lot quantity) and their job."""
    cols = [*_k(by), F.col("ma_id").alias("LOT_ID"),
            F.col("attribute_prior_value").alias("LOT_QTY"), "job_oid"]
    if with_time:
        cols.append("date_time_local")
    cols.append("partition_date")
    return (
        scoped.where((F.col("attribute_id") == QTY_ATTRIBUTE)
                     & F.col("attribute_prior_value").isNotNull())
        .select(*cols)
        .distinct()
    )


# ---- C3: which tester processed which lot step --------------------------------------------


def tester_first_start(scoped: DataFrame, by: Keys = ()) -> DataFrame:
    """A2: earliest start (epoch seconds) per (lot, job, tester) of STARTED tester events."""
    return (
        scoped.where((F.col("role") == TESTER_ROLE) & (F.col("event_action") == TESTER_STARTED))
        .groupBy(*_k(by), F.col("ma_id").alias("LOT_ID"), "job_oid",
                 F.col("resource").alias("TESTER_ID"))
        .agg(F.min(event_epoch("date_time_local")).alias("time_machine_start"))
    )


def genealogy_last_change(scoped: DataFrame, by: Keys = ()) -> DataFrame:
    """A3: latest genealogy change (epoch seconds) per (lot, step, step job)."""
    return (
        scoped.where(F.col("event_type") == GENEALOGY_EVENT)
        .groupBy(*_k(by), F.col("ma_id").alias("LOT_ID"), F.col("location").alias("STEP_ID"),
                 "step_job_oid")
        .agg(F.max(event_epoch("date_time_local")).alias("time_record_start"))
    )


def tester_step(first_start: DataFrame, last_change: DataFrame, by: Keys = ()) -> DataFrame:
    """J3 + F8 + A8: a tester worked a lot step when it started strictly before (whole seconds)
    the step's last genealogy change of the same job. Distinct (lot, step, tester, step job).

    Starts are unique per (lot, job, tester) and changes per (lot, step, job), so their join on (lot, job)
    is distinct. Its key has a hash of the lot as a further part, so that the join with the quantities has a
    shuffle of its own on this side (``skew``).
    """
    s, g = first_start.alias("s"), last_change.alias("g")
    cond = _on(s, g, by, [("LOT_ID", "LOT_ID"), ("job_oid", "step_job_oid")]) & (
        F.xxhash64("s.LOT_ID") == F.xxhash64("g.LOT_ID")) & (
        F.col("s.time_machine_start") < F.col("g.time_record_start")
    )
    return s.join(g, cond).select(*[F.col(f"g.{c}") for c in by], F.col("g.LOT_ID"), F.col("g.STEP_ID"),
                                  F.col("s.TESTER_ID"), F.col("g.step_job_oid"))


def resolve_tester_step(scoped: DataFrame, by: Keys = ()) -> DataFrame:
    return tester_step(tester_first_start(scoped, by), genealogy_last_change(scoped, by), by)


# ---- J2: quantity rows x tester steps -----------------------------------------------------


def lot_step(quantity: DataFrame, steps: DataFrame, by: Keys = (),
             keep_step_job: bool = True) -> DataFrame:
    """Distinct (lot, step, tester, quantity, event time, partition date[, step job])."""
    q, t = quantity.alias("q"), steps.alias("t")
    cols = [*[F.col(f"t.{c}") for c in by], F.col("t.LOT_ID"), F.col("t.STEP_ID"),
            F.col("t.TESTER_ID"), F.col("q.LOT_QTY"), F.col("q.date_time_local"),
            F.col("q.partition_date")]
    if keep_step_job:
        cols.append(F.col("t.step_job_oid"))
    return q.join(t, _on(q, t, by, [("LOT_ID", "LOT_ID"), ("job_oid", "step_job_oid")])) \
        .select(*cols).distinct()


# ---- J1: attributes x variance events -----------------------------------------------------


def variance_attributes(pivot: DataFrame, events: DataFrame, by: Keys = ()) -> DataFrame:
    """Variance events with the lot's attributes. The pivot has one row per lot and the events
    are distinct, so the join is already distinct (the reference's extra GROUP BY is a no-op)."""
    return pivot.join(events, [*_k(by), "LOT_ID"])


# ---- C1, C2: the two daily datasets -------------------------------------------------------


def _layout(df: DataFrame, by: Keys, columns: Sequence[str]) -> DataFrame:
    return df.select(*_k(by), *[work_week("date_time_local").alias(c) if c == "ww" else F.col(c)
                                for c in columns])


def _attributes(pivot: DataFrame, by: Keys, columns: Sequence[str]) -> DataFrame:
    return pivot.select(*_k(by), "LOT_ID", *[c for c in columns if c in ATTRIBUTE_COLUMNS])


def variance_rows(pivot: DataFrame, events: DataFrame, steps_with_job: DataFrame,
                  by: Keys = ()) -> DataFrame:
    """C1 in the daily layout (18 columns, ``ww`` derived from the quantity row's time).

    Equivalent to the reference's (pivot x events) x (quantity x tester steps) on
    (lot, step job) followed by DISTINCT: the pivot is unique per lot, so the rows are made distinct
    while they are narrow and the lot's attributes attached last.
    """
    e, st = events.alias("e"), steps_with_job.alias("st")
    rows = e.join(st, _on(e, st, by, [("LOT_ID", "LOT_ID"), ("step_job_oid", "step_job_oid")]))
    rows = rows.select(
        *[F.col(f"e.{c}") for c in by], F.col("e.LOT_ID"), F.col("e.STEP_ID"),
        F.col("st.TESTER_ID"), F.col("st.LOT_QTY"), F.col("e.reason"), F.col("e.action"),
        F.col("e.quantity"), F.col("st.date_time_local"), F.col("st.partition_date"),
    )
    out = attach_per_lot(rows.distinct(), _attributes(pivot, by, VARIANCE_COLUMNS), by)
    return _layout(out, by, VARIANCE_COLUMNS)


def totallot_rows(pivot: DataFrame, steps_no_job: DataFrame, by: Keys = ()) -> DataFrame:
    """C2 in the daily layout (10 columns). The step rows are distinct and the three attributes
    kept are functions of the lot, so the result is distinct without another DISTINCT (dropping
    the five unused attributes cannot merge rows)."""
    out = attach_per_lot(steps_no_job, _attributes(pivot, by, TOTALLOT_COLUMNS), by)
    return _layout(out, by, TOTALLOT_COLUMNS)


def variance_dataset(scoped: DataFrame, by: Keys = (), steps: DataFrame | None = None,
                     pivot: DataFrame | None = None, quantity: DataFrame | None = None,
                     events: DataFrame | None = None,
                     reasons: Sequence[str] = VARIANCE_REASONS,
                     lot_steps: DataFrame | None = None) -> DataFrame:
    """C1 from a run's scoped rows; parts that are given are not built again."""
    pivot = attribute_pivot(scoped, by) if pivot is None else pivot
    events = variance_events(scoped, by, reasons) if events is None else events
    if lot_steps is None:
        lot_steps = steps_with_job(scoped, by, steps, quantity)
    return variance_rows(pivot, events, lot_steps, by)


def steps_with_job(scoped: DataFrame, by: Keys = (), steps: DataFrame | None = None,
                   quantity: DataFrame | None = None) -> DataFrame:
    """J2 with the step job. Both datasets can be made of it."""
    steps = resolve_tester_step(scoped, by) if steps is None else steps
    quantity = lot_quantity(scoped, by) if quantity is None else quantity
    return lot_step(quantity, steps, by, keep_step_job=True)


def totallot_dataset(scoped: DataFrame, by: Keys = (), steps: DataFrame | None = None,
                     pivot: DataFrame | None = None, quantity: DataFrame | None = None,
                     lot_steps: DataFrame | None = None) -> DataFrame:
    """C2 from a run's scoped rows; parts that are given are not built again. ``lot_steps`` has the step
    job, which the total lots lack: DISTINCT of a projection of a DISTINCT."""
    pivot = attribute_pivot(scoped, by, TOTALLOT_COLUMNS) if pivot is None else pivot
    if lot_steps is not None:
        return totallot_rows(pivot, lot_steps.drop("step_job_oid").distinct(), by)
    steps = resolve_tester_step(scoped, by) if steps is None else steps
    quantity = lot_quantity(scoped, by) if quantity is None else quantity
    return totallot_rows(pivot, lot_step(quantity, steps, by, keep_step_job=False), by)
