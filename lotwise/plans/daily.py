"""C1 + C2: the current daily job (variance and total lots for one run date).

The reference scans the log 5 + 4 times and resolves testers twice. Here the two aggregated
intermediates both datasets need, the attribute pivot (one row per lot) and the lot steps with their
testers and quantities (C3, J2), are built once and persisted or, in the stored job, written as tables in
the shared checkpoint folder, whose shuffles end with them; every raw read stays a partition-pruned,
column-pruned scan with pushed-down filters. The shared parts are aggregates, far smaller than
the window; blocks lost with an executor are recomputed from a short lineage, and the written
datasets are the durable results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..operators import lots as L
from ..operators.scope import scoped_window
from ..params import RunWindow, Scope
from ..schemas import TOTALLOT_COLUMNS
from ..session import Keep, as_is, stored_parts
from ..sinks.text import write_dated
from ..sources.eventlog import read_event_log

# Columns any daily operator reads; everything else is pruned at the scan.
WORK_COLUMNS = (
    "ma_id", "attribute_id", "attribute_value", "attribute_prior_value", "reason", "action",
    "location", "quantity", "step_job_oid", "job_oid", "date_time_local", "resource", "role",
    "event_action", "event_type", "partition_date",
)


@dataclass
class DailyDatasets:
    variance: DataFrame
    totallot: DataFrame
    cached: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        for df in self.cached:
            df.unpersist()


def daily_datasets(log: DataFrame, window: RunWindow, scope: Scope = Scope(),
                   cache: bool = True, keep: Keep = as_is) -> DailyDatasets:
    """Both datasets of one run. The parts they share are persisted (``cache``), or go through ``keep``,
    which may store them."""
    scoped = scoped_window(log, window, scope).select(*WORK_COLUMNS)
    pivot = keep(L.attribute_pivot(scoped), "pivot")
    if not cache and keep is as_is:
        steps = L.resolve_tester_step(scoped)
        return DailyDatasets(
            variance=L.variance_dataset(scoped, steps=steps, pivot=pivot, reasons=scope.variance_reasons),
            totallot=L.totallot_dataset(scoped, steps=steps),  # with a pivot of its own columns
        )
    lot_steps = keep(L.steps_with_job(scoped), "steps")
    cached: tuple[DataFrame, ...] = ()
    if cache:
        pivot = pivot.persist(StorageLevel.MEMORY_AND_DISK)
        lot_steps = lot_steps.persist(StorageLevel.MEMORY_AND_DISK)
        cached = (pivot, lot_steps)
    return DailyDatasets(
        variance=L.variance_dataset(scoped, pivot=pivot, lot_steps=lot_steps, reasons=scope.variance_reasons),
        totallot=L.totallot_dataset(scoped, pivot=pivot, lot_steps=lot_steps),
        cached=cached,
    )


def daily_dataset(log: DataFrame, window: RunWindow, dataset: str, scope: Scope = Scope(),
                  keep: Keep = as_is) -> DataFrame:
    """One dataset of a run, ``variance`` or ``totallot``, with the parts that it needs alone. ``keep`` gets
    them one after the other and may store them, so that each one's shuffles end before the next begin."""
    scoped = scoped_window(log, window, scope).select(*WORK_COLUMNS)
    of_variance = dataset == "variance"
    pivot = keep(L.attribute_pivot(scoped) if of_variance else L.attribute_pivot(scoped, columns=TOTALLOT_COLUMNS), "pivot")
    steps = keep(L.resolve_tester_step(scoped), "tester-steps")
    lot_steps = keep(L.lot_step(L.lot_quantity(scoped), steps, keep_step_job=of_variance), "steps")
    if of_variance:
        return L.variance_dataset(scoped, pivot=pivot, lot_steps=lot_steps, reasons=scope.variance_reasons)
    return L.totallot_rows(pivot, lot_steps)


def run_daily_job(log: DataFrame, window: RunWindow, variance_root: str, totallot_root: str,
                  scope: Scope = Scope(), variance_table: str | None = None,
                  totallot_table: str | None = None) -> None:
    """Compute both datasets and store them under ``run_date=<window.run_date>`` (K2); tables that
    are named see the run at once (K5)."""
    with stored_parts(log.sparkSession, f"daily-{window.run_date}") as keep:
        ds = daily_datasets(log, window, scope, cache=False, keep=keep)
        write_dated(ds.variance, variance_root, window.run_date, table=variance_table)
        write_dated(ds.totallot, totallot_root, window.run_date, table=totallot_table)


def run_daily_job_at(spark, log_path: str, window: RunWindow, variance_root: str,
                     totallot_root: str, scope: Scope = Scope(), **tables: str | None) -> None:
    """The daily job over a stored log, listing only the window's partition folders."""
    log = read_event_log(spark, log_path, window.days())
    run_daily_job(log, window, variance_root, totallot_root, scope, **tables)
