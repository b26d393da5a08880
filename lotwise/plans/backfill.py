"""Many run dates in one Spark job.

Each event row belongs to every run whose window contains its partition date: 2 for the daily job, 16
for the archive job. Every aggregate of a run is one of per-day parts (MAX of MAXes, MIN of MINs,
DISTINCT of DISTINCTs), so the parts are built once per partition day, and only they are copied to
their run dates by a generator (``explode(sequence(...))``, no join, no driver loop) and combined per
run. No raw row is copied. ``run_date`` then rides in the grouping and join keys, so each run sees
only its own window, exactly as separate runs would.

The stored jobs cut the range into chunks of run dates, each with bounded shuffles, and mark every run
date as they store it; ``resume`` leaves out the run dates that both stores have marked.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..operators import archive as A
from ..operators import lots as L
from ..operators.scope import scope_predicate, window_predicate
from ..params import ATTRIBUTE_COLUMNS, RunWindow, Scope
from ..schemas import EVENT_LOG, TOTALLOT_COLUMNS, TTE
from ..session import Keep, as_is, checkpoint_root, materialize, remove_path, scratch_path
from ..sinks.text import committed_runs, write_dated
from ..sources.eventlog import present_days, read_event_log
from ..sources.testrecords import day_glob, read_dated_records
from .daily import WORK_COLUMNS

RUN_KEY = ("run_date",)
DAY_KEY = ("partition_date",)


def _shift(day: str, days: int) -> str:
    return (dt.date.fromisoformat(day) + dt.timedelta(days=days)).isoformat()


def _days(log: DataFrame, first_run: str, last_run: str, template: RunWindow,
          scope: Scope) -> DataFrame:
    """Scoped rows of every partition day some run in ``first_run .. last_run`` reads."""
    lo, hi = template.lower_offset, template.upper_offset
    return log.where(
        scope_predicate(scope) & window_predicate(_shift(first_run, lo), _shift(last_run, hi))
    ).select(*WORK_COLUMNS)


@dataclass(frozen=True)
class Runs:
    """Run dates ``first .. last`` whose windows have the shape of ``template``."""

    first: str
    last: str
    template: RunWindow
    lots: DataFrame | None = None  # (run_date, LOT_ID), distinct: the lots that a run is about, if not all

    def copies(self, rows: DataFrame) -> DataFrame:
        """One copy of each row per run date whose window contains its ``partition_date`` and, where
        the runs name their lots, whose lots include the row's."""
        day = F.try_to_date("partition_date")
        if self.lots is not None:
            run_day = F.try_to_date("run_date")
            within = run_day.between(F.date_sub(day, self.template.upper_offset), F.date_sub(day, self.template.lower_offset))
            return rows.join(self.lots, "LOT_ID").where(within & F.col("run_date").between(self.first, self.last)).select(*rows.columns, "run_date")
        runs = F.sequence(F.date_sub(day, self.template.upper_offset), F.date_sub(day, self.template.lower_offset))
        rows = rows.select("*", F.explode(runs).alias("run_day"))
        rows = rows.withColumn("run_date", F.col("run_day").cast("string")).drop("run_day")
        return rows.where(F.col("run_date").between(self.first, self.last))

    def distinct(self, per_day: DataFrame) -> DataFrame:
        """Distinct rows of days, copied to their runs and made distinct per run."""
        return self.copies(per_day).select(*RUN_KEY, *[c for c in per_day.columns if c != "partition_date"]).distinct()

    # The shared parts of the runs, from the scoped rows of all days.

    def pivot(self, days: DataFrame, columns: Sequence[str] = ATTRIBUTE_COLUMNS, keep: Keep = as_is) -> DataFrame:
        """A1: a (day, lot) is pivoted once; eight attribute rows are one before they are copied."""
        per_day = self.copies(keep(L.attribute_pivot(days, DAY_KEY, columns), "pivot-days"))
        return per_day.groupBy(*RUN_KEY, "LOT_ID").agg(*[F.max(c).alias(c) for c in ATTRIBUTE_COLUMNS if c in columns])

    def first_start(self, days: DataFrame) -> DataFrame:
        """A2: the least of the days' first starts."""
        return self.copies(L.tester_first_start(days, DAY_KEY)).groupBy(*RUN_KEY, "LOT_ID", "job_oid", "TESTER_ID").agg(
            F.min("time_machine_start").alias("time_machine_start"))

    def last_change(self, days: DataFrame) -> DataFrame:
        """A3: the greatest of the days' last changes."""
        return self.copies(L.genealogy_last_change(days, DAY_KEY)).groupBy(*RUN_KEY, "LOT_ID", "STEP_ID", "step_job_oid").agg(
            F.max("time_record_start").alias("time_record_start"))

    def tester_step(self, days: DataFrame) -> DataFrame:
        return L.tester_step(self.first_start(days), self.last_change(days), RUN_KEY)

    def quantity(self, per_day: DataFrame) -> DataFrame:
        """Quantity rows keep their ``partition_date``, so rows that are distinct per day are
        distinct in each run."""
        return self.copies(per_day)


def _window(log: DataFrame, runs: Runs, scope: Scope) -> DataFrame:
    """Scoped rows of every partition day that some run reads."""
    lo, hi = runs.template.lower_offset, runs.template.upper_offset
    return log.where(
        scope_predicate(scope) & window_predicate(_shift(runs.first, lo), _shift(runs.last, hi))
    ).select(*WORK_COLUMNS)


def backfill_daily(log: DataFrame, first_run: str, last_run: str, scope: Scope = Scope(),
                   keep: Keep = as_is) -> tuple[DataFrame, DataFrame]:
    """Variance and total-lot rows of every daily run in the range, with ``run_date``. ``keep`` gets
    the parts that both datasets use and may store them."""
    runs = Runs(first_run, last_run, RunWindow.daily(first_run))
    days = _window(log, runs, scope)
    pivot, steps, quantity = keep(runs.pivot(days), "pivot"), runs.tester_step(days), runs.quantity(L.lot_quantity(days))
    # Where parts are stored, both datasets are made of the same lot steps.
    shared = dict(pivot=pivot, **(dict(steps=steps, quantity=quantity) if keep is as_is else dict(
        lot_steps=keep(L.steps_with_job(days, RUN_KEY, steps, quantity), "steps"))))
    events = runs.distinct(L.variance_events(days, DAY_KEY, scope.variance_reasons))
    # Where they are not, the total lots have a pivot of their own columns.
    own = shared | (dict(pivot=runs.pivot(days, TOTALLOT_COLUMNS)) if keep is as_is else {})
    return (L.variance_dataset(days, RUN_KEY, events=events, **shared), L.totallot_dataset(days, RUN_KEY, **own))


def backfill_dataset(log: DataFrame, first_run: str, last_run: str, dataset: str, scope: Scope = Scope(),
                     keep: Keep = as_is) -> DataFrame:
    """One dataset of every daily run in the range, ``variance`` or ``totallot``, with the parts that it
    needs alone. ``keep`` gets them one after the other and may store them, so that each one's shuffles end
    before the next begin."""
    runs = Runs(first_run, last_run, RunWindow.daily(first_run))
    days = _window(log, runs, scope)
    of_variance = dataset == "variance"
    pivot = keep(runs.pivot(days, ATTRIBUTE_COLUMNS if of_variance else TOTALLOT_COLUMNS, keep), "pivot")
    steps = keep(L.tester_step(keep(runs.first_start(days), "starts"), runs.last_change(days), RUN_KEY), "tester-steps")
    lot_steps = keep(L.lot_step(runs.quantity(L.lot_quantity(days)), steps, RUN_KEY, keep_step_job=of_variance), "steps")
    if of_variance:
        events = runs.distinct(L.variance_events(days, DAY_KEY, scope.variance_reasons))
        return L.variance_dataset(days, RUN_KEY, pivot=pivot, events=events, lot_steps=lot_steps)
    return L.totallot_rows(pivot, lot_steps, RUN_KEY)


def backfill_archive(log: DataFrame, records: DataFrame, first_run: str, last_run: str,
                     scope: Scope = Scope(), keep: Keep = as_is) -> tuple[DataFrame, DataFrame]:
    """Archive variance and total lots of every archive run in the range.

    ``records`` carries ``record_date``; each archive run reads the records of its run date. Both
    datasets join the testers on run and lot, so the log's parts are copied only to the runs that have
    a record of the lot, not to all 16 whose windows hold the day.
    """
    template = RunWindow.archive(first_run)
    testers = keep(A.tte_testers(records.where(F.col("record_date").between(first_run, last_run))
                                 .withColumnRenamed("record_date", "run_date"), RUN_KEY).distinct(), "testers")
    runs = Runs(first_run, last_run, template, lots=keep(testers.select(*RUN_KEY, "LOT_ID").distinct(), "tested"))
    days = _window(log, runs, scope)
    pivot = keep(runs.pivot(days, keep=keep), "pivot")
    genealogy = keep(runs.distinct(A.genealogy_steps(days, DAY_KEY)), "genealogy")
    steps = {t: keep(A.steps_of(runs.quantity(A.archive_quantity(days, with_time=t)), genealogy, RUN_KEY, t), f"steps-{t}")
             for t in (False, True)}
    events = runs.distinct(A.archive_variance_events(days, DAY_KEY, scope.variance_reasons))
    return (A.archive_variance(days, testers, RUN_KEY, pivot=pivot, events=events, steps=steps[False]),
            A.archive_totallot(days, testers, RUN_KEY, pivot=pivot, steps=steps[True]))


# ---- stored jobs ------------------------------------------------------------------------------


def pending_chunks(spark: SparkSession, first_run: str, last_run: str, roots: tuple[str, ...],
                   chunk_days: int | None, resume: bool) -> Iterator[tuple[str, str]]:
    """Ranges of consecutive run dates, ``chunk_days`` at most; with ``resume`` without those that
    all stores hold completely."""
    done = set.intersection(*[committed_runs(spark, r) for r in roots]) if resume else set()
    chunk: list[str] = []
    for day in RunWindow.span(first_run, last_run).days():
        if day not in done:
            chunk.append(day)
        if chunk and (day in done or len(chunk) == chunk_days or day == last_run):
            yield chunk[0], chunk[-1]
            chunk = []


def _store_chunk(spark: SparkSession, lo: str, hi: str, build, variance_root: str, totallot_root: str,
                 variance_table: str | None, totallot_table: str | None) -> None:
    """Both datasets of a chunk. The parts they share are written once as tables in the cluster's
    ``spark.checkpoint.dir``, so the second write neither computes them again nor depends on executors
    that may be gone; they are removed whatever happens."""
    tables = scratch_path(spark, f"backfill-{lo}")
    days = RunWindow.span(lo, hi).days()
    try:
        variance, totallot = build(lo, hi, lambda df, name: materialize(df, name, tables))
        write_dated(variance, variance_root, run_dates=days, table=variance_table)
        write_dated(totallot, totallot_root, run_dates=days, table=totallot_table)
    finally:
        remove_path(spark, tables)


def run_backfill(log: DataFrame, first_run: str, last_run: str, variance_root: str,
                 totallot_root: str, chunk_days: int | None = 31, scope: Scope = Scope(),
                 resume: bool = False, variance_table: str | None = None, totallot_table: str | None = None) -> None:
    """Store both daily datasets for every run date in the range (K2 per run date).

    Stored run dates are durable and marked. A failed backfill is called again with ``resume``;
    without it, every run date is computed anew, which replaces only its own rows.
    """
    spark = log.sparkSession
    checkpoint_root(spark)
    for lo, hi in pending_chunks(spark, first_run, last_run, (variance_root, totallot_root), chunk_days, resume):
        _store_chunk(spark, lo, hi, lambda a, b, keep: backfill_daily(log, a, b, scope, keep),
                     variance_root, totallot_root, variance_table, totallot_table)


def _window_days(template: RunWindow, lo: str, hi: str) -> list[str]:
    return RunWindow.span(_shift(lo, template.lower_offset), _shift(hi, template.upper_offset)).days()


def _log_of(spark: SparkSession, path: str, days: list[str]) -> DataFrame:
    """The log's rows of a chunk's days; a chunk may have none, as long as the range has some."""
    try:
        return read_event_log(spark, path, days)
    except FileNotFoundError:
        return spark.createDataFrame([], EVENT_LOG)


def _check_log(spark: SparkSession, path: str, days: list[str]) -> None:
    there = set(files.names(spark, path))
    present_days([(d, f"partition_date={d}") for d in days], there.__contains__, path)


def run_backfill_at(spark: SparkSession, log_path: str, first_run: str, last_run: str,
                    variance_root: str, totallot_root: str, chunk_days: int | None = 31,
                    scope: Scope = Scope(), resume: bool = False, variance_table: str | None = None,
                    totallot_table: str | None = None) -> None:
    """``run_backfill`` over a stored log; each chunk lists and reads only its own days."""
    checkpoint_root(spark)
    template = RunWindow.daily(first_run)
    _check_log(spark, log_path, _window_days(template, first_run, last_run))

    def build(lo: str, hi: str, keep: Keep):
        return backfill_daily(_log_of(spark, log_path, _window_days(template, lo, hi)), lo, hi, scope, keep)

    for lo, hi in pending_chunks(spark, first_run, last_run, (variance_root, totallot_root), chunk_days, resume):
        _store_chunk(spark, lo, hi, build, variance_root, totallot_root, variance_table, totallot_table)


def run_archive_backfill(spark: SparkSession, log_path: str, tte_root: str, first_run: str, last_run: str,
                         variance_root: str, totallot_root: str, chunk_days: int | None = 8,
                         scope: Scope = Scope(), resume: bool = False, variance_table: str | None = None,
                         totallot_table: str | None = None) -> None:
    """The archive job for every run date in the range, from the stored log and test records.

    A chunk reads the log days of its windows once (``chunk_days`` + 15) and the records of its own
    run dates; a run date without records stores no rows, as its run would.
    """
    checkpoint_root(spark)
    template = RunWindow.archive(first_run)
    _check_log(spark, log_path, _window_days(template, first_run, last_run))
    run_days = RunWindow.span(first_run, last_run).days()
    if not any(files.any_match(spark, day_glob(tte_root, d)) for d in run_days):
        raise FileNotFoundError(f"{tte_root}: none of the days {first_run} .. {last_run} is there")

    def build(lo: str, hi: str, keep: Keep):
        try:
            records = read_dated_records(spark, tte_root, RunWindow.span(lo, hi).days())
        except FileNotFoundError:
            records = spark.createDataFrame([], TTE).withColumn("record_date", F.lit(None).cast("string"))
        log = _log_of(spark, log_path, _window_days(template, lo, hi))
        return backfill_archive(log, records, lo, hi, scope, keep)

    for lo, hi in pending_chunks(spark, first_run, last_run, (variance_root, totallot_root), chunk_days, resume):
        _store_chunk(spark, lo, hi, build, variance_root, totallot_root, variance_table, totallot_table)
