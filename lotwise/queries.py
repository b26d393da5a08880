"""Registered queries: one per operator group of the survey, each over the whole derived log.

Every query derives the event log (and test records) from the given tables with Spark and runs
over all of it: the operator-level and daily-layout queries use one run window that covers every
partition date, the backfill runs every run date. ``oracle_sql()`` holds the DuckDB statement
that must return the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions.time import event_epoch
from .functions.workweek import register_sql_function, week_labels, work_week, work_week_range
from .operators import archive as A
from .operators import lots as L
from .operators.scope import scoped_window
from .params import RunWindow, Scope
from .plans.archive import archive_dataset
from .plans.backfill import backfill_dataset, run_archive_backfill, run_backfill
from .plans.daily import daily_dataset, daily_datasets, run_daily_job_at
from .plans.weekly import extract_name, report_name, run_daily_extracts, run_weekly_job, weekly_report
from .schemas import (
    ARCHIVE_TOTALLOT,
    ARCHIVE_VARIANCE,
    REPORT_TABLE_TOTALLOT,
    REPORT_TABLE_VARIANCE,
    REPORT_TOTALLOT,
    REPORT_VARIANCE,
    TOTALLOT,
    VARIANCE,
)
from .session import Keep, configure, dematerialize, materialize, scratch_path, stored_parts
from .sinks.tables import drop_table, register_report, register_store
from .sinks.text import write_dated, write_delimited, write_extract, write_report
from .sources.delimited import read_dated_store, read_delimited, read_report, read_table
from .sources.eventlog import write_event_parts
from .sources.fixtures import WIDE_LOWER, WIDE_UPPER, event_kinds, event_log, tte_records
from .sources.testrecords import write_test_records

# ---------------------------------------------------------------------------
# Fixed parameters of the registered queries.
# ---------------------------------------------------------------------------
WIDE = RunWindow.span(WIDE_LOWER, WIDE_UPPER)  # one run over every partition date
AS_OF = dt.datetime(2024, 10, 15, 12, 0, 0)  # weekly report date
FIRST_RUN, LAST_RUN = "2023-09-30", WIDE_UPPER  # every daily run that sees any partition
TWO_REASONS = Scope(variance_reasons=("VARIANCE", "OTHER"))
RERUNS = ("2024-02-03", "2024-02-04", "2024-02-05", "2024-02-06")  # of the catalog's tables
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return scoped_window(event_log(spark, sf_dir), WIDE)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tte_records(spark, sf_dir).where(F.col("record_date").between(WIDE.lower, WIDE.upper))


# ---- operator groups of the current job ---------------------------------------------------


def q_scope_window(spark, sf_dir):
    return _scoped(spark, sf_dir)


def q_attribute_pivot(spark, sf_dir):
    return L.attribute_pivot(_scoped(spark, sf_dir))


def q_variance_events(spark, sf_dir):
    return L.variance_events(_scoped(spark, sf_dir))


def q_lot_quantity(spark, sf_dir):
    return L.lot_quantity(_scoped(spark, sf_dir))


def q_tester_first_start(spark, sf_dir):
    return L.tester_first_start(_scoped(spark, sf_dir))


def q_genealogy_last_change(spark, sf_dir):
    return L.genealogy_last_change(_scoped(spark, sf_dir))


def q_tester_step(spark, sf_dir):
    return L.resolve_tester_step(_scoped(spark, sf_dir))


def q_lot_step(spark, sf_dir):
    s = _scoped(spark, sf_dir)
    return L.lot_step(L.lot_quantity(s), L.resolve_tester_step(s))


def q_variance_attributes(spark, sf_dir):
    s = _scoped(spark, sf_dir)
    return L.variance_attributes(L.attribute_pivot(s), L.variance_events(s))


def _daily(spark: SparkSession, sf_dir: str, dataset: str, keep: Keep = materialize, scope: Scope = Scope()) -> DataFrame:
    """C1 or C2. The parts are stored, so that the shuffles of one end before those of the next begin."""
    configure(spark)
    return daily_dataset(event_log(spark, sf_dir), WIDE, dataset, scope, keep)


def q_variance_daily(spark, sf_dir):
    return _daily(spark, sf_dir, "variance")


def q_totallot_daily(spark, sf_dir):
    return _daily(spark, sf_dir, "totallot")


def q_variance_two_reasons(spark, sf_dir):
    """F4 with two reasons, C1."""
    return _daily(spark, sf_dir, "variance", scope=TWO_REASONS)


def q_archive_variance_two_reasons(spark, sf_dir):
    """F4 with two reasons, C5. The parts are stored: their shuffles end before the rows'."""
    configure(spark)
    return archive_dataset(event_log(spark, sf_dir), _records(spark, sf_dir), WIDE, "variance", TWO_REASONS, keep=materialize)


# ---- work weeks and run windows -----------------------------------------------------------


def q_work_week_label(spark, sf_dir):
    """P9 as a Column and X1 as the SQL function ``get_ww``, over every event time."""
    configure(spark)
    register_sql_function(spark)
    times = event_log(spark, sf_dir).select("date_time_local").distinct()
    return times.select("date_time_local", work_week("date_time_local").alias("ww"),
                        F.expr("get_ww(date_time_local)").alias("ww_sql"))


def q_work_week_range(spark, sf_dir):
    """P10 for every partition date of the log taken as report date (noon): 52 labels each."""
    configure(spark)
    days = event_log(spark, sf_dir).select("partition_date").distinct()
    noon = event_epoch(F.concat("partition_date", F.lit(" 12:00:00")))
    return days.select(
        F.col("partition_date").alias("as_of_date"),
        F.posexplode(work_week_range(noon)).alias("pos", "ww"),
    )


def q_run_windows(spark, sf_dir):
    """P11, P12 for every partition date of the log taken as run date."""
    configure(spark)
    days = event_log(spark, sf_dir).select(F.col("partition_date").alias("run_date")).distinct()
    d = F.to_date("run_date")
    daily, archive = RunWindow.daily("2000-01-01"), RunWindow.archive("2000-01-01")
    return days.select(
        "run_date",
        F.date_format(d, "yyyy/MM/dd").alias("run_path"),
        F.date_add(d, daily.lower_offset).cast("string").alias("daily_lower"),
        F.date_add(d, daily.upper_offset).cast("string").alias("daily_upper"),
        F.date_add(d, archive.lower_offset).cast("string").alias("archive_lower"),
        F.date_add(d, archive.upper_offset).cast("string").alias("archive_upper"),
    )


# ---- archive job --------------------------------------------------------------------------


def q_tte_testers(spark, sf_dir):
    configure(spark)
    return A.tte_testers(_records(spark, sf_dir))


def q_archive_steps(spark, sf_dir):
    return A.archive_steps(_scoped(spark, sf_dir), with_time=True)


def q_archive_variance(spark, sf_dir):
    s = _scoped(spark, sf_dir)
    return A.archive_variance(s, A.tte_testers(_records(spark, sf_dir)), keep=materialize)


def q_archive_totallot(spark, sf_dir):
    s = _scoped(spark, sf_dir)
    return A.archive_totallot(s, A.tte_testers(_records(spark, sf_dir)), keep=materialize)


# ---- weekly reports -----------------------------------------------------------------------


def _weekly(spark: SparkSession, sf_dir: str, dataset: str, keep: Keep = materialize) -> DataFrame:
    return weekly_report(_daily(spark, sf_dir, dataset, keep), dataset, week_labels(AS_OF))


def q_weekly_totallot(spark, sf_dir):
    return _weekly(spark, sf_dir, "totallot")


def q_weekly_variance(spark, sf_dir):
    return _weekly(spark, sf_dir, "variance")


def q_weekly_totallot_history(spark, sf_dir):
    """C7 over the history as production stores it: the rows of every daily run (overlapping
    windows, per-run pivots), de-duplicated across runs by the report."""
    configure(spark)
    history = backfill_dataset(event_log(spark, sf_dir), FIRST_RUN, LAST_RUN, "totallot", keep=materialize)
    return weekly_report(history, "totallot", week_labels(AS_OF))


def q_weekly_variance_history(spark, sf_dir):
    """C8 over the history of every daily run."""
    configure(spark)
    history = backfill_dataset(event_log(spark, sf_dir), FIRST_RUN, LAST_RUN, "variance", keep=materialize)
    return weekly_report(history, "variance", week_labels(AS_OF))


# ---- sinks and sources, as write-then-read round trips in the shared scratch folder --------


def q_delimited_roundtrip(spark, sf_dir):
    """K1 then S2: Ctrl-A text with ``\\N`` for NULL, read back by position."""
    path = scratch_path(spark, "delimited")
    with stored_parts(spark, "delimited-parts") as keep:
        write_delimited(_daily(spark, sf_dir, "variance", keep), path)
    return read_delimited(spark, path, VARIANCE)


def q_dated_store_roundtrip(spark, sf_dir):
    """K2 then S4: the per-run-date store, read back with its ``run_date`` column."""
    root = scratch_path(spark, "dated")
    with stored_parts(spark, "dated-parts") as keep:
        write_dated(_daily(spark, sf_dir, "totallot", keep), root, WIDE.run_date)
    return read_dated_store(spark, root, TOTALLOT)


def q_report_roundtrip(spark, sf_dir):
    """K3 then S5: header + CRLF report, read back skipping each file's header line."""
    root = scratch_path(spark, "report")
    labels = week_labels(AS_OF)
    with stored_parts(spark, "report-parts") as keep:
        write_report(_weekly(spark, sf_dir, "variance", keep), root, f"variance_{labels[0]}-{labels[-1]}")
    return read_report(spark, root, REPORT_VARIANCE)


def q_daily_extract(spark, sf_dir):
    """Store the run, extract its run date as headerless comma text (K4), read it back."""
    root, out = scratch_path(spark, "store"), scratch_path(spark, "extract")
    with stored_parts(spark, "store-parts") as keep:
        write_dated(_daily(spark, sf_dir, "variance", keep), root, WIDE.run_date)
    write_extract(read_dated_store(spark, root, VARIANCE), WIDE.run_date, out)
    return read_delimited(spark, out, VARIANCE, sep=",")


def q_catalog_tables(spark, sf_dir):
    """K5, K6: an external CSV table over the dated store, read through the catalog."""
    root = scratch_path(spark, "table")
    with stored_parts(spark, "table-parts") as keep:
        write_dated(_daily(spark, sf_dir, "totallot", keep), root, WIDE.run_date)
    name = "lotwise_auto_totallot"
    drop_table(spark, name)
    register_store(spark, name, TOTALLOT, root)
    return spark.table(name)


# ---- stored inputs, and jobs that read and store like in production -------------------------


def _stored_log(spark: SparkSession, sf_dir: str) -> str:
    configure(spark)
    path = scratch_path(spark, "mam_tx")
    write_event_parts(event_kinds(spark, sf_dir, by_day=True), path)
    return path


def _daily_store(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """The daily job over the stored log, one run over every partition date."""
    log = _stored_log(spark, sf_dir)
    roots = {d: scratch_path(spark, f"daily-{d}") for d in ("variance", "totallot")}
    run_daily_job_at(spark, log, WIDE, roots["variance"], roots["totallot"])
    return read_dated_store(spark, roots[dataset], {"variance": VARIANCE, "totallot": TOTALLOT}[dataset])


def q_daily_job_variance(spark, sf_dir):
    return _daily_store(spark, sf_dir, "variance")


def q_daily_job_totallot(spark, sf_dir):
    return _daily_store(spark, sf_dir, "totallot")


def _archive_store(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """C10 of the archive job: every run date, from the stored log (S1) and the stored test records
    of two sources (S3), in chunks; the second call resumes and finds nothing to do."""
    log, records = _stored_log(spark, sf_dir), scratch_path(spark, "tte")
    rows = tte_records(spark, sf_dir)
    for source, even in (("tester-a", 0), ("tester-b", 1)):
        write_test_records(rows.where(F.pmod(F.xxhash64("summaryID"), F.lit(2)) == even), records, source)
    roots = {d: scratch_path(spark, f"archive-{d}") for d in ("variance", "totallot")}
    for resume in (False, True):
        run_archive_backfill(spark, log, records, WIDE.lower, WIDE.upper, roots["variance"], roots["totallot"],
                             chunk_days=150, resume=resume)
    return read_dated_store(spark, roots[dataset], {"variance": ARCHIVE_VARIANCE, "totallot": ARCHIVE_TOTALLOT}[dataset])


def q_backfill_archive_variance(spark, sf_dir):
    return _archive_store(spark, sf_dir, "variance")


def q_backfill_archive_totallot(spark, sf_dir):
    return _archive_store(spark, sf_dir, "totallot")


def _weekly_store(spark: SparkSession, sf_dir: str) -> str:
    """C7, C8 as in production: the backfill's stores, pruned by work week, to the stored reports."""
    configure(spark)
    roots = {d: scratch_path(spark, f"history-{d}") for d in ("variance", "totallot")}
    run_backfill(event_log(spark, sf_dir), FIRST_RUN, LAST_RUN, roots["variance"], roots["totallot"], chunk_days=None)
    reports = scratch_path(spark, "reports")
    run_weekly_job(spark, roots["variance"], roots["totallot"], reports, AS_OF)
    return reports


def q_weekly_job_variance(spark, sf_dir):
    return read_report(spark, f"{_weekly_store(spark, sf_dir)}/report_variance", REPORT_VARIANCE)


def q_weekly_job_totallot(spark, sf_dir):
    return read_report(spark, f"{_weekly_store(spark, sf_dir)}/report_totallot", REPORT_TOTALLOT)


def q_daily_extract_both(spark, sf_dir):
    """Both datasets of a run date, each in its own folder; their rows by the columns they share."""
    configure(spark)
    ds = daily_datasets(event_log(spark, sf_dir), WIDE, cache=False, keep=materialize)
    roots = {d: scratch_path(spark, f"extract-{d}") for d in ("variance", "totallot")}
    for d, rows in (("variance", ds.variance), ("totallot", ds.totallot)):
        stored = materialize(rows, f"both-{d}")  # the shuffles of one dataset end before those of the other
        write_dated(stored, roots[d], WIDE.run_date)
        dematerialize(stored)
    out = run_daily_extracts(spark, roots["variance"], roots["totallot"], WIDE.run_date, scratch_path(spark, "extracts"))
    both = [read_delimited(spark, out[d], schema, sep=",").select(F.lit(extract_name(d, WIDE.run_date)).alias("extract"), *TOTALLOT.fieldNames())
            for d, schema in (("variance", VARIANCE), ("totallot", TOTALLOT))]
    return both[0].union(both[1])


# ---- the catalog's tables over several runs (K5, K6) ----------------------------------------


def _catalog_runs(spark: SparkSession, rows: DataFrame, schema, name: str) -> DataFrame:
    """The table is registered over an empty store; three runs are stored (the log's lots in three
    parts), the first is run again and has no rows, the second again with a part of its own. The
    table is dropped and registered anew over the kept files, and a fourth run is stored. The runs take
    their parts from one stored copy of the rows."""
    root, rows = scratch_path(spark, name), materialize(rows, f"rows-{name}")
    drop_table(spark, name)
    register_store(spark, name, schema, root)
    third = F.pmod(F.length("PRODUCT_FAMILY") + F.length("LOT_QTY"), F.lit(3))
    for k in range(3):
        write_dated(rows.where(third == k), root, RERUNS[k], table=name)
    write_dated(rows.where(F.lit(False)), root, RERUNS[0], table=name)
    write_dated(rows.where((third == 1) & (F.length("LOT_QTY") == 2)), root, RERUNS[1], table=name)
    drop_table(spark, name)
    drop_table(spark, name)  # a table that is not there
    register_store(spark, name, schema, root)
    write_dated(rows.where(third == 0), root, RERUNS[3], table=name)
    dematerialize(rows)
    return read_table(spark, name)


def q_catalog_runs_variance(spark, sf_dir):
    with stored_parts(spark, "runs-parts") as keep:
        return _catalog_runs(spark, _daily(spark, sf_dir, "variance", keep), VARIANCE, "lotwise_runs_variance")


def q_catalog_runs_totallot(spark, sf_dir):
    with stored_parts(spark, "runs-parts") as keep:
        return _catalog_runs(spark, _daily(spark, sf_dir, "totallot", keep), TOTALLOT, "lotwise_runs_totallot")


def _catalog_report(spark: SparkSession, report: DataFrame, dataset: str, schema) -> DataFrame:
    """The report table with its own column names, over a report that replaces an older one. Both come
    from one stored copy of the rows."""
    report = materialize(report, f"rows-report-{dataset}")
    root, name, labels = scratch_path(spark, "reports"), f"lotwise_report_{dataset}", week_labels(AS_OF)
    older = week_labels(AS_OF - dt.timedelta(weeks=1))
    write_report(report.where(F.col(f"{dataset}_ww") == labels[0]), root, report_name(dataset, older))
    drop_table(spark, name)
    register_report(spark, name, schema, root)
    spark.table(name).count()  # the session has listed the older report's files
    write_report(report, root, report_name(dataset, labels), table=name)
    dematerialize(report)
    return read_table(spark, name)


def q_catalog_report_variance(spark, sf_dir):
    with stored_parts(spark, "report-parts") as keep:
        return _catalog_report(spark, _weekly(spark, sf_dir, "variance", keep), "variance", REPORT_TABLE_VARIANCE)


def q_catalog_report_totallot(spark, sf_dir):
    with stored_parts(spark, "report-parts") as keep:
        return _catalog_report(spark, _weekly(spark, sf_dir, "totallot", keep), "totallot", REPORT_TABLE_TOTALLOT)


# ---- values that hold line breaks, separators, quotes and escapes ---------------------------


def _awkward(spark: SparkSession, sf_dir: str, keep: Keep = materialize) -> DataFrame:
    """The variance rows with line breaks, backslashes, quotes, separators and a ``\\N`` in them."""
    def with_text(column: str, *text: str):
        return F.concat(F.col(column), F.lit("".join(text)), F.col(column)).alias(column)

    changed = {"LOT_ID": with_text("LOT_ID", "\n"), "STEP_ID": with_text("STEP_ID", "\r\n"), "DESIGN_ID": with_text("DESIGN_ID", "\\"),
               "PACKAGE_TYPE": with_text("PACKAGE_TYPE", "\\n\\\n"), "PRODUCT_FAMILY": with_text("PRODUCT_FAMILY", '",\x01"'),
               "reason": F.lit("\\N").alias("reason"), "action": with_text("action", "\r"), "quantity": F.lit("").alias("quantity")}
    return _daily(spark, sf_dir, "variance", keep).select(*[changed.get(c, F.col(c)) for c in VARIANCE.fieldNames()])


def q_delimited_any_text(spark, sf_dir):
    """K1, S2."""
    path = scratch_path(spark, "any-text")
    with stored_parts(spark, "any-parts") as keep:
        write_delimited(_awkward(spark, sf_dir, keep), path)
    return read_delimited(spark, path, VARIANCE)


def q_dated_store_any_text(spark, sf_dir):
    """K2, S4 and K4."""
    root, out = scratch_path(spark, "any-store"), scratch_path(spark, "any-extract")
    with stored_parts(spark, "any-parts") as keep:
        write_dated(_awkward(spark, sf_dir, keep), root, WIDE.run_date)
    write_extract(read_dated_store(spark, root, VARIANCE), WIDE.run_date, out)
    return read_delimited(spark, out, VARIANCE, sep=",")


def q_report_any_text(spark, sf_dir):
    """K3, S5."""
    root = scratch_path(spark, "any-report")
    with stored_parts(spark, "any-parts") as keep:
        write_report(_awkward(spark, sf_dir, keep), root, "any")
    return read_report(spark, root, VARIANCE)


# ---- backfill -----------------------------------------------------------------------------


def q_backfill_variance(spark, sf_dir):
    configure(spark)
    return backfill_dataset(event_log(spark, sf_dir), FIRST_RUN, LAST_RUN, "variance", keep=materialize)


def q_backfill_totallot(spark, sf_dir):
    configure(spark)
    return backfill_dataset(event_log(spark, sf_dir), FIRST_RUN, LAST_RUN, "totallot", keep=materialize)


QUERIES: dict[str, Query] = {
    "scope_window": q_scope_window,
    "attribute_pivot": q_attribute_pivot,
    "variance_events": q_variance_events,
    "lot_quantity": q_lot_quantity,
    "tester_first_start": q_tester_first_start,
    "genealogy_last_change": q_genealogy_last_change,
    "tester_step": q_tester_step,
    "lot_step": q_lot_step,
    "variance_attributes": q_variance_attributes,
    "variance_daily": q_variance_daily,
    "totallot_daily": q_totallot_daily,
    "work_week_label": q_work_week_label,
    "work_week_range": q_work_week_range,
    "run_windows": q_run_windows,
    "tte_testers": q_tte_testers,
    "archive_steps": q_archive_steps,
    "archive_variance": q_archive_variance,
    "archive_totallot": q_archive_totallot,
    "weekly_totallot": q_weekly_totallot,
    "weekly_variance": q_weekly_variance,
    "weekly_totallot_history": q_weekly_totallot_history,
    "weekly_variance_history": q_weekly_variance_history,
    "delimited_roundtrip": q_delimited_roundtrip,
    "dated_store_roundtrip": q_dated_store_roundtrip,
    "report_roundtrip": q_report_roundtrip,
    "daily_extract": q_daily_extract,
    "catalog_tables": q_catalog_tables,
    "backfill_variance": q_backfill_variance,
    "backfill_totallot": q_backfill_totallot,
    "variance_two_reasons": q_variance_two_reasons,
    "archive_variance_two_reasons": q_archive_variance_two_reasons,
    "daily_job_variance": q_daily_job_variance,
    "daily_job_totallot": q_daily_job_totallot,
    "backfill_archive_variance": q_backfill_archive_variance,
    "backfill_archive_totallot": q_backfill_archive_totallot,
    "weekly_job_variance": q_weekly_job_variance,
    "weekly_job_totallot": q_weekly_job_totallot,
    "daily_extract_both": q_daily_extract_both,
    "catalog_runs_variance": q_catalog_runs_variance,
    "catalog_runs_totallot": q_catalog_runs_totallot,
    "catalog_report_variance": q_catalog_report_variance,
    "catalog_report_totallot": q_catalog_report_totallot,
    "delimited_any_text": q_delimited_any_text,
    "dated_store_any_text": q_dated_store_any_text,
    "report_any_text": q_report_any_text,
}


def _oracles() -> dict[str, str]:
    wide, every = O.Runs.one(WIDE), O.Runs.each(FIRST_RUN, LAST_RUN, RunWindow.daily(FIRST_RUN))
    archive_runs = O.Runs.each(WIDE.lower, WIDE.upper, RunWindow.archive(WIDE.lower))
    variance, totallot = O.variance(wide), O.totallot(wide)
    sql = {p: O.part(p, wide) for p in (*O.PARTS, "variance_attributes")}
    return sql | {
        "variance_daily": variance,
        "totallot_daily": totallot,
        "work_week_label": O.week_labels_of_times(),
        "work_week_range": O.week_ranges_of_days(),
        "run_windows": O.run_windows(),
        "archive_variance": O.archive_variance(wide),
        "archive_totallot": O.archive_totallot(wide),
        "weekly_totallot": O.weekly("totallot", wide, AS_OF),
        "weekly_variance": O.weekly("variance", wide, AS_OF),
        "weekly_totallot_history": O.weekly("totallot", every, AS_OF),
        "weekly_variance_history": O.weekly("variance", every, AS_OF),
        "delimited_roundtrip": variance,
        "dated_store_roundtrip": O.stamped(totallot, WIDE.run_date),
        "report_roundtrip": O.weekly("variance", wide, AS_OF),
        "daily_extract": variance,
        "catalog_tables": O.stamped(totallot, WIDE.run_date),
        "backfill_variance": O.variance(every),
        "backfill_totallot": O.totallot(every),
        "variance_two_reasons": O.variance(wide, TWO_REASONS),
        "archive_variance_two_reasons": O.archive_variance(wide, TWO_REASONS),
        "daily_job_variance": O.stamped(variance, WIDE.run_date),
        "daily_job_totallot": O.stamped(totallot, WIDE.run_date),
        "backfill_archive_variance": O.archive_variance(archive_runs),
        "backfill_archive_totallot": O.archive_totallot(archive_runs),
        "weekly_job_variance": O.weekly("variance", every, AS_OF),
        "weekly_job_totallot": O.weekly("totallot", every, AS_OF),
        "daily_extract_both": O.both_extracts(wide, WIDE.run_date),
        "catalog_runs_variance": O.reruns(variance, RERUNS),
        "catalog_runs_totallot": O.reruns(totallot, RERUNS),
        "catalog_report_variance": O.weekly("variance", wide, AS_OF, prefix=False),
        "catalog_report_totallot": O.weekly("totallot", wide, AS_OF, prefix=False),
        "delimited_any_text": O.awkward(variance),
        "dated_store_any_text": O.awkward(variance),
        "report_any_text": O.awkward(variance),
    }


ORACLES: dict[str, str] = _oracles()
