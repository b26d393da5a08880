"""The job entry points end to end on stored inputs (sf0.001): daily, archive, backfill, weekly
report and one-day extract, each checked against the in-memory operators."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lotwise.functions.workweek import week_labels
from lotwise.params import RunWindow
from lotwise.plans.archive import archive_datasets, run_archive_job
from lotwise.plans import backfill
from lotwise.plans.backfill import backfill_archive, backfill_daily, run_archive_backfill, run_backfill_at
from lotwise.plans.daily import daily_datasets, run_daily_job_at
from lotwise.plans.weekly import report_name, run_daily_extract, run_weekly_job, weekly_report
from lotwise.schemas import (
    ARCHIVE_TOTALLOT,
    ARCHIVE_VARIANCE,
    REPORT_TOTALLOT,
    REPORT_VARIANCE,
    TOTALLOT,
    VARIANCE,
)
from lotwise.sources.delimited import read_dated_store, read_delimited, read_report
from lotwise.sources.eventlog import write_event_log
from lotwise.sources.fixtures import event_log, tte_records
from lotwise.sources.testrecords import write_test_records

RUN = "2024-02-03"


def same(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    log = event_log(spark, SF001)
    write_event_log(log, f"{root}/mam_tx")
    recs = tte_records(spark, SF001).where(F.col("record_date") == RUN).drop("record_date")
    recs.write.parquet(f"{root}/tte/testerA/{RUN.replace('-', '/')}")
    return root, log, recs


def test_daily_job(spark, stored):
    root, log, _ = stored
    window = RunWindow.daily(RUN)
    run_daily_job_at(spark, f"{root}/mam_tx", window, f"{root}/variance", f"{root}/totallot")
    ds = daily_datasets(log, window, cache=False)
    got_v = read_dated_store(spark, f"{root}/variance", VARIANCE, [RUN]).drop("run_date")
    got_t = read_dated_store(spark, f"{root}/totallot", TOTALLOT, [RUN]).drop("run_date")
    assert got_v.count() > 0 and same(got_v, ds.variance) and same(got_t, ds.totallot)
    # The run date as headerless comma text
    out = f"{root}/extract"
    run_daily_extract(spark, f"{root}/variance", VARIANCE, RUN, out)
    assert same(read_delimited(spark, out, VARIANCE, sep=","), ds.variance)


def test_archive_job_reads_the_run_dates_records(spark, stored):
    root, log, recs = stored
    window = RunWindow.archive(RUN)
    run_archive_job(spark, f"{root}/mam_tx", f"{root}/tte", window, f"{root}/archive_variance",
                    f"{root}/archive_totallot")
    v, t = archive_datasets(log, recs, window)
    got_v = read_dated_store(spark, f"{root}/archive_variance", ARCHIVE_VARIANCE).drop("run_date")
    got_t = read_dated_store(spark, f"{root}/archive_totallot", ARCHIVE_TOTALLOT).drop("run_date")
    assert got_t.count() > 0 and same(got_v, v) and same(got_t, t)


def test_backfill_then_weekly_reports(spark, stored):
    root, log, _ = stored
    first, last = "2024-01-20", "2024-02-20"
    run_backfill_at(spark, f"{root}/mam_tx", first, last, f"{root}/bf_v", f"{root}/bf_t",
                    chunk_days=16)
    as_of = dt.datetime(2024, 2, 15, 12)
    paths = run_weekly_job(spark, f"{root}/bf_v", f"{root}/bf_t", f"{root}/reports", as_of)
    labels = week_labels(as_of)
    assert paths["variance"].endswith(report_name("variance", labels))
    v, t = backfill_daily(log, first, last)
    got_v = read_report(spark, f"{root}/reports/report_variance", REPORT_VARIANCE)
    got_t = read_report(spark, f"{root}/reports/report_totallot", REPORT_TOTALLOT)
    assert got_v.count() > 0
    assert same(got_v, weekly_report(v, "variance", labels))
    assert same(got_t, weekly_report(t, "totallot", labels))
    assert os.listdir(f"{root}/reports/report_variance") == [report_name("variance", labels)]


def test_backfill_resumes_where_it_was_killed(spark, stored, monkeypatch):
    """A backfill that dies between chunks goes on with the run dates that are not marked; one
    that dies between its two datasets does that chunk again."""
    root, log, _ = stored
    first, last = "2024-02-01", "2024-02-12"
    v, t = f"{root}/res_v", f"{root}/res_t"
    stored_chunks, real, writes = [], backfill.write_dated, []

    def dies(df, where, **how):
        writes.append(where)
        if len(writes) == 4:  # the second chunk's second dataset
            raise RuntimeError("killed")
        return real(df, where, **how)

    monkeypatch.setattr(backfill, "write_dated", dies)
    with pytest.raises(RuntimeError, match="killed"):
        run_backfill_at(spark, f"{root}/mam_tx", first, last, v, t, chunk_days=4)
    monkeypatch.setattr(backfill, "write_dated", lambda df, where, **how: (stored_chunks.append((where, tuple(how["run_dates"]))),
                                                                          real(df, where, **how))[1])
    run_backfill_at(spark, f"{root}/mam_tx", first, last, v, t, chunk_days=4, resume=True)
    assert [c[1][0] for c in stored_chunks if c[0] == v] == ["2024-02-05", "2024-02-09"]
    want_v, want_t = backfill_daily(log, first, last)
    assert same(read_dated_store(spark, v, VARIANCE).select(want_v.columns), want_v)
    assert same(read_dated_store(spark, t, TOTALLOT).select(want_t.columns), want_t)
    stored_chunks.clear()
    run_backfill_at(spark, f"{root}/mam_tx", first, last, v, t, chunk_days=4, resume=True)
    assert stored_chunks == []


def test_archive_backfill_over_stored_inputs(spark, stored):
    """Archive runs with the records of their own dates, from the dated folders; a run date
    without records stores no rows; equal to the in-memory backfill."""
    from lotwise.__main__ import main

    root, log, _ = stored
    first, last, hole = "2024-02-01", "2024-02-09", "2024-02-05"
    records = tte_records(spark, SF001).where(F.col("record_date").between(first, last) & (F.col("record_date") != hole))
    write_test_records(records, f"{root}/records", "testerA")
    v, t = f"{root}/abf_v", f"{root}/abf_t"
    main(["archive-backfill", "--log", f"{root}/mam_tx", "--tte-root", f"{root}/records", "--first", first, "--last", last,
          "--variance-root", v, "--totallot-root", t, "--chunk-days", "4"], spark)
    want_v, want_t = backfill_archive(log, records, first, last)
    got_v, got_t = read_dated_store(spark, v, ARCHIVE_VARIANCE), read_dated_store(spark, t, ARCHIVE_TOTALLOT)
    assert got_v.count() > 0 and same(got_v.select(want_v.columns), want_v) and same(got_t.select(want_t.columns), want_t)
    assert got_t.where(F.col("run_date") == hole).count() == 0
    with pytest.raises(FileNotFoundError):
        run_archive_backfill(spark, f"{root}/mam_tx", f"{root}/records", "2024-03-01", "2024-03-02", v, t)


def test_command_line(spark, stored):
    """The jobs as subcommands of one application (``python -m lotwise``)."""
    from lotwise.__main__ import main

    root, log, _ = stored
    out = f"{root}/cli"
    main(["daily", "--log", f"{root}/mam_tx", "--run-date", RUN,
          "--variance-root", f"{out}/v", "--totallot-root", f"{out}/t"], spark)
    main(["backfill", "--log", f"{root}/mam_tx", "--first", "2024-02-04", "--last", "2024-02-05",
          "--variance-root", f"{out}/v", "--totallot-root", f"{out}/t"], spark)
    main(["weekly", "--variance-root", f"{out}/v", "--totallot-root", f"{out}/t",
          "--report-root", f"{out}/r", "--as-of", "2024-02-07T12:00:00"], spark)
    main(["extract", "--root", f"{out}/v", "--dataset", "variance", "--run-date", RUN,
          "--out", f"{out}/x"], spark)
    main(["tables", "--variance-root", f"{out}/v", "--totallot-root", f"{out}/t",
          "--report-root", f"{out}/r"], spark)
    ds = daily_datasets(log, RunWindow.daily(RUN), cache=False)
    assert same(spark.table("auto_variance").where(F.col("run_date") == RUN).select(VARIANCE.fieldNames()), ds.variance)
    assert spark.table("auto_totallot").select("run_date").distinct().count() == 3
    main(["daily", "--log", f"{root}/mam_tx", "--run-date", "2024-02-06", "--variance-root", f"{out}/v",
          "--totallot-root", f"{out}/t", "--totallot-table", "auto_totallot"], spark)
    assert spark.table("auto_totallot").select("run_date").distinct().count() == 4
    main(["weekly", "--variance-root", f"{out}/v", "--totallot-root", f"{out}/t", "--report-root", f"{out}/r",
          "--as-of", "2024-02-14T12:00:00", "--variance-table", "report_variance", "--totallot-table", "report_totallot"], spark)
    assert spark.table("report_variance").columns == [c.removeprefix("variance_") for c in REPORT_VARIANCE.fieldNames()]
    main(["extract-day", "--variance-root", f"{out}/v", "--totallot-root", f"{out}/t", "--run-date", RUN, "--out", f"{out}/d"], spark)
    assert same(read_delimited(spark, f"{out}/d/totallot_{RUN}", TOTALLOT, sep=","), ds.totallot)
    assert same(read_delimited(spark, f"{out}/d/variance_{RUN}", VARIANCE, sep=","), ds.variance)
    assert spark.table("report_variance").count() > 0
    assert same(read_delimited(spark, f"{out}/x", VARIANCE, sep=","), ds.variance)
    main(["tables", "--variance-root", "-", "--totallot-root", "-", "--report-root", "-",
          "--drop"], spark)
    assert not spark.catalog.tableExists("auto_variance")
