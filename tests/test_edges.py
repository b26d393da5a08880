"""Edge units on tiny hand-made frames (cases the derived fixture does not contain)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from lotwise.functions.workweek import week_labels, week_of, work_week
from lotwise.operators import archive as A
from lotwise.operators import lots as L
from lotwise.params import RunWindow
from lotwise.schemas import EVENT_LOG, TTE


def _log(spark, rows):
    full = []
    for r in rows:
        d = {c: None for c in EVENT_LOG.fieldNames()}
        d.update(ma_type="LOT", system_name="MAMTSTSI", facility_id="TEST-MSA",
                 partition_date="2024-02-03")
        d.update(r)
        full.append(d)
    return spark.createDataFrame(full, EVENT_LOG)


def test_pivot_max_is_lexicographic(spark):
    """M2: '9' > '16' as text; other values in the window are lost; absent attribute is NULL."""
    log = _log(spark, [
        dict(ma_id="L1", attribute_id="LEAD COUNT", attribute_value="16"),
        dict(ma_id="L1", attribute_id="LEAD COUNT", attribute_value="9"),
        dict(ma_id="L1", attribute_id="NOT LISTED", attribute_value="x"),
        dict(ma_id="L2", attribute_id="NOT LISTED", attribute_value="y"),
    ])
    rows = L.attribute_pivot(log).collect()
    assert len(rows) == 1  # L2 has no listed attribute: it vanishes (M3)
    assert rows[0]["LEAD_COUNT"] == "9"
    assert rows[0]["DESIGN_ID"] is None


def _tester_rows(start: str, change: str, job=7):
    return [
        dict(ma_id="L1", role="TESTER MACHINE", event_action="STARTED", resource="T1",
             job_oid=job, date_time_local=start),
        dict(ma_id="L1", event_type="GenealogyChanged", location="HOT TEST", step_job_oid=job,
             date_time_local=change),
    ]


def test_same_second_is_not_before(spark):
    """M6: strict '<' at whole seconds: the fraction is ignored, equal seconds drop out."""
    log = _log(spark, _tester_rows("2024-02-03 08:00:00.10+0800", "2024-02-03 08:00:00.90+0800"))
    assert L.resolve_tester_step(log).count() == 0
    log = _log(spark, _tester_rows("2024-02-03 08:00:00.90+0800", "2024-02-03 08:00:01.00+0800"))
    assert L.resolve_tester_step(log).count() == 1


def test_unparsable_time_fails_the_comparison(spark):
    """M8: a time that does not parse is NULL; MIN skips it; an all-NULL side never matches."""
    log = _log(spark, _tester_rows("not a time", "2024-02-03 09:00:00.00+0800"))
    first = L.tester_first_start(log).collect()
    assert first[0]["time_machine_start"] is None
    assert L.resolve_tester_step(log).count() == 0
    rows = _tester_rows("2024-02-03 07:00:00.00+0800", "2024-02-03 09:00:00.00+0800")
    rows.append(dict(ma_id="L1", role="TESTER MACHINE", event_action="STARTED", resource="T1",
                     job_oid=7, date_time_local="garbage"))
    assert L.resolve_tester_step(_log(spark, rows)).count() == 1


def test_null_job_never_joins(spark):
    """M9: NULL job ids on both sides do not match."""
    log = _log(spark, _tester_rows("2024-02-03 07:00:00.00+0800", "2024-02-03 09:00:00.00+0800",
                                   job=None))
    assert L.resolve_tester_step(log).count() == 0


def test_work_week_edges(spark):
    """Thursday 11:00 boundary; before the epoch; week 52 rolls to 01 of next year."""
    cases = {
        "2016-12-29 10:59:59.00+0800": "201652",
        "2016-12-29 11:00:00.00+0800": "201701",
        "2016-01-01 00:00:00.00+0800": "201601",
        "2017-12-28 10:59:59.00+0800": "201752",
        "2017-12-28 11:00:00.00+0800": "201801",
        "2024-02-03 15:04:26.26+0800": "202407",
        "bad": None,
    }
    df = spark.createDataFrame([Row(t=k) for k in cases]).select("t", work_week("t").alias("ww"))
    got = {r.t: r.ww for r in df.collect()}
    assert got == cases
    for t, label in cases.items():
        if label:
            assert week_of(dt.datetime.fromisoformat(t[:19])) == label


def test_week_range_always_52_and_rolls_over():
    for day in range(0, 800, 37):
        as_of = dt.datetime(2017, 1, 1, 12) + dt.timedelta(days=day)
        labels = week_labels(as_of)
        assert len(labels) == 52 == len(set(labels))
        assert labels[-1] == week_of(as_of)
    labels = week_labels(dt.datetime(2024, 10, 15, 12))
    assert (labels[0], labels[-1]) == ("202344", "202443")
    assert labels[labels.index("202352") + 1] == "202401"


def test_run_windows():
    d = RunWindow.daily_as_of("2024-02-06")
    assert (d.run_date, d.lower, d.upper, d.run_path) == (
        "2024-02-03", "2024-02-03", "2024-02-04", "2024/02/03")
    a = RunWindow.archive_as_of("2024-04-01")
    # anchor = today - 53, run date = anchor - 7, window = anchor - 15 .. anchor (16 days)
    assert (a.run_date, a.lower, a.upper) == ("2024-02-01", "2024-01-24", "2024-02-08")
    assert len(a.days()) == 16


def _records(spark, entries):
    rows = [dict({f: None for f in TTE.fieldNames()}, attributes=e) for e in entries]
    return spark.createDataFrame(rows, TTE)


def test_tte_branches(spark):
    """The U-lot branch keeps NULL testers and cuts only the last U; a U-lot with a
    tester appears in both branches (bag union)."""
    recs = _records(spark, [
        {"LOT": "LUU", "STEP_ID": "HOT_TEST", "TESTER_ID": "t1"},
        {"LOT": "L2U", "STEP_ID": "BURN_IN"},
        {"LOT": "L3", "STEP_ID": "COLD_TEST"},
        {"LOT": "L4", "STEP_ID": "COLD_TEST", "TESTER_ID": "t4"},
    ])
    got = sorted((r.LOT_ID, r.STEP_ID, r.TESTER_ID) for r in A.tte_testers(recs).collect())
    assert got == sorted([
        ("LU", "HOT TEST", "t1"), ("LUU", "HOT TEST", "t1"),
        ("L2", "BURN IN", None),
        ("L4", "COLD TEST", "t4"),
    ])


def test_backfill_equals_separate_runs(log01):
    """One backfill job gives exactly the union of separate daily runs (per-run pivot)."""
    from lotwise.plans.backfill import backfill_daily
    from lotwise.plans.daily import daily_datasets

    first, last = "2024-02-03", "2024-02-05"
    v, t = backfill_daily(log01, first, last)
    for run in ("2024-02-03", "2024-02-04", "2024-02-05"):
        ds = daily_datasets(log01, RunWindow.daily(run), cache=False)
        one_v = v.where(F.col("run_date") == run).drop("run_date")
        one_t = t.where(F.col("run_date") == run).drop("run_date")
        assert one_v.exceptAll(ds.variance).count() == 0 == ds.variance.exceptAll(one_v).count()
        assert one_t.exceptAll(ds.totallot).count() == 0 == ds.totallot.exceptAll(one_t).count()
    # Adjacent runs overlap by one partition day, so a few rows repeat across run dates (M5).
    assert v.where(F.col("run_date") == "2024-02-03").count() == 100
    assert v.where(F.col("run_date") == "2024-02-04").count() == 38


def test_chunked_backfill_store_equals_one_job(spark, log01, tmp_dir):
    """run_backfill: chunks of run dates, checkpointed shared parts, stored per run date."""
    import os

    from lotwise.plans.backfill import backfill_daily, run_backfill
    from lotwise.schemas import TOTALLOT, VARIANCE
    from lotwise.sources.delimited import read_dated_store

    first, last = "2024-02-01", "2024-02-07"
    vr, tr = os.path.join(tmp_dir, "v"), os.path.join(tmp_dir, "t")
    run_backfill(log01, first, last, vr, tr, chunk_days=3)
    v, t = backfill_daily(log01, first, last)
    got_v = read_dated_store(spark, vr, VARIANCE).select(*v.columns)
    got_t = read_dated_store(spark, tr, TOTALLOT).select(*t.columns)
    assert got_v.exceptAll(v).count() == 0 == v.exceptAll(got_v).count()
    assert got_t.exceptAll(t).count() == 0 == t.exceptAll(got_t).count()
    assert len(os.listdir(vr)) >= 7


def test_archive_backfill_equals_separate_runs(spark, log01):
    """C10 for the archive job: 16-day windows, test records of each run date."""
    from conftest import SF01
    from lotwise.plans.archive import archive_datasets
    from lotwise.plans.backfill import backfill_archive
    from lotwise.sources.fixtures import tte_records

    records = tte_records(spark, SF01).cache()
    first, last = "2024-02-03", "2024-02-04"
    v, t = backfill_archive(log01, records, first, last)
    for run in (first, last):
        recs = records.where(F.col("record_date") == run).drop("record_date")
        av, at = archive_datasets(log01, recs, RunWindow.archive(run))
        one_v = v.where(F.col("run_date") == run).drop("run_date")
        one_t = t.where(F.col("run_date") == run).drop("run_date")
        assert av.count() > 0 and at.count() > 0
        assert one_v.exceptAll(av).count() == 0 == av.exceptAll(one_v).count()
        assert one_t.exceptAll(at).count() == 0 == at.exceptAll(one_t).count()


def test_backfill_from_stored_log_reads_only_chunk_days(spark, tmp_dir):
    """run_backfill_at: same rows as the in-memory backfill, each chunk reading its own days."""
    import os

    from conftest import SF001
    from lotwise.plans.backfill import backfill_daily, run_backfill_at
    from lotwise.schemas import VARIANCE
    from lotwise.sources.delimited import read_dated_store
    from lotwise.sources.eventlog import write_event_log
    from lotwise.sources.fixtures import event_log

    path = os.path.join(tmp_dir, "mam_tx")
    log = event_log(spark, SF001)
    write_event_log(log, path)
    vr, tr = os.path.join(tmp_dir, "v"), os.path.join(tmp_dir, "t")
    run_backfill_at(spark, path, "2024-02-01", "2024-02-06", vr, tr, chunk_days=2)
    v, _ = backfill_daily(log, "2024-02-01", "2024-02-06")
    got = read_dated_store(spark, vr, VARIANCE).select(*v.columns)
    assert got.exceptAll(v).count() == 0 == v.exceptAll(got).count()
