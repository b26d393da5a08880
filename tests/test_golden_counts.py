"""Row counts on which Spark and DuckDB agreed in the survey (FIXTURES.md section 5).

A: sf0.01, run window 2024-02-03..2024-02-04. B: sf0.001, window 2024-02-01..2024-03-01.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lotwise.operators import archive as A
from lotwise.operators import lots as L
from lotwise.operators.scope import scoped_window
from lotwise.params import RunWindow
from lotwise.plans.daily import daily_datasets
from lotwise.sources.fixtures import event_log, tte_records

WIN_A = RunWindow.span("2024-02-03", "2024-02-04")
WIN_B = RunWindow.span("2024-02-01", "2024-03-01")


@pytest.fixture(scope="module")
def scoped_a(log01):
    return scoped_window(log01, WIN_A).cache()


def test_whole_log_rows(log01, spark):
    assert log01.count() == 645_800
    assert event_log(spark, SF001).count() == 64_234


def test_operator_counts_a(scoped_a):
    assert scoped_a.count() == 2_847
    pivot = L.attribute_pivot(scoped_a)
    assert pivot.count() == 59
    assert pivot.where(F.col("STEP_TEMPERATURE").isNull()).count() == 30
    assert L.variance_events(scoped_a).count() == 87
    assert L.lot_quantity(scoped_a).count() == 247
    assert L.tester_first_start(scoped_a).count() == 255
    assert L.genealogy_last_change(scoped_a).count() == 203
    steps = L.resolve_tester_step(scoped_a)
    assert steps.count() == 172
    assert L.lot_step(L.lot_quantity(scoped_a), steps).count() == 169
    assert L.variance_attributes(pivot, L.variance_events(scoped_a)).count() == 79


def test_daily_datasets_a(log01):
    ds = daily_datasets(log01, WIN_A, cache=False)
    assert ds.variance.count() == 100
    assert ds.totallot.count() == 156


def test_daily_datasets_b(spark):
    ds = daily_datasets(event_log(spark, SF001), WIN_B, cache=True)
    try:
        assert ds.variance.count() == 144
        assert ds.totallot.count() == 299
    finally:
        ds.release()


def test_archive_counts_a(spark, scoped_a):
    from conftest import SF01

    recs = tte_records(spark, SF01).where(F.col("record_date").between(WIN_A.lower, WIN_A.upper))
    testers = A.tte_testers(recs)
    assert testers.count() == 292
    assert testers.where(F.col("TESTER_ID").isNull()).count() == 18
    assert A.archive_steps(scoped_a, with_time=True).count() == 164
    assert A.archive_steps(scoped_a, with_time=False).count() == 164
    assert A.archive_variance(scoped_a, testers).drop("ww").distinct().count() == 301
    assert A.archive_totallot(scoped_a, testers).drop("ww").distinct().count() == 300


def test_wide_window_counts(log01):
    wide = RunWindow.span("2023-10-01", "2024-11-30")
    ds = daily_datasets(log01, wide, cache=False)
    assert ds.variance.count() == 21_316
    assert ds.totallot.count() == 40_650
