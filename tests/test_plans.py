"""Physical-plan shape of the daily job over a partitioned Parquet log."""

from __future__ import annotations

import contextlib
import io
import os
import re

import pytest

from conftest import SF001
from pyspark.sql import functions as F

from lotwise.operators import archive as A
from lotwise.operators import lots as L
from lotwise.operators.scope import scoped_window
from lotwise.params import RunWindow
from lotwise.plans.archive import archive_datasets
from lotwise.plans.backfill import backfill_daily, run_backfill
from lotwise.plans.daily import daily_datasets
from lotwise.plans.weekly import weekly_report
from lotwise.schemas import EVENT_LOG, TOTALLOT
from lotwise.sources.delimited import read_dated_store
from lotwise.sources.eventlog import read_event_log, write_event_log
from lotwise.sources.fixtures import event_log, tte_records


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "mam_tx")
    write_event_log(event_log(spark, SF001), path)
    log = read_event_log(spark, path)
    assert len(os.listdir(path)) > 300  # one folder per partition date
    ds = daily_datasets(log, RunWindow.daily("2024-02-03"), cache=False)
    return {"variance": explain(ds.variance), "totallot": explain(ds.totallot),
            "weekly": explain(weekly_report(ds.variance, "variance", ["202405", "202406"]))}


@pytest.mark.parametrize("name", ["variance", "totallot"])
def test_scans_are_pruned_and_pushed(plans, name):
    text = plans[name]
    scans = re.findall(r"\(\d+\) Scan parquet.*?(?=\n\(\d+\) )", text, flags=re.S)
    assert len(scans) >= 4
    for scan in scans:
        assert "PartitionFilters: [isnotnull(partition_date" in scan
        assert "(partition_date#" in scan and ">= 2024-02-03" in scan and "<= 2024-02-04" in scan
        pushed = re.search(r"PushedFilters: \[(.*)\]", scan).group(1)
        for f in ("EqualTo(ma_type,LOT)", "EqualTo(system_name,MAMTSTSI)",
                  "EqualTo(facility_id,TEST-MSA)"):
            assert f in pushed
        read = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
        assert read.count(":") <= 9, read  # a narrow projection, never all 19 columns


@pytest.mark.parametrize("name", ["variance", "totallot", "weekly"])
def test_no_python_and_no_forced_broadcast(plans, name):
    text = plans[name]
    assert "EvalPython" not in text and "PythonUDF" not in text
    # Joins are sort-merge until AQE measures a side small enough.
    assert "BroadcastExchange" not in text and "BroadcastHashJoin" not in text


def test_variance_shuffle_count(plans):
    physical = plans["variance"].split("\n\n")[0]
    # 5 branch aggregates (the pivot has two), the DISTINCTs of J3, J2 and J4, both sides of 4 joins.
    assert physical.count("Exchange") <= 17


def test_pivot_is_reduced_by_hash_first(spark):
    """A1, A4: only a lot's distinct values reach the sort-based MAX of text."""
    text = explain(L.attribute_pivot(event_log(spark, SF001)))
    physical = text.split("\n\n")[0]
    assert physical.index("SortAggregate") < physical.index("Sort ") < physical.index("HashAggregate")


def test_week_list_prunes_folders(spark, tmp_path_factory):
    """The report reads only the folders of its weeks."""
    root = str(tmp_path_factory.mktemp("history"))
    run_backfill(event_log(spark, SF001), "2024-01-20", "2024-02-20", f"{root}/v", f"{root}/t", chunk_days=None)
    history = read_dated_store(spark, f"{root}/t", TOTALLOT)
    weeks = ["202406", "202407"]
    report = weekly_report(history, "totallot", weeks)
    scan = explain(report).split("\n\n(1) Scan csv")[1].split("\n\n(2)")[0]
    assert re.search(r"PartitionFilters: \[.*ww#\d+ IN \(202406,202407\)", scan), scan
    assert 0 < report.count() < weekly_report(history, "totallot", ["202408", *weeks]).count()


# ---- hot keys ------------------------------------------------------------------------------

SPLIT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
HOT, ROWS = "HOT", 40_000


@pytest.fixture()
def split_conf(spark):
    before = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _hot_log(spark):
    """A log in which one lot, with one job and one step, has half of all quantity rows and variance
    events; 400 other lots share the rest. The lot's times differ, so nothing collapses."""
    hot, other = F.col("id") % 2 == 0, (F.col("id") % 401).cast("string")
    base = spark.range(ROWS).select(
        "id", F.when(hot, HOT).otherwise(F.concat(F.lit("L"), other)).alias("ma_id"),
        F.when(hot, 7).otherwise(1000 + F.col("id") % 401).cast("bigint").alias("job"))
    time = F.concat(F.lit("2024-02-03 "), F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":00:00."),
                    F.lpad((F.col("id") % 100).cast("string"), 2, "0"), F.lit("+0800"))
    fixed = [F.lit("LOT").alias("ma_type"), F.lit("MAMTSTSI").alias("system_name"), F.lit("TEST-MSA").alias("facility_id"),
             F.lit("2024-02-03").alias("partition_date")]

    def rows(df, **values):
        return df.select(*[F.col(c) if c in ("ma_id",) else values[c].alias(c) if c in values else next(
            (f for f in fixed if f._jc.toString().endswith(f" AS {c}")), F.lit(None).cast(t).alias(c))
            for c, t in [(f.name, f.dataType.simpleString()) for f in EVENT_LOG.fields]])

    lots = base.select("ma_id", "job").distinct()
    return (rows(base, attribute_id=F.lit("CURRENT QTY"), attribute_prior_value=F.col("id").cast("string"),
                 job_oid=F.col("job"), date_time_local=time)
            .unionByName(rows(base.where("id < 4000"), reason=F.lit("VARIANCE"), action=F.col("id").cast("string"), location=F.lit("HOT TEST"),
                              quantity=F.lit("1"), step_job_oid=F.col("job"), date_time_local=time))
            .unionByName(rows(lots, role=F.lit("TESTER MACHINE"), event_action=F.lit("STARTED"), resource=F.lit("T1"),
                              job_oid=F.col("job"), date_time_local=F.lit("2024-02-03 01:00:00.00+0800")))
            .unionByName(rows(lots, event_type=F.lit("GenealogyChanged"), location=F.lit("HOT TEST"), step_job_oid=F.col("job"),
                              date_time_local=F.lit("2024-02-03 09:00:00.00+0800")))
            .unionByName(rows(lots, attribute_id=F.lit("DESIGN ID"), attribute_value=F.lit("D1"))))


def _skewed_joins(df) -> list[str]:
    """The joins of the executed plan that were split, by their left keys."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"SortMergeJoin\(skew=true\) \[(.*?)\]", re.sub(r"#\d+L?", "", plan))


def test_hot_keys_are_split_in_every_join(spark, split_conf, tmp_path_factory):
    """One (lot, job), (lot, step) or lot with half of all rows is joined by
    several tasks; the rows are those of a plan that doesn't split."""
    path = str(tmp_path_factory.mktemp("hot") / "log")
    _hot_log(spark).write.parquet(path)
    log = spark.read.schema(EVENT_LOG).parquet(path)
    scoped = scoped_window(log, RunWindow.daily("2024-02-03"))
    quantity, steps, pivot = L.lot_quantity(scoped), L.resolve_tester_step(scoped), L.attribute_pivot(scoped)
    assert "LOT_ID, job_oid" in _skewed_joins(L.lot_step(quantity, steps))  # J2
    few = quantity.where(F.col("LOT_QTY").cast("int") < 60)  # J4 multiplies a hot job's rows
    events = L.variance_events(scoped)
    j4 = L.variance_rows(pivot, events, L.lot_step(few, steps))
    assert "LOT_ID, step_job_oid" in _skewed_joins(j4)
    assert any(j.startswith("LOT_ID, ") and "job" not in j for j in _skewed_joins(L.totallot_rows(pivot, L.lot_step(quantity, steps, keep_step_job=False))))  # J5
    testers = path.replace("/log", "/testers")
    lots = quantity.select("LOT_ID").distinct().crossJoin(spark.range(2))
    lots.select("LOT_ID", F.lit("HOT TEST").alias("STEP_ID"), F.col("id").cast("string").alias("TESTER_ID"),
                F.lit("1").alias("SPEED"), F.lit("2").alias("TEMPERATURE")).write.parquet(testers)
    testers = spark.read.parquet(testers)
    total = A.archive_totallot(scoped, testers)
    assert "LOT_ID, STEP_ID" in _skewed_joins(total) and any("_lot_part" in j for j in _skewed_joins(total))  # J8, J9
    st = A.steps_of(A.archive_quantity(scoped.where(F.col("attribute_prior_value").cast("int") < 20), with_time=False),
                    A.genealogy_steps(scoped), with_time=False)
    variance = A.archive_variance(scoped, testers, steps=st)
    split = _skewed_joins(variance)
    assert "LOT_ID, STEP_ID" in split and any("_lot_part" in j for j in split)  # J7, J10
    rows = {name: sorted(map(str, df.collect())) for name, df in (("total", total), ("variance", variance), ("j4", j4))}
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert rows["total"] == sorted(map(str, A.archive_totallot(scoped, testers).collect()))
        assert rows["variance"] == sorted(map(str, A.archive_variance(scoped, testers, steps=st).collect()))
        assert rows["j4"] == sorted(map(str, L.variance_rows(pivot, events, L.lot_step(few, steps)).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_building_a_query_starts_no_job(spark, tmp_path_factory):
    """The datasets are declared without a look at the data."""
    path = str(tmp_path_factory.mktemp("lazy") / "mam_tx")
    write_event_log(event_log(spark, SF001), path)
    log, records, group = read_event_log(spark, path), tte_records(spark, SF001).drop("record_date"), "building"
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        ds = daily_datasets(log, RunWindow.daily("2024-02-03"), cache=True)
        backfill_daily(log, "2024-02-01", "2024-02-09")
        archive_datasets(log, records, RunWindow.archive("2024-02-03"))
        assert not sc.statusTracker().getJobIdsForGroup(group)
        ds.release()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
