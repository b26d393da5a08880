"""Work that must not grow with the number of event kinds, runs or stores: plans and row counts."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lotwise import files
from lotwise import queries as Q
from lotwise.operators import archive as A
from lotwise.operators import lots as L
from lotwise.operators.scope import scoped_window
from lotwise.params import RunWindow
from lotwise.plans import daily
from lotwise.plans.archive import archive_datasets
from lotwise.plans.backfill import Runs, backfill_archive, backfill_daily
from lotwise.plans.daily import daily_datasets
from lotwise.plans.weekly import report_name
from lotwise.schemas import EVENT_LOG, REPORT_TABLE_VARIANCE, REPORT_VARIANCE, TOTALLOT, TOTALLOT_COLUMNS, VARIANCE
from lotwise.functions.workweek import week_labels
from lotwise.session import checkpoint_root
from lotwise.sinks.text import write_dated, write_delimited, write_extract, write_report
from lotwise.sources.delimited import read_dated_store
from lotwise.sources.eventlog import read_event_log, write_event_parts
from lotwise.sources.fixtures import event_kinds, event_log
from test_plans import explain


@pytest.mark.parametrize("build, lineitem", [
    (L.tester_first_start, {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"}),
    (L.lot_quantity, {"l_orderkey", "l_partkey", "l_linenumber", "l_quantity"}),
    (L.genealogy_last_change, {"l_orderkey", "l_partkey", "l_linenumber"}),
])
def test_a_reader_of_one_event_kind_derives_that_kind_only(spark, build, lineitem):
    text = explain(build(scoped_window(event_log(spark, SF001), Q.WIDE)))
    assert "Generate" not in text and "Union" not in text
    read = [line.split("struct<")[1].rstrip(">") for line in text.splitlines() if line.startswith("ReadSchema")]
    assert sorted(len(r.split(",")) for r in read) == sorted([1, len(lineitem)])
    assert {c.split(":")[0] for r in read for c in r.split(",") if c.startswith("l_")} == lineitem


def _counted(spark, schema, **values):
    """12 rows of text, and an accumulator of how many were computed."""
    n = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            n.add(len(b))
            yield b

    rows = spark.range(12).select(*[values.get(c, F.concat(F.lit(c), F.col("id").cast("string"))).cast("string").alias(c)
                                    for c in schema.fieldNames()])
    return rows.mapInPandas(count, rows.schema), n


def test_stored_runs_take_their_parts_from_rows_computed_once(spark):
    rows, n = _counted(spark, VARIANCE, LOT_QTY=F.col("id") % 12, PRODUCT_FAMILY=F.lit("abc"), ww=F.lit("202405"))
    got = Q._catalog_runs(spark, rows, VARIANCE, "lotwise_test_runs_once")
    # lengths 3 + 1 and 3 + 2: the runs of ten and of two rows; the rerun of the second has none of length 2
    assert sorted((r.run_date, r["count"]) for r in got.groupBy("run_date").count().collect()) == [(Q.RERUNS[2], 2)]
    assert n.value == 12


def test_a_report_and_the_older_one_come_from_rows_computed_once(spark):
    labels = week_labels(Q.AS_OF)
    rows, n = _counted(spark, REPORT_VARIANCE, variance_ww=F.when(F.col("id") < 5, labels[0]).otherwise(labels[1]))
    got = Q._catalog_report(spark, rows, "variance", REPORT_TABLE_VARIANCE)
    assert got.count() == 12 and n.value == 12
    assert all(report_name("variance", labels) in f for f in got.inputFiles())


def test_both_extracts_share_stored_parts(spark, monkeypatch):
    stored, real = [], Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda df, name: stored.append(name) or real(df, name))
    assert Q.q_daily_extract_both(spark, SF001).count() > 0
    assert stored == ["pivot", "steps", "both-variance", "both-totallot"]


def test_rows_are_copied_only_to_runs_of_their_lots(spark):
    runs = Runs("2024-02-01", "2024-02-20", RunWindow.archive("2024-02-01"),
                lots=spark.createDataFrame([("2024-02-03", "A"), ("2024-02-19", "A"), ("2024-02-03", "B"), (None, "A")],
                                           "run_date string, LOT_ID string"))
    rows = spark.createDataFrame([("A", "2024-02-03"), ("C", "2024-02-03"), ("B", None), (None, "2024-02-03"), ("A", "no day")],
                                 "LOT_ID string, partition_date string")
    every = Runs(runs.first, runs.last, runs.template).copies(rows)
    wanted = every.join(runs.lots, ["run_date", "LOT_ID"], "left_semi").select(*rows.columns, "run_date")
    assert sorted(runs.copies(rows).collect()) == sorted(wanted.collect()) != []
    assert runs.copies(rows).columns == every.columns


def test_archive_backfill_pivots_a_lot_for_the_runs_that_test_it(spark):
    days = [(dt.date(2024, 2, 1) + dt.timedelta(days=i)).isoformat() for i in range(20)]
    records = Q.tte_records(spark, SF001)
    tested = A.tte_testers(records.where(F.col("record_date").between(days[0], days[-1]))
                           .withColumnRenamed("record_date", "run_date"), ("run_date",)).select("run_date", "LOT_ID").distinct()
    parts = {}
    backfill_archive(event_log(spark, SF001), records, days[0], days[-1], keep=lambda df, name: parts.setdefault(name, df))
    pivots = parts["pivot"].select("run_date", "LOT_ID")
    assert pivots.count() > 0 and pivots.exceptAll(tested).count() == 0


def test_archive_variance_deals_the_rows_once_between_its_joins(spark):
    """Events x steps are distinct as they are: no DISTINCT between that join and the testers'."""
    ds = archive_datasets(event_log(spark, SF001), Q.tte_records(spark, SF001), Q.WIDE)[0]
    physical = explain(ds).split("\n\n")[0]
    # pivot 2, events, quantity, genealogy, steps' DISTINCT, testers' and rows' DISTINCTs, both sides of 4 joins and
    # of the 6 derivations' joins
    assert physical.count("Exchange") <= 28


def test_events_hash_the_parts(spark):
    """Every kind of event reads the lines' join with the parts; none sorts the lines for it."""
    physical = explain(event_log(spark, SF001)).split("\n\n")[0]
    assert physical.count("ShuffledHashJoin") == 5 and "SortMergeJoin" not in physical


def test_both_datasets_come_from_lot_steps_computed_once(spark):
    """J2 is stored once, with the step job; the total lots are made of it and have the same rows."""
    log, parts = event_log(spark, SF001), {}
    shared = backfill_daily(log, "2024-01-01", "2024-03-31", keep=lambda df, name: parts.setdefault(name, df))
    assert {"LOT_QTY", "step_job_oid"} <= set(parts["steps"].columns)
    for mine, own in zip(shared, backfill_daily(log, "2024-01-01", "2024-03-31")):
        assert mine.count() > 0 and mine.exceptAll(own).count() == own.exceptAll(mine).count() == 0
    ds, alone = (daily_datasets(log, Q.WIDE, cache=c) for c in (True, False))
    try:
        assert any("LOT_QTY" in df.columns for df in ds.cached)
        for mine, own in ((ds.variance, alone.variance), (ds.totallot, alone.totallot)):
            assert mine.count() > 0 and mine.exceptAll(own).count() == own.exceptAll(mine).count() == 0
    finally:
        ds.release()


def test_tasks_that_explode_lines_to_attributes_are_not_merged(spark):
    """AQE merges partitions by the size of the lines; a task's hash aggregate of the pivot holds eight rows for each."""
    text = explain(L.attribute_pivot(event_log(spark, SF001)))
    assert "REPARTITION_BY_NUM" in text and "REPARTITION_BY_NUM" not in explain(L.lot_quantity(event_log(spark, SF001)))


def _pivot_log(spark):
    rows = [("A", "DESIGN ID", "D1"), ("A", "DESIGN ID", "D2"), ("A", "LEAD COUNT", "9"), ("A", "LEAD COUNT", "16"),
            ("B", "LEAD COUNT", "4"), ("B", "PACKAGE WIDTH", "1"), ("C", "NOT LISTED", "x"), ("D", "DESIGN ID", None),
            (None, "PACKAGE TYPE", "P"), (None, "DESIGN ID", "D0"), ("E", None, "y")]
    return spark.createDataFrame(rows * 2, "ma_id string, attribute_id string, attribute_value string")


def test_pivot_of_some_columns_keeps_every_lot(spark):
    log = _pivot_log(spark)
    every, some = L.attribute_pivot(log), L.attribute_pivot(log, columns=TOTALLOT_COLUMNS)
    assert {r.LOT_ID: r.LEAD_COUNT for r in every.collect()} == {"A": "9", "B": "4", "D": None, None: None}
    assert set(some.columns) < set(every.columns) and "DESIGN_ID" in some.columns
    assert sorted(some.collect(), key=str) == sorted(every.select(some.columns).collect(), key=str)


def test_total_lots_pivot_their_own_columns(spark):
    """Attributes that a dataset lacks are one row a lot and task, without a value, before the pivot's shuffle."""
    log, records = event_log(spark, SF001), Q.tte_records(spark, SF001)
    scoped = scoped_window(log, Q.WIDE)
    for df in (daily_datasets(log, Q.WIDE, cache=False).totallot, A.archive_totallot(scoped, A.tte_testers(records)),
               backfill_daily(log, "2024-01-01", "2024-01-31")[1]):
        assert "STEP_TEMPERATURE" not in explain(df)


def _exchanges(df) -> int:
    return explain(df).split("\n\n")[0].count("Exchange")


def test_joins_of_distinct_parts_are_not_made_distinct_again(spark):
    """What joins distinct parts and keeps their columns deals its rows for the next join only."""
    log, records = event_log(spark, SF001), Q.tte_records(spark, SF001)
    scoped = scoped_window(log, Q.WIDE)
    started, changed = L.tester_first_start(scoped), L.genealogy_last_change(scoped)
    steps = L.tester_step(started, changed)
    assert _exchanges(steps) == _exchanges(started) + _exchanges(changed) + 2
    testers, pivot = A.tte_testers(records), L.attribute_pivot(scoped)
    given = A.archive_steps(scoped, with_time=True)
    total = A.archive_totallot(scoped, testers, pivot=pivot, steps=given)
    kept = testers.select("LOT_ID", "STEP_ID", F.upper("TESTER_ID")).distinct()
    assert _exchanges(total) == _exchanges(given) + _exchanges(kept) + _exchanges(pivot) + 4
    for df in (steps, total, A.archive_variance(scoped, testers.union(testers), pivot=pivot)):
        assert df.count() == df.distinct().count() > 0


def test_distinct_rows_from_repeated_and_null_events(spark):
    """Copies of every event and record, and a tester, step and job that are NULL, give each row once."""
    day, time = "2024-02-03", "2024-02-03 {}:00:00.00+0800"
    columns = "ma_id, attribute_id, attribute_value, attribute_prior_value, reason, action, location, quantity, step_job_oid, job_oid, " \
              "date_time_local, resource, role, event_action, event_type, partition_date".split(", ")
    events = [dict(role="TESTER MACHINE", event_action="STARTED", resource=r, job_oid=j, date_time_local=time.format("08"))
              for r in ("T1", "T2", None) for j in (7, None)]
    events += [dict(event_type="GenealogyChanged", location=s, step_job_oid=j, date_time_local=time.format(h))
               for s in ("HOT", None) for j in (7, None) for h in ("07", "09", "10")]
    events += [dict(attribute_id="CURRENT QTY", attribute_prior_value="5", job_oid=7, date_time_local=time.format("15")),
               dict(attribute_id="DESIGN ID", attribute_value="D", date_time_local=time.format("06")),
               dict(reason="VARIANCE", action="HOLD", location="HOT", quantity="1", step_job_oid=7, date_time_local=time.format("14"))]
    rows = [[{"ma_id": "A", "partition_date": day, **e}.get(c) for c in columns] for e in events * 2]
    log = spark.createDataFrame(rows, ", ".join(f"{c} {'bigint' if c.endswith('oid') else 'string'}" for c in columns))
    steps = L.resolve_tester_step(log).collect()
    assert sorted(map(str, steps)) == sorted({str(r) for r in steps}) and len(steps) == 6
    testers = spark.createDataFrame([("A", "HOT", t, "1", "2") for t in ("x", "X", None)] * 2,
                                    "LOT_ID string, STEP_ID string, TESTER_ID string, SPEED string, TEMPERATURE string")
    for build in (A.archive_variance, A.archive_totallot):
        assert sorted(str(r.TESTER_ID) for r in build(log, testers).collect()) == ["None", "X"]


def test_testers_read_the_records_once(spark):
    """Both branches in one pass; the same bag as two passes that are put together."""
    assert explain(A.tte_testers(Q.tte_records(spark, SF001))).split("\n\n")[0].count("Scan parquet") == 2  # lines and parts
    maps = [{"LOT": "AU", "STEP_ID": "A_B_", "TESTER_ID": "t"}, {"LOT": "U", "STEP_ID": "_"}, {"LOT": "BUU", "SPEED": "1"}, {"LOT": "Cu", "TESTER_ID": ""},
            {"TESTER_ID": "t", "TEMPERATURE": "2"}, {"LOT": "D"}, {"LOT": "", "TESTER_ID": "t"}, {}, None]
    records = spark.createDataFrame([(m,) for m in maps] * 2, "attributes map<string,string>")
    raw = A.tte_fields(records).withColumn("STEP_ID", F.regexp_replace("STEP_ID_RAW", "_", " "))
    rest = ["STEP_ID", "TESTER_ID", "SPEED", "TEMPERATURE"]
    two = raw.where(F.col("LOT_ID_RAW").endswith("U")).select(F.expr("left(LOT_ID_RAW, length(LOT_ID_RAW) - 1)").alias("LOT_ID"), *rest).union(
        raw.where("TESTER_ID is not null").select(F.col("LOT_ID_RAW").alias("LOT_ID"), *rest))
    got = A.tte_testers(records)
    assert got.columns == two.columns and sorted(map(str, got.collect())) == sorted(map(str, two.collect())) and got.count() == 14


# ---- parts that are stored one after the other ----------------------------------------------


@pytest.mark.parametrize("name", ["variance_daily", "totallot_daily", "weekly_variance", "variance_two_reasons", "archive_variance", "archive_totallot",
                                  "archive_variance_two_reasons", "backfill_variance", "backfill_totallot", "weekly_variance_history"])
def test_the_pivots_shuffles_end_before_the_last_joins(spark, name):
    """What is left to run when a query is returned reads stored parts: no attribute is derived or pivoted beside its joins."""
    text = explain(Q.QUERIES[name](spark, SF001))
    assert "p_name" not in text and "SortAggregate" not in text
    assert "LOT_ID" in text and "Join" in text


def _shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {n for n in (blocks.apply(i).name() for i in range(blocks.size())) if n.startswith("shuffle_")}


def _until(check, seconds: float = 20) -> bool:
    end = time.time() + seconds
    while not check() and time.time() < end:
        time.sleep(0.2)
    return check()


def test_shuffles_end_with_the_stores_writes(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i % 7}", "2024-02-03", "202405") for i in range(50)], "a string, run_date string, ww string")
    rows = rows.groupBy("a", "run_date", "ww").count().select("a", F.col("count").cast("string").alias("n"), "run_date", "ww")
    for write in (lambda i: write_delimited(rows, f"{tmp_path}/k1-{i}"), lambda i: write_dated(rows, f"{tmp_path}/k2-{i}", run_dates=["2024-02-03"]),
                  lambda i: write_report(rows, f"{tmp_path}/k3-{i}", "r"), lambda i: write_extract(rows, "2024-02-03", f"{tmp_path}/k4-{i}")):
        before = _shuffle_files(spark)
        write(0)
        assert _until(lambda: not _shuffle_files(spark) - before)
    assert spark.read.csv(f"{tmp_path}/k1-0", sep="\x01").count() == 7


def test_a_log_stored_by_kinds_has_the_logs_rows(spark, tmp_path):
    """The base rows are dealt by day, not the events made of them; a day's rows are sorted once."""
    kinds = event_kinds(spark, SF001, by_day=True)
    assert all(explain(k).split("\n\n")[0].count("Exchange") == 3 for k in kinds)
    write_event_parts(kinds, f"{tmp_path}/log")
    log, stored = event_log(spark, SF001), read_event_log(spark, f"{tmp_path}/log").select(*EVENT_LOG.fieldNames())
    assert log.exceptAll(stored).count() == stored.exceptAll(log).count() == 0 < stored.count()
    for day in {r.partition_date for r in stored.select("partition_date").distinct().limit(3).collect()}:
        got = spark.read.parquet(f"{tmp_path}/log/partition_date={day}").select("date_time_local").collect()
        assert got and all(r.date_time_local.startswith(day) for r in got)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):  # a log is not put beside another one
        write_event_parts(kinds, f"{tmp_path}/log")


def test_the_daily_jobs_parts_go_with_its_end(spark, tmp_path, monkeypatch):
    log, roots = event_log(spark, SF001), [f"{tmp_path}/v", f"{tmp_path}/t"]
    left = lambda: [n for n in files.names(spark, checkpoint_root(spark)) if "lotwise-daily-2024-02-03" in n]
    daily.run_daily_job(log, RunWindow.daily("2024-02-03"), *roots)
    for root, schema, wanted in zip(roots, (VARIANCE, TOTALLOT), (lambda d: d.variance, lambda d: d.totallot)):
        got, want = read_dated_store(spark, root, schema).drop("run_date"), wanted(daily_datasets(log, RunWindow.daily("2024-02-03"), cache=False))
        assert got.exceptAll(want).count() == want.exceptAll(got.select(want.columns)).count() == 0
    assert left() == []
    seen = []

    def fails(*_, **__):
        seen.extend(left())
        raise RuntimeError("disk")

    monkeypatch.setattr(daily, "write_dated", fails)
    with pytest.raises(RuntimeError):
        daily.run_daily_job(log, RunWindow.daily("2024-02-03"), *roots)
    assert seen and left() == []
