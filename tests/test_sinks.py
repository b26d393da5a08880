"""Sink/source round trips in fresh temp folders."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from lotwise.schemas import TOTALLOT, TTE, strings
from lotwise.sinks.tables import drop_table, register_report, register_store
from lotwise.sinks.text import committed_runs, write_dated, write_delimited, write_extract, write_report
from lotwise.sources.delimited import read_dated_store, read_delimited, read_report, read_table
from lotwise.sources.testrecords import read_dated_records, read_test_records, write_test_records

S3 = strings("a", "b", "c")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_delimited_null_empty_and_separator(spark, tmp_dir):
    """NULL -> \\N -> NULL, empty string stays empty; M12: separators are quoted."""
    df = spark.createDataFrame([("x,y", None, ""), ("p\x01q", "2", "3")], S3)
    for sep in ("\x01", ","):
        path = os.path.join(tmp_dir, f"d{ord(sep)}")
        write_delimited(df, path, sep=sep)
        assert _rows(read_delimited(spark, path, S3, sep=sep)) == _rows(df)
    text = "".join(open(f).read() for f in glob.glob(os.path.join(tmp_dir, "d1", "part-*")))
    assert "\\N" in text


def test_dated_store_is_idempotent_per_run_date(spark, tmp_dir):
    """K2: re-running a date replaces only that date; other dates stay."""
    root = os.path.join(tmp_dir, "store")
    a = spark.createDataFrame([("1", "a", "b")], S3)
    b = spark.createDataFrame([("2", "c", "d"), ("3", "e", None)], S3)
    write_dated(a, root, "2024-02-03")
    write_dated(b, root, "2024-02-04")
    write_dated(b, root, "2024-02-03")  # rerun of 02-03
    got = read_dated_store(spark, root, S3)
    assert got.where(F.col("run_date") == "2024-02-03").count() == 2
    assert got.where(F.col("run_date") == "2024-02-04").count() == 2
    assert dict(got.dtypes)["run_date"] == "string"
    assert [n for n in sorted(os.listdir(root)) if "=" in n] == ["run_date=2024-02-03", "run_date=2024-02-04"]
    assert committed_runs(spark, root) == {"2024-02-03", "2024-02-04"}
    # K4: one run date, headerless comma text
    out = os.path.join(tmp_dir, "extract")
    write_extract(read_dated_store(spark, root, S3), "2024-02-04", out)
    assert _rows(read_delimited(spark, out, S3, sep=",")) == _rows(b)


def test_rerun_without_rows_clears_the_date(spark, tmp_dir):
    """K2: a rerun whose result is empty leaves no rows of its dates; other dates stay."""
    root = os.path.join(tmp_dir, "store")
    df = spark.createDataFrame([(" 16 ", "\t t", "b")], S3)
    for day in ("2024-02-03", "2024-02-04", "2024-02-05"):
        write_dated(df, root, day)
    write_dated(df.limit(0), root, "2024-02-03")
    write_dated(df.limit(0).withColumn("run_date", F.lit("x")), root, run_dates=["2024-02-04"])
    got = read_dated_store(spark, root, S3)
    assert _rows(got) == [(" 16 ", "\t t", "b", "2024-02-05")]


def test_report_header_crlf_and_cleanup(spark, tmp_dir):
    """K3: header line per file, CRLF, Excel quoting; older report folders are removed."""
    root = os.path.join(tmp_dir, "report_variance")
    df = spark.createDataFrame([('say "hi", you', None, "z")], S3)
    write_report(df, root, "variance_202301-202352")
    write_report(df, root, "variance_202302-202401")
    assert os.listdir(root) == ["variance_202302-202401"]
    parts = glob.glob(os.path.join(root, "variance_202302-202401", "part-*.csv"))
    raws = [open(p, "rb").read() for p in parts]
    assert all(r.startswith(b"a,b,c\r\n") for r in raws)  # a header line in every file
    assert any(b'"say ""hi"", you",\\N,z\r\n' in r for r in raws)
    assert _rows(read_report(spark, root, S3)) == _rows(df)


WEEKLY = strings("a", "ww", "b")


def test_failed_rerun_keeps_the_old_rows(spark, tmp_dir):
    """K2: a rerun that fails midway leaves the rows as they were, and its run date unmarked."""
    root = os.path.join(tmp_dir, "store")
    df = spark.createDataFrame([(str(i), "202405", "x") for i in range(100)], WEEKLY)
    for day in ("2024-02-03", "2024-02-04"):
        write_dated(df, root, day)
    fails = df.withColumn("b", F.when(F.col("a") == "57", F.raise_error(F.lit("midway")).cast("string")).otherwise("new"))
    with pytest.raises(Exception, match="midway"):
        write_dated(fails, root, "2024-02-03")
    got = read_dated_store(spark, root, WEEKLY)
    assert got.count() == 200 and got.where("b = 'new'").count() == 0
    assert committed_runs(spark, root) == {"2024-02-04"}
    write_dated(df.limit(7), root, "2024-02-03")
    assert read_dated_store(spark, root, WEEKLY, ["2024-02-03"]).count() == 7
    assert committed_runs(spark, root) == {"2024-02-03", "2024-02-04"}


def test_rerun_drops_weeks_it_no_longer_has(spark, tmp_dir):
    """K2: run date and week are folder levels; a rerun leaves no week of an earlier run behind."""
    root = os.path.join(tmp_dir, "store")
    df = spark.createDataFrame([("1", "202405", "x"), ("2", "202406", "y"), ("3", None, "z")], WEEKLY)
    write_dated(df, root, "2024-02-03")
    write_dated(df, root, "2024-02-04")
    got = read_dated_store(spark, root, WEEKLY, ["2024-02-03"])
    assert got.columns == ["a", "ww", "b", "run_date"] and got.count() == 3 and got.where("ww IS NULL").count() == 1
    write_dated(df.where("ww = '202406'"), root, "2024-02-03")
    assert _rows(read_dated_store(spark, root, WEEKLY, ["2024-02-03"])) == [("2", "202406", "y", "2024-02-03")]
    assert read_dated_store(spark, root, WEEKLY, ["2024-02-04"]).count() == 3
    # Two run dates in one frame; one of those it stands for has no rows, others stay.
    both = df.where("a = '1'").withColumn("run_date", F.lit("2024-02-04"))
    write_dated(both, root, run_dates=["2024-02-03", "2024-02-04"])
    assert _rows(read_dated_store(spark, root, WEEKLY)) == [("1", "202405", "x", "2024-02-04")]


def test_any_text_comes_back(spark, tmp_dir):
    """Line breaks, escapes, quotes, separators and texts that look like NULL, through every store."""
    values = ["l1\nl2", "\r", "\r\n", "\\", "\\n", "\\\\n", "\\\n", "\\N", '"', 'a"b,c"', "\x01", "a\x01\n", " pad\t", "", None, "\\\\"]
    df = spark.createDataFrame([(str(i), v, values[-1 - i]) for i, v in enumerate(values)], S3)
    for sep in ("\x01", ","):
        path = os.path.join(tmp_dir, f"k1-{ord(sep)}")
        write_delimited(df, path, sep=sep)
        assert sorted(map(repr, read_delimited(spark, path, S3, sep=sep).collect())) == sorted(map(repr, df.collect()))
    write_dated(df, os.path.join(tmp_dir, "k2"), "2024-02-03")
    stored = read_dated_store(spark, os.path.join(tmp_dir, "k2"), S3)
    assert sorted(map(repr, stored.drop("run_date").collect())) == sorted(map(repr, df.collect()))
    write_report(df, os.path.join(tmp_dir, "k3"), "r")
    assert sorted(map(repr, read_report(spark, os.path.join(tmp_dir, "k3"), S3).collect())) == sorted(map(repr, df.collect()))
    write_extract(stored, "2024-02-03", os.path.join(tmp_dir, "k4"))
    assert sorted(map(repr, read_delimited(spark, os.path.join(tmp_dir, "k4"), S3, sep=",").collect())) == sorted(map(repr, df.collect()))
    lines = sum(len(open(f, newline="").read().split("\n")) - 1 for f in glob.glob(os.path.join(tmp_dir, "k4", "part-*")))
    assert lines == len(values)  # a row is a line, so files stay splittable


def test_catalog_follows_the_store(spark, tmp_dir):
    """K5: the table sees run dates as they are stored and loses those that are stored empty; K6
    drops it (also when it is not there) and keeps the files."""
    root, name = os.path.join(tmp_dir, "auto_totallot"), "t_auto_totallot"
    row = dict(zip(TOTALLOT.fieldNames(), map(str, range(len(TOTALLOT.fields)))))
    df = spark.createDataFrame([row | {"ww": w} for w in ("202405", "202406", None)], TOTALLOT)
    drop_table(spark, name)
    register_store(spark, name, TOTALLOT, root)
    register_store(spark, name, TOTALLOT, root)  # no-op
    for day in ("2024-02-03", "2024-02-04"):
        write_dated(df, root, day, table=name)
    assert spark.table(name).count() == 6 and spark.table(name).where("ww IS NULL").count() == 2
    write_dated(df.limit(0), root, "2024-02-03", table=name)
    write_dated(df.where("ww = '202406'"), root, "2024-02-04", table=name)
    got = read_table(spark, name)
    assert [(r.ww, r.run_date) for r in got.collect()] == [("202406", "2024-02-04")]
    assert [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["run_date=2024-02-04/ww=202406"]
    drop_table(spark, name)
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and os.path.isdir(os.path.join(root, "run_date=2024-02-04"))
    register_store(spark, name, TOTALLOT, root)  # over the kept files
    assert spark.table(name).count() == 1
    drop_table(spark, name)


def test_catalog_report_names(spark, tmp_dir):
    """K5: a report's table has names of its own and reads the report that replaced another."""
    root, name = os.path.join(tmp_dir, "report"), "t_report"
    old, new = (spark.createDataFrame([(x, None, "z")], strings("p_a", "p_b", "p_c")) for x in ("old", "new"))
    write_report(old, root, "r_1")
    drop_table(spark, name)
    register_report(spark, name, S3, root)
    assert _rows(spark.table(name)) == [("old", None, "z")]
    write_report(new, root, "r_2", table=name)
    assert spark.table(name).columns == ["a", "b", "c"] and _rows(spark.table(name)) == [("new", None, "z")]
    drop_table(spark, name)


def test_test_records_by_dated_glob(spark, tmp_dir):
    """S3: <root>/<source>/yyyy/MM/dd/*.parquet, one glob per day, declared nested schema."""
    rows = [dict({f: None for f in TTE.fieldNames()}, attributes={"LOT": f"L{i}"})
            for i in range(3)]
    df = spark.createDataFrame(rows, TTE)
    df.limit(2).write.parquet(os.path.join(tmp_dir, "tte", "srcA", "2024", "02", "03"))
    df.limit(1).write.parquet(os.path.join(tmp_dir, "tte", "srcB", "2024", "02", "04"))
    got = read_test_records(spark, os.path.join(tmp_dir, "tte"), ["2024-02-03"])
    assert got.count() == 2
    assert got.schema == TTE
    days = ["2024-02-03", "2024-02-04", "2024-02-05"]  # the last has no files
    both = read_dated_records(spark, os.path.join(tmp_dir, "tte"), days)
    assert sorted(r.record_date for r in both.collect()) == ["2024-02-03", "2024-02-03", "2024-02-04"]
    with pytest.raises(FileNotFoundError):
        read_test_records(spark, os.path.join(tmp_dir, "tte"), days[2:])


def test_test_records_are_stored_by_day(spark, tmp_dir):
    """The staging of test records: the layout that is read, and a day stored again is replaced."""
    root = os.path.join(tmp_dir, "tte")
    rows = [dict({f: None for f in TTE.fieldNames()}, attributes={"LOT": f"L{i}"}) for i in range(5)]
    df = spark.createDataFrame(rows, TTE).withColumn("record_date", F.concat(F.lit("2024-02-0"), (F.substring(F.col("attributes")["LOT"], 2, 1).cast("int") % 2 + 1).cast("string")))
    for _ in range(2):
        write_test_records(df, root, "src")
    got = read_dated_records(spark, root, ["2024-02-01", "2024-02-02"])
    assert got.groupBy("record_date").count().orderBy("record_date").collect() == [("2024-02-01", 3), ("2024-02-02", 2)]


def test_event_log_day_folders(spark, tmp_dir):
    """A day-scoped read lists only the named folders and keeps partition_date a string."""
    from lotwise.sources.eventlog import read_event_log, write_event_log
    from lotwise.sources.fixtures import event_log
    from conftest import SF001

    path = os.path.join(tmp_dir, "mam_tx")
    write_event_log(event_log(spark, SF001), path)
    full = read_event_log(spark, path)
    days = ["2024-02-03", "2024-02-04", "1999-01-01"]  # the last has no folder
    part = read_event_log(spark, path, days)
    assert dict(part.dtypes)["partition_date"] == "string"
    assert part.inputFiles() and all("2024-02-0" in f for f in part.inputFiles())
    want = full.where(F.col("partition_date").isin(*days))
    assert part.count() == want.count() > 0
    assert part.exceptAll(want).count() == 0 == want.exceptAll(part).count()
    with pytest.raises(FileNotFoundError):
        read_event_log(spark, path, ["1999-01-01", "1999-01-02"])
