"""Text sinks (K1-K4). The codec is that of ``sources.delimited``: a value can neither shift columns
nor split rows, and comes back unchanged."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..session import shuffles_end
from ..sources.delimited import CTRL_A, TEXT_OPTIONS, WEEK, escaped
from .tables import refresh_table, sync_partitions

# The CSV writer trims values by default; stored text must come back unchanged.
WRITE_OPTIONS = {**TEXT_OPTIONS, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
MARKERS = "_runs"  # of committed run dates; readers skip names with an underscore


def _encoded(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*[escaped(F.col(c)).alias(c) if t == "string" and c not in keep else F.col(c) for c, t in df.dtypes])


def write_delimited(df: DataFrame, path: str, sep: str = CTRL_A) -> None:
    """K1: replace a folder with separator-delimited text, NULL as ``\\N``."""
    with shuffles_end(df.sparkSession):
        _encoded(df).write.mode("overwrite").options(sep=sep, **WRITE_OPTIONS).csv(path)


def write_dated(df: DataFrame, root: str, run_date: str | None = None, run_dates: Iterable[str] = (),
                table: str | None = None) -> None:
    """K2: idempotent store ``<root>/run_date=<date>[/ww=<week>]/``, comma separated.

    ``run_date`` stamps a single run; a backfill frame brings its own column, and ``run_dates`` lists
    those it stands for. Other run dates stay as they are. The steps of a store:

    1. the markers of the run dates go;
    2. the rows are written, each folder replaced as Spark commits the job (until then a failure
       leaves the old rows in place);
    3. what was there before and is there still is left over from an earlier run (a run date that
       has no rows any more, a week that a rerun no longer has) and goes;
    4. the folders are added to, or taken from, the catalog's ``table``;
    5. each run date gets its marker.

    So a marker says that a run date is complete, and a run that fails midway has none.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    if run_date is not None:
        df = df.withColumn("run_date", F.lit(run_date))
        run_dates = (run_date,)
    run_dates = list(run_dates)
    levels = ["run_date", *([WEEK] if WEEK in df.columns else [])]
    marked = set(files.names(spark, f"{root}/{MARKERS}"))
    files.delete(spark, [f"{root}/{MARKERS}/{d}" for d in run_dates if d in marked])
    present = [n.removeprefix("run_date=") for n in files.names(spark, root) if n.startswith("run_date=")]
    before = {d: files.files_below(spark, f"{root}/run_date={d}") for d in present if d in run_dates or not run_dates}
    with shuffles_end(spark):
        (
            # Cluster rows by run date so each folder gets few files; AQE splits a run date that is
            # too large for one task and merges small ones (no skewed single-task write).
            _encoded(df, *levels).hint("rebalance", "run_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(sep=",", **WRITE_OPTIONS)
            .partitionBy(*levels)
            .csv(root)
        )
    for day, old in before.items():
        now = files.files_below(spark, f"{root}/run_date={day}")
        if now <= old and day not in run_dates:
            continue  # a run date that this frame does not stand for
        left = {f for f in now & old if not f.rsplit("/", 1)[1].startswith(("_", "."))}
        files.delete(spark, {f.rsplit("/", 1)[0] for f in left} if now - old else [f"{root}/run_date={day}"])
    if table is not None:
        sync_partitions(spark, table, root, run_dates, levels)
    files.touch(spark, [f"{root}/{MARKERS}/{d}" for d in run_dates])


def committed_runs(spark: SparkSession, root: str) -> set[str]:
    """The run dates that a store holds completely, those without rows too."""
    return set(files.names(spark, f"{root.rstrip('/')}/{MARKERS}"))


def write_report(df: DataFrame, root: str, name: str, table: str | None = None) -> str:
    """K3: a report folder ``<root>/<name>`` with a header line per file, comma separated,
    CRLF line ends, Excel-style quoting; older report folders under ``root`` are removed, and the
    catalog's ``table`` reads the new one."""
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{name}"
    with shuffles_end(spark):
        _encoded(df).write.mode("overwrite").options(header=True, sep=",", lineSep="\r\n", **WRITE_OPTIONS).csv(path)
    files.delete(spark, [f"{root.rstrip('/')}/{n}" for n in files.names(spark, root) if n != name])
    if table is not None:
        refresh_table(spark, table)
    return path


def write_extract(stored: DataFrame, run_date: str, path: str) -> None:
    """K4: the rows of one run date of a stored dataset, as headerless comma text.

    The reference concatenates the day into one local file; here the day stays a folder of part
    files written in parallel (no single task, nothing through the driver).
    """
    rows = stored.where(F.col("run_date") == run_date).drop("run_date")
    with shuffles_end(stored.sparkSession):
        _encoded(rows).write.mode("overwrite").options(sep=",", **WRITE_OPTIONS).csv(path)
