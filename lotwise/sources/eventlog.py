"""The event log as a Parquet table partitioned by ``partition_date``.

Reading with the declared schema keeps ``partition_date`` a string (no type inference), and the
run filters then prune whole partition folders and push the scope equalities into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import files
from ..schemas import EVENT_LOG
from ..session import shuffles_end


MANY_DAYS = 64  # from here on one listing of the log's folder costs less than a look at each day


def read_event_log(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """The log at ``path``; with ``days``, only those partition folders are listed and read.

    Path-based reads list every partition folder before pruning; for a run that needs 2 (or 16)
    days of a multi-year log, naming the folders keeps listing proportional to the window.
    ``basePath`` keeps ``partition_date`` as a column. Days without a folder are skipped; a log that
    has none of them is an error, as a run over it would store an empty result.
    """
    reader = spark.read.schema(EVENT_LOG)
    if days is None:
        return reader.parquet(path)
    root = path.rstrip("/")
    there = {f"{root}/{n}" for n in files.names(spark, root)} if len(days) > MANY_DAYS else None
    folders = present_days([(d, f"{root}/partition_date={d}") for d in days],
                           lambda f: files.exists(spark, f) if there is None else f in there, root)
    return reader.option("basePath", root).parquet(*folders)


def present_days(folders: list[tuple[str, str]], exists, root: str) -> list[str]:
    """The folders (or globs) of the days that are there: the rule for missing days of all inputs."""
    present = [f for _, f in folders if exists(f)]
    if not present:
        raise FileNotFoundError(f"{root}: none of the days {folders[0][0]} .. {folders[-1][0]} is there")
    return present


# What is dealt is smaller than the events made of it, which a task sorts in memory.
SMALL_TASKS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}


def write_event_parts(parts: list[DataFrame], path: str) -> None:
    """``write_event_log`` to a new folder of a log that comes in parts, each dealt and sorted by partition
    date: one after the other, so that a part's shuffles end before those of the next begin."""
    for i, part in enumerate(parts):
        with shuffles_end(part.sparkSession, **SMALL_TASKS):
            part.write.mode("append" if i else "errorifexists").partitionBy("partition_date").parquet(path)


def write_event_log(log: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a log in the layout ``read_event_log`` expects (one folder per partition date).

    Rows are clustered by date before the write so each task writes few folders; AQE splits a
    date too large for one task.
    """
    with shuffles_end(log.sparkSession):
        (
            log.hint("rebalance", "partition_date")
            .sortWithinPartitions("ma_id")
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("partition_date")
            .parquet(path)
        )
