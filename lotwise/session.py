"""Session set-up: the SQL options the jobs are tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL options applied by every job entry point.
JOB_CONF = {
    # Partition values such as partition_date stay strings (compared as text by the jobs).
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Re-running a run date replaces only that date's folder.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed (lot, job) join partition even where that costs one more shuffle after it
    # (several joins reuse their partitioning for the DISTINCT that follows).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # An aggregate or DISTINCT is dealt by all its keys even where its input is dealt by some of them
    # already: a hot (lot, job) is spread, and both sides of the join after it are shuffles of its own,
    # which AQE can split.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # Broadcast only what AQE has measured at run time (a materialised shuffle stage below the
    # threshold); no broadcast from file-size estimates, which under-count compressed Parquet.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lotwise",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC, modest shuffle width)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def bound_batches(spark: SparkSession, rows: int = 2_048, size: str = "8m") -> SparkSession:
    """What a Python worker gets at once: it and its executor hold some batches of whole texts each, so
    the defaults of 10,000 rows or 64 MB cost them hundreds of MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured (local tests) is a folder of our own set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = tempfile.mkdtemp(prefix="lotwise-ckpt-")
        if not sc.master.startswith("local"):
            warnings.warn(f"spark.checkpoint.dir is not set; {configured} serves only a local session", stacklevel=2)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root, e.g. for write/read round trips."""
    return f"{checkpoint_root(spark).rstrip('/')}/lotwise-{name}-{uuid.uuid4().hex[:12]}"


# Shuffle files of a finished write serve nobody: the stored table is what is read from then on.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession, **more: str) -> Iterator[None]:
    """The shuffle files of a write inside go with its end. ``more`` options hold for the write too."""
    options = {_CLEAN_UP: "true", **more}
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def materialize(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Cut lineage with a written table: ``df`` is computed once, stored as Parquet in the
    shared checkpoint folder (or under ``root``) and read back; the result survives the loss of
    the executors that built it. The shuffle files of the write go with its end."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{name}" if root else scratch_path(spark, name)
    with shuffles_end(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# What a plan does with a part that it uses more than once: nothing, or store it under the given name.
Keep = Callable[[DataFrame, str], DataFrame]


def as_is(df: DataFrame, name: str) -> DataFrame:
    return df


@contextmanager
def stored_parts(spark: SparkSession, name: str) -> Iterator[Keep]:
    """A ``keep`` that stores parts, which are there until the end: each part's shuffles end before those
    of the next begin."""
    root = scratch_path(spark, name)
    try:
        yield lambda df, part: materialize(df, part, root)
    finally:
        remove_path(spark, root)


def dematerialize(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once nothing reads them any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            remove_path(df.sparkSession, folder)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder (driver-side file-system call)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
