"""File-system calls of the driver: listing, marking and deleting folders of stored datasets.

Everything goes through the Hadoop file system of the path, so any store that Spark reads will do.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def any_match(spark: SparkSession, glob: str) -> bool:
    p, fs = _path(spark, glob)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's children; none if it is not there."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def files_below(spark: SparkSession, folder: str) -> set[str]:
    """Paths of all files below a folder; none if it is not there."""
    p, fs = _path(spark, folder)
    out: set[str] = set()
    if fs.exists(p):
        found = fs.listFiles(p, True)
        while found.hasNext():
            out.add(found.next().getPath().toString())
    return out


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        p, fs = _path(spark, path)
        fs.delete(p, True)


def touch(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        p, fs = _path(spark, path)
        fs.create(p, True).close()


def replace(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder to a place, whatever lay there."""
    a, fs = _path(spark, old)
    b, _ = _path(spark, new)
    fs.delete(b, True)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{old} could not be moved to {new}")
