"""External CSV tables over stored datasets (K5, K6), through the session catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .. import files
from ..sources.delimited import TEXT_OPTIONS, partition_columns, stored_schema

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # the folder name of a NULL


def _literal(text: str) -> str:
    # SQL string literals unescape backslashes, so ``\\N`` must be written doubled.
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def _create(spark: SparkSession, name: str, schema: T.StructType, location: str, options: dict[str, str],
            partitioned_by: list[str]) -> None:
    given = ", ".join(f"{_literal(k)} {_literal(v)}" for k, v in {**TEXT_OPTIONS, "sep": ",", **options}.items())
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING csv OPTIONS ({given}){part} "
              f"LOCATION {_literal(location)}")


def register_store(spark: SparkSession, name: str, schema: T.StructType, root: str) -> None:
    """K5: the external table of a dated store (no file is touched), with the folders that are there
    as its partitions. A store that is given the table's name keeps them up to date."""
    _create(spark, name, stored_schema(schema), root, {}, partition_columns(schema))
    if files.exists(spark, root):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def register_report(spark: SparkSession, name: str, schema: T.StructType, root: str) -> None:
    """K5: the external table of a report's folder. Columns go by position, so the table may name them
    otherwise than the files' header lines, which are skipped."""
    _create(spark, name, schema, root, {"header": "true", "recursiveFileLookup": "true"}, [])


def refresh_table(spark: SparkSession, name: str) -> None:
    """Have the session read the table's files anew."""
    spark.sql(f"REFRESH TABLE {name}")


def _spec(folders: dict[str, str]) -> str:
    return "PARTITION (" + ", ".join(f"{k} = " + ("null" if v == NO_VALUE else _literal(v))
                                     for k, v in folders.items()) + ")"


def _partitions(spark: SparkSession, name: str) -> set[tuple[str, ...]]:
    return {tuple(level.split("=", 1)[1] for level in r.partition.split("/"))
            for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def sync_partitions(spark: SparkSession, name: str, root: str, run_dates: Iterable[str], levels: list[str]) -> None:
    """Add the folders of the given run dates to the table, and drop those that are gone."""
    run_dates = list(run_dates)
    there: set[tuple[str, ...]] = set()
    for day in run_dates:
        folder = f"{root}/run_date={day}"
        if len(levels) == 1:
            there |= {(day,)} if files.exists(spark, folder) else set()
        else:
            there |= {(day, n.split("=", 1)[1]) for n in files.names(spark, folder) if n.startswith(f"{levels[1]}=")}
    known = {p for p in _partitions(spark, name) if p[0] in run_dates}
    for verb, parts, between in ((f"ALTER TABLE {name} ADD IF NOT EXISTS ", there - known, " "),
                                 (f"ALTER TABLE {name} DROP IF EXISTS ", known - there, ", ")):
        if parts:
            spark.sql(verb + between.join(_spec(dict(zip(levels, p))) for p in sorted(parts)))
    refresh_table(spark, name)


def drop_table(spark: SparkSession, name: str) -> None:
    """K6: ``DROP TABLE IF EXISTS``; the table is external, so its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
