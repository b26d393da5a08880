"""Delimited text sources, always with a declared all-string schema.

Text codec of all stores: NULL is ``\\N``, an empty string is a quoted nothing, separators and quotes are
quoted and doubled (RFC 4180). Backslash, line feed and carriage return inside a value are written as
``\\\\``, ``\\n`` and ``\\r``, so a row is one line of a file whatever its values hold, files stay splittable,
and a value that reads ``\\N`` is no NULL. Both directions are Column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CTRL_A = "\x01"
NULL_TEXT = "\\N"
WEEK = "ww"  # datasets with a work week are stored by run date and week

# Options both of the readers and of the writers.
TEXT_OPTIONS = {"nullValue": NULL_TEXT, "escape": '"'}


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")),
                     F.lit("\r"), F.lit("\\r"))


def unescaped(c: Column) -> Column:
    """The inverse: a backslash starts an escape unless it is the second of a pair, and pairs are
    found from the left, so the text is split at pairs and each part's escapes are replaced."""
    parts = F.transform(F.split(c, r"\\\\", -1), lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(parts, "\\")).otherwise(c)


def _decoded(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    return df.select(*[unescaped(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) and f.name not in more
                       else F.col(f.name) for f in schema.fields],
                     *[F.col(c) for c in more if c not in schema.fieldNames()])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType,
                   sep: str = CTRL_A) -> DataFrame:
    """Ctrl-A separated files of a staging folder, columns by position."""
    return _decoded(spark.read.schema(schema).options(sep=sep, **TEXT_OPTIONS).csv(path), schema)


def partition_columns(schema: T.StructType) -> list[str]:
    """The folder levels of a dated store."""
    return ["run_date", *([WEEK] if WEEK in schema.fieldNames() else [])]


def stored_schema(schema: T.StructType) -> T.StructType:
    """The columns of a dated store: those in the files, then those in the folder names."""
    levels = partition_columns(schema)
    return T.StructType([f for f in schema.fields if f.name not in levels]
                        + [T.StructField(c, T.StringType()) for c in levels])


def read_dated_store(spark: SparkSession, root: str, schema: T.StructType,
                     run_dates: list[str] | None = None) -> DataFrame:
    """A comma-delimited dataset stored as ``<root>/run_date=<yyyy-MM-dd>[/ww=<YYYYWW>]/part-*``.

    ``run_date`` and ``ww`` are declared string partition columns, so filters on them prune folders.
    """
    df = spark.read.schema(stored_schema(schema)).options(sep=",", **TEXT_OPTIONS).csv(root)
    df = _decoded(df, schema, *partition_columns(schema))
    if run_dates is not None:
        df = df.where(df.run_date.isin(*run_dates))
    return df


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Report files with a header line each (skipped), comma separated, CRLF line ends.

    Files may sit in one sub-folder per week range, so the lookup is recursive.
    """
    return _decoded(spark.read.schema(schema).options(header=True, sep=",", recursiveFileLookup=True, **TEXT_OPTIONS)
                    .csv(path), schema)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table (K5) with its text decoded: the catalog's rows are those of the files, so a
    line break inside a value is an escape there."""
    df = spark.table(name)
    return _decoded(df, df.schema, "run_date", WEEK) if "run_date" in df.columns else _decoded(df, df.schema)
