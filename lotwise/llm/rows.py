"""Narrow jobs over whole rows: the input's columns ride along in one struct column ``row``, so
extra columns and clashing names can't meet the operator's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def as_rows(df: DataFrame) -> DataFrame:
    """One struct column ``row`` holding the input's columns."""
    return df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"))


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column of the input, from a batch whose first column is ``row``."""
    return pc.struct_field(batch.column(0), [batch.column(0).type.get_field_index(name)])


def text_field(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = field(batch, name)
    return column if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(pa.string())


def map_rows(rows: DataFrame, schema: str, work: Callable) -> DataFrame:
    """``rows`` (from ``as_rows``) with the result columns of ``schema`` beside ``row``.

    ``work(batch)`` yields ``(lo, hi, arrays)`` for consecutive slices of the batch.
    """
    results = _parse_datatype_string(schema)
    out = StructType([StructField("row", rows.schema["row"].dataType), *results.fields])
    names = ["row", *results.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0)
            for lo, hi, arrays in work(batch):
                yield pa.RecordBatch.from_arrays([whole.slice(lo, hi - lo), *arrays], names)

    return rows.mapInArrow(run, out)
