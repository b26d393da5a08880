"""Scope and window filters on the event log (F1, F2).

Both are plain column predicates, so Catalyst pushes the equality filters into the Parquet scan
(``PushedFilters``) and the window into partition pruning (``PartitionFilters``) when the log
is a table partitioned by ``partition_date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import RunWindow, Scope


def scope_predicate(scope: Scope) -> Column:
    return (
        (F.col("ma_type") == scope.ma_type)
        & (F.col("system_name") == scope.system_name)
        & (F.col("facility_id") == scope.facility_id)
    )


def window_predicate(lower: str, upper: str) -> Column:
    """Inclusive at both ends, compared as ``yyyy-MM-dd`` text."""
    return F.col("partition_date").between(F.lit(lower), F.lit(upper))


def scoped_window(log: DataFrame, window: RunWindow, scope: Scope = Scope()) -> DataFrame:
    """Rows of one run: scope literals and the inclusive partition-date window (duplicates kept)."""
    return log.where(scope_predicate(scope) & window_predicate(window.lower, window.upper))
