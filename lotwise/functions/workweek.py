"""Work-week labels (``YYYYWW``) and 52-week label ranges.

Week 1 of 2017 starts 2016-12-29 11:00:00 and every year has exactly 52 weeks, so the label of
an instant is a pure function of its week index ``wd = floor((t - epoch) / 1 week)``:
year = 2017 + floor(wd / 52), week = (wd mod 52) + 1 (mod is non-negative, also before the epoch).

The Column form keeps the label inside codegen; the Python form computes the driver-side
parameter list for a report (always 52 labels).
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..params import REPORT_WEEKS, SECONDS_PER_WEEK, WEEK_BASE_YEAR, WEEK_EPOCH, WEEKS_PER_YEAR
from .time import event_epoch

_UTC = dt.timezone.utc
WEEK_EPOCH_SECONDS = int(
    dt.datetime.fromisoformat(WEEK_EPOCH).replace(tzinfo=_UTC).timestamp()
)


def week_index(epoch_seconds: Column) -> Column:
    return F.floor((epoch_seconds - F.lit(WEEK_EPOCH_SECONDS)) / F.lit(SECONDS_PER_WEEK))


def week_label(index: Column) -> Column:
    """``YYYYWW`` of a week index (long)."""
    year = F.lit(WEEK_BASE_YEAR) + F.floor(index / F.lit(WEEKS_PER_YEAR))
    week = F.pmod(index, F.lit(WEEKS_PER_YEAR)) + F.lit(1)
    return F.concat(year.cast("string"), F.lpad(week.cast("string"), 2, "0"))


def work_week(event_time: Column | str) -> Column:
    """Work week of an event-time text; NULL when the time does not parse (X1 ``get_ww``)."""
    return week_label(week_index(event_epoch(event_time)))


def work_week_range(as_of_epoch: Column, weeks: int = REPORT_WEEKS) -> Column:
    """Array of the ``weeks`` labels ending at the week of ``as_of_epoch``, oldest first."""
    end = week_index(as_of_epoch)
    return F.transform(F.sequence(end - F.lit(weeks - 1), end), week_label)


# ---- driver-side parameter helpers ------------------------------------------------------


def _label(index: int) -> str:
    return f"{WEEK_BASE_YEAR + math.floor(index / WEEKS_PER_YEAR)}{index % WEEKS_PER_YEAR + 1:02d}"


def _index(as_of: dt.datetime) -> int:
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=_UTC)
    return math.floor((as_of.timestamp() - WEEK_EPOCH_SECONDS) / SECONDS_PER_WEEK)


def week_of(as_of: dt.datetime) -> str:
    return _label(_index(as_of))


def week_labels(as_of: dt.datetime, weeks: int = REPORT_WEEKS) -> list[str]:
    """The report's week list: ``weeks`` consecutive labels ending at ``as_of``'s week."""
    end = _index(as_of)
    return [_label(i) for i in range(end - weeks + 1, end + 1)]


def register_sql_function(spark: SparkSession, name: str = "get_ww") -> None:
    """Expose the work-week rule to SQL as ``get_ww(text)`` (a SQL function, no Python UDF)."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS STRING RETURN
        concat(
          CAST({WEEK_BASE_YEAR} + floor(floor((unix_seconds(try_to_timestamp(
              concat(substring(t, 1, 19), 'Z'), 'yyyy-MM-dd HH:mm:ssX')) - {WEEK_EPOCH_SECONDS})
              / {SECONDS_PER_WEEK}) / {WEEKS_PER_YEAR}) AS STRING),
          lpad(CAST(pmod(floor((unix_seconds(try_to_timestamp(
              concat(substring(t, 1, 19), 'Z'), 'yyyy-MM-dd HH:mm:ssX')) - {WEEK_EPOCH_SECONDS})
              / {SECONDS_PER_WEEK}), {WEEKS_PER_YEAR}) + 1 AS STRING), 2, '0'))
        """
    )
