"""Event-time parsing as Column expressions (stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The log writes ``yyyy-MM-dd HH:mm:ss.SS+0800``. The offset is matched as text by the
# reference, never applied, so only the wall-clock part (first 19 characters) is read, and it
# is read as UTC so that results do not depend on the session time zone.
WALL_CLOCK_LENGTH = 19
_PARSE_FORMAT = "yyyy-MM-dd HH:mm:ssX"


def wall_clock(text: Column | str) -> Column:
    """Timestamp of the wall-clock part of an event time; NULL when it does not parse."""
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(
        F.concat(F.substring(c, 1, WALL_CLOCK_LENGTH), F.lit("Z")), F.lit(_PARSE_FORMAT)
    )


def event_epoch(text: Column | str) -> Column:
    """Whole seconds since 1970 of an event time (``unix_timestamp`` of the job); NULL if bad."""
    return F.unix_seconds(wall_clock(text))
