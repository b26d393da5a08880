"""The joins on the lot alone (attaching one row per lot to many rows per lot), safe for hot lots.

AQE splits a large partition of a sort-merge join if both sides are shuffles made for that join. The
per-lot side is an aggregate by lot, whose partitioning would serve the join as it is, so there would
be one shuffle only and a lot with a third of all rows would be joined by one task. Here the join key
has a second part, a hash of the lot: it changes no result (equal lots have equal hashes), but the
aggregate's partitioning does not cover it, so each side gets a shuffle of its own and AQE splits a
hot lot by its measured size, whatever the size of the run. The price is a shuffle of one row per lot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PART = "_lot_part"


def attach_per_lot(rows: DataFrame, per_lot: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Inner join of ``rows`` with ``per_lot`` (one row per (by, LOT_ID)). Distinct rows stay
    distinct."""
    part = F.xxhash64("LOT_ID")
    return rows.withColumn(_PART, part).join(per_lot.withColumn(_PART, part), [*by, "LOT_ID", _PART]).drop(_PART)
