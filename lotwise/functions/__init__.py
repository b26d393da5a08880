"""Scalar Column functions: event time (P3) and work weeks."""

from .time import event_epoch, wall_clock
from .workweek import (
    register_sql_function,
    week_label,
    week_labels,
    week_of,
    work_week,
    work_week_range,
)

__all__ = [
    "event_epoch",
    "wall_clock",
    "register_sql_function",
    "week_label",
    "week_labels",
    "week_of",
    "work_week",
    "work_week_range",
]
