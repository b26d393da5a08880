"""Job parameters: scope literals, attribute list and run windows.

Every literal the reference jobs repeat in each derived table lives here once, so a run is
described by one ``Scope`` and one ``RunWindow`` and can be replayed for any date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the reference job's literals for equal results.
# ---------------------------------------------------------------------------
# Lot attributes pivoted into columns, as (attribute_id in the log, output column), in the
# reference's column order.
ATTRIBUTES = (
    ("DESIGN ID", "DESIGN_ID"),
    ("PACKAGE TYPE", "PACKAGE_TYPE"),
    ("STEP TEMPERATURE", "STEP_TEMPERATURE"),
    ("LEAD COUNT", "LEAD_COUNT"),
    ("PACKAGE HEIGHT", "PACKAGE_HEIGHT"),
    ("PACKAGE LENGTH", "PACKAGE_LENGTH"),
    ("PACKAGE WIDTH", "PACKAGE_WIDTH"),
    ("PRODUCT FAMILY", "PRODUCT_FAMILY"),
)
QTY_ATTRIBUTE = "CURRENT QTY"
VARIANCE_REASONS = ("VARIANCE",)
TESTER_ROLE = "TESTER MACHINE"
TESTER_STARTED = "STARTED"
GENEALOGY_EVENT = "GenealogyChanged"
DEFAULT_MA_TYPE = "LOT"
DEFAULT_SYSTEM = "MAMTSTSI"
DEFAULT_FACILITY = "TEST-MSA"
# Test-record attribute keys read by the archive job.
TTE_KEYS = ("LOT", "STEP_ID", "TESTER_ID", "SPEED", "TEMPERATURE")
# Work weeks: week 1 of 2017 starts Thursday 2016-12-29 11:00:00; every year has 52 weeks.
WEEK_EPOCH = "2016-12-29 11:00:00"
WEEK_BASE_YEAR = 2017
WEEKS_PER_YEAR = 52
SECONDS_PER_WEEK = 7 * 24 * 60 * 60
REPORT_WEEKS = 52
# Day offsets from "today" (the wall clock of the reference run).
DAILY_RUN_OFFSET = 3  # run date D = today - 3 = window lower bound
DAILY_UPPER_OFFSET = 2  # window upper bound = today - 2
ARCHIVE_EPOCH_OFFSET = 53  # archive anchor = today - 53 = window upper bound
ARCHIVE_RUN_OFFSET = 7  # archive run date = anchor - 7 (the test-record day)
ARCHIVE_LOWER_OFFSET = 15  # archive window lower bound = anchor - 15
# ---------------------------------------------------------------------------

ATTRIBUTE_IDS = tuple(a for a, _ in ATTRIBUTES)
ATTRIBUTE_COLUMNS = tuple(c for _, c in ATTRIBUTES)


@dataclass(frozen=True)
class Scope:
    """Entity type, source system and facility that every event-log read is limited to."""

    ma_type: str = DEFAULT_MA_TYPE
    system_name: str = DEFAULT_SYSTEM
    facility_id: str = DEFAULT_FACILITY
    variance_reasons: tuple[str, ...] = VARIANCE_REASONS


def _day(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


@dataclass(frozen=True)
class RunWindow:
    """One run: the dated output folder ``run_date`` and the inclusive partition-date window.

    All three are ``yyyy-MM-dd`` strings, compared as strings like the reference does.
    """

    run_date: str
    lower: str
    upper: str

    @classmethod
    def daily(cls, run_date: str | dt.date) -> RunWindow:
        """The current daily job for run date D: partitions D and D+1."""
        d = _day(run_date)
        upper = d + dt.timedelta(days=DAILY_RUN_OFFSET - DAILY_UPPER_OFFSET)
        return cls(d.isoformat(), d.isoformat(), upper.isoformat())

    @classmethod
    def daily_as_of(cls, today: str | dt.date) -> RunWindow:
        """The current daily job as the reference runs it on ``today``."""
        return cls.daily(_day(today) - dt.timedelta(days=DAILY_RUN_OFFSET))

    @classmethod
    def archive(cls, run_date: str | dt.date) -> RunWindow:
        """The archive job whose test-record day is D: partitions D-8 .. D+7 (16 days)."""
        d = _day(run_date)
        anchor = d + dt.timedelta(days=ARCHIVE_RUN_OFFSET)
        lower = anchor - dt.timedelta(days=ARCHIVE_LOWER_OFFSET)
        return cls(d.isoformat(), lower.isoformat(), anchor.isoformat())

    @classmethod
    def archive_as_of(cls, today: str | dt.date) -> RunWindow:
        """The archive job as the reference runs it on ``today``."""
        anchor = _day(today) - dt.timedelta(days=ARCHIVE_EPOCH_OFFSET)
        return cls.archive(anchor - dt.timedelta(days=ARCHIVE_RUN_OFFSET))

    @classmethod
    def span(cls, lower: str, upper: str, run_date: str | None = None) -> RunWindow:
        """An explicit window, e.g. one wide run over the whole log."""
        return cls(run_date or lower, lower, upper)

    @property
    def lower_offset(self) -> int:
        return (_day(self.lower) - _day(self.run_date)).days

    @property
    def upper_offset(self) -> int:
        return (_day(self.upper) - _day(self.run_date)).days

    @property
    def run_path(self) -> str:
        """The run date as ``yyyy/MM/dd``, the layout of dated test-record folders."""
        return _day(self.run_date).strftime("%Y/%m/%d")

    def days(self) -> list[str]:
        lo, hi = _day(self.lower), _day(self.upper)
        return [(lo + dt.timedelta(days=i)).isoformat() for i in range((hi - lo).days + 1)]
