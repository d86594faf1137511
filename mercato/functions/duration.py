"""Durations given as text (``"5 minutes"``), seconds, or ``timedelta``."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def micros(duration) -> int:
    """Duration -> whole microseconds."""
    if isinstance(duration, dt.timedelta):
        return duration // dt.timedelta(microseconds=1)
    if isinstance(duration, (int, float)):
        return int(round(duration * 1_000_000))
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]+?)s?\s*", str(duration))
    if not m or m.group(2).lower() not in _UNITS_US:
        raise ValueError(f"cannot read duration {duration!r}")
    return int(m.group(1)) * _UNITS_US[m.group(2).lower()]


def text(duration) -> str:
    """Duration -> text that ``F.window`` accepts."""
    return f"{micros(duration)} microseconds"


def interval(duration) -> Column:
    """Duration -> a day-time interval literal, usable in event-time conditions."""
    return interval_us(micros(duration))


def interval_us(us: int) -> Column:
    """Whole microseconds (>= 0) -> a day-time interval literal."""
    # a literal, so streaming joins can read the bound and evict state
    return F.expr(f"INTERVAL {int(us)} MICROSECONDS")
