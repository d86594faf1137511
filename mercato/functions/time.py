"""Time conversions (F2-F5). All return Column expressions, nothing runs in Python.

Event times are carried as TIMESTAMP_NTZ (what the Parquet tables hold);
``to_event_time`` turns them into TIMESTAMP for ``withWatermark`` and
``to_wall_time`` turns results back. The session zone is pinned to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value (must equal the reference's print format).
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def millis_to_ts(ms, truncate_to_seconds: bool = False) -> Column:
    """epoch ms -> TIMESTAMP_NTZ; ``truncate_to_seconds`` mirrors the ms -> s cut (F2)."""
    ms = _c(ms).cast("bigint")
    if truncate_to_seconds:
        return F.timestamp_seconds(F.floor(ms / 1000)).cast("timestamp_ntz")
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def seconds_to_ts(seconds) -> Column:
    """epoch seconds (number or numeric text) -> TIMESTAMP_NTZ."""
    return F.timestamp_seconds(_c(seconds).try_cast("bigint")).cast("timestamp_ntz")


def ts_to_millis(ts) -> Column:
    """TIMESTAMP(_NTZ) -> epoch ms (floor)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def format_ts(ts) -> Column:
    """TIMESTAMP -> 'yyyy-MM-dd HH:mm:ss' text."""
    return F.date_format(_c(ts), TEXT_FORMAT)


def format_epoch_seconds(seconds) -> Column:
    """epoch seconds -> 'yyyy-MM-dd HH:mm:ss' text in the session zone."""
    return F.date_format(F.timestamp_seconds(_c(seconds).cast("bigint")), TEXT_FORMAT)


def parse_text_ts(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss' -> TIMESTAMP_NTZ; bad text -> NULL."""
    return F.try_to_timestamp(_c(text), F.lit(TEXT_FORMAT)).cast("timestamp_ntz")


def to_event_time(ts) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP, the type ``withWatermark`` accepts."""
    return _c(ts).cast("timestamp")


def to_wall_time(ts) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ for output."""
    return _c(ts).cast("timestamp_ntz")
