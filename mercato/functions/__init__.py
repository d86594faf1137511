"""Scalar functions as JVM-side Column expressions."""

from .text import (channel_message, equals_ignore_case, join_text, match_message,
                   pair_message, split_text, to_number, to_text)
from .time import (format_epoch_seconds, format_ts, millis_to_ts, parse_text_ts,
                   seconds_to_ts, to_event_time, to_wall_time, ts_to_millis)

__all__ = [
    "channel_message", "equals_ignore_case", "join_text", "match_message", "pair_message",
    "split_text",
    "to_number", "to_text", "format_epoch_seconds", "format_ts", "millis_to_ts",
    "parse_text_ts", "seconds_to_ts", "to_event_time", "to_wall_time", "ts_to_millis",
]
