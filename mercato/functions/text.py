"""Text helpers (F6-F8, F10, P14, P15) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_text(col, delimiter: str) -> Column:
    """Split on a literal delimiter."""
    import re
    return F.split(_c(col), re.escape(delimiter))


def join_text(cols, delimiter: str) -> Column:
    """Join values with a delimiter, skipping nulls."""
    return F.concat_ws(delimiter, *[_c(c) for c in cols])


def equals_ignore_case(col, value: str) -> Column:
    """Case-insensitive equality with a literal (F8)."""
    return F.lower(_c(col)) == F.lit(value.lower())


def to_number(col, type_name: str = "double") -> Column:
    """Text -> number; malformed text gives NULL instead of failing."""
    return _c(col).try_cast(type_name)


def to_text(col) -> Column:
    """Any value -> its text form; NULL stays NULL."""
    return _c(col).cast("string")


def channel_message(channel, user_count) -> Column:
    """Presentation line of the channel statistic."""
    # Fixed value (must equal the reference's output line).
    return F.format_string("channel: %s, user count: %d", _c(channel), _c(user_count))


def pair_message(left, right, separator: str = " ==> ") -> Column:
    """Presentation line of a joined pair."""
    return F.concat_ws(separator, _c(left), _c(right))


def match_message(order_id, outcome, order_first) -> Column:
    """Presentation line of a two-stream match.

    The reference prints a match from whichever side arrives second, and its two
    branches differ by one space; unmatched rows leave on a side output.
    """
    # Fixed values (must equal the reference's output lines).
    oid = _c(order_id).cast("string")
    return (F.when((_c(outcome) == "matched") & _c(order_first),
                   F.concat(F.lit("order id: "), oid, F.lit(" matched")))
            .when(_c(outcome) == "matched", F.concat(F.lit("order id:"), oid, F.lit(" matched")))
            .otherwise(F.concat(F.lit("order id: "), oid, F.lit(" fail to match"))))
