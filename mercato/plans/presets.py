"""Window widths, slides, thresholds and tolerances, in real time units.

``SPEC`` is what the warehouse's requirements state; ``LITERAL`` the numbers
written in its jobs, read in correct units (SURVEY 0.1: some jobs handed
seconds to a millisecond API, which turned e.g. 20 s into 20,000 s; that slip
is reachable with ``LITERAL_AS_RUN``, it is not coded). ``FIXTURE`` is sized for
the sparse shared test tables (events span 30 days, orders 6 years), where the
literal windows would be empty.
"""

from __future__ import annotations

# Fixed values (must equal the reference's stated requirements and literals).
SPEC = {
    "order_window": ("1 hour", "5 minutes"),
    "ad_window": ("1 hour", "5 seconds"),
    "blacklist_window": "10 seconds",
    "blacklist_threshold": 10,
    "repeat_times": 10,
    "repeat_within": "10 seconds",
    "channel_window": "10 seconds",
    "channel_sliding": ("1 hour", "10 seconds"),
    "pay_within": "15 minutes",
    "interval_bounds": ("-10 minutes", "0 seconds"),
    "window_join_width": "2 seconds",
    "match_tolerance": "5 seconds",
    "watermark_delay": "500 milliseconds",
}

LITERAL = dict(SPEC, order_window=("600 seconds", "5 seconds"),
               ad_window=("20 seconds", "10 seconds"))

LITERAL_AS_RUN = dict(LITERAL, ad_window=("20000 seconds", "10000 seconds"),
                      blacklist_window="10000 seconds", repeat_within="10000 seconds",
                      watermark_delay="500 seconds")

FIXTURE = {
    "order_window": ("7 days", "1 day"),
    "ad_window": ("1 hour", "5 minutes"),
    "blacklist_window": "1 day",
    "blacklist_threshold": 2,
    "repeat_times": 3,
    "repeat_within": "7 days",
    "channel_window": "1 day",
    "channel_sliding": ("7 days", "1 day"),
    "pay_within": "1 day",
    "interval_bounds": ("-6 hours", "0 seconds"),
    "window_join_width": "1 day",
    "match_tolerance": "90 days",
    "watermark_delay": "1 hour",
}

