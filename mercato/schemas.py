"""Fixed record schemas of the warehouse (DDL strings for ``from_json`` etc.).

JSON payloads carry every leaf as text; they are parsed as strings or
``map<string,string>`` and cast afterwards, because a typed ``from_json``
turns a quoted number into NULL.
"""

# App event envelope: {"lagou_event": [...], "attr": {...}}.
# Fixed values (must equal the reference's message format): the field names.
EVENT_ENVELOPE = (
    "lagou_event array<struct<name: string, json: map<string,string>, time: bigint>>, "
    "attr map<string,string>"
)

# Database change-log envelope (one message, several changed rows).
CHANGE_ENVELOPE = (
    "data array<map<string,string>>, database string, es bigint, id bigint, "
    "isDdl boolean, old array<map<string,string>>, pkNames array<string>, "
    "`table` string, ts bigint, `type` string, `sql` string"
)

# Order status lines: order_id,status,time,money
ORDER_DETAIL_CSV = "order_id string, status string, time string, money double"

# Flattened area dimension.
AREA_DIMENSION_COLUMNS = ("areaid", "aname", "cid", "city", "proid", "province")

# Default change types taken by ingestion, and by the statistics job.
# Fixed values (must equal the reference): upper-case exact names.
INGEST_TYPES = ("INSERT", "UPDATE", "DELETE")
STATISTICS_TYPES = ("INSERT",)
