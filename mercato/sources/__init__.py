"""Sources: table scans, domain shapes, streams and keyed-table scans."""

from .tables import TABLES, table

__all__ = ["TABLES", "table"]
