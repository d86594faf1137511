"""Parsing, projections and filters.

All of it is ``from_json`` / ``from_csv`` / higher-order array functions: one
pass, no Python per row, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import equals_ignore_case
from ..functions.time import millis_to_ts, parse_text_ts
from ..schemas import CHANGE_ENVELOPE, EVENT_ENVELOPE, INGEST_TYPES, ORDER_DETAIL_CSV

AD_EVENT = "ad"


def _keep(df: DataFrame, keep: Iterable[str] | None) -> list[Column]:
    return [F.col(c) for c in (keep or [])]


def parse_ad_clicks(envelopes: DataFrame, value_col: str = "value", mode: str = "last",
                    truncate_to_seconds: bool = True, drop_missing: bool = True,
                    keep: Iterable[str] | None = None) -> DataFrame:
    """Event envelope -> (area, uid, product_id, ts).

    ``mode="last"``: one row per envelope, the last ``ad`` event wins; an
    envelope without one gives a NULL product at epoch 0. ``mode="all"``: one
    row per ``ad`` event. ``drop_missing`` removes rows without a product (P9).
    """
    env = F.from_json(F.col(value_col), EVENT_ENVELOPE)
    base = envelopes.select(*_keep(envelopes, keep), env.alias("_e"))
    ads = F.filter(F.col("_e.lagou_event"), lambda e: e["name"] == F.lit(AD_EVENT))
    if mode == "last":
        base = base.select("*", F.try_element_at(ads, F.lit(-1)).alias("_ad"))
    elif mode == "all":
        base = base.select("*", F.explode(ads).alias("_ad"))
    else:
        raise ValueError(f"mode must be 'last' or 'all', not {mode!r}")
    out = base.select(
        *_keep(base, keep),
        F.col("_e.attr")["area"].alias("area"),
        F.col("_e.attr")["uid"].alias("uid"),
        F.col("_ad.json")["product_id"].alias("product_id"),
        millis_to_ts(F.coalesce(F.col("_ad.time"), F.lit(0)), truncate_to_seconds).alias("ts"),
    )
    return out.where(F.col("product_id").isNotNull()) if drop_missing else out


def parse_channels(envelopes: DataFrame, value_col: str = "value",
                   keep: Iterable[str] | None = None) -> DataFrame:
    """Event envelope -> (channel, uid, ts) for every envelope.

    The reference counts in processing time; here ``ts`` is the envelope's
    latest event time, so results are reproducible.
    """
    env = F.from_json(F.col(value_col), EVENT_ENVELOPE)
    times = F.transform(env["lagou_event"], lambda e: e["time"])
    return envelopes.select(
        *_keep(envelopes, keep),
        env["attr"]["channel"].alias("channel"),
        env["attr"]["uid"].alias("uid"),
        millis_to_ts(F.array_max(times)).alias("ts"),
    )


def row_key(pk_names: Column, row: Column) -> Column:
    """Primary-key values joined by ``_``.

    Without key columns the key is a hash of the row, not a random id, so a
    retried batch writes the same keys. A key with a missing value is NULL.
    (A DELETE without key columns names no row: ``parse_changes`` gives it NULL.)
    """
    values = F.transform(pk_names, lambda k: row[k])
    joined = F.when(F.exists(values, lambda v: v.isNull()), F.lit(None)).otherwise(
        F.array_join(values, "_"))
    # one key column, the usual case, needs no lambda (those run outside generated code)
    return (F.when(F.size(pk_names) == 1, row[F.get(pk_names, F.lit(0))])
            .when(F.size(pk_names) == 0, F.sha2(F.to_json(row), 256)).otherwise(joined))


def parse_changes(envelopes: DataFrame, value_col: str = "value",
                  types: Iterable[str] = INGEST_TYPES,
                  keep: Iterable[str] | None = None, observe=None) -> DataFrame:
    """Change-log envelope -> one row per changed row.

    Columns: database, table, type, pk_names, row (map of text), es, change_id,
    pos (index in ``data``), row_key. ``types`` is matched exactly, as the
    ingestion job does; anything else is dropped, and counted as
    ``dropped_types`` under the metrics name ``observe`` (a query's progress, or
    an ``Observation``). A DELETE without key columns is rejected: NULL key.

    An envelope is parsed once: filters (these and the caller's) are not moved below an ``explode``
    whose rows they read, but below a plain projection they are, each with a ``from_json`` of its own.
    """
    env = F.from_json(F.col(value_col), CHANGE_ENVELOPE)
    parsed = envelopes.select(*_keep(envelopes, keep), F.explode(F.array(env)).alias("_c"))
    wanted = F.coalesce(F.col("_c.type").isin(list(types)), F.lit(False))
    if observe is not None:
        parsed = parsed.observe(observe, F.count_if(~wanted).alias("dropped_types"))
    parsed = parsed.where(wanted)
    rows = parsed.select(
        *_keep(parsed, keep),
        F.col("_c.database").alias("database"),
        F.col("_c.table").alias("table"),
        F.col("_c.type").alias("type"),
        F.coalesce(F.col("_c.pkNames"), F.array().cast("array<string>")).alias("pk_names"),
        F.col("_c.es").alias("es"),
        F.col("_c.id").alias("change_id"),
        F.posexplode(F.col("_c.data")).alias("pos", "row"),
    )
    nameless = (F.lower("type") == "delete") & (F.size("pk_names") == 0)
    return rows.withColumn("row_key", F.when(
        ~nameless, row_key(F.col("pk_names"), F.col("row"))))


def filter_database(changes: DataFrame, database: str = "dwshow") -> DataFrame:
    """Keep one database, ignoring case (P3). Fixed default: the reference's database."""
    return changes.where(equals_ignore_case("database", database))


def filter_table(changes: DataFrame, table_name: str) -> DataFrame:
    """Keep one table."""
    return changes.where(F.col("table") == F.lit(table_name))


def decode_row(df: DataFrame, fields: dict[str, tuple[str, str]], row_col: str = "row",
               keep: Iterable[str] | None = None) -> DataFrame:
    """Text cells -> typed columns (P7): ``{out_name: (cell_name, spark_type)}``.

    ``try_cast`` gives NULL on malformed text; ``'0'``/``'1'`` cast to boolean.
    """
    cols = [F.col(row_col)[src].try_cast(typ).alias(name) for name, (src, typ) in fields.items()]
    return df.select(*_keep(df, keep), *cols)


def parse_order_lines(lines: DataFrame, value_col: str = "value",
                      keep: Iterable[str] | None = None) -> DataFrame:
    """``order_id,status,time,money`` -> (order_id, status, ts, money)."""
    rec = F.from_csv(F.col(value_col), ORDER_DETAIL_CSV)
    return lines.select(
        *_keep(lines, keep),
        rec["order_id"].alias("order_id"),
        rec["status"].alias("status"),
        parse_text_ts(rec["time"]).alias("ts"),
        rec["money"].alias("money"),
    )
