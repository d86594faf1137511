"""Signed rows, views kept up to date by them, and balanced time slices."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import changelog, retract, slices

FIELDS = {"cust": ("o_custkey", "bigint"), "money": ("o_totalprice", "double")}
SCHEMA = changelog.CHANGE_SCHEMA


def random_log(seed, keys=12, changes=400):
    """Inserts, whole and partial updates (also of cells to NULL), deletions, new lives."""
    rnd = random.Random(seed)
    log = []
    for i in range(changes):
        kind = rnd.choice(["INSERT", "UPDATE", "update", "DELETE", "UPDATE", "ALTER"])
        row = {"o_custkey": str(rnd.randrange(4)), "o_totalprice": str(rnd.randrange(100)), "note": "x"}
        if kind in ("UPDATE", "update"):
            row = {c: rnd.choice([v, v, None]) for c, v in row.items() if rnd.random() < 0.6}
        key = None if rnd.random() < 0.03 else f"k{0 if rnd.random() < 0.4 else rnd.randrange(keys)}"
        log.append((rnd.choice(["dwshow", "DWSHOW"]), rnd.choice(["orders"] * 5 + ["other"]), key, kind, row,
                    i // 3 * 7_000_000, i, 0))
    rnd.shuffle(log)
    return log


def replay(log):
    """Every change's row before and after, by a dictionary."""
    rows, out = {}, []
    for db, table, key, kind, row, es, cid, pos in sorted(log, key=lambda r: (r[5], r[6], r[7])):
        if key is None or kind.lower() not in ("insert", "update", "delete"):
            continue
        at = (table, key)
        before = rows.get(at)
        if kind == "DELETE":
            rows.pop(at, None)
        else:
            rows[at] = {**(before or {}), **row}

        def typed(r):
            if r is None:
                return None
            cust, money = r.get("o_custkey"), r.get("o_totalprice")
            return (None if cust is None else int(cust), None if money is None else float(money))
        out.append((table, key, es, cid, typed(before), typed(rows.get(at))))
    return out


@pytest.mark.parametrize("seed,slice_us,most", [
    (1, retract.DAY_US, 1 << 16), (2, 1_000_000, 1 << 16), (3, retract.DAY_US, 20), (4, 10**15, 5)])
def test_images_are_those_of_a_replay(spark, monkeypatch, seed, slice_us, most):
    """One slice per key, many fixed ones, and heavy ones cut at quantiles."""
    monkeypatch.setattr(slices, "PER_CUT", 3)
    log = random_log(seed)
    got = retract.row_images(spark.createDataFrame(log, SCHEMA).repartition(5), FIELDS, slice_us, most)
    rows = [(r.table, r.row_key, r.es, r.change_id, r.before and tuple(r.before), r.after and tuple(r.after))
            for r in got.collect()]
    assert sorted(rows, key=str) == sorted(replay(log), key=str)


def test_signed_rows_sum_to_the_state(spark):
    df = spark.createDataFrame(random_log(5), SCHEMA)
    signed = retract.signed_rows(retract.row_images(df, FIELDS))
    got = {r.cust: (r.total_money, r.order_count)
           for r in retract.totals(signed, ["cust"], "money").collect()}
    state = changelog.cell_state(df).select(
        F.col("row")["o_custkey"].cast("bigint").alias("cust"), F.col("row")["o_totalprice"].cast("double").alias("m"))
    want = {r.cust: (r.m, r.n) for r in state.groupBy("cust").agg(
        F.sum("m").alias("m"), F.count(F.lit(1)).alias("n")).collect()}
    assert {k: ((v[0] or 0.0), v[1]) for k, v in got.items()} == {k: ((v[0] or 0.0), v[1]) for k, v in want.items()}
    assert signed.agg(F.sum("sign")).first()[0] == state.count()


def test_changelog_of_totals_replays_to_them(spark):
    """Applying the stream step by step: a retraction names the value that stands, and the
    last additions are the totals."""
    df = spark.createDataFrame([r for r in random_log(6) if r[4].get("o_totalprice", "0") is not None
                                and r[4].get("o_custkey", "0") is not None], SCHEMA)
    signed = retract.signed_rows(retract.row_images(df, FIELDS)).where("cust is not null and money is not null")
    order = ["es", "change_id", "pos", "row_key", "table"]
    told = retract.changelog_of_totals(signed, ["cust"], "money", order)
    standing, retracted = {}, 0
    for r in sorted(told.collect(), key=lambda r: (r.es, r.change_id, r.pos, r.row_key, r.table, r.is_add)):
        value = (r.total_money, r.order_count)
        if r.is_add:
            assert r.cust not in standing
            standing[r.cust] = value
        else:
            assert standing.pop(r.cust) == value
            retracted += 1
    assert retracted > 50
    assert standing == {r.cust: (r.total_money, r.order_count)
                        for r in retract.totals(signed, ["cust"], "money").collect()}


def test_empty_log(spark):
    images = retract.row_images(spark.createDataFrame([], SCHEMA), FIELDS)
    signed = retract.signed_rows(images)
    assert images.count() == 0 and retract.totals(signed, ["cust"], "money").count() == 0


def test_slices_of_a_hot_key_are_bounded_and_ordered(spark):
    """A third of all rows are one user's in one minute, most of them at one instant."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("uid"),
        F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, 60_000_000).otherwise(F.col("id") * 1000))
        .otherwise(F.col("id") * 1_000_000).alias("t"), "id")
    cut = slices.sliced(df, ["uid"], F.col("t"), F.col("id"), 3_600_000_000, most=500)
    sizes = cut.groupBy("_ks").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "id")).alias("a"),
                                   F.max(F.struct("t", "id")).alias("b"))
    rows = sorted(sizes.collect(), key=lambda r: (r._ks.uid, r._ks._slice))
    assert sum(r.n for r in rows) == n and max(r.n for r in rows) <= 2 * 500
    assert sum(r._ks.uid == "hot" for r in rows) > 10
    for x, y in zip(rows, rows[1:]):
        if x._ks.uid == y._ks.uid:
            assert tuple(x.b) < tuple(y.a)
    order = Window.partitionBy("uid").orderBy("t", "id")
    assert cut.withColumn("r", F.row_number().over(order)).count() == n
