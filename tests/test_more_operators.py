"""User aggregates (A6), hierarchies of any depth (J2), keyed scans (S3-S5), sliding distinct
counts (A5), hot groups of the window join (J5)."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from mercato.operators import aggregates, dims, joins, patterns, slices, windows
from mercato.sources.keyed_scan import scan_keyed, write_keyed

T0 = dt.datetime(2024, 1, 1)


def longest():
    """An aggregate no built-in gives (a class of its own, so workers need not import this file)."""
    class Longest(aggregates.UserAggregate):
        """An aggregate no built-in gives: the longest value, and how often values were longer."""

        accumulator, returns = "text string, n bigint", "struct<text: string, n: bigint>"

        def create(self):
            return None, 0

        def add(self, acc, rows):
            values = rows.iloc[:, 0].dropna().tolist()
            best = max([*values, *([acc[0]] if acc[0] is not None else [])], key=lambda v: (len(v), v), default=None)
            return best, acc[1] + len(values)

        def merge(self, a, b):
            texts = [t for t in (a[0], b[0]) if t is not None]
            return max(texts, key=lambda v: (len(v), v), default=None), a[1] + b[1]

        def result(self, acc):
            return acc

    return Longest()


@pytest.mark.parametrize("most", [1 << 16, 2])
def test_user_aggregates_equal_plain_python(spark, most):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]), rnd.choice(["x", "yy", "zzz", None]),
             rnd.choice([None, 5, 7])) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, w int, v string, cents long").repartition(7)
    want = {}
    for k, w, v, c in rows:
        want.setdefault((k, w), []).append((v, c))

    def got(agg, inputs):
        return {(r.k, r.w): r.out for r in aggregates.aggregate(df, ["k", "w"], inputs, agg, "out", most).collect()}

    assert got(aggregates.Count(), []) == {g: len(x) for g, x in want.items()}
    assert got(aggregates.DistinctCount(), ["v"]) == {g: len({v for v, _ in x if v}) for g, x in want.items()}
    sums = got(aggregates.SumAndCount(), ["cents"])
    assert {g: tuple(r) for g, r in sums.items()} == {
        g: (sum(c or 0 for _, c in x) / 100, len(x)) for g, x in want.items()}
    longer = got(longest(), ["v"])
    for g, x in want.items():
        values = [v for v, _ in x if v]
        assert tuple(longer[g]) == (max(values, key=len, default=None), len(values))
    spread = aggregates.spread(df, ["k"], "v", aggregates.DistinctCount(), "n", parts=3)
    assert {r.k: r.n for r in spread.collect()} == {k: len({v for a, _, v, _ in rows if a == k and v})
                                                    for k in ("a", "b", None)}
    assert aggregates.aggregate(df.limit(0), ["k"], [], aggregates.Count(), "n").count() == 0


def test_a_keys_rows_come_in_few_pieces():
    """user_channel_users (F21): a piece of rows has a price, so rows of many batches are grouped together,
    and a set grows in place instead of being made anew by every piece."""
    import pyarrow as pa

    pieces = []

    class Counted(aggregates.DistinctCount):
        def add(self, acc, rows):
            pieces.append(len(rows))
            return super().add(acc, rows)

    batches = [pa.RecordBatch.from_pydict({"k": ["a", None, "a"], "v": [str(i), str(i), None]}) for i in range(50)]
    sent = list(aggregates._partial(iter(batches), ["k"], Counted(), ["k", "_acc_values"], 100))
    assert sorted(pieces) == [50, 100]
    assert {k: sorted(map(int, v)) for b in sent for k, v in zip(*b.to_pydict().values())} == {
        k: list(range(50)) for k in ("a", None)}
    own = {"x"}
    assert Counted().merge((own,), (["y"],))[0] is own == {"x", "y"}


def test_ancestors_at_any_depth(spark):
    rows = [(1, "r", 0), (2, "a", 1), (3, "b", 2), (4, "c", 3), (5, "d", 4), (6, "e", 2), (7, "other", None),
            (8, "orphan", 999), *((100 + i, f"n{i}", 100 + i - 1 if i else 1) for i in range(40))]
    got = {r.id: r for r in dims.ancestors(spark.createDataFrame(rows, "id long, name string, pid long")).collect()}
    assert len(got) == len(rows) and not any(r.cyclic for r in got.values())
    assert [p.name for p in got[5].path] == ["r", "a", "b", "c", "d"] and got[5].depth == 5
    assert got[7].depth == got[8].depth == 1 and got[8].root == "orphan"
    assert got[139].depth == 41 and got[139].root == "r" and [p.id for p in got[139].path][:2] == [1, 100]


def test_ancestors_meet_in_bounded_tasks(spark):
    """area_paths (F17): rows that are done, and rows behind a node that many share, are not one task's."""
    rows = spark.createDataFrame([(i, i % 2 or None) for i in range(4000)]
                                 + [(9000 + i, i) for i in range(4000)], "id long, _up long")
    there = spark.createDataFrame([(i, f"n{i}") for i in range(3000)], "_id long, _n string")
    out = dims._behind(rows, there, 16, most=500)
    got = out.withColumn("p", F.spark_partition_id()).collect()
    assert sorted((r.id, r._up, r._n) for r in got if r._up is not None) == sorted(
        (i, u, f"n{u}" if u < 3000 else None) for i, u in
        [*((i, 1) for i in range(1, 4000, 2)), *((9000 + i, i) for i in range(4000))])
    assert sum(r._up is None and r._id is None and r._n is None for r in got) == 2000 and len(got) == 8000
    sizes = {}
    for r in got:
        sizes[r.p] = sizes.get(r.p, 0) + 1
    assert max(sizes.values()) < 1300


def test_ancestors_of_a_cycle(spark):
    """A cycle of three, one of a node with itself, and what hangs below them."""
    rows = [(1, "a", 3), (2, "b", 1), (3, "c", 2), (4, "below", 1), (5, "far", 4), (6, "self", 6), (7, "under", 6),
            (8, "root", 0), (9, "fine", 8), *((20 + i, "x", 19 + i if i else 5) for i in range(9))]
    got = {r.id: (r.cyclic, r.depth) for r in dims.ancestors(
        spark.createDataFrame(rows, "id long, name string, pid long")).collect()}
    assert {i for i, (cyclic, _) in got.items() if cyclic} == {1, 2, 3, 4, 5, 6, 7, *range(20, 29)}
    assert got[9] == (False, 2) and got[8] == (False, 1)


def test_keyed_scan_pushes_the_key_range(spark, scratch):
    path = os.path.join(scratch, "store")
    rows = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("row_key"),
                                    F.col("id").alias("a"), F.lit("x").alias("b"))
    write_keyed(rows.repartition(8), path)
    part = scan_keyed(spark, path, start="0100", stop="0103", cells=["a"])
    assert sorted(r.a for r in part.collect()) == [100, 101, 102] and part.columns == ["row_key", "a"]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,0100)" in plan and "LessThan(row_key,0103)" in plan
    assert "struct<row_key:string,a:bigint>" in plan
    assert sorted(r.a for r in scan_keyed(spark, path, prefix="099").collect()) == list(range(990, 1000))
    assert scan_keyed(spark, path).count() == 1000


@pytest.mark.parametrize("chunk", [4096, 2])
def test_sliding_distinct_counts(spark, chunk):
    rnd = random.Random(3)
    rows = [(rnd.choice(["c", None]), rnd.choice(["u1", "u2", "u3", None]),
             T0 + dt.timedelta(minutes=rnd.randrange(3000))) for _ in range(120)]
    df = spark.createDataFrame(rows, "channel string, uid string, ts timestamp_ntz")
    got = windows.sliding_distinct(df, "ts", ["channel"], "uid", "2 hours", "10 minutes", chunk=chunk)
    w = df.groupBy("channel", F.window("ts", "2 hours", "10 minutes").alias("w")).agg(
        F.count_distinct("uid").alias("user_count"))
    want = w.select("channel", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_count")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_window_join_deals_a_hot_group(spark):
    n = 3000
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                 F.col("id").alias("a"), F.lit(T0).alias("lt"))
    right = spark.range(20).select(F.lit(0).cast("long").alias("rk"), F.col("id").alias("b"), F.lit(T0).alias("rt"))
    out = joins.window_join(left, right, "k", "rk", "lt", "rt", "1 hour", most=100)
    rows = out.select("a", "b").collect()
    assert len(rows) == len(set(rows)) == 20 * n // 3


def test_repetition_under_a_hot_minute(spark, monkeypatch):
    """A third of the clicks are one user's in one minute: slices are cut, results stay."""
    monkeypatch.setattr(slices, "MOST", 200)
    monkeypatch.setattr(slices, "PER_CUT", 8)
    rnd = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else f"u{rnd.randrange(40)}", "p",
             T0 + dt.timedelta(seconds=rnd.randrange(60) if i % 3 == 0 else rnd.randrange(90_000)), "x")
            for i in range(1500)]
    df = spark.createDataFrame(rows, "offset long, uid string, product_id string, ts timestamp_ntz, area string")
    for op in (patterns.repeated_skip_past_last, patterns.repeated_all):
        cut = op(df, ["uid", "product_id"], "ts", "offset", 3, "10 seconds", payload=["area"])
        monkeypatch.setattr(slices, "MOST", 1 << 16)
        whole = op(df, ["uid", "product_id"], "ts", "offset", 3, "10 seconds", payload=["area"])
        assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
        monkeypatch.setattr(slices, "MOST", 200)
