"""Sliding windows from signed events against the copying forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mercato.operators import windows

T0 = dt.datetime(1969, 12, 30)


def rows(seed, n=400):
    rnd = random.Random(seed)
    return [(rnd.choice(["a", "b", None]), T0 + dt.timedelta(seconds=rnd.randrange(400_000)), rnd.randrange(100),
             rnd.choice([None, round(rnd.random() * 100, 2)])) for _ in range(n)]


MEASURES = {"n": ("count", None), "known": ("count", "price"), "total": ("sum", "qty"), "money": ("money", "price")}


@pytest.mark.parametrize("seed,width,slide,chunk", [
    (1, "1 hour", "5 minutes", 4096), (2, "1 hour", "1 hour", 4096), (3, "2 hours", "1 minute", 7), (4, "1 day", "2 hours", 1)])
def test_signed_events_give_the_windows(spark, seed, width, slide, chunk):
    """NULL keys, times before 1970, empty stretches, rows without a value, small ranges."""
    df = spark.createDataFrame(rows(seed), "k string, ts timestamp_ntz, qty int, price double")
    df = df.unionByName(df.limit(1).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    got = windows.sliding_aggregate(df, "ts", ["k"], MEASURES, width, slide, chunk)
    want = windows.window_aggregate(df, "ts", ["k"], MEASURES, width, slide)
    assert got.schema["window_start"].dataType == want.schema["window_start"].dataType
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_only_what_can_be_taken_back(spark):
    df = spark.createDataFrame(rows(5, 5), "k string, ts timestamp_ntz, qty int, price double")
    for measure in (("min", "qty"), ("sum", "price")):
        with pytest.raises(ValueError):
            windows.sliding_aggregate(df, "ts", ["k"], {"x": measure}, "1 hour", "1 minute")
    with pytest.raises(ValueError):
        windows.sliding_aggregate(df, "ts", ["k"], {"n": ("count", None)}, "1 hour", "7 minutes")
    assert windows.sliding_aggregate(df.limit(0), "ts", ["k"], {"n": ("count", None)}, "1 hour", "1 minute").count() == 0


def test_rows_shuffled_do_not_depend_on_the_ratio(spark):
    """No expression before the last exchange copies a pane to its windows."""
    df = spark.createDataFrame(rows(6), "k string, ts timestamp_ntz, qty int, price double")
    plan = windows.sliding_aggregate(df, "ts", ["k"], {"n": ("count", None)}, "1 hour", "5 seconds") \
        ._jdf.queryExecution().optimizedPlan().toString()
    spread = plan.index("explode(sequence(")
    assert "Aggregate" not in plan[:spread] and "Repartition" not in plan[:spread]
