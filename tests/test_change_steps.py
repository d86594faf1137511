"""The steps all change-log queries share: a message is parsed once, a log is read once."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato.operators import changelog, parse, retract, slices
from mercato.plans import queries
from test_retract import FIELDS, SCHEMA, random_log, replay


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_message_is_parsed_once(spark):
    """Filters on the type, database and table do not parse it again."""
    orders = parse.filter_table(queries.order_changes(spark, SF_SMALL), "orders").where("row_key is not null")
    assert plan_of(orders).count("from_json(") == 1


def test_cell_state_reads_its_log_once(spark, scratch):
    spark.createDataFrame(random_log(7), SCHEMA).write.parquet(f"{scratch}/log")
    state = changelog.cell_state(spark.read.parquet(f"{scratch}/log"))
    assert plan_of(state).count("FileScan parquet") == 1


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_cell_state_is_that_of_a_replay(spark, seed):
    """Puts of many sets of columns (and none), deletions, of the same place too."""
    log = [(*r[:4], {} if i % 17 == 0 else r[4], r[5], r[6] // 2 * 2 if r[3] == "DELETE" else r[6], r[7])
           for i, r in enumerate(random_log(seed))]
    rows, newest = {}, {}
    for _, table, key, kind, row, es, cid, pos in sorted(log, key=lambda r: (r[5], r[6], r[7], r[3] == "DELETE")):
        if key is None or kind.lower() not in ("insert", "update", "delete"):
            continue
        if kind == "DELETE":
            rows.pop((table, key), None)
        elif row:
            rows[table, key] = {**rows.get((table, key), {}), **row}
            newest[table, key] = es
    got = changelog.cell_state(spark.createDataFrame(log, SCHEMA).repartition(5)).collect()
    assert {(r.table, r.row_key): (dict(r.row), r.es) for r in got} == {k: (v, newest[k]) for k, v in rows.items()}


def test_a_cell_named_twice_is_one_cell(spark):
    message = ('{"data":[{"k":"1","a":"x","a":"y"}],"database":"dwshow","es":%d,"id":%d,"pkNames":["k"],'
               '"table":"t","type":"INSERT"}')
    other = message.replace('"a":"x","a":"y"', '"b":"z"')
    changes = parse.parse_changes(spark.createDataFrame([(message % (5, 1),), (other % (6, 2),)], "value string"))
    assert [(r.row, r.es) for r in changelog.cell_state(changes).collect()] == [({"k": "1", "a": "x", "b": "z"}, 6)]
    one = parse.parse_changes(spark.createDataFrame([(message % (5, 1),)], "value string"))
    assert changelog.cell_state(one).select(F.size("row")).first()[0] == 2


@pytest.mark.parametrize("seed,slice_us,most", [(21, 1_000_000, 20), (22, 50_000_000, 60), (23, retract.DAY_US, 1)])
def test_heavy_and_light_keys_have_the_images_of_a_replay(spark, monkeypatch, seed, slice_us, most):
    """Some keys in slices, some in one window, some sharing a hash with a heavy one."""
    monkeypatch.setattr(slices, "PER_CUT", 3)
    monkeypatch.setattr(slices, "BUCKETS", 5)
    log = random_log(seed)
    df = spark.createDataFrame(log, SCHEMA).repartition(5)
    got = retract.row_images(df, FIELDS, slice_us, most)
    rows = [(r.table, r.row_key, r.es, r.change_id, r.before and tuple(r.before), r.after and tuple(r.after))
            for r in got.collect()]
    assert sorted(rows, key=str) == sorted(replay(log), key=str)
    ch = changelog.supported(df)
    sizes = ch.groupBy(*changelog.KEY).count()
    heavy = slices.heavy_keys(ch, changelog.KEY, most)
    assert heavy.exceptAll(sizes.where(f"count > {most}").drop("count")).isEmpty()
    assert heavy.count() == sizes.where(f"count > {most}").count() > 0


def test_light_keys_are_shuffled_once(spark):
    """Without a heavy key no images are handed on between slices."""
    images = retract.row_images(spark.createDataFrame(random_log(24), SCHEMA), FIELDS)
    plan = plan_of(images)
    assert plan.count("Exchange") == 1 and "Join" not in plan
