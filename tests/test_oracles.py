"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001),
plus the entry-point contract."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

import __spark_entry__ as entry  # noqa: E402
from mercato.plans import queries as own_queries  # noqa: E402
from compare import digest  # noqa: E402
from mercato.plans.oracles import ORACLES  # noqa: E402
from mercato.sources.tables import TABLES  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

OWN = own_queries.registered()
NAMES = sorted(OWN)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.queries())
    assert set(NAMES) == set(ORACLES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["city", "province", "total_money", "order_count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = OWN[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(srows, df.columns)[0] == digest(orows, ocols)[0]
