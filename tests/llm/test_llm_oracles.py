"""The queries that SQL can express, against their DuckDB SQL; the whole registry."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import digest  # noqa: E402
from mercato.llm.oracles import ORACLES  # noqa: E402
from mercato.llm.queries import registered  # noqa: E402
from mercato.sources.tables import TABLES  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402


def test_registered():
    names = set(entry.queries())
    assert set(registered()) <= names and "pipeline" in names
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in registered()}
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = registered()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    columns = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(want)
    assert digest(rows, df.columns)[0] == digest(want, columns)[0]
