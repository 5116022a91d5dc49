"""Every registered query equals its independent DuckDB oracle (sf0.001)."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from compare import TABLES, digest  # noqa: E402
from tessera.plans.queries import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    # the training-data queries that SQL cannot express have brute-force tests of their own
    assert set(registry()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(oracle_sql()[key])
    want = digest([d[0] for d in cur.description], cur.fetchall())
    assert got == want
