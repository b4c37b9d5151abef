"""Every registered query against its DuckDB oracle (row count, columns,
order-insensitive values) on the smallest testdata."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import duck, frame_hash  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

# the training-data operators have their own tests
QUERIES = {k: v for k, v in entry.queries().items() if k != "pipeline" and not k.startswith("op")}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(SQL) == set()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert frame_hash(rows, df.columns) == frame_hash(drows, dcols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert "session_count" in df.columns
