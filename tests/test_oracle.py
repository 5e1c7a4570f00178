"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from tools.check import compare, connect  # noqa: E402

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="session")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        same, note = compare(df, con, ORACLE[name])
        assert same, note
    else:
        assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(QUERIES)
