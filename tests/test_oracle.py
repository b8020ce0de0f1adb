"""Every registered query against its DuckDB SQL on the smallest test scale.

Set STARLOOM_ORACLE_SF=/root/testdata/sf0.01 to run at the driver's scale.
"""
import os

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = os.environ.get("STARLOOM_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert r["cols_equal"] and r["rows_spark"] == r["rows_oracle"] and r["hash_equal"], r
