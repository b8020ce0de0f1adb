import __spark_entry__ as E
from starloom.plans.catalog import QUERIES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_sk" in df.columns


def test_every_query_has_an_oracle_except_documented():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) - set(o) == set()
