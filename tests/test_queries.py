"""Every named query against its SQL, at the smallest scale."""

import pytest
from conftest import SMALL
from oracle import compare

from listenlake import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, QUERIES[name], SQL[name], SMALL) == ""


def test_entry_has_the_flagship_columns(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns[:2] == ["genre", "subscription_type"]
    assert df.count() > 0
