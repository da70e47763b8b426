"""Every named query against its SQL, over the smallest whole tables."""

import pytest
from compare import connect, differences
from conftest import SMALL

from cartmill.plans.catalog import QUERIES
from cartmill.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    assert differences(found.collect(), dict(found.dtypes), duck.sql(ORACLE[name])) == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1084
