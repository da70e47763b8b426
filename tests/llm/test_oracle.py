"""The queries that SQL can express, over the smallest whole tables."""

import pytest
from compare import connect, differences
from llm_fixtures import SMALL, docs, folder  # noqa: F401

from cartmill.llm.oracle import ORACLE
from cartmill.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, name):
    found = QUERIES[name](spark, SMALL)
    assert differences(found.collect(), dict(found.dtypes), connect(SMALL).sql(ORACLE[name])) == []
