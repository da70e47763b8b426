"""Tables with hardly more vectors than a result shows."""

import pytest
from llm_fixtures import folder  # noqa: F401

from cartmill.llm import ann


@pytest.mark.parametrize("n", [2, 4, 5, 6, 7])
def test_all_candidates_at_the_default_reach(spark, n):
    rows = [(i, [float(i == j) + 0.01 * j for j in range(8)]) for i in range(n)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.search(table, table).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in found} == {i: min(5, n - 1) for i in range(n)}
