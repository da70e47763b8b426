"""Many different vectors with one score."""

import random

import pytest
from llm_fixtures import folder  # noqa: F401

from cartmill.llm import ann


def lengths():
    """One direction in powers of two, whose cosines are exact."""
    return [[x * 2.0 ** (i - 30) for x in (1.0, 1.0, -1.0, 1.0)] for i in range(60)]


def one_hot():
    return [[float(j == 0)] * 1 + [float(j == i) for i in range(1, 64)] for j in range(64)]


def one_id():
    """The nearest forty vectors are of one id."""
    return [[1.0, 0.001 * i, 0.0, 0.0] for i in range(40)] + [[0.5, 1.0, 0.1 * i, 0.0] for i in range(20)]


@pytest.mark.parametrize("make", [lengths, one_hot, one_id])
def test_ties_go_to_the_smaller_id(spark, make):
    vectors = make()
    ids = list(range(len(vectors)))
    random.Random(1).shuffle(ids)
    if make is one_id:
        ids = [1000] * 40 + list(range(20))
    rows = list(zip(ids, vectors))
    table = spark.createDataFrame([*rows, (5000, vectors[0])], "vec_id long, embedding array<double>")
    found = {r.rank: r.vec_id for r in ann.search(table, table.where("vec_id = 5000"), reach=1.0).collect()}
    best = {}
    for i, v in rows:
        dot = sum(a * b for a, b in zip(v, vectors[0]))
        score = dot / (sum(a * a for a in v) ** 0.5 * sum(a * a for a in vectors[0]) ** 0.5)
        best[i] = max(score, best.get(i, -1))
    expected = sorted(best, key=lambda i: (-round(best[i], 14), i))[:5]
    assert [found[r] for r in range(1, 6)] == expected
