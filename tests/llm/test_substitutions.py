"""Every substitution that the rule accepts is found."""

from itertools import combinations

import pytest
from llm_fixtures import folder  # noqa: F401

from cartmill.llm import decontaminate


def accepted(n):
    """The places that may differ in a run of n tokens."""
    most = max(k for k in range(n) if 10 * (n - k) >= 8 * n)
    return [set(x) for k in range(most + 1) for x in combinations(range(n), k)]


@pytest.mark.parametrize("n", range(2, 14))
def test_masks_leave_out_what_may_differ(n):
    masks = list(decontaminate.short_masks(n)) if n < 13 else []
    placed = [{p + s for p in m} for m in decontaminate.MASKS for s in range(n - m[-1])] + [set(m) for m in masks]
    assert all(any(not out & m for m in placed) for out in accepted(n))


def test_substitutions_of_short_items(spark):
    items = {n: [f"w{n}x{k}" for k in range(n)] for n in (2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 15)}
    docs, expected = [], set()
    for n, item in items.items():
        for out in accepted(n) if n < 14 else [{3, 4}, {5, 9, 14}]:
            expected.add((len(docs), n))
            docs.append((len(docs), " ".join(["before", *("other" if k in out else t for k, t in enumerate(item)), "after"])))
        docs.append((len(docs), " ".join("other" if k < (n + 3) // 4 or k > 10 else t for k, t in enumerate(item))))
    bench = spark.createDataFrame([(n, " ".join(t)) for n, t in items.items()], "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(rows, bench).collect()} == expected
