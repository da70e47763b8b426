"""Array expressions in SQL."""

from __future__ import annotations


def let(name: str, value: str, body: str) -> str:
    """`body` with `name` standing for `value`, which is worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running_totals(lengths: str, chunk: int = 256) -> str:
    """The sums before each element of an array of longs.

    Totals are built chunk by chunk, so that a very long array isn't copied once for each of
    its elements.
    """

    def before(array: str, value: str) -> str:
        return f"aggregate({array}, array(0L), (acc, e) -> array_append(acc, element_at(acc, -1) + {value}))"

    chunks = f"""if(size(v) = 0, CAST(array() AS ARRAY<ARRAY<BIGINT>>),
        transform(sequence(0, CAST((size(v) - 1) div {chunk} AS INT)), c -> slice(v, c * {chunk} + 1, {chunk})))"""
    within = f"transform(slice({before('p', 'e')}, 1, size(p)), x -> x + starts[k])"
    all_of = f"flatten(transform(parts, (p, k) -> {within}))"
    starts = before("parts", "aggregate(e, 0L, (a, x) -> a + x)")
    return let("v", lengths, let("parts", chunks, let("starts", starts, all_of)))
