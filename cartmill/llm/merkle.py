"""A manifest of a table: a hash tree over its rows, and a proof for each row.

A row's leaf is the SHA-256 of its fields, each with its length in front. Leaves of one group
ascend by id and form a tree, whose nodes hash runs of FAN neighbours (the last run may be
shorter); the trees' tops, ordered by group, form the tree that gives the root.

Rows are numbered by one sort over ranges, which cuts a hot group like any other. Nodes are
computed in blocks of FAN ** LEVELS neighbours, LEVELS levels at a time, from the leaves up, so
that no task sees more than a block. Proofs are an octopus multiproof a block: it works out the
fewest nodes that its leaves' paths lack, all at once; one join fetches them; what lies between
is derived from them and the leaves, and each leaf's own proof is read off.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.llm.store import discard, keep, small

FAN = 3
#: Levels computed in a task: a block has FAN ** LEVELS neighbours at most.
LEVELS = 6
#: The number of the tree over the groups' trees, which have the numbers from 0 on.
TOP = -1


def leaf(fields: dict[str, Column]) -> Column:
    """Lowercase hex SHA-256 of the fields in turn: `-` where null, else UTF-8 byte count, `:`, value."""
    parts = []
    for value in fields.values():
        value = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def width(n: int, level: int) -> int:
    """Nodes on a level of a tree of n leaves."""
    return -(-n // FAN**level)


def height(n: int) -> int:
    """The level that has a single node."""
    level = 0
    while width(n, level) > 1:
        level += 1
    return level


def digest(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def fold(start: str, proof: str, path: list[tuple[int, int]]) -> str:
    """The root that a leaf and its proof lead to; path has (place, leaves) of each tree, from below."""
    node, at = start, 0
    for place, n in path:
        while n > 1:
            slot = place % FAN
            others = min(FAN, n - (place - slot)) - 1
            left, right = at + 64 * slot, at + 64 * others
            node = hashlib.sha256((proof[at:left] + node + proof[left:right]).encode()).hexdigest()
            at, place, n = right, place // FAN, width(n, 1)
    return node


def missing(places: list[int], n: int) -> list[tuple[int, int]]:
    """The fewest (level, index) that the paths of these leaves lack, in a tree of n leaves."""
    found, known = [], sorted(set(places))
    for level in range(height(n)):
        parents = sorted({k // FAN for k in known})
        children = {c for p in parents for c in range(p * FAN, min(p * FAN + FAN, width(n, level)))}
        found += [(level, c) for c in sorted(children.difference(known))]
        known = parents
    return found


def _numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """With `nth`, the place of each row in the order, from 0 on; written.

    Rows are sorted by ranges; a range's first place is the sum of the sizes before, of which
    there are as many as partitions.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = keep(dealt.withColumn("at", F.monotonically_increasing_id()), "sorted")
    # The number's upper part is the partition, the lower 33 bits count its rows.
    sizes = dealt.groupBy(F.expr("at >> 33 AS range")).count().orderBy("range").collect()
    before = np.concatenate([[0], np.cumsum([r["count"] for r in sizes])]).tolist()
    starts = rows.sparkSession.createDataFrame([(r["range"], b) for r, b in zip(sizes, before)], "range long, before long")
    placed = dealt.join(F.broadcast(starts), F.expr("at >> 33") == F.col("range"))
    return placed.selectExpr(*[f"`{c}`" for c in rows.columns], "before + (at & ((1L << 33) - 1)) AS nth")


def _climb(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of the next LEVELS levels above (tree, n, idx, hash) of this one."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        tree, n, first = int(rows["tree"].iloc[0]), int(rows["n"].iloc[0]), int(rows["idx"].iloc[0])
        below, out = rows["hash"].tolist(), []
        for k in range(level + 1, level + LEVELS + 1):
            if width(n, k - 1) == 1:
                break
            below, first = [digest(below[i : i + FAN]) for i in range(0, len(below), FAN)], first // FAN
            out += [(tree, n, k, first + i, h) for i, h in enumerate(below)]
        return pd.DataFrame(out, columns=["tree", "n", "level", "idx", "hash"])

    block = F.expr(f"idx div {FAN**LEVELS}").alias("block")
    return nodes.groupBy("tree", block).applyInPandas(run, "tree long, n long, level int, idx long, hash binary")


def _nodes(leaves: DataFrame, most: int) -> DataFrame:
    """All nodes of the trees of (tree, n, idx, hash), leaves included, as (tree, n, level, idx, hash)."""
    level, found = 0, leaves.select("tree", "n", F.lit(0).alias("level"), "idx", "hash")
    frontier = leaves
    while level < height(most):
        higher = keep(_climb(frontier, level), "nodes")
        found = found.unionByName(higher)
        level += LEVELS
        frontier = higher.where(F.col("level") == level)
    return found


def _tops(nodes: DataFrame, most: int) -> DataFrame:
    """The nodes that are tops of their trees."""
    top = F.coalesce(*[F.when(F.col("n") <= FAN**k, F.lit(k)) for k in range(height(most) + 1)])
    return nodes.where(F.col("level") == top)


def prove(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    doc_id: str = "doc_id",
    group: str = "source",
    presented: dict[str, Column] | None = None,
) -> DataFrame:
    """A row a document: its id and group, leaf, subroot, root, proof, place, leaves, folded_root, verified.

    `proof` has the digests, 64 characters each, of the others in every run on the way up, level
    by level, left to right. folded_root is what `presented` (fields as they are found later;
    the given ones by default) and the proof lead to, and verified tells whether that is the
    root. `place` is the document's place in its group's tree, which has `leaves` leaves.

    Groups are ordered null first, then by UTF-8 bytes; in a group null ids come first, and rows
    with one id are ordered by their leaves, so that repeated rows are leaves of their own. An
    empty frame gives no rows. Other columns aren't returned.
    """
    given = {c: F.col(f"`{c}`") for c in fields}
    found = leaf({**given, **presented}) if presented else F.lit(None).cast("string")
    own = leaf(given)
    rows = keep(
        docs.select(
            F.col(f"`{doc_id}`").alias("id"),
            F.col(f"`{group}`").alias("part"),
            F.unhex(own).alias("hash"),
            F.unhex(found).alias("found"),
            F.monotonically_increasing_id().alias("row"),
        ).select("id", "part", "hash", F.when(F.col("found") != F.col("hash"), F.col("found")).alias("found"), "row"),
        "leaves",
    )
    order = [F.col("part").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("hash"), F.col("row")]
    numbered = _numbered(rows, *order)
    trees = numbered.groupBy("part").agg(F.min("nth").alias("first"), F.count("*").alias("n"))
    trees = keep(_numbered(trees, F.col("first")).withColumnRenamed("nth", "tree"), "trees")
    many, most = trees.agg(F.count("*"), F.max("n")).first()
    named = trees.select(F.col("part").alias("of"), "first", "n", "tree")
    leaves = keep(
        numbered.join(small(named, many, 256), F.col("part").eqNullSafe(F.col("of")))
        .withColumn("idx", F.col("nth") - F.col("first"))
        .select("tree", "n", "idx", "hash", "found", "id", "part"),
        "numbered",
    )
    discard(rows)
    nodes = _nodes(leaves, most or 0)
    tops = keep(_tops(nodes, most or 0).select(F.lit(TOP).cast("long").alias("tree"), F.lit(many).cast("long").alias("n"), F.col("tree").alias("idx"), "hash"), "tops")
    over = _nodes(tops, many)
    root = _tops(over, many).select(F.hex("hash")).first()
    root = root[0].lower() if root else None
    block = F.expr(f"idx div {FAN**LEVELS}").alias("block")
    # As text: numbers with nulls would pass through pandas as floats.
    as_text = [F.col(c).cast("string").alias(c) for c in ("id", "part")]
    blocks = leaves.select("tree", "n", "idx", "hash", "found", *as_text, block)

    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        tree, n = int(rows["tree"].iloc[0]), int(rows["n"].iloc[0])
        wanted = [(tree, *x) for x in missing(rows["idx"].tolist(), n)] + [(TOP, *x) for x in missing([tree], many)]
        out = pd.DataFrame(wanted, columns=["of", "level", "idx"])
        return out.assign(tree=tree, block=rows["block"].iloc[0])

    asked = blocks.select("tree", "n", "idx", "block").groupBy("tree", "block").applyInPandas(
        ask, "tree long, block long, of long, level int, idx long"
    )
    stored = nodes.unionByName(over).select(F.col("tree").alias("of"), "level", "idx", "hash")
    fetched = keep(asked.join(stored, ["of", "level", "idx"]).select("tree", "block", "of", "level", "idx", "hash"), "fetched")

    def expand(rows: pd.DataFrame, lacking: pd.DataFrame) -> pd.DataFrame:
        tree, n = int(rows["tree"].iloc[0]), int(rows["n"].iloc[0])
        got: dict[tuple[int, int], dict[int, bytes]] = {}
        for of, level, idx, hashed in zip(lacking["of"], lacking["level"], lacking["idx"], lacking["hash"]):
            got.setdefault((of, level), {})[idx] = hashed
        shared = _paths(dict(zip(rows["idx"], rows["hash"])), n, {k: v for (of, k), v in got.items() if of == tree})
        subroot = shared[-1][0][0]
        above = _paths({tree: subroot}, many, {k: v for (of, k), v in got.items() if of == TOP})
        rest, out = _proof(above, tree), []
        proofs: dict[int, str] = {}
        for idx, hashed, found in zip(rows["idx"], rows["hash"], rows["found"]):
            run = idx // FAN
            if run not in proofs:
                proofs[run] = _proof(shared, run, 1)
            proof = _others(shared, 0, idx) + proofs[run] + rest
            start = (hashed if found is None else found).hex()
            out.append((hashed.hex(), subroot.hex(), proof, fold(start, proof, [(idx, n), (tree, many)])))
        own = pd.DataFrame(out, columns=["leaf", "subroot", "proof", "folded_root"])
        return pd.concat([rows[["id", "part", "idx", "n"]].reset_index(drop=True), own], axis=1)

    kinds = dict(leaves.dtypes)
    schema = "id string, part string, idx long, n long, leaf string, subroot string, proof string, folded_root string"
    proven = blocks.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInPandas(expand, schema)
    return proven.select(
        F.col("id").cast(kinds["id"]).alias(doc_id),
        *([F.col("part").cast(kinds["part"]).alias(group)] if group != doc_id else []),
        "leaf",
        "subroot",
        F.lit(root).alias("root"),
        "proof",
        F.col("idx").alias("place"),
        F.col("n").alias("leaves"),
        "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )


def _paths(known: dict[int, bytes], n: int, got: dict[int, dict[int, bytes]]) -> list[tuple[dict[int, bytes], int]]:
    """(nodes, width) of each level, from leaves and the nodes fetched: what lies between is derived."""
    out = []
    for level in range(height(n) + 1):
        here = {**known, **got.get(level, {})}
        out.append((here, width(n, level)))
        if level < height(n):
            known = {
                p: digest([here[c] for c in range(p * FAN, min(p * FAN + FAN, width(n, level)))])
                for p in {k // FAN for k in known}
            }
    return out


def _others(levels, level: int, idx: int) -> str:
    """Digests of the others in a node's run; none at the top."""
    here, many = levels[level]
    if many == 1:
        return ""
    first = idx - idx % FAN
    return "".join(here[c].hex() for c in range(first, min(first + FAN, many)) if c != idx)


def _proof(levels, idx: int, level: int = 0) -> str:
    """The siblings from a node to the top of its tree."""
    out = []
    for k in range(level, len(levels)):
        out.append(_others(levels, k, idx))
        idx //= FAN
    return "".join(out)
