"""The manifest's trees and proofs, against a tree built in plain Python."""

import hashlib
import random

import pytest
from llm_fixtures import SMALL, folder  # noqa: F401
from pyspark.sql import functions as F

from cartmill.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """The top, and each leaf's path of (before, after) siblings."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for k, i in enumerate(at):
            run = runs[i // 3]
            paths[k].append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        at, level = [i // 3 for i in at], [sha("".join(r)) for r in runs]
    return level[0], paths


def expected(rows, change):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = [sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in names]
    tops = [tree([leaf(r) for r in g]) for g in ordered]
    root, over = tree([t for t, _ in tops])
    out = []
    for g, (top, paths), above in zip(ordered, tops, over):
        for r, path in zip(g, paths):
            node = sha_start = leaf(change(r))
            for left, right in path + above:
                node = sha(left + node + right)
            proof = "".join(x + y for x, y in path + above)
            out.append((r[0], r[1], leaf(r), top, root, proof, node, node == root, sha_start))
    return sorted(out, key=str)


def sample(rng, n):
    sources = [None, "", "a", "b", "é", "z", "Z", "hot"]
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "one\ntwo", "\n\n", "日本\n語", f"text {i}", "x" * 5000])
        rows.append((i * 7 % n, "hot" if i % 3 else rng.choice(sources), rng.choice([None, "en"]), rng.choice([None, i]), text))
    return rows


@pytest.mark.parametrize("n, levels", [(1, 6), (2, 1), (400, 2), (400, 6)])
def test_against_plain_trees(spark, monkeypatch, n, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = sample(random.Random(n), n)
    if n > 100:
        rows += [rows[5]] * 9 + [(None, "a", None, None, "no id\n"), (None, None, None, None, None), (3, "a", "en", 1, "shared id"), (2**60 + 1, "a", "en", 2, "large id")]
        rows += [(k, f"source {k}", None, None, "alone") for k in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS tree", "2 AS idx", "'x' AS leaf", "4 AS part", "5 AS hash")
    later = {"text": F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))}
    change = lambda r: (*r[:4], r[4].replace("\n", "") if r[4] and r[0] is not None and r[0] % 2 == 0 else r[4])
    proven = merkle.prove(frame, presented=later).collect()
    found = [(r.doc_id, r.source, r.leaf, r.subroot, r.root, r.proof, r.folded_root, r.verified) for r in proven]
    assert sorted(found, key=str) == [e[:-1] for e in expected(rows, change)]


def test_a_table_that_nobody_changed_and_an_empty_one(spark):
    frame = spark.createDataFrame(sample(random.Random(1), 30), SCHEMA)
    assert all(r.verified and r.folded_root == r.root for r in merkle.prove(frame).collect())
    assert merkle.prove(frame.where("false")).count() == 0


def test_least_missing_nodes():
    assert merkle.missing(list(range(9)), 9) == []
    assert merkle.missing([0], 1) == []
    assert merkle.missing([4], 10) == [(0, 3), (0, 5), (1, 0), (1, 2), (2, 1)]
    # Two leaves of one run share all that lies above; what either derives isn't fetched.
    assert merkle.missing([0, 3], 9) == [(0, 1), (0, 2), (0, 4), (0, 5), (1, 2)]


def test_query_matches_plain_trees(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    import zlib

    change = lambda r: (*r[:4], r[4].replace("\n", "") if r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[4])
    found = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in queries.op11_merkle_manifest(spark, SMALL).collect()]
    wanted = [(e[0], *e[2:5], sha(e[5]), *e[6:8]) for e in expected(rows, change)]
    assert sorted(found) == sorted(wanted)
