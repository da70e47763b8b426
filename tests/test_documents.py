"""Cutting list documents, against Python's JSON reader."""

import json
import random

import pytest

from cartmill.sources import documents


def text_of(rng, depth=0):
    """A JSON value with its own spelling."""
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.choice(["1.10", "0", "-2e3", "null", "true", "12345678901234567890.123456"])
    if kind in (1, 2):
        return json.dumps("".join(rng.choices('ab{}[],:"\\ é日\n\t', k=rng.randint(0, 12))), ensure_ascii=rng.random() < 0.5)
    if kind == 3:
        return rng.choice(["[]", "{}", '""'])
    gap = rng.choice(["", " ", "\n  ", "\t"])
    inner = [text_of(rng, depth + 1) for _ in range(rng.randint(1, 4))]
    if kind == 4:
        return "[" + gap + f",{gap}".join(inner) + gap + "]"
    return "{" + gap + f",{gap}".join(f'"k{i}"{gap}:{v}' for i, v in enumerate(inner)) + gap + "}"


def cut(spark, path, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        return documents.cut(spark, str(path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("split", [40, 1000, 1 << 27])
def test_elements_keep_every_byte_however_the_file_is_split(spark, tmp_path, split):
    rng = random.Random(split)
    given = {}
    for name in ("a", "b"):
        bodies = [text_of(rng) for _ in range(30)]
        given[name] = bodies
        gaps = [rng.choice(["", " ", "\r\n", "\t "]) for _ in range(2 * len(bodies) + 2)]
        text = gaps.pop() + "[" + ",".join(f"{gaps.pop()}{b}{gaps.pop()}" for b in bodies) + "]" + gaps.pop()
        json.loads(text)
        (tmp_path / f"{name}.json").write_text(text)
    found = cut(spark, tmp_path, split)
    assert found.unreadable() == []
    rows = found.elements().orderBy("doc", "block", "pos").collect()
    for name, bodies in given.items():
        assert [r.body for r in rows if r.doc.endswith(f"{name}.json")] == bodies
    if split == 40:
        assert found.ranges.count() > 20


def test_one_long_element_and_empty_lists(spark, tmp_path):
    long = json.dumps({"text": "{[,]}" * 2000, "n": [1] * 500})
    for name, text, bodies in (("long", f"[{long}]", [long]), ("none", " [ ] ", []), ("one", "[7]", ["7"]), ("two", "[{},{}]\n", ["{}", "{}"])):
        (tmp_path / f"{name}.json").write_text(text)
        for split in (100, 1 << 27):
            found = cut(spark, tmp_path / f"{name}.json", split)
            assert [r.body for r in found.elements().orderBy("block", "pos").collect()] == bodies
            assert found.unreadable() == []


def test_documents_that_are_not_one_list(spark, tmp_path):
    bad = ['[{"id":1}', '[{"id":1},', '{"a":1}', "hello", " ", "[1]]", "[1][2]", "[1],[2]", '["a', "[1}", "[{]", "x[1]", "[1] x", '{"a":[1]}', "]"]
    for i, text in enumerate(bad):
        (tmp_path / f"{i:02d}.json").write_text(text)
    for split in (4, 1 << 27):
        found = {d.rsplit("/", 1)[1] for d in cut(spark, tmp_path, split).unreadable(most=100)}
        assert found == {f"{i:02d}.json" for i in range(len(bad))}, split


def test_an_element_that_is_no_json_is_cut_like_others(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":}, 1 2, ,{"b":"c"}]')
    found = cut(spark, tmp_path, 1 << 27)
    assert [r.body for r in found.elements().orderBy("pos").collect()] == ['{"id":}', "1 2", "", '{"b":"c"}']
    assert found.unreadable() == []
