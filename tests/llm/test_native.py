"""Sharding, url rules, chat formatting and secret scans."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, folder  # noqa: F401

from cartmill.llm import chat, secrets, sharding, urls


def filled(offsets, skips, size):
    held, at = [-1] * size, [0] * len(offsets)
    for turn in range(size):
        i = turn % len(offsets)
        while held[(offsets[i] + at[i] * skips[i]) % size] >= 0:
            at[i] += 1
        held[(offsets[i] + at[i] * skips[i]) % size] = i
    return held


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_lookup_table_is_filled_in_turns(spark):
    names, size = ["a", "b", "c"], 31
    expected = filled([number(f"{n}/offset") % size for n in names], [number(f"{n}/skip") % (size - 1) + 1 for n in names], size)
    rows = sharding.lookup_table(spark, names, size).orderBy("slot").collect()
    assert [names.index(r.shard) for r in rows] == expected
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, names, 30)
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, ["a", "a"], 31)


def test_few_rows_move_when_a_shard_goes(spark):
    keys = spark.range(3000).withColumnRenamed("id", "k")
    names = [f"s{i}" for i in range(8)]
    before = {r.k: r.shard for r in sharding.place(keys, "k", names, 1009).collect()}
    after = {r.k: r.shard for r in sharding.place(keys, "k", names[:-1], 1009).collect()}
    moved = sum(before[k] != after[k] for k in before if before[k] != names[-1])
    assert moved < 0.1 * len(before)


def test_placing_nulls_repeats_and_clashing_columns(spark, docs):
    rows = docs(["a", None, "a", ""])
    placed = sharding.place(rows, "text", ["x", "y"], 101)
    found = placed.orderBy("doc_id").collect()
    assert len(found) == 4 and found[0].shard == found[2].shard and found[1].shard == found[3].shard
    assert sorted(placed.columns).count("slot") == 1 and "SHARD" not in placed.columns
    assert sharding.place(rows.where("false"), "text", ["x"], 101).count() == 0
    assert sum(r.rows for r in sharding.shares(placed).collect()) == 4


URLS = [
    None, "", "no scheme", "http://", "http:///en/", "HTTP://Blog.Example.ORG/es/1?x#y", "http://example.org/en/1", "http://notexample.org/es/",
    "http://example.org", "https://a.b.com/de/fr/?://x", "http://org/", "http://x.com/fr/" + "z" * 20000, "http://." * 300, "http://a.org/\n#",
]


def judged(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({i: i + 32 for i in range(65, 91)}), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *((max(fits)[3], max(fits)[2]) if fits else (None, "allow")))


@pytest.mark.parametrize("many", [0, 3000])
def test_url_rules(spark, many):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
             ("com", "/de/", "block"), ("a.org", "/", "allow"), ("a.org", "/", "block")]
    rules += [(f"h{i}.net", f"/p{i % 50}", "block") for i in range(many)]
    given = URLS + [f"http://w.h{i}.net/p{i % 50}/x" for i in range(0, many, 7)] + [f"http://h{i}.net/q" for i in range(0, many, 11)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*given, *given[:6]])], "page_id long, url string").selectExpr("*", "'z' AS rule", "1 AS u", "2 AS entry")
    listed = spark.createDataFrame([*rules, (None, "/", "block"), ("x", None, "block"), ("x", "/", None)], "host string, path string, verdict string")
    found = urls.judge(pages, listed).collect()
    assert len(found) == len(given) + 6
    assert all((r.host, r.path, r.rule, r.verdict) == judged(r.url, rules) for r in found)
    assert urls.judge(pages.where("false"), listed).count() == 0
    assert {r.verdict for r in urls.judge(pages, listed.where("false"), default="block").collect()} == {"block"}


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("ts", F.lit(1)).withColumn("formatted", F.lit("x"))


def test_chat_round_trip(spark):
    odd = ["<|end|>", "\\", "\\<|", "<\\|turn|>", "<<||", "|", "", None, "a\nb", "é😀<|next|>\\|", "<"]
    rows = [(1, i, ["user", "assistant", "assistant"][i % 3], t) for i, t in enumerate(odd)]
    rows += [(2, 5, "a", "x"), (2, 5, "a", "x"), (2, None, None, "first"), (None, 0, "assistant", "lone")]
    rows += [(3, i, "assistant", f"{i}<|") for i in range(700)]
    expected = {}
    for c, t, r, x in rows:
        expected.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    found = chat.format_conversations(conversations(spark, rows)).select("*", chat.read_back(F.col("formatted")).alias("back")).collect()
    assert {r.conv_id for r in found} == set(expected)
    for r in found:
        turns = [t[1:] for t in sorted(expected[r.conv_id])]
        assert [tuple(t) for t in r.back] == turns and r.n_turns == len(turns)
        spans = [re.sub(r"(?s)\\(.)", r"\1", r.formatted[s.start : s.end]) for s in r.loss_spans]
        assert spans == [x for role, x in turns if role == "assistant"]
        runs = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert r.formatted.count(chat.TURN) == runs
    assert chat.format_conversations(conversations(spark, rows).where("false")).count() == 0


BASE = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def base(text):
    found = [(m.start(), n, f"{k}:{m.start()}:{m.end()}") for n, (k, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m)]
    return ",".join(x for *_, x in sorted(found))


def test_base_spans(spark, docs):
    texts = [
        None, "", "password=token:abcdefgh", "😀 API_KEY = 'abc.def-123'", "passwordpassword=123456", "secret: short", "AKIAAKIA" + "A" * 16,
        "AKIA123", "a" * 24 + "g" + "0" * 23, "deadbeef" * 4 + " token=deadbeefdeadbeefdeadbeef99", "token" * 500 + "=abcdef " + "f" * 30000, "x\nPassword\"= \"abcdefg\"",
    ] + ["token=abcdefg " * 600]
    found = {r.doc_id: secrets_text(r) for r in listed(secrets.scan(docs(texts, base="'b'"))).collect()}
    assert found == {i: base(t) for i, t in enumerate(texts)}
    assert secrets.scan(docs(texts).where("false")).count() == 0


def listed(scanned):
    return scanned.select("doc_id", secrets.listing(F.col("base")).alias("b"))


def secrets_text(row):
    return row.b


def test_random_strings_are_told_from_text(spark, docs):
    import random

    rng = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(30)]
    words = ["internationalization-of-names", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdef", "thiswordisverylongbutstilltext", "1111111111111111111111", "http/path/to/some/document/file"]
    texts = [f"before {k} after" for k in keys] + [f"the {w} there" for w in words] + ["password=" + keys[0]]
    found = {r.doc_id: [s for s in r.spans if s.kind == "random"] for r in secrets.scan(docs(texts)).collect()}
    caught = sum(len(found[i]) == 1 and found[i][0].start == 7 and found[i][0].end == 47 for i in range(30))
    assert caught >= 25
    assert not any(found[i] for i in range(30, 37))
