"""Aligned tokens against all pairs of the libraries' tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from llm_fixtures import SMALL, docs, folder  # noqa: F401
from tokenizers import Tokenizer

from cartmill.llm import alignment, piece_codec, queries
from cartmill.llm.store import keep


class Plain:
    """Tokens with their byte ranges, by the libraries alone."""

    def __init__(self):
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
        self.a = Tokenizer.from_file(alignment.default_vocabulary())
        self.a.encode_special_tokens = True
        self.names = {v: k for k, v in self.a.get_vocab().items()}

    def ranges(self, spelt):
        at, out = 0, []
        for raw in spelt:
            out.append((at, at + len(raw)))
            at += len(raw)
        return out

    def tokens(self, text):
        letters = alignment.byte_letters()
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        of_a = [bytes(letters[c] for c in self.names[i]) for i in a]
        of_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [self.b.id_to_piece(i)]]
        if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
            return None
        return list(zip(a, self.ranges(of_a))), list(zip(b, self.ranges(of_b)))

    def align(self, text):
        """n_a, n_b, overlaps, groups, links."""
        found = self.tokens(text)
        if found is None:
            return 0, 0, 0, "", []
        a, b = found
        ends = {e for _, (_, e) in a} & {e for _, (_, e) in b}
        groups, low = [], 0
        for end in sorted(ends):
            groups.append("|".join(",".join(str(i) for i, (_, e) in side if low < e <= end) for side in (a, b)))
            low = end
        by_end = {e: i for i, (_, e) in b}
        overlaps = sum(s < v and u < e for _, (s, e) in a for _, (u, v) in b) if len(a) < 300 else None
        return len(a), len(b), overlaps, ";".join(groups), [(i, by_end[e]) for i, (_, e) in a if e in by_end]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def odd_texts(rng, n):
    alphabets = ["abc \n", "the ing\t \n'", "日本 é🙂", "  \r\nx1.9", " \x1c\x85 　a", "A's "]
    out = ["", "▁x", " a", "\n", "a\n\nb  c\t d\n", "<|endoftext|> x", "é 日本語テキスト 🙂👩‍👧", "don't we'll I'M 3.14  ", "a\x1cb \x1c c", "\x00"]
    return out + ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 80))) for _ in range(n)]


def test_texts(plain):
    texts = odd_texts(random.Random(1), 800)
    sides = alignment.sides(alignment.default_vocabulary(), piece_codec.default_model())
    for text, (*found, links) in zip(texts, sides.align(texts)):
        *expected, pairs = plain.align(text)
        assert found == expected, text
        numbers = sides.pairs[np.frombuffer(links, "<i4")]
        assert list(zip(numbers // sides.width, numbers % sides.width)) == pairs, text


def scored(plain, texts):
    """(n_a, n_b, n_links, n_best, count_sum, groups) of each text."""
    each = [plain.align(t) for t in texts]
    counts = Counter(p for e in each for p in e[4])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    return [(e[0], e[1], len(e[4]), sum(counts[p] == highest[p[1]] for p in e[4]), sum(counts[p] for p in e[4]), e[3]) for e in each]


def test_frames(spark, docs, plain):
    rng = random.Random(2)
    texts = [None, *odd_texts(rng, 150), "the same text", "the same text", " ".join(rng.choices("the of and tion ing é".split(), k=20_000))]
    rows = docs(texts, links="'x'", n_a="1", doc="2", at="3")
    found = alignment.score(keep(alignment.align(rows), "aligned"))
    assert {"doc", "at", "node"} <= {*found.columns} and "links" not in found.columns
    got = {r.doc_id: (r.n_a, r.n_b, r.n_links, r.n_best, r.count_sum, r.groups) for r in found.collect()}
    assert got == dict(enumerate(scored(plain, texts)))
    assert all(r.n_groups == r.n_links for r in found.collect())
    twice = alignment.align(rows.unionByName(rows))
    assert twice.count() == 2 * len(texts)
    assert alignment.score(keep(alignment.align(rows.where("false")), "aligned")).count() == 0


def test_query(spark, plain):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for r, (a, b, links, best, total, groups) in zip(rows, scored(plain, [r.text for r in rows])):
        digest = hashlib.sha256(groups.encode()).hexdigest() if a else ""
        expected.append((r.doc_id, a, b, links, links, best, total, digest))
    found = queries.op13_token_alignment(spark, SMALL)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
