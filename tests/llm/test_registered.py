"""The registered queries that SQL can't express, over the smallest whole tables, against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SMALL, folder  # noqa: F401
from test_free import nearest

from cartmill.llm import packing, queries, secrets

KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def base_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            long = {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}[kind]()
            if long:
                found.append((m.start(), KINDS.index(kind), m.end()))
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def tested(token):
    """(length class, step of the bound, looks random) of a string, by the module's formulas in plain Python."""
    body = token.rstrip("=")
    alphabet = next(a for p, a in secrets.ENCODINGS if re.fullmatch(p, body))
    n, k, v = len(body), len(alphabet), [alphabet.index(c) + 1 for c in body]
    squares, mean, high = sum(x * x for x in Counter(v).values()), sum(v) / n, [2 * x > k + 1 for x in v]
    up = sum(high)
    even, runs = 2 * up * (n - up) / n, 1 + sum(a != b for a, b in zip(high, high[1:]))
    chi = (k / n * squares - n - (k - 1)) / math.sqrt(2 * (k - 1))
    runs_z = 99 if up in (0, n) else (runs - 1 - even) / math.sqrt(max(even * (even - 1) / (n - 1), 0.01))
    spread = sum((x - mean) ** 2 for x in v)
    lagged = sum((a - mean) * (b - mean) for a, b in zip(v, v[1:]))
    serial = 99 if spread == 0 else lagged / spread * math.sqrt(n)
    kinds = ["lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "sign" for c in body]
    rate = min(max(sum(a != b for a, b in zip(kinds, kinds[1:])) / (n - 1), 1e-9), 1 - 1e-9)
    two, three, change = secrets.SAME_TWO, secrets.SAME_THREE, secrets.CHANGE
    text_z = (squares - n - n * (n - 1) * two) / math.sqrt(2 * n * n * two + 4 * n**3 * (three - two**2))
    log_p = -0.69 - text_z**2 / 2 if text_z < 0 else 0.0
    if rate > change:
        log_p -= (n - 1) * (rate * math.log(rate / change) + (1 - rate) * math.log((1 - rate) / (1 - change)))
    step = min(int(-(log_p + math.log(1 - log_p)) * secrets.STEPS), secrets.MOST)
    length = max((x for x in secrets.LENGTHS if n >= x), default=None)
    return length, step, all(abs(z) < secrets.REJECT_Z for z in (chi, runs_z, serial))


def discovered(tokens):
    scored = {t: tested(t) for t in tokens}
    least = {}
    for length in secrets.LENGTHS:
        cells = [(step, random) for group, step, random in scored.values() if group == length]
        for limit in sorted({step for step, _ in cells}):
            found = sum(random for step, random in cells if step >= limit)
            if found and len(cells) * math.exp(-limit / secrets.STEPS) <= secrets.FALSE_SHARE * found:
                least[length] = limit
                break
    return {t for t, (length, step, random) in scored.items() if random and step >= least.get(length, math.inf)}


def test_random_strings(spark):
    rng = random.Random(7)
    texts = []
    for _, alphabet in secrets.ENCODINGS:
        texts += ["".join(rng.choices(alphabet, k=rng.choice([16, 20, 32, 40, 64, 128]))) for _ in range(60)]
    texts += ["".join(rng.choices(["word", "the", "Name", "of", "_", "-", "12", "list"], k=rng.randint(6, 20))) for _ in range(300)]
    tokens = {t for t in texts if re.fullmatch(secrets.CANDIDATE, t)} | {"aaaaaaaaaaaaaaaaaaaa==", "0" * 40, "ab" * 20}
    expected = discovered(tokens)
    assert len(expected) > 50
    found = secrets.discoveries(spark.createDataFrame([(t,) for t in [*tokens, *tokens, None]], "token string"))
    assert sorted(r.token for r in found.collect()) == sorted(expected)


def test_op9_random_spans(spark, texts):
    places = {}
    for doc_id, row in texts.items():
        base = [tuple(map(int, s.split(":")[1:])) for s in base_spans(row.text or "")]
        found = [(m[0], m.start(), m.end()) for m in re.finditer(secrets.CANDIDATE, row.text or "")]
        places[doc_id] = [(t, a, b) for t, a, b in found if not any(x <= a and b <= y for x, y in base)]
    good = discovered({t for found in places.values() for t, _, _ in found})
    for r in queries.op9_secret_scan(spark, SMALL).collect():
        found = [s for s in r.spans.split(",") if s.startswith("random")]
        assert found == [f"random:{a}:{b}" for t, a, b in places[r.doc_id] if t in good]


def test_op9(spark, texts):
    found = queries.op9_secret_scan(spark, SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        base = base_spans(texts[r.doc_id].text or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k + ":") for s in base) for k in KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("random")] == base
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), (*KINDS, "random").index(s.split(":")[0])))


def test_op8(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    places, pieces = defaultdict(list), defaultdict(list)
    for r in queries.op8_packing(spark, SMALL).collect():
        places[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for doc_id, row in texts.items():
        ids = np.array([*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 0], "<u4")
        parts = [ids[i : i + 2048] for i in range(0, len(ids), 2048)]
        expected = [(k, 2048 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(parts)]
        assert sorted(pieces[doc_id]) == expected
    total = 0
    for placed in places.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
    assert len(places) <= total / 2048 * 1.03 + 2


def test_op5(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    expected = nearest(rows, [i for i, _ in rows if i % 50 == 0])
    found = defaultdict(list)
    for r in sorted(queries.op5_multi_index(spark, SMALL).collect(), key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(found) == set(expected)
    hits = 0
    for q, rows in found.items():
        assert [k for k, _, _ in rows] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        hits += len({i for _, i, _ in rows} & {i for i, _ in expected[q]})
        assert all(abs(s - dict(expected[q])[i]) < 1e-12 for _, i, s in rows if i in dict(expected[q]))
    assert hits >= 0.9 * 5 * len(expected)


def test_op10(spark, texts):
    found = queries.op10_language_id(spark, SMALL).collect()
    assert {r.doc_id for r in found} == set(texts) and len(found) == len(texts)
    langs = {r.lang for r in texts.values()}
    held = []
    for r in found:
        row = texts[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in row.text or ""))
        assert r.lang_pred in langs | {"und"}
        if r.held_out and r.lang_pred != "und" and row.lang:
            held.append(r.lang_pred == row.lang)
    assert np.mean(held) > 0.9


def test_op3(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in queries.op3_decontamination(spark, SMALL).collect()}

    def words(text):
        return re.findall(r"\w+", (text or "").lower())

    # Runs of 13 words that stand unchanged in both, by hand.
    runs = defaultdict(set)
    for item, text in items.items():
        w = words(text)
        for i in range(len(w) - 12):
            runs[tuple(w[i : i + 13])].add(item)
    same = set()
    for doc_id, row in texts.items():
        w = words(row.text)
        for i in range(len(w) - 12):
            same |= {(doc_id, item) for item in runs.get(tuple(w[i : i + 13]), ())}
    assert same and same <= found
