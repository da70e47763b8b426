"""Line dedup, similarity join, search, packing, language, decontamination and the pipeline."""

import random
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import SMALL, docs, folder  # noqa: F401
from pyspark.sql import functions as F

from cartmill.llm import ann, decontaminate, jaccard, langid, line_dedup, packing, queries
from cartmill.llm.components import components

WORDS = [f"w{i}" for i in range(3000)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_lines(spark):
    pages = [(i, "a", f"menu\nbody {i}\n \n menu ") for i in range(20)] + [(50 + i, "a", "copy\nof one page") for i in range(30)]
    pages += [(90, "b", "menu\nbody"), (91, None, "menu"), (92, "a", None), (93, "a", ""), (93, "a", "")]
    rows = spark.createDataFrame(pages, "doc_id long, source string, text string").selectExpr("*", "1 AS lines_dropped", "2 AS lines", "3 AS host", "4 AS __lines")
    out = line_dedup.drop_boilerplate(rows)
    found = [(r.doc_id, r.text, r.lines_dropped) for r in out.collect()]
    expected = [(i, f"body {i}\n ", 2) for i in range(20)] + [(50 + i, "copy\nof one page", 0) for i in range(30)]
    expected += [(90, "menu\nbody", 0), (91, "menu", 0), (92, None, 0), (93, "", 0), (93, "", 0)]
    assert sorted(found) == sorted(expected)
    assert sorted(out.columns) == sorted(rows.columns)
    assert line_dedup.drop_boilerplate(rows.where("false")).count() == 0


def classes(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 80 * len(a | b):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return {i: (len(s), root[i]) for i, s in enumerate(sets)}


def near_copies(rng, text, n, most):
    out = []
    for _ in range(n):
        w = text.split(" ")
        for k in rng.sample(range(len(w)), rng.randint(0, most)):
            w[k] = rng.choice(WORDS)
        out.append(" ".join(w))
    return out


def test_jaccard_against_all_pairs(spark, docs):
    rng = random.Random(1)
    passage = prose(rng, 60)
    texts = [None, "", " \n", "One two", "one TWO", "one two", "É a b c d", "é a b c d", "\x1fa b"]
    texts += [prose(rng, rng.randint(1, 200)) for _ in range(120)]
    texts += near_copies(rng, prose(rng, 150), 90, 8)  # many share their prefixes: blocks
    texts += near_copies(rng, prose(rng, 30), 60, 2) + near_copies(rng, prose(rng, 400), 6, 12)
    texts += [f"{prose(rng, rng.randint(0, 90))} {passage} {prose(rng, rng.randint(0, 90))}" for _ in range(60)]
    texts += ["same text of copies here"] * 40 + [prose(rng, 20000)]
    texts += [texts[-1] + " more"]
    found = jaccard.join(docs(texts, n_shingles="'x'"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == classes(texts)
    assert found.count() == len(texts) and "node" in found.columns
    assert jaccard.join(docs(["a"]).where("false")).count() == 0


def test_jaccard_of_repeated_and_null_ids(spark):
    rows = spark.createDataFrame([(1, "a b c d e f"), (1, "other words are in this one"), (None, "a b c d e f"), (None, "x"), (7, None)], "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard.join(rows).collect())
    assert found == [(0, 1, 0), (0, 2, 1), (1, 2, 1), (1, 2, 1), (7, 0, 7)]


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 900)] + [(3, 3), (1000, 999)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(101)}, **{i: 500 for i in range(500, 900)}, 999: 999, 1000: 999}


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(0)
    near, far, counts = rng.random(6), rng.random(5), rng.integers(0, 4, (6, 5))
    cells = ann.walk(near, far, counts, 10**9)
    sums = [near[c // 5] + far[c % 5] for c in cells]
    assert sums == sorted(sums) and set(cells) == {c for c in range(30) if counts.flat[c]}
    assert counts.ravel()[ann.walk(near, far, counts, 7)].sum() >= 7


def nearest(rows, asked, k=5):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in asked:
        if q in good:
            scores = {i: good[q] @ v / (np.sqrt(good[q] @ good[q]) * np.sqrt(v @ v)) for i, v in good.items() if i != q}
            out[q] = sorted(scores.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


@pytest.mark.parametrize("reach, recall", [(1.0, 1.0), (ann.REACH, 0.9)])
def test_search(spark, reach, recall):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16)]) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2050, [float("inf")] * 16), (None, rows[0][1])]
    table = spark.createDataFrame([*rows, rows[5]], "vec_id long, embedding array<float>").selectExpr("*", "1 AS v", "2 AS cell")
    found = {}
    for r in sorted(ann.search(table, table.where("vec_id % 50 = 0"), reach=reach).collect(), key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = nearest(rows, [i for i, _ in rows if i is not None and i % 50 == 0])
    assert set(found) == set(expected)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= recall * sum(map(len, expected.values()))
    assert all(abs(s - dict(expected[q]).get(i, s)) < 1e-12 for q in found for i, s in found[q])
    assert ann.search(table.where("false"), table).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert ann.search(few, few.where("vec_id = 0"), reach=1.0).count() == 2


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    rng = random.Random(2)
    letters = ["thé", "Naïve,", "x_,", "it's.", "...", "3.5.", "İ,", "ΣΑΣ", "<|endoftext|>,", "日本", "á,", "word", "Word.", "!!,", "ÀÉ."]
    texts = [None, "", " \n\t", " ".join(letters), "a" * 5000] + [" ".join(rng.choice(letters) for _ in range(rng.randint(1, 900))) for _ in range(80)]
    rows = docs(texts, piece="'p'", offset="1", length="2", lot="3")
    rows = rows.unionByName(rows.where("doc_id = 3"))
    found = packing.pack(packing.pieces(rows, capacity=64), capacity=64).collect()
    by_sequence, by_doc = {}, {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for i, t in enumerate(texts):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = [ids[a : a + 64].tobytes() for a in range(0, len(ids), 64)]
        expected = [(k, 64 * k, len(p) // 4, zlib.crc32(p), p) for k, p in enumerate(pieces)] * (2 if i == 3 else 1)
        assert sorted((r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in by_doc[i]) == sorted(expected)
    total = sum(r.length for r in found)
    assert len(by_sequence) <= total / 64 * 1.03 + 2
    assert packing.pack(packing.pieces(rows.where("false"))).count() == 0


def test_sum_of_squares_step():
    bins, offsets, made = packing.place(np.array([6, 5, 4, 3, 2]), 10)
    assert made == 2 and sorted(np.bincount(bins, [6, 5, 4, 3, 2])) == [10, 10]


def test_languages(spark):
    rng = random.Random(4)
    sounds = {"aa": ["ka", "lo", "mi"], "bb": ["strü", "ßen", "och"], "cc": ["éa", "ñu", "ció"]}
    rows = [(i, (l := rng.choice(list(sounds))), " ".join("".join(rng.choices(sounds[l], k=3)) for _ in range(rng.randint(5, 300)))) for i in range(600)]
    frame = spark.createDataFrame([*rows, (None, None, "kalo milo"), (900, "aa", None), (901, "aa", "123 !"), (902, None, ""), (0, rows[0][1], rows[0][2])], "doc_id long, lang string, text string")
    found = langid.identify(frame.withColumn("score", F.lit("x"))).collect()
    assert len(found) == 605
    labels = {i: l for i, l, _ in rows}
    held = [r for r in found if r.doc_id in labels and r.held_out]
    assert np.mean([r.lang_pred == labels[r.doc_id] for r in held]) > 0.97
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert [(r.lang_pred, r.score) for r in found if r.doc_id in (900, 901, 902)] == [("und", 0.0)] * 3
    assert all(0 <= r.score <= 1 for r in found)
    unlabelled = frame.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
    assert langid.identify(frame.where("false")).count() == 0


def test_overlaps_against_all_alignments(spark, docs):
    rng = random.Random(6)
    items = [prose(rng, n) for n in (40, 25, 13, 6)] + [None, "", "one"]
    changed = items[0].split(" ")
    for k in (3, 12, 21, 30):
        changed[k] = "changed"
    texts = [None, "", prose(rng, 300)] + [prose(rng, 200) for _ in range(20)]
    texts += [f"{prose(rng, 50)} {items[0].upper()} {prose(rng, 9)}", items[1].replace(" ", ", "), " ".join(changed), f"{prose(rng, 5)} {' '.join(items[0].split(' ')[5:25])}"]
    texts += [items[2], items[3], " ".join(items[0].split(" ")[:9]), f"{items[0]} {items[1]} {items[0]}", prose(rng, 20000) + " " + items[1]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("w", F.lit(1))
    rows = docs(texts, item_id="'i'", w="1", shifts="2")
    expected = set()
    for d, t in enumerate(texts):
        words = re.findall(r"\w+", (t or "").lower())
        for i, item in enumerate(items):
            target = (item or "").split(" ")
            wide = min(13, len(target))
            if len(target) > 1 and any(
                sum(x == y for x, y in zip(words[a : a + wide], target[b : b + wide])) >= 0.8 * wide
                for b in range(len(target) - wide + 1)
                for a in range(len(words) - wide + 1)
            ):
                expected.add((d, i))
    found = decontaminate.overlaps(rows, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    whole = next(r for r in found if (r.doc_id, r.item_id) == (23, 0))
    assert (whole.token_start, whole.item_start, whole.aligned, whole.agreeing) == (50, 0, 40, 40)
    clean = {r.doc_id for r in decontaminate.decontaminate(rows, bench).collect()}
    assert clean == set(range(len(texts))) - {d for d, _ in expected}
    assert decontaminate.overlaps(rows, bench.where("false")).count() == decontaminate.overlaps(rows.where("false"), bench).count() == 0
    assert decontaminate.decontaminate(rows, bench.where("false")).count() == len(texts)


def test_every_operator_has_a_query():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = {r.doc_id for r in docs.collect()}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    kept = given
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, SMALL)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        after = {r.doc_id for r in docs.collect()}
        assert after <= kept
        if name == "jaccard_join":
            ids = sorted(before)
            roots = classes([before[i] for i in ids])
            assert after == {ids[k] for k, (_, root) in roots.items() if root == k}
        if name == "decontamination":
            assert kept - after == {r.doc_id for r in decontaminate.overlaps(spark.createDataFrame([(i, before[i]) for i in before], "doc_id long, text string"), spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
        kept = after
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in packed} == kept
