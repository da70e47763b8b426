"""Encoding and decoding against the library that the vocabulary was made for."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from llm_fixtures import SMALL, docs, folder  # noqa: F401

from cartmill.llm import piece_codec, queries


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())


@pytest.fixture(scope="module")
def model():
    return piece_codec.PieceModel(piece_codec.default_model())


def odd_texts(rng, n):
    alphabets = ["abcdefghij", "abab", "aab ", " ▁\n\té日本", "ἀβγδ ", "0123 abc", "\x00\x01 a", "🙂👩‍👧 ", "thesingreoul ", " ", "　\xa0 x"]
    out = ["", " ", "▁", "<s>x</s>", "<0x41>", "á ﻿", "\U0010ffff"]
    out += ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 200))) for _ in range(n)]
    return out + ["".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0x4E00, 0x9FFF)])) for _ in range(60)) for _ in range(n // 10)]


def test_ids_and_texts(model, library):
    rng = random.Random(1)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    texts = odd_texts(rng, 2000) + ["".join(rng.choices(pieces, k=rng.randint(1, 60))) for _ in range(1500)]
    for text, raw in zip(texts, model.encode(texts)):
        ids = np.frombuffer(raw, "<i4")
        assert ids.tolist() == library.encode(text), text
        assert model.decode(ids) == library.decode(ids.tolist()), text


@pytest.mark.parametrize(
    "text",
    ["the" * 20_000, "ab" * 30_000, " " * 20_000, "a" + "   b" * 9_000, "".join(random.Random(2).choices("aeiouthns", k=100_000)), "的一是" * 9_000],
)
def test_long_words(model, library, text):
    assert np.frombuffer(model.encode([text])[0], "<i4").tolist() == library.encode(text)


def test_decoding_any_ids(model, library):
    rng = random.Random(3)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randint(0, 30))]
        assert model.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_remembered_words_go(model, library, monkeypatch):
    monkeypatch.setattr(model, "keeps", 20)
    rng = random.Random(4)
    for _ in range(30):
        texts = [" ".join(rng.choices("ab cde fg hij k lmn".split(), k=9)) + str(rng.random()) for _ in range(5)]
        assert [np.frombuffer(r, "<i4").tolist() for r in model.encode(texts)] == library.encode(texts)


def test_frames(spark, docs, library):
    texts = [None, *odd_texts(random.Random(5), 60), "x y " * 30_000]
    rows = docs(texts, ids="'clash'", pieces="1")
    rows = rows.unionByName(rows.where("doc_id = 3"))
    coded = piece_codec.decode(piece_codec.encode(rows).withColumnRenamed("n", "text"), text="text")
    assert set(coded.columns) == {*rows.columns} - {"n"}
    found = sorted((r.doc_id, r.ids, r.text) for r in coded.collect())
    expected = [(i, [*library.encode(t or ""), 2], library.decode(library.encode(t or ""))) for i, t in enumerate(texts)]
    assert found == sorted(expected + [expected[3]])
    assert piece_codec.encode(rows.where("false")).count() == 0
    assert piece_codec.encode(docs([None, "a"]), end=False).first().ids == []
    unknown = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.text for r in piece_codec.decode(unknown).collect()] == [None, ""]


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    other = pb.ModelProto()
    with open(piece_codec.default_model(), "rb") as file:
        other.ParseFromString(file.read())
    other.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(other.SerializeToString())
    with pytest.raises(ValueError, match="identity"):
        piece_codec.PieceModel(str(path))


def test_query(spark, library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = [*library.encode(r.text or ""), 2]
        expected.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    found = queries.op12_sentencepiece(spark, SMALL)
    assert found.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
