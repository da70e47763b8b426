"""What a task remembers of the words that it has met."""

import random
import struct

import pandas as pd
from tokenizers import Tokenizer

from cartmill.llm import alignment, packing, piece_codec


def test_packing_remembers_few_words():
    rng = random.Random(3)
    model = packing.WordIds(packing.default_vocabulary())
    whole = Tokenizer.from_file(packing.default_vocabulary())
    for _ in range(300):
        text = " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(1500)) + " " + "x" * 5000
        ids = whole.encode(text, add_special_tokens=False).ids
        assert model.ids(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert len(model.known) + len(model.older) < 250_000
    assert max(map(len, model.known)) < 5000 and max(map(len, model.older), default=0) < 5000


def test_packing_forgets_a_text_of_very_many_words():
    model = packing.WordIds(packing.default_vocabulary())
    for text in (" ".join(f"w{n}" for n in range(300_000)), "one more", "another"):
        model.ids(text)
    assert len(model.known) + len(model.older) < 100


def test_alignment_merges_only_new_words(monkeypatch):
    sides = alignment.Sides(alignment.default_vocabulary(), piece_codec.default_model())
    merged = []
    merge_asof = pd.merge_asof
    monkeypatch.setattr(alignment.pd, "merge_asof", lambda left, right, **how: merged.append(len(left)) or merge_asof(left, right, **how))
    first = list(sides.align(["some words, some\nwords and some more"] * 50))
    assert sum(merged) < 40
    merged.clear()
    assert list(sides.align(["some words, some\nwords and some more"])) == first[:1] and not merged
