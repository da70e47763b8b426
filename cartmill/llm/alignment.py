"""The tokens of one tokenizer set beside those of another, by the bytes they cover.

Side A is a byte-level vocabulary, side B a piece vocabulary (piece_codec). Both spell a space
and the text; each token covers a range of those bytes. A document's words, which no token of
either side crosses, are aligned once and remembered. For all new words of a batch of documents,
pandas.merge_asof, keyed by word, finds for each token's start the token of the other side
that covers it; both directions together give every overlap. Overlapping tokens that end
together are linked, and the ends that both sides have cut a document into groups.

Of tokens that end together one's bytes are the other's last ones, so the pairs of ids that can
be linked follow from the vocabularies alone: a few hundred thousand. They are numbered, and a
document's links are numbers. What the corpus counts has that many entries, whatever its size.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmill.llm.piece_codec import SPACE, default_model, loaded, text_slices
from cartmill.llm.store import process_cache, without

#: Characters of text aligned together: bounds memory at some three hundred times as many bytes.
CHUNK = 1 << 19
#: Words a task remembers, once over: the older half goes. Longer ones aren't remembered.
WORDS, WORD_CHARS = 250_000, 48
#: A text's numbers of tokens are added up in so many bits each.
BITS = 40
COUNT = (1 << BITS) - 1
#: Documents whose links are counted at once.
ROWS = 500

_UNEVEN = re.compile(r"\s\s|\s\Z")
_WORD = re.compile(r"[ \n][^ \n]+")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies spell each byte as a letter: printable ones as themselves, the rest in turn from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {chr(b if b in plain else next(others)): b for b in range(256)}


class ByteLevelIds:
    """Token ids of a byte-level vocabulary, by word.

    The vocabulary's words end before a single space or line end between other characters, so a
    text's ids are those of the parts between in turn. Vocabularies with other rules are looked
    up a whole text at a time. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        before = rules.get("pre_tokenizer") or {}
        self.in_words = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not rules.get("normalizer")
        )
        letters = byte_letters()
        self.space = next(c for c, b in letters.items() if b == 32)
        self.bytes_of: list[bytes] = [b""] * self.tokenizer.get_vocab_size()
        special = {t["id"] for t in rules.get("added_tokens", [])}
        for token, number in self.tokenizer.get_vocab().items():
            if number not in special:
                self.bytes_of[number] = bytes(letters[c] for c in token)
        self.lengths = np.array([len(x) for x in self.bytes_of], np.int64)
        #: With a token for every byte, tokens spell any text.
        self.spells_all = {bytes([b]) for b in range(256)} <= set(self.bytes_of)
        #: Words that their tokens don't spell, as a vocabulary may lack bytes.
        self.unspelt: set[str] = set()

    def parts(self, text: str) -> list[str]:
        if not self.in_words:
            return [text]
        # Where each white space stands alone between others, words are quick to find.
        return _CUT.split(text) if _UNEVEN.search(text) else _WORD.findall(text)

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word as little-endian 32-bit numbers."""
        learnt = {}
        if self.in_words and self.spells_all:
            # A space and letters: nothing is left but the merges.
            merge, space = self.tokenizer.model.tokenize, self.space
            for w in words:
                if w[0] == " " and w.isascii() and w[1:].isalpha():
                    found = [t.id for t in merge(space + w[1:])]
                    learnt[w] = struct.pack(f"<{len(found)}i", *found)
            # Other words that begin and end as they would in a text are looked up as one text, and
            # the ids dealt out by the bytes they spell.
            words = [w for w in words if w not in learnt]
            regular = [w for w in words if len(w) > 1 and w[0] in " \n" and not w[1].isspace() and not w[-1].isspace()]
            ids = np.array(self.tokenizer.encode("".join(regular), add_special_tokens=False).ids, "<i4")
            ends = np.cumsum([len(w.encode()) for w in regular])
            stops = (4 * np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 4).tolist()
            raw = ids.tobytes()
            learnt |= {w: raw[a:b] for w, a, b in zip(regular, [0, *stops], stops)}
            words = [w for w in words if w not in learnt]
        for word, found in zip(words, self.tokenizer.encode_batch(words, add_special_tokens=False)):
            learnt[word] = np.array(found.ids, "<i4").tobytes()
            if not self.spells_all and b"".join(map(self.bytes_of.__getitem__, found.ids)) != word.encode():
                self.unspelt.add(word)
        return learnt


class Sides:
    """Both vocabularies, and the numbered pairs of ids that can end together."""

    def __init__(self, vocabulary: str, model: str):
        self.a, self.b = ByteLevelIds(vocabulary), loaded(model)
        self.lengths = [self.a.lengths, np.array([len(x) for x in self.b.bytes_of], np.int64)]
        by_bytes: list[dict[bytes, list[int]]] = []
        for side in (self.a, self.b):
            ids: dict[bytes, list[int]] = {}
            for number, raw in enumerate(side.bytes_of):
                if raw:
                    ids.setdefault(raw, []).append(number)
            by_bytes.append(ids)
        of_a, of_b = by_bytes
        self.width = len(self.b.bytes_of)
        pairs = {
            a * self.width + b
            for raw, numbers in of_a.items()
            for k in range(len(raw))
            for b in of_b.get(raw[k:], ())
            for a in numbers
        }
        pairs |= {
            a * self.width + b
            for raw, numbers in of_b.items()
            for k in range(len(raw))
            for a in of_a.get(raw[k:], ())
            for b in numbers
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        a_ids, b_ids = range(len(self.a.bytes_of)), range(self.width)
        self.known: dict[str, tuple[str, bytes, int]] = {}
        self.older: dict[str, tuple[str, bytes, int]] = {}
        self.spelt = [f"{i}," for i in a_ids] + [f"{i}|" for i in a_ids] + [f"{i}," for i in b_ids] + [f"{i};" for i in b_ids]

    def align(self, texts: list[str]):
        """For each text its numbers of A and B tokens and overlaps, its groups spelt out, and its links.

        Both sides' tokens end where a word does, so a text's groups and links are those of its
        words in turn.
        """
        if len(self.known) > WORDS:
            self.older, self.known = self.known, {}
        # Side B spells any text but one with its own sign for a space.
        parts = [self._parts(" " + t) if t and SPACE not in t else [] for t in texts]
        new = set().union(*parts).difference(self.known)
        learnt = {w: self.older[w] for w in new & self.older.keys()}
        learnt |= self._learn(sorted(new - learnt.keys()))
        self.known |= {w: found for w, found in learnt.items() if len(w) <= WORD_CHARS}
        look = learnt | self.known if any(len(w) > WORD_CHARS for w in learnt) else self.known
        odd = self.a.unspelt
        for words in parts:
            if not words or odd and not odd.isdisjoint(words):
                yield 0, 0, 0, "", b""
                continue
            groups, links, counts = zip(*map(look.__getitem__, words))
            total = sum(counts)
            yield total & COUNT, total >> BITS & COUNT, total >> 2 * BITS, "".join(groups)[:-1], b"".join(links)

    def _parts(self, text: str) -> list[str]:
        """What nothing crosses on either side."""
        return self.a.parts(text) if self.b.in_words else [text]

    def _learn(self, words: list[str]) -> dict[str, tuple[str, bytes, int]]:
        """New words' groups, each with its closing sign, links, and counts: A tokens, B tokens and overlaps in BITS each."""
        if not words:
            return {}
        of_a, of_b = self.a.encode(words), self.b.encode_parts(words)
        raw = [[of_a[w] for w in words], of_b]
        if odd := self.a.unspelt:
            raw = [[b"" if w in odd else x for w, x in zip(words, own)] for own in raw]
        counts = [np.fromiter(map(len, own), np.int64, len(words)) // 4 for own in raw]
        flat = [np.frombuffer(b"".join(own), "<i4").astype(np.int64) for own in raw]
        ends = [np.cumsum(size[own]) for size, own in zip(self.lengths, flat)]
        tokens = [
            pd.DataFrame({"at": end - size[own], "doc": np.repeat(np.arange(len(words)), n), side: np.arange(len(own))})
            for side, end, size, own, n in zip("ab", ends, self.lengths, flat, counts)
        ]
        covering = pd.merge_asof(tokens[0], tokens[1], on="at", by="doc")
        covered = pd.merge_asof(tokens[1], tokens[0], on="at", by="doc")
        # Tokens that begin together are in both directions.
        more = covered["at"].to_numpy() > tokens[0]["at"].to_numpy()[covered["a"].to_numpy()]
        a = np.concatenate([covering["a"].to_numpy(), covered["a"].to_numpy()[more]])
        b = np.concatenate([covering["b"].to_numpy(), covered["b"].to_numpy()[more]])
        doc = np.concatenate([covering["doc"].to_numpy(), covered["doc"].to_numpy()[more]])
        overlaps = np.bincount(doc, minlength=len(words))
        linked = ends[0][a] == ends[1][b]
        order = np.argsort(a[linked], kind="stable")
        a, b = a[linked][order], b[linked][order]
        links = np.searchsorted(self.pairs, flat[0][a] * self.width + flat[1][b]).astype("<i4").tobytes()
        spelt = list(map(self.spelt.__getitem__, self._spell(flat, a, b).tolist()))
        upto = np.cumsum(counts[0] + counts[1]).tolist()
        last = (4 * np.cumsum(np.bincount(doc[linked], minlength=len(words)))).tolist()
        sums = zip(counts[0].tolist(), counts[1].tolist(), overlaps.tolist())
        return {
            w: ("".join(spelt[i:j]), links[k:m], n_a | n_b << BITS | n << 2 * BITS)
            for w, i, j, k, m, (n_a, n_b, n) in zip(words, [0, *upto], upto, [0, *last], last, sums)
        }

    def _spell(self, flat, a, b) -> np.ndarray:
        """Places in `spelt` of all tokens, group by group, A's before B's."""
        many_a = len(self.a.bytes_of)
        last_a, last_b = np.zeros(len(flat[0]), bool), np.zeros(len(flat[1]), bool)
        last_a[a], last_b[b] = True, True
        # A token's group is the number of links that end before it does.
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        first_b = np.concatenate([[0], b + 1])
        out = np.empty(len(flat[0]) + len(flat[1]), np.int64)
        out[np.arange(len(flat[0])) + first_b[group_a]] = flat[0] + many_a * last_a
        out[np.arange(len(flat[1])) + (a + 1)[group_b]] = flat[1] + 2 * many_a + self.width * last_b
        return out


def sides(vocabulary: str, model: str) -> Sides:
    """Both vocabularies, read once by a Python worker."""
    models = process_cache("aligned vocabularies")
    if (vocabulary, model) not in models:
        models[vocabulary, model] = Sides(vocabulary, model)
    return models[vocabulary, model]


def align(docs: DataFrame, text: str = "text", vocabulary: str | None = None, model: str | None = None) -> DataFrame:
    """The documents' other columns with n_a, n_b, n_overlaps longs, groups string and links binary.

    n_a and n_b count the tokens. `groups` spells them as a1,a2|b1;a3|b2,b3. `links` holds a
    little-endian 32-bit number (pair_ids) for each two tokens that end together, in the order
    of the text. Texts that are null, empty or not spelt back by either side's tokens have
    none: zeros and an empty string. Rows are kept, repeated ones too; input columns named like
    a result are replaced. An empty frame gives no rows.
    """
    paths = vocabulary or default_vocabulary(), model or default_model()
    added = {"n_a": "long", "n_b": "long", "n_overlaps": "long", "groups": "string", "links": "binary"}
    rows = without(docs, *added)
    others = [c for c in rows.columns if c != text]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text]

    def run(batches):
        import pyarrow as pa

        both = sides(*paths)
        kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        for batch in batches:
            for first, texts in text_slices(batch.column(text).to_pylist(), CHUNK):
                part = batch.slice(first, len(texts))
                found = [pa.array(c, k) for c, k in zip(zip(*both.align(texts)), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in others] + found, names=[*others, *added])

    return rows.mapInArrow(run, ", ".join([*fields, *(f"{n} {k}" for n, k in added.items())]))


def pair_ids(vocabulary: str | None = None, model: str | None = None) -> pd.DataFrame:
    """(link, a, b): the ids that each number in `links` stands for."""
    both = sides(vocabulary or default_vocabulary(), model or default_model())
    return pd.DataFrame({"link": np.arange(len(both.pairs)), "a": both.pairs // both.width, "b": both.pairs % both.width})


def link_counts(aligned: DataFrame, vocabulary: str | None = None, model: str | None = None) -> np.ndarray:
    """How many links of all documents each pair has: an entry a pair of the vocabularies.

    Every task counts its own rows first; what is added up is bounded by the vocabularies.
    """
    paths = vocabulary or default_vocabulary(), model or default_model()

    def count(batches):
        import pyarrow as pa

        total = np.zeros(len(sides(*paths).pairs), np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                links = b"".join(raw.as_py() or b"" for raw in batch.column(0).slice(first, ROWS))
                total += np.bincount(np.frombuffer(links, "<i4"), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["link", "n"])

    found = aligned.select("links").mapInArrow(count, "link long, n long").groupBy("link").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(sides(*paths).pairs), np.int64)
    counts[found["link"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def score(aligned: DataFrame, vocabulary: str | None = None, model: str | None = None) -> DataFrame:
    """The aligned rows without `links`, with n_groups, n_links, n_best and count_sum longs.

    A link's count is how often all the rows have its pair. n_best counts the links whose count
    is the highest that their B id has, ties included; count_sum adds up counts. A null `links`
    is none. `aligned` is read twice: write it first.
    """
    counts = link_counts(aligned, vocabulary, model)
    of_b = pair_ids(vocabulary, model)["b"].to_numpy()
    highest = np.zeros(of_b.max() + 1, np.int64)
    np.maximum.at(highest, of_b, counts)
    shared = aligned.sparkSession.sparkContext.broadcast((counts, counts == highest[of_b]))
    added = ("n_groups", "n_links", "n_best", "count_sum")
    rows = without(aligned, *added)
    others = [c for c in rows.columns if c != "links"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "links"]

    def run(batches):
        import pyarrow as pa

        counts, best = shared.value
        for batch in batches:
            links = [np.frombuffer(raw.as_buffer(), "<i4") if raw.is_valid else np.zeros(0, np.int32) for raw in batch.column("links")]
            n = pa.array([len(x) for x in links], pa.int64())
            # Each of these ends is one token's on either side, so a group has one link.
            found = [n, n, pa.array([int(best[x].sum()) for x in links], pa.int64()), pa.array([int(counts[x].sum()) for x in links], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + found, names=[*others, *added])

    return rows.mapInArrow(run, ", ".join([*fields, *(f"{n} long" for n in added)]))
