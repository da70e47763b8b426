"""Texts to token ids and back with a byte-pair model of the SentencePiece kind, in numpy.

A text becomes one flat array of symbols, a symbol a character at first. Two neighbours may
merge where the vocabulary has their joined spelling; a piece's rank is the place of its score
among all scores, the best first. Segments are cut wherever no piece holds the two characters
at the cut side by side, so that no merge crosses one. In every round each segment looks up the
smallest rank of its pairs and merges all pairs that have it, the leftmost first, in all
segments at once; merged places are taken out, segments without a pair are done.

The rule that the vocabulary was made for takes one pair at a time. Merging several at once is
the same unless a merge makes a pair of a rank as small or smaller beside it: such a place is
the last one of its round among those near it (pieces have a bounded length, so places that are
further apart than twice that can't reach each other). Where pieces share a score, as runs of spaces do, every
merge is such a place: what is left of that segment is merged one pair at a time, from a heap.

Characters that no piece spells become the pieces of their UTF-8 bytes. Decoding is a lookup of
each id's bytes; the space that encoding puts in front goes.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmill.llm.store import process_cache, without

SPACE = "▁"
#: Characters of text encoded together: bounds memory at some hundred times as many bytes.
CHUNK = 1 << 19
#: Words a task remembers, once over: the older half goes. Longer ones aren't remembered.
WORDS, WORD_CHARS = 100_000, 48

NONE = np.int32(2**31 - 1)
# Kinds of pieces in the model's file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The pieces of a byte-pair model with byte fallback, an identity normaliser and a space put
    in front, as decoding needs them.

    Other models are refused, as their results would differ.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        rules, trained = model.normalizer_spec, model.trainer_spec
        kinds = [p.type for p in model.pieces]
        if (
            trained.model_type != trained.BPE
            or not trained.byte_fallback
            or trained.treat_whitespace_as_suffix
            or rules.precompiled_charsmap
            or not rules.add_dummy_prefix
            or rules.remove_extra_whitespaces
            or not rules.escape_whitespaces
            or not {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError(f"{path}: only byte-pair models with byte fallback, identity normaliser and a prefix space")
        self.pieces = [p.piece for p in model.pieces]
        self.end = trained.eos_id
        spelt = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self._decoding(model, kinds, trained.unk_surface)
        self._prepare(spelt, {s: model.pieces[i].score for s, i in spelt.items()})

    def _prepare(self, spelt: dict[str, int], scores: dict[str, float]) -> None:
        """Decoding needs no more."""

    def _decoding(self, model, kinds, unknown: str) -> None:
        self.bytes_of: list[bytes] = []
        self.byte_piece = np.zeros(256, np.int32)
        self.is_byte = np.array([k == BYTE for k in kinds])
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_piece[value] = i
                self.bytes_of.append(bytes([value]))
            elif p.type == CONTROL:
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append((unknown if p.type == UNKNOWN else p.piece).replace(SPACE, " ").encode())
        self.starts_spaced = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in model.pieces])
        self.is_control = np.array([k == CONTROL for k in kinds])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD one by one."""
        if not len(ids):
            return ""
        shown = np.flatnonzero(~self.is_control[ids])
        spaced = int(len(shown) > 0 and self.starts_spaced[ids[shown[0]]])
        if len(shown) < len(ids) - 1 or self.is_control[ids[:-1]].any():
            return self._decode_runs(ids, spaced)
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        try:
            return raw[spaced:].decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids, spaced)

    def _decode_runs(self, ids: np.ndarray, spaced: int) -> str:
        """Runs of byte pieces by themselves: a character of valid bytes, or one byte that isn't, at a time."""
        kinds = self.is_byte[ids]
        out = []
        for run in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(kinds)) + 1):
            raw = b"".join(map(self.bytes_of.__getitem__, ids[run].tolist()))
            out.append("".join(_character(m[0]) for m in CHARACTER.finditer(raw)) if kinds[run[0]] else raw.decode())
        return "".join(out)[spaced:]


class PieceModel(Pieces):
    """The same with what encoding needs: which symbols merge, and the words met so far."""

    def _prepare(self, spelt: dict[str, int], scores: dict[str, float]) -> None:
        self._merging(spelt, scores)
        self.keeps = WORDS
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merging(self, spelt: dict[str, int], scores: dict[str, float]) -> None:
        # A symbol is a piece, or a character that stands in pieces without being one; other
        # characters have the numbers from `unspelt` on.
        symbols = dict(spelt)
        for ch in sorted({c for s in spelt for c in s} - spelt.keys()):
            symbols[ch] = len(self.pieces) + len(symbols) - len(spelt)
        self.unspelt = len(self.pieces) + len(symbols) - len(spelt)
        self.symbol_of = np.arange(self.unspelt, self.unspelt + 0x110000, dtype=np.int32)
        for ch, number in symbols.items():
            if len(ch) == 1:
                self.symbol_of[ord(ch)] = number
        places = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        per_place = np.bincount([places[v] for v in scores.values()], minlength=len(places) + 1)
        self.shared = np.flatnonzero(per_place > 1).astype(np.int32)
        keys, ranks, to, beside = [], [], [], set()
        for piece, number in spelt.items():
            for cut in range(1, len(piece)):
                beside.add((ord(piece[cut - 1]) << 21) | ord(piece[cut]))
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(self._key(left, right))
                    ranks.append(places[scores[piece]])
                    to.append(number)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.array(ranks, np.int32)[order], NONE)
        self.to = np.append(np.array(to, np.int32)[order], 0)
        self.beside = np.append(np.array(sorted(beside), np.int64), np.iinfo(np.int64).max)
        self.reach = 2 * max(map(len, spelt))
        # Words can be cut before a space and around a line end where no piece crosses them.
        crossing = any("\n" in p and len(p) > 1 or re.search(f"[^{SPACE}]{SPACE}", p) for p in spelt)
        self.in_words = not crossing
        self.words = re.compile("(?s).+" if crossing else r"\n| *[^ \n]+| +")

    def _key(self, left, right):
        return left * (self.unspelt + 0x110000) + right

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; rank NONE where they don't merge."""
        keys = self._key(left.astype(np.int64), right)
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE), self.to[at]

    def merge(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The symbol at each character of `codes` where one begins, -1 elsewhere.

        `begins` tells where words begin; nothing merges across.
        """
        final = np.full(len(codes), -1, np.int32)
        if not len(codes):
            return final
        side = (codes[:-1].astype(np.int64) << 21) | codes[1:]
        first = np.concatenate([[True], self.beside[np.searchsorted(self.beside, side)] != side])
        first[begins] = True
        segment = np.cumsum(first)
        symbol, at = self.symbol_of[codes], np.arange(len(codes))
        rank, to = np.full(len(codes), NONE), np.zeros(len(codes), np.int32)

        def look_up(places: np.ndarray) -> None:
            """Pairs that begin at these places anew."""
            rank[places] = NONE
            places = places[places + 1 < len(symbol)]
            places = places[segment[places] == segment[places + 1]]
            rank[places], to[places] = self._pairs(symbol[places], symbol[places + 1])

        look_up(at)
        while True:
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(rank))))
            done = least == NONE
            if done.any():
                final[at[done]] = symbol[done]
                if done.all():
                    return final
                left = ~done
                symbol, at, segment, rank, to, least = (x[left] for x in (symbol, at, segment, rank, to, least))
            tied = np.isin(least, self.shared)
            if tied.any():
                self._one_by_one(final, symbol[tied], at[tied], segment[tied])
                if tied.all():
                    return final
                left = ~tied
                symbol, at, segment, rank, to, least = (x[left] for x in (symbol, at, segment, rank, to, least))
            sites = np.flatnonzero(rank == least)
            # Of places that overlap, every other one from the left.
            fresh = np.concatenate([[True], np.diff(sites) != 1])
            run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            sites = sites[(np.arange(len(sites)) - run) % 2 == 0]
            sites = sites[self._in_order(sites, symbol, segment, rank, to)]
            symbol[sites] = to[sites]
            stays = np.ones(len(symbol), bool)
            stays[sites + 1] = False
            moved = np.cumsum(stays) - 1
            symbol, at, segment, rank, to = (x[stays] for x in (symbol, at, segment, rank, to))
            changed = moved[sites]
            again = np.zeros(len(symbol), bool)
            again[changed] = True
            again[changed[changed > 0] - 1] = True
            look_up(np.flatnonzero(again))

    def _one_by_one(self, final: np.ndarray, symbol: np.ndarray, at: np.ndarray, segment: np.ndarray) -> None:
        """Merge the smallest rank's leftmost pair until none is left, within each segment."""
        symbol, after = symbol.copy(), np.arange(1, len(symbol) + 1)
        before = np.arange(-1, len(symbol) - 1)
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i] if i >= 0 else len(symbol)
            if j < len(symbol) and segment[i] == segment[j]:
                rank, to = self._pairs(symbol[i : i + 1], symbol[j : j + 1])
                if rank[0] != NONE:
                    heapq.heappush(heap, (int(rank[0]), i, int(symbol[i]), int(symbol[j]), int(to[0])))

        for i in range(len(symbol)):
            push(i)
        while heap:
            _, i, left, right, to = heapq.heappop(heap)
            j = after[i]
            # A pair whose symbols have changed since is no pair any more.
            if symbol[i] == left and j < len(symbol) and symbol[j] == right:
                symbol[i], symbol[j], after[i] = to, -1, after[j]
                if after[i] < len(symbol):
                    before[after[i]] = i
                push(before[i])
                push(i)
        final[at] = symbol

    def _in_order(self, sites, symbol, segment, rank, to) -> np.ndarray:
        """Which sites can merge in one round: up to the first that makes a pair of a rank as small."""
        made, limit = to[sites], rank[sites]
        before = np.maximum(sites - 1, 0)
        left = symbol[before]
        touching = np.concatenate([[False], np.diff(sites) == 2])
        left[touching] = made[:-1][touching[1:]]
        after = np.minimum(sites + 2, len(symbol) - 1)
        with_left = np.where((sites > 0) & (segment[before] == segment[sites]), self._pairs(left, made)[0], NONE)
        with_right = np.where(
            (sites + 2 < len(symbol)) & (segment[after] == segment[sites]), self._pairs(made, symbol[after])[0], NONE
        )
        better = np.minimum(with_left, with_right) <= limit
        if not better.any():
            return np.ones(len(sites), bool)
        apart = np.concatenate([[True], (np.diff(sites) > self.reach) | (np.diff(segment[sites]) != 0)])
        earlier = np.cumsum(better) - better
        group = np.flatnonzero(apart)[np.cumsum(apart) - 1]
        return earlier == earlier[group]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids, as little-endian 32-bit numbers, of words with their spaces."""
        codes = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        symbols = self.merge(codes, np.concatenate([[0], ends[:-1]]))
        spelt = np.flatnonzero(symbols >= 0)
        ids = symbols[spelt]
        lengths = np.ones(len(ids), np.int64)
        odd = np.flatnonzero(ids >= len(self.pieces))
        if len(odd):
            # Characters without a piece: their bytes instead.
            raw = [chr(codes[spelt[k]]).encode() for k in odd]
            lengths[odd] = [len(r) for r in raw]
            ids = np.repeat(ids, lengths)
            ids[np.repeat(np.isin(np.arange(len(lengths)), odd), lengths)] = self.byte_piece[np.frombuffer(b"".join(raw), np.uint8)]
        upto = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(spelt, ends)]
        stops = (4 * upto).tolist()
        raw = ids.astype("<i4").tobytes()
        return {w: raw[a:b] for w, a, b in zip(words, [0, *stops], stops)}

    def encode_parts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as they are, without a space put in front, as little-endian 32-bit numbers; none are remembered."""
        whole = {t for t in texts if self.in_words and t.rfind(" ") == 0 and len(t) > 1 and "\n" not in t}
        parts = {t: self.words.findall(t) for t in texts if t not in whole}
        look = self._learn(sorted(whole.union(*parts.values())))
        return [look[t] if t in whole else b"".join(map(look.__getitem__, parts[t])) for t in texts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit numbers, without an end id; an empty text has none."""
        if len(self.known) > self.keeps:
            self.older, self.known = self.known, {}
        parts = [self.words.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        new = set().union(*parts).difference(self.known)
        again = {w: self.older[w] for w in new & self.older.keys()}
        learnt = again | (self._learn(sorted(new - again.keys())) if len(new) > len(again) else {})
        self.known |= {w: ids for w, ids in learnt.items() if len(w) <= WORD_CHARS}
        look = learnt | self.known if any(len(w) > WORD_CHARS for w in learnt) else self.known
        return [b"".join(map(look.__getitem__, p)) for p in parts]


#: What may be a character in UTF-8, or else a single byte.
CHARACTER = re.compile(rb"(?s)[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}|.")


def _character(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return "\ufffd" * len(raw)


def loaded(path: str, kind: type[Pieces] = PieceModel) -> Pieces:
    """The model at this path, read once by a Python worker."""
    models = process_cache(kind.__name__)
    if path not in models:
        models[path] = kind(path)
    return models[path]


def text_slices(texts: list[str | None], chars: int = CHUNK):
    """(first, texts) runs of texts that stay small together; null texts are empty."""
    first = 0
    while first < len(texts):
        end, size = first, 0
        while end < len(texts) and size < chars:
            size += len(texts[end] or "") + 1
            end += 1
        yield first, [t or "" for t in texts[first:end]]
        first = end


def encode(docs: DataFrame, text: str = "text", model: str | None = None, end: bool = True) -> DataFrame:
    """The documents' other columns with `ids`, an array of ints; with `end`, an end id closes it.

    A null text is empty: its only id is the end id. Texts are encoded whole, whatever their
    length; each row by itself, so repeated rows give repeated rows. An input column ids is
    replaced; an empty frame gives no rows.
    """
    path = model or default_model()
    rows = without(docs, "ids")
    others = [c for c in rows.columns if c != text]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text]

    def run(batches):
        import pyarrow as pa

        pieces = loaded(path)
        closing = np.array([pieces.end] if end else [], "<i4").tobytes()
        for batch in batches:
            for first, texts in text_slices(batch.column(text).to_pylist()):
                ids = [i + closing for i in pieces.encode(texts)]
                offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                part = batch.slice(first, len(texts))
                arrays = [part.column(c) for c in others] + [pa.ListArray.from_arrays(pa.array(offsets), flat)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*others, "ids"])

    return rows.mapInArrow(run, ", ".join([*fields, "ids array<int>"]))


def decode(rows: DataFrame, ids: str = "ids", model: str | None = None, text: str = "text") -> DataFrame:
    """The rows with `text`, what their ids stand for; a null array is a null text.

    Control ids are left out, the first piece loses the space that encoding put in front, and
    an unknown id is the model's sign for it. An id outside the vocabulary is an error. An input
    column of the result's name is replaced.
    """
    path = model or default_model()
    rows = without(rows, text)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    names = [*rows.columns, text]

    def run(batches):
        import pyarrow as pa

        pieces = loaded(path, Pieces)
        for batch in batches:
            column = batch.column(ids)
            texts = [pieces.decode(a.values.to_numpy()) if a.is_valid else None for a in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return rows.mapInArrow(run, ", ".join([*fields, f"`{text}` string"]))


def joined_ids(ids: str = "ids"):
    """Decimal ids with a blank between."""
    return F.array_join(F.col(ids).cast("array<string>"), " ")
