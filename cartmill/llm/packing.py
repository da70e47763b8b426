"""Documents packed into training sequences by the sum-of-squares rule.

A document's token ids and a closing id form one piece, or several where it is longer than a
sequence. Each piece goes where the sum over all gaps g of (open sequences with gap g) squared
becomes smallest; among equals, where it fits most closely. A task packs the pieces of its
partition, the longest first, in lots of bounded size; sequences that stay short are taken
apart and their pieces packed again with those of other tasks.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.llm.store import fresh, keep, process_cache, without

CAPACITY = 2048
CLOSING = 0
#: Pieces packed together: bounds a task's memory, as a lot is a few arrays of this length.
LOT = 200_000
#: Distinct words whose ids a task remembers, once over: the older half goes. Longer ones aren't
#: remembered. Keeping more is no faster, as most new words are met once.
WORDS, WORD_CHARS = 100_000, 48
#: Rows of text that a task gets at once.
ROWS = 1000
#: A sequence with a larger share of free places is taken apart for the second pass.
SHORT = 0.005

_WIDE = re.compile("[^\x00-\u012f\u0131-\u024f]")
_MET = re.compile(r"(?:[^\w\s]|_)[.,] ")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids as little-endian bytes, remembered by word.

    The vocabulary's tokens never span white space, so a text's ids are those of its words in
    turn; words are what blanks, tabs and line ends part. Letters and signs are never one token
    either, so a comma or full stop after a word counts as a word, and the vocabulary has lower
    case only: both make fewer words to remember. Texts where signs meet, or with letters whose
    lower case isn't settled by the letter alone, are looked up as they are.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(vocabulary)
        self.merge = self.whole.model.tokenize
        # Byte-level vocabularies spell each byte as a letter: printable ones as themselves, the
        # rest in turn from 256 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.spelling = "".join(chr(b) if b in plain else chr(next(others)) for b in range(256))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> list[str]:
        """Make all words known; returns those that are too long to stay."""
        if len(self.known) > WORDS:
            # A text with so many words that it would outgrow the bound by itself leaves none.
            self.older, self.known = ({} if len(self.known) > 2 * WORDS else self.known), {}
        new = []
        for word in words:
            if word not in self.known:
                if word in self.older:
                    self.known[word] = self.older[word]
                else:
                    new.append(word)
        for word in new:
            if word.isalpha() and word.islower() and not _WIDE.search(word):
                # Letters alone, composed and in lower case: nothing is left but the merges.
                spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self.spelling)
                ids = [t.id for t in self.merge(spelt)]
            else:
                ids = self.whole.encode(word, add_special_tokens=False).ids
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
        return [word for word in new if len(word) > WORD_CHARS]

    def ids(self, text: str) -> bytes:
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ") + " "
        if (text.isascii() or not _WIDE.search(text)) and not _MET.search(text) and "<|" not in text:
            text = text.lower().replace(", ", " , ").replace(". ", " . ")
        words = text.split(" ")
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            long = self.learn(set(words))
        found = b"".join(map(self.known.__getitem__, words))
        for word in long:
            del self.known[word]
        return found


def pieces(
    docs: DataFrame,
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    closing: int = CLOSING,
    with_ids: bool = True,
) -> DataFrame:
    """A row for each piece: the other columns, piece int, start, length, ids_crc32, and ids.

    A null text is empty, so its only id is the closing one. Only documents of more than
    `capacity` ids are cut; their last piece may be shorter. ids is binary, little-endian
    unsigned 32-bit; ids_crc32 is its checksum. Repeated rows give repeated pieces; input
    columns named like a result are replaced.
    """
    path = vocabulary or default_vocabulary()
    added = ["piece", "start", "length", "ids_crc32", "ids"]
    rows = without(docs, *added)
    others = [c for c in rows.columns if c != text]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in others)
    schema += (", " if others else "") + "piece int, start long, length long, ids_crc32 long"
    schema += ", ids binary" if with_ids else ""
    end = np.asarray([closing], "<u4").tobytes()

    def cut(batches):
        import pyarrow as pa

        models = process_cache("word ids")
        if path not in models:
            models[path] = WordIds(path)
        model = models[path]
        for batch in batches:
            texts = batch.column(text)
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i in range(batch.num_rows):
                raw = model.ids(texts[i].as_py() or "") + end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            index = pa.array(row, pa.int64())
            columns = [batch.column(c).take(index) for c in others]
            columns += [pa.array(piece, pa.int32())] + [pa.array(x, pa.int64()) for x in (start, length, crc)]
            names = [*others, *added[:4]]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(cut, schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each length, in the order given: its sequence, its offset; and how many sequences.

    The sum of squares changes only at the gap that is filled and the gap that is left, which
    decides the place; a new sequence is begun where no open one has room, as sequences are
    what is to be saved. Ties go to the smallest gap.
    """
    counts = np.zeros(capacity + 1, np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    made = 0
    for i, n in enumerate(lengths.tolist()):
        here = counts[n:]
        left = counts[: capacity + 1 - n].copy()
        left[0] = -1  # a full sequence has no gap: nothing is added for it
        change = np.where(here > 0, 2 * (left - here), np.iinfo(np.int64).max)
        best = int(change.argmin())
        if here[best] > 0:
            gap = n + best
            at = open_by_gap[gap].pop()
            counts[gap] -= 1
        else:
            gap, at, made = capacity, made, made + 1
        bins[i], offsets[i] = at, capacity - gap
        if gap > n:
            counts[gap - n] += 1
            open_by_gap[gap - n].append(at)
    return bins, offsets, made


def _packed(lot: pd.DataFrame, columns: list[str], capacity: int, first: int) -> tuple[pd.DataFrame, int]:
    lot = lot.sort_values(["length", *columns], ascending=False, kind="stable")
    bins, offsets, made = place(lot["length"].to_numpy(), capacity)
    filled = np.bincount(bins, lot["length"], made)
    return lot.assign(sequence_id=bins + first, offset=offsets, filled=filled[bins].astype("int64")), made


def pack(rows: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The rows with sequence_id long and offset long: places without overlap, gapless from 0.

    `length` must lie in 1..capacity in every row; a null or other length raises. Sequence
    numbers are unique but not consecutive. Repeated rows are packed each; an empty frame
    gives no rows; input columns sequence_id and offset are replaced. Only a row number and
    the length are moved and packed; other columns join in at the end.
    """
    plain = without(rows, "sequence_id", "offset")
    (rid,) = fresh(plain, "rid")
    numbered = keep(plain.withColumn(rid, F.monotonically_increasing_id()), "pieces", ROWS)
    sizes = numbered.select(
        F.col(rid).alias("rid"),
        F.when(F.col(f"`{length}`").between(1, capacity), F.col(f"`{length}`"))
        .otherwise(F.raise_error(F.lit(f"a length outside 1..{capacity}")).cast("long"))
        .cast("long")
        .alias("length"),
    )
    once = keep(_pass(sizes.repartition("rid"), capacity, 0), "packed")
    good = F.col("filled") >= int(capacity * (1 - SHORT))
    short = once.where(~good).select("rid", "length")
    again = _pass(short.repartition(max(1, -(-short.count() // LOT)), "rid"), capacity, 1)
    placed = once.where(good).unionByName(again).select(F.col("rid").alias("__r"), "sequence_id", "offset")
    return numbered.join(placed, F.col(rid) == F.col("__r")).drop(rid, "__r")


def _pass(sizes: DataFrame, capacity: int, number: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = (number << 62) + (TaskContext.get().partitionId() << 36)
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= LOT:
                out, made = _packed(pd.concat(held), ["rid"], capacity, first)
                held, first = [], first + made
                yield out
        if held and sum(map(len, held)):
            yield _packed(pd.concat(held), ["rid"], capacity, first)[0]

    return sizes.mapInPandas(run, "rid long, length long, sequence_id long, offset long, filled long")


def fill(packed: DataFrame, capacity: int = CAPACITY) -> Column:
    """Share of places in use, as an aggregate."""
    return F.sum("length") / (F.count_distinct("sequence_id") * capacity)
