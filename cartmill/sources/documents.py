"""List documents cut into the text of their elements, byte for byte, by many tasks a document.

A JSON document has no record ends, but Spark can split a file at any byte as well as at line
ends, so it is read in pieces that `}` ends; the pieces of one split are a range. What a bracket
or comma means depends on all that comes before. So there are three steps:

1. Each range tells what it does to whoever enters it: whether the number of its quotes is odd,
   and by how much its brackets change the depth, entered outside a string or within one.
2. A prefix scan over the ranges of a document, of which there are few, tells how each is entered.
3. Each range is cut at the commas of depth one. What lies before its first cut and after its
   last one are fragments, which are joined with those of the neighbouring ranges.

Nothing is parsed: an element may be no JSON, which is seen later. Strings, escapes and nesting
are followed, and whether the brackets add up to one list.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.session import work_folder

PIECE_END = b"}"
BLANK = b" \t\r\n"
STATE = "doc string, block bigint, odd int, out_depth bigint, in_depth bigint"
CUT = "doc string, block bigint, pos bigint, kind int, body binary"
#: Kinds of cut rows: an element, its first fragment, further ones, the list's end, a fault.
WHOLE, BEGUN, GOES_ON, CLOSED, FAULT = range(5)
#: A table of ranges up to this many bytes goes to every task.
BROADCAST_BYTES, RANGE_BYTES = 64 << 20, 512
#: Ranges smaller than this share a task, up to so many bytes of them.
TASK_BYTES = 128 << 20


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    pieces = spark.read.option("lineSep", PIECE_END.decode()).text(path).select(
        F.col("_metadata.file_path").alias("doc"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )
    splits = pieces.rdd.getNumPartitions()
    a_range = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    tasks = max(-(-splits * min(a_range, TASK_BYTES) // TASK_BYTES), 3 * spark.sparkContext.defaultParallelism)
    # Without a shuffle: a task reads its splits one after the other, each still a range.
    return pieces.coalesce(tasks) if tasks < splits else pieces


def quotes_of(codes: np.ndarray) -> np.ndarray:
    """True at quotes that begin or end a string: those that no backslash escapes."""
    quotes = codes == ord('"')
    slashes = np.flatnonzero(codes == ord("\\"))
    if len(slashes):
        fresh = np.concatenate([[True], np.diff(slashes) != 1])
        firsts = np.flatnonzero(fresh)
        lengths = np.diff(np.append(firsts, len(slashes)))
        after = slashes[firsts + lengths - 1] + 1
        escaped = after[(lengths % 2 == 1) & (after < len(codes))]
        quotes[escaped] = False
    return quotes


def _followed(codes: np.ndarray, odd: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Whether each byte is outside strings, what its bracket adds to the depth, and whether a string is open after."""
    quotes = quotes_of(codes)
    before = np.cumsum(quotes) - quotes + odd
    opening, closing = (codes == ord("[")) | (codes == ord("{")), (codes == ord("]")) | (codes == ord("}"))
    return before % 2 == 0, opening.astype(np.int8) - closing.astype(np.int8), int(odd + quotes.sum()) % 2


def _runs(batch):
    """(doc, block, first row, bytes) of each run of rows of one range in a batch."""
    docs, blocks = batch.column("doc").to_pylist(), batch.column("block").to_pylist()
    values, first = batch.column("value").to_pylist(), 0
    for i in range(1, len(docs) + 1):
        if i == len(docs) or blocks[i] != blocks[first] or docs[i] != docs[first]:
            yield docs[first], blocks[first], first, PIECE_END.join(values[first:i]) + PIECE_END
            first = i


def _summaries(batches):
    """A row a range: step 1."""
    import pyarrow as pa

    at, odd, out, within = None, 0, 0, 0

    def row():
        values = zip((*at, odd, out, within), (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in values], names=["doc", "block", "odd", "out_depth", "in_depth"])

    for batch in batches:
        for doc, block, _, text in _runs(batch):
            if (doc, block) != at:
                if at:
                    yield row()
                at, odd, out, within = (doc, block), 0, 0, 0
            outside, change, after = _followed(np.frombuffer(text, np.uint8), odd)
            out += int(change[outside].sum())
            within += int(change[~outside].sum())
            odd = after
    if at:
        yield row()


class _Range:
    """One range being cut; text comes in order, a part at a time."""

    def __init__(self, doc: str, block: int, odd: int, depth: int):
        self.doc, self.block, self.odd, self.depth = doc, block, odd, depth
        self.listed = depth > 0  # within the list
        self.ended = depth == 0 and block > 0
        self.here = False  # the element at hand begins in this range
        self.held: list[bytes] = []
        self.begun = 0
        self.rows: list[tuple[str, int, int, int, bytes]] = []

    def _row(self, pos: int, kind: int, body: bytes) -> None:
        self.rows.append((self.doc, self.block, pos, kind, body))

    def _begin(self) -> None:
        self.here, self.begun = True, self.begun + 1

    def _finish(self, text: bytes) -> None:
        if self.here:
            self._row(self.begun - 1, WHOLE, text.strip(BLANK))
        else:
            self._row(-1, GOES_ON, text)

    def feed(self, text: bytes) -> None:
        codes = np.frombuffer(text, np.uint8)
        outside, change, self.odd = _followed(codes, self.odd)
        change = np.where(outside, change, 0)
        depth = np.cumsum(change, dtype=np.int64) + self.depth
        comma = outside & (codes == ord(",")) & (depth == 1)
        events = np.flatnonzero(comma | ((change == 1) & (depth == 1)) | ((change == -1) & (depth == 0)))
        if (depth < 0).any() and not self._only_last_piece(text, depth):
            self._row(-1, FAULT, b"a bracket too many")
        start = 0
        for i in events.tolist():
            if change[i] == 1:
                if self.ended or codes[i] != ord("[") or b"".join([*self.held, text[start:i]]).strip(BLANK):
                    self._row(-1, FAULT, b"not one list")
                self.listed = True
                self.held = []
                self._begin()
            else:
                body = b"".join([*self.held, text[start:i]])
                self.held = []
                if comma[i]:
                    self._finish(body)
                    self._begin()
                elif codes[i] != ord("]"):
                    self._row(-1, FAULT, b"not one list")
                    self.ended = True
                else:
                    # "[]" has no element; "[1,]" has an empty one.
                    if not (self.here and self.begun == 1 and self.block == 0 and not body.strip(BLANK)):
                        self._finish(body)
                    self._row(-1, CLOSED, b"")
                    self.listed, self.ended = False, True
            start = i + 1
        self.held.append(text[start:])
        self.depth = int(depth[-1])

    def _only_last_piece(self, text: bytes, depth: np.ndarray) -> bool:
        """The end that each piece is given is more than a document's last piece has."""
        return bool((depth[:-1] >= 0).all())

    def close(self) -> list[tuple[str, int, int, int, bytes]]:
        rest = b"".join(self.held)
        if self.listed:
            self._row(self.begun - 1 if self.here else -1, BEGUN if self.here else GOES_ON, rest)
        elif rest.removesuffix(PIECE_END).strip(BLANK):
            self._row(-1, FAULT, b"not one list")
        return self.rows


def _cut(batches):
    """Elements, fragments, ends and faults of whole ranges: step 3. Rows of a range come in order."""
    import pyarrow as pa

    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary())

    def table(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc", "block", "pos", "kind", "body"]
        )

    now = None
    for batch in batches:
        odds, depths = batch.column("odd"), batch.column("depth")
        for doc, block, first, text in _runs(batch):
            if now is None or (doc, block) != (now.doc, now.block):
                if now is not None and (rows := now.close()):
                    yield table(rows)
                now = _Range(doc, block, odds[first].as_py(), depths[first].as_py())
            now.feed(text)
            if now.rows:
                yield table(now.rows)
                now.rows = []
    if now is not None and (rows := now.close()):
        yield table(rows)


def entered(summaries: DataFrame) -> DataFrame:
    """How each range is entered: in a string or not, and at what depth. Step 2."""
    before = "OVER (PARTITION BY doc ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    strings = summaries.selectExpr("*", f"CAST(coalesce(sum(odd) {before}, 0) % 2 AS INT) AS begins")
    return strings.selectExpr(
        "doc",
        "block",
        "begins AS odd",
        f"coalesce(sum(if(begins = 0, out_depth, in_depth)) {before}, 0) AS depth",
    )


@dataclass(frozen=True)
class Documents:
    """The documents at a path, cut; rows are written, so that a lost executor repeats little."""

    ranges: DataFrame
    rows: DataFrame

    def elements(self) -> DataFrame:
        """(doc, block, pos, body): block is where the range begins in which the element does."""
        whole = self.rows.where(F.col("kind") == WHOLE)
        # Two fragments a range at most, however long the documents are.
        order = "OVER (PARTITION BY doc ORDER BY block, pos ROWS UNBOUNDED PRECEDING)"
        parts = self.rows.where(F.col("kind").isin(BEGUN, GOES_ON)).selectExpr(
            "doc",
            f"last(if(kind = {BEGUN}, block, NULL), true) {order} AS home",
            f"last(if(kind = {BEGUN}, pos, NULL), true) {order} AS place",
            "block",
            "pos",
            "body",
        )
        joined = parts.where("home IS NOT NULL").groupBy("doc", "home", "place").agg(
            F.sort_array(F.collect_list(F.struct("block", "pos", "body"))).alias("parts")
        )
        text = "aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.body))"
        joined = joined.selectExpr("doc", "home AS block", "place AS pos", f"btrim(CAST({text} AS STRING), ' \\t\\r\\n') AS body")
        return whole.select("doc", "block", "pos", F.col("body").cast("string").alias("body")).unionByName(joined)

    def unreadable(self, most: int = 10) -> list[str]:
        """Up to so many of the documents that aren't one whole list."""
        closed = self.rows.where(F.col("kind") == CLOSED).select("doc").distinct()
        open_ = self.ranges.select("doc").distinct().join(closed, "doc", "left_anti")
        faulty = self.rows.where(F.col("kind") == FAULT).select("doc")
        return [r["doc"] for r in open_.unionByName(faulty).distinct().limit(most).collect()]


def cut(spark: SparkSession, path: str) -> Documents:
    """Read, settle and cut all documents at a path (a file, folder or pattern).

    A document is read by as many tasks as it has splits; a compressed one by one task.
    """
    folder = work_folder(spark)
    pieces = _pieces(spark, path)
    pieces.mapInArrow(_summaries, STATE).write.parquet(f"{folder}/ranges")
    ranges = spark.read.schema(STATE).parquet(f"{folder}/ranges")
    states = entered(ranges)
    if ranges.count() * RANGE_BYTES <= BROADCAST_BYTES:
        placed = pieces.join(F.broadcast(states), ["doc", "block"])
    else:
        # A join by shuffle loses the order, which the pieces' numbers bring back.
        numbered = pieces.withColumn("nth", F.monotonically_increasing_id())
        placed = numbered.join(states, ["doc", "block"]).repartition("doc", "block").sortWithinPartitions("doc", "block", "nth")
    placed.select("doc", "block", "value", "odd", "depth").mapInArrow(_cut, CUT).write.parquet(f"{folder}/cut")
    return Documents(ranges, spark.read.schema(CUT).parquet(f"{folder}/cut"))
