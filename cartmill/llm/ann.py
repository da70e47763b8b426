"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut into two halves, and each half is quantised to one of CENTROIDS centroids;
a vector's cell is its pair of centroids. A query walks the pairs in order of the summed
squared distances of its own halves to the two centroids, popping them from a heap, until the
cells it has met hold a set share of all entries; every entry in them is then ranked by its
exact cosine. The share is the same at every size, so recall doesn't fall as the index grows.

Equal vectors are one entry with their smallest ids, as many as a result can show, so that a
vector that a third of the rows have costs one comparison. Entries are compared in blocks of
bounded size: small cells share one, a large cell is split over several, and queries come in
lots, so a task holds one block and one lot.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartmill.llm.store import keep

#: Bound of the sample that the centroids are fitted to.
SAMPLE = 20_000
CENTROIDS = 32
#: Share of all entries that a query's walk reaches before it stops.
REACH = 0.7
#: Entries of a block, and queries of a lot.
BLOCK, LOT = 8192, 8192
#: More than products of unit vectors are off by.
NEAR = 1e-9


def usable(vector: Column) -> Column:
    """Not null, not zero, and only finite components."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(vectors) -> np.ndarray:
    x = np.asarray(list(vectors), np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(1)[None] - 2 * x @ centres.T + (x * x).sum(1)[:, None]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return _distances(x, centres).argmin(1)


def fit(vectors: DataFrame, centroids: int = CENTROIDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of the two halves, from at most SAMPLE rows of `v` in hash order."""
    rows = vectors.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    x = _units([r["v"] for r in rows])
    half = max(1, x.shape[1] // 2)
    right = x[:, half:] if x.shape[1] > 1 else np.zeros((len(x), 1))
    return _kmeans(x[:, :half], centroids, 1), _kmeans(right, centroids, 2)


def _halves(x: np.ndarray, books) -> tuple[np.ndarray, np.ndarray]:
    half = books[0].shape[1]
    return x[:, :half], (x[:, half:] if x.shape[1] > half else np.zeros((len(x), 1)))


def walk(near: np.ndarray, far: np.ndarray, counts: np.ndarray, enough: float) -> list[int]:
    """Cells in order of summed distance, until they hold `enough` entries.

    `near` and `far` are a query's distances to the centroids of either half; `counts` has a
    row for each centroid of the first half and a column for each of the second.
    """
    a, b = near.argsort(kind="stable"), far.argsort(kind="stable")
    heap = [(near[a[0]] + far[b[0]], 0, 0)]
    cells, held = [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        n = counts[a[i], b[j]]
        if n:
            cells.append(int(a[i] * counts.shape[1] + b[j]))
            held += n
        if j + 1 < len(b):
            heapq.heappush(heap, (near[a[i]] + far[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (near[a[i + 1]] + far[b[0]], i + 1, 0))
    return cells


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    reach: float = REACH,
    centroids: int = CENTROIDS,
) -> DataFrame:
    """query_id long, rank int from 1, vec_id long, score double: each query's k nearest rows.

    Nearness is the cosine in double precision of the vectors as they are; equal scores go to
    the smaller id. A query's own id is no candidate. Vectors that are null, zero or have null
    or non-finite components take no part on either side, nor do rows with a null id or with
    another dimension than the most frequent one. Repeated rows count once. With fewer
    candidates than k a query gets all; an empty index gives no rows. With reach = 1 the
    search is exhaustive.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    asked = queries.select(F.col(f"`{vec_id}`").cast("long").alias("q"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    asked = asked.where(F.col("q").isNotNull() & usable(F.col("v"))).distinct()
    result = "query_id long, rank int, vec_id long, score double"
    # One id more than a result shows: the query's own may be among them.
    order = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    entries = rows.distinct().withColumn("r", order).where(F.col("r") <= k + 1)
    entries = keep(entries.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    size = entries.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if size is None:
        return spark.createDataFrame([], result)
    d = size["d"]
    entries, asked = entries.where(F.size("v") == d), asked.where(F.size("v") == d)
    books = fit(entries, centroids)
    width = len(books[1])

    def cell_of(vs: pd.Series) -> np.ndarray:
        left, right = _halves(_units(vs), books)
        return _nearest(left, books[0]) * width + _nearest(right, books[1])

    def quantise(batches):
        for x in batches:
            if len(x):
                yield x.assign(cell=cell_of(x["v"]))

    coded = keep(entries.mapInPandas(quantise, "v array<double>, ids array<long>, cell long"), "index")
    counts = np.zeros((len(books[0]), width), np.int64)
    for r in coded.groupBy("cell").count().collect():  # at most CENTROIDS squared
        counts.flat[r["cell"]] = r["count"]
    # At least so many entries that k are left without the query's own, each with an id or more.
    enough = max(reach * counts.sum(), k + 1)
    first, parts, blocks = _blocks(counts.ravel())
    lots = max(1, -(-asked.count() // LOT))

    def deal(batches):
        for x in batches:
            c = x["cell"].to_numpy()
            salt = pd.util.hash_array(np.array([i[0] for i in x["ids"]], np.int64)) % parts[c].astype(np.uint64)
            yield x.assign(block=first[c] + salt.astype(np.int64))

    def visit(batches):
        for x in batches:
            if not len(x):
                continue
            left, right = _halves(_units(x["v"]), books)
            a, b = _distances(left, books[0]), _distances(right, books[1])
            out = []
            for i in range(len(x)):
                cells = walk(a[i], b[i], counts, enough)
                seen = np.zeros(counts.size, bool)
                seen[cells] = True
                to = np.unique(np.concatenate([np.arange(first[c], first[c] + parts[c]) for c in cells]))
                lot = int(pd.util.hash_array(x["q"].to_numpy()[i : i + 1])[0] % lots)
                out.append((x["q"].iat[i], x["v"].iat[i], np.packbits(seen).tobytes(), lot, to))
            frame = pd.DataFrame(out, columns=["q", "v", "cells", "lot", "block"])
            yield frame.explode("block").astype({"block": "int64"})

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"q": [], "vec_id": [], "score": []})
        if not len(left) or not len(right):
            return none
        qv, ev = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
        qu, eu = _units(left["v"]), _units(right["v"])
        seen = np.unpackbits(np.frombuffer(b"".join(left["cells"]), np.uint8).reshape(len(left), -1), axis=1)
        cells = right["cell"].to_numpy()
        names = right["ids"].to_numpy()
        lengths = np.array([len(x) for x in names])
        found = []
        for at in range(0, len(left), 256):
            part = slice(at, at + 256)
            score = np.where(seen[part][:, cells] > 0, qu[part] @ eu.T, -2.0)
            # The query's own may be one of them.
            most = min(k + 1, score.shape[1])
            least = np.partition(score, -most, axis=1)[:, -most]
            for i, row in enumerate(score):
                own, q = left["q"].iat[at + i], qv[at + i]
                wide, low = most, least[i]
                while True:
                    # All that rounding may order otherwise, equal scores included.
                    js = np.flatnonzero((row >= low - NEAR) & (row > -2))
                    e = ev[js]
                    exact = (e * q).sum(1) / (np.sqrt((q * q).sum()) * np.sqrt((e * e).sum(1)))
                    ids = np.concatenate([names[j] for j in js]) if len(js) else np.zeros(0, np.int64)
                    exact = np.repeat(exact, lengths[js])
                    ids, exact = ids[ids != own], exact[ids != own]
                    order = np.lexsort((ids, -exact))
                    _, firsts = np.unique(ids[order], return_index=True)
                    # One id may have many vectors: more are taken until k ids are met.
                    if len(firsts) >= k or wide == len(row):
                        break
                    wide = min(2 * wide, len(row))
                    low = np.partition(row, -wide)[-wide]
                for j in order[np.sort(firsts)[:k]]:
                    found.append((own, ids[j], exact[j]))
        return pd.DataFrame(found, columns=["q", "vec_id", "score"]) if found else none

    dealt = coded.mapInPandas(deal, "v array<double>, ids array<long>, cell long, block long")
    lot_numbers = F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))
    index = dealt.withColumn("lot", lot_numbers).groupBy("block", "lot")
    visits = asked.mapInPandas(visit, "q long, v array<double>, cells binary, lot int, block long")
    near = visits.groupBy("block", "lot").cogroup(index).applyInPandas(nearest, "q long, vec_id long, score double")
    pairs = near.groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("q").alias("query_id"), "rank", "vec_id", "score"
    )


def _blocks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each cell's first block and number of blocks: neighbours share one up to BLOCK entries."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    block, held = 0, 0
    for c, n in enumerate(counts.tolist()):
        if n > BLOCK // 2:
            if held:
                block, held = block + 1, 0
            parts[c] = -(-n // (BLOCK // 2))
            first[c] = block
            block += int(parts[c])
            continue
        if held + n > BLOCK:
            block, held = block + 1, 0
        first[c] = block
        held += n
    return first, parts, block + 1
