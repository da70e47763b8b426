"""Documents that hold passages of benchmark items, found by spaced seeds.

Tokens are runs of letters and digits, lower-cased. A seed hashes the tokens at some of ten
neighbouring places: which ones, each of three fixed masks says, and what stands at the others
doesn't matter. Items shorter than WINDOW have masks of their own length besides, and the masks
are such that every alignment that is accepted has a common seed. Seeds at every place of every document are joined with those of the items; a
common seed gives an alignment of the two texts, and along it tokens are compared one by one.
A document is contaminated where, of WINDOW aligned tokens in a row (or of all the item's, if
it has fewer), at least AGREE agree: substituted words are tolerated.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.llm.store import fresh, keep, small, without

# The masks, as places that count. Whichever two of WINDOW places differ, one of
# the masks fits somewhere between them.
MASKS = ((0, 1, 2, 4, 7, 9), (0, 1, 3, 5, 6, 9), (0, 3, 4, 5, 8, 9))
WINDOW, AGREE = 13, 0.8
#: Places that count in a mask, at least, where an item has enough.
WEIGHT = 6


def tokens(text: Column) -> Column:
    """Hashes of the tokens in order; null for a null text."""
    plain = F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(plain, " ", -1), lambda t: F.xxhash64(t))
    )


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks of a whole run of n places: whichever places may differ, one leaves them out.

    Places are dealt into groups, and each mask leaves out as many groups as places may differ.
    """
    differ = n - -(-round(100 * AGREE) * n // 100)
    groups = next(g for g in range(differ + 1, n + 1) if n - differ * -(-n // g) >= min(WEIGHT, n - differ))
    return [
        tuple(p for p in range(n) if p % groups not in out) for out in combinations(range(groups), differ)
    ]


def _seeds(words: str, short: list[int], items: bool) -> list[Column]:
    """The seeds at every place, by mask; `short` has item lengths below WINDOW, which have masks
    of their own. Of the items, only those of that length have such seeds."""
    masks = [(m, m[-1] + 1, f"size({words}) > {m[-1]}") for m in MASKS]
    for n in short:
        masks += [(m, n, f"size({words}) {'=' if items else '>='} {n}") for m in short_masks(n)]
    arrays = []
    for number, (mask, span, fits) in enumerate(masks):
        places = ", ".join(f"{words}[i + {p}]" for p in mask)
        arrays.append(
            f"""if({fits}, transform(sequence(0, size({words}) - {span}),
                  i -> xxhash64({number}, {places})), CAST(array() AS ARRAY<BIGINT>))"""
        )
    return [F.expr(a) for a in arrays]


def overlaps(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """A row for each document and item that overlap: the document's columns, item_id, token_start,
    item_start, aligned and agreeing.

    aligned tokens from the document's token_start (from 0) lie against the item's from
    item_start: the stretch that the agreeing windows cover, in the alignment with the most
    agreeing tokens. Null and empty texts hold nothing, and are nothing as items, nor are items
    of one token. Repeated documents and items give repeated rows. Input columns named like a
    result are replaced. An empty table on either side gives no rows.
    """
    bench = keep(
        items.select(F.col(f"`{item_id}`").alias("item_id"), tokens(F.col(f"`{item_text}`")).alias("w"))
        .where("size(w) > 1")
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    lengths = bench.where(F.size("w") < WINDOW).select(F.size("w").alias("n")).distinct().orderBy("n")
    short = [r["n"] for r in lengths.collect()]  # at most WINDOW - 2
    seeds = keep(
        _placed(bench, "item", short, True).select("item", F.col("place").alias("at"), "seed"), "seeds"
    )
    n = seeds.count()

    key = F.xxhash64(F.col(f"`{text}`"))
    words = docs.select(key.alias("page"), tokens(F.col(f"`{text}`")).alias("w"))
    hits = _placed(words, "page", short, False).join(small(seeds, n, 64), "seed")
    shifts = hits.select("page", "item", (F.col("place") - F.col("at")).alias("shift")).distinct()
    met = keep(
        shifts.groupBy("page", "item").agg(F.collect_list("shift").alias("shifts")).join(small(bench, n, 1024), "item"),
        "hits",
    ).selectExpr("page AS __page", "item_id AS __item_id", "shifts AS __shifts", "w AS __item")
    # Measured: a row carries an item's whole tokens and all shifts against a document.
    width = F.size("__shifts") * 8 + F.size("__item") * 8 + F.coalesce(F.octet_length(F.col("__item_id").cast("string")), F.lit(0)) + 64
    met_bytes = met.agg(F.sum(width.cast("long"))).first()[0] or 0
    rows = without(docs, "item_id", "token_start", "item_start", "aligned", "agreeing")
    return (
        rows.withColumn("__key", key)
        .join(small(met, met_bytes, 1), F.col("__key") == F.col("__page"))
        .withColumn("__w", tokens(F.col(f"`{text}`")))
        .withColumn("__best", F.expr(f"array_max(transform(__shifts, d -> {_ALONG}))"))
        .where("__best IS NOT NULL")
        .selectExpr(
            *[f"`{c}`" for c in rows.columns],
            "__item_id AS item_id",
            "-__best.back AS token_start",
            "__best.item_start",
            "__best.aligned",
            "__best.agreeing",
        )
    )


def _placed(words: DataFrame, key: str, short: list[int], items: bool) -> DataFrame:
    """(key, place, seed) of all masks, in one pass over the words."""
    arrays = F.array(*[F.struct(s.alias("s")) for s in _seeds("w", short, items)])
    return words.select(key, F.explode(arrays).alias("m")).select(key, F.posexplode("m.s").alias("place", "seed"))


_WIDE = f"least({WINDOW}, size(__item))"
#: The document's words shifted by d against the item's: null where no window agrees.
_ALONG = f"""transform(array(struct(
    greatest(0, -d) AS low, least(size(__item), size(__w) - d) AS high)), b ->
  if(b.high - b.low < {_WIDE}, NULL, transform(array(
    transform(sequence(b.low, b.high - 1), j -> if(__w[j + d] = __item[j], 1, 0))), same ->
    transform(array(filter(sequence(0, size(same) - {_WIDE}),
      s -> aggregate(slice(same, s + 1, {_WIDE}), 0, (a, x) -> a + x) >= ceil({AGREE} * {_WIDE}))), good ->
      if(size(good) = 0, NULL, struct(
        CAST(aggregate(slice(same, good[0] + 1, element_at(good, -1) + {_WIDE} - good[0]), 0, (a, x) -> a + x) AS BIGINT)
          AS agreeing,
        CAST(element_at(good, -1) + {_WIDE} - good[0] AS BIGINT) AS aligned,
        CAST(-(b.low + good[0] + d) AS BIGINT) AS back,
        CAST(b.low + good[0] AS BIGINT) AS item_start)))[0])[0]))[0]"""


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents that overlap no item; rows, repeated ones too, and columns stay as they are."""
    (page,) = fresh(docs, "page")
    dirty = overlaps(docs.select(F.col(f"`{text}`").alias("text")), items).select(F.xxhash64("text").alias(page))
    dirty = keep(dirty.distinct(), "contaminated")
    count = dirty.count()
    # The key is the text's hash: copies of a contaminated text go with it.
    return docs.join(small(dirty, count, 16), F.xxhash64(docs[f"`{text}`"]) == F.col(page), "left_anti")
