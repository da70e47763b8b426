"""Removal of boilerplate lines by how many of a host's pages have them.

A page counts once however often it repeats a line, and pages of a host whose whole texts are
equal count as one page, in both numbers: copies of a page are for document deduplication to
find, and don't make its own text boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.llm.store import fresh, keep, small, without

#: A line goes where more than this share of a host's pages have it, and at least PAGES do.
RATIO = 0.1
PAGES = 5
#: From this many words on a line may have a share of its own: ordinary lines of so many hardly repeat.
WORDS = 5


def line_key(line: Column) -> Column:
    """128 bits of the line without the spaces around it; null for a blank line."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(bare, F.lit(1)).alias("b")))


def _several(line: Column) -> Column:
    return line.rlike(rf"^\s*+(?:\S++\s++){{{WORDS - 1}}}\S")


def boilerplate(
    pages: DataFrame,
    host: str,
    text: str,
    ratio: float = RATIO,
    least_pages: int = PAGES,
    several: float | None = None,
) -> DataFrame:
    """(host, lines): the keys of each host's boilerplate lines, for hosts that have any.

    `several` is the share for lines of WORDS words or more, `ratio` for all without it. A host's
    array has at most its mean number of lines per page divided by the smaller share elements.
    """
    page = F.xxhash64("text", F.lit(1))
    texts = pages.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text"))

    def entry(line: Column) -> Column:
        share = F.lit(ratio) if several is None else F.when(_several(line), several).otherwise(ratio)
        return F.struct(line_key(line).alias("line"), share.cast("double").alias("share"))

    keys = F.array_distinct(F.filter(F.transform(F.split("text", "\n", -1), entry), lambda k: k["line"].isNotNull()))
    counted = (
        texts.select("host", page.alias("page"), F.explode(keys).alias("k"))
        .groupBy("host", "k.line", "k.share")
        .agg(F.count_distinct("page").alias("pages"))
        .where(F.col("pages") >= least_pages)
    )
    totals = texts.where("text IS NOT NULL").groupBy("host").agg(F.count_distinct(page).alias("total"))
    return (
        counted.join(totals.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
        .where(F.col("pages") > F.col("share") * F.col("total"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = PAGES,
    several: float | None = None,
) -> DataFrame:
    """The pages without their hosts' boilerplate lines, and lines_dropped long.

    A line is what newlines part; it is compared without the spaces, tabs and carriage returns
    around it. Blank lines are neither counted nor dropped. Null texts stay null and are no
    pages; a null host is a host of its own. A page that loses all lines keeps its row with an
    empty text. Repeated rows are kept. An input column lines_dropped is replaced. Lines of
    WORDS words or more go above the share `several`, where that is given.
    """
    found = keep(boilerplate(pages, host, text, ratio, least_pages, several), "boilerplate")
    size = found.agg(F.count("*").alias("hosts"), F.sum(F.size("lines")).alias("lines")).first()
    key, lines, parts, left = fresh(pages, "host", "lines", "parts", "left")
    table = small(
        found.select(F.col("host").alias(key), F.col("lines").alias(lines)),
        size["hosts"] * 300 + (size["lines"] or 0) * 40,
        1,
    )
    rows = without(pages, "lines_dropped")
    joined = rows.join(table, rows[f"`{host}`"].eqNullSafe(F.col(key)), "left")
    listed = F.array_contains
    split = joined.withColumn(parts, F.when(F.col(lines).isNotNull(), F.split(F.col(f"`{text}`"), "\n", -1)))
    stays = split.withColumn(
        left,
        F.filter(
            F.col(parts), lambda x: line_key(x).isNull() | ~listed(F.col(lines), F.coalesce(line_key(x), _nothing()))
        ),
    )
    return stays.select(
        *[
            F.coalesce(F.array_join(F.col(left), "\n"), F.col(f"`{text}`")).alias(text)
            if c == text
            else F.col(f"`{c}`")
            for c in rows.columns
        ],
        F.coalesce(F.size(parts) - F.size(left), F.lit(0)).cast("long").alias("lines_dropped"),
    )


def _nothing() -> Column:
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
