"""Allow and block decisions on urls from a list of canonical urls.

An entry of the list is a host and a path prefix; it fits a url whose host is that host or one
below it and whose path starts with the prefix. The longest fitting entry decides.

A blocked Bloom filter over the entries (512 bits a block, one bit in each of eight words, so
that a probe reads one block) sieves the forms a url could be listed under; forms that pass go
to an exact hash join with the list, which removes false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.llm.store import ascii_lower, fresh, small, without

#: Entries per block of 512 bits: 16 bits an entry, about one false positive in a thousand.
PER_BLOCK = 32
WORDS = 8
#: Bytes a row takes in a broadcast: a block is eight words, an entry at most 2 kB of text.
BLOCK_BYTES, ENTRY_BYTES = 128, 2048


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(entry: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(entry), F.lit(blocks)).cast("int")


def _bit(entry: Column, word: int) -> Column:
    """The bit of a word that an entry sets: six bits of a second hash for each word."""
    at = F.shiftrightunsigned(F.xxhash64(entry, F.lit(1)), 6 * word).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def bloom_blocks(entries: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) of the filter over column `entry`; empty blocks have no row."""
    bits = [F.bit_or(_bit(F.col("entry"), k)).alias(f"w{k}") for k in range(WORDS)]
    return entries.groupBy(_block(F.col("entry"), blocks).alias("block")).agg(*bits)


def judge(pages: DataFrame, listed: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with host, path, rule and verdict.

    `listed` has host, path and verdict ('allow' or 'block'); its rows may repeat. The longest
    entry (host and path together) that fits decides; of equally long ones that with the
    longer host, and where one entry has both verdicts, block. Rows with a null host, path or
    verdict are no entries. Where none fits, rule is null and the verdict is `default`; a null
    url, or one without ://, has empty host and path and fits nothing. Every page is kept, in
    repeated rows too; input columns named like a result are replaced.
    """
    entries = (
        listed.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .select(
            F.concat(ascii_lower(F.col("host")), "path").alias("entry"),
            F.length("host").alias("host_chars"),
            "verdict",
            F.size(F.split("host", r"\.", -1)).alias("labels"),
            F.length("path").alias("path_chars"),
        )
        .where("host_chars > 0")
    )
    # Lengths in use, not entries, come to the driver: as many as the longest entry has characters.
    known = entries.agg(
        F.count("*").alias("n"),
        F.sort_array(F.collect_set("labels")).alias("labels"),
        F.sort_array(F.collect_set("path_chars")).alias("path_chars"),
    ).first()
    blocks = max(1, -(-known["n"] // PER_BLOCK))
    labels = F.array(*[F.lit(x) for x in known["labels"]]).cast("array<int>")
    chars = F.array(*[F.lit(x) for x in known["path_chars"]]).cast("array<int>")

    urls = pages.select(F.col(f"`{url}`").alias("u")).distinct()
    parts = urls.select("u", host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p"))
    names = F.split("h", r"\.", -1)
    suffixes = F.transform(
        F.filter(labels, lambda n: (n <= F.size(names)) & (F.length("h") > 0)),
        lambda n: F.array_join(F.slice(names, F.size(names) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(chars, lambda n: n <= F.length("p")), lambda n: F.col("p").substr(F.lit(1), n)
    )
    forms = (
        parts.select("u", F.explode(suffixes).alias("s"), prefixes.alias("ps"))
        .select("u", F.explode("ps").alias("f"), "s")
        .select("u", F.concat("s", "f").alias("entry"))
    )
    sieve = small(bloom_blocks(entries, blocks), blocks, BLOCK_BYTES)
    passed = forms.join(
        sieve.withColumnRenamed("block", "__block"),
        (F.col("__block") == _block(F.col("entry"), blocks))
        & _all_set(),
    ).select("u", "entry")
    fits = passed.join(small(entries.distinct(), known["n"], ENTRY_BYTES), "entry")
    kept = without(pages, "host", "path", "rule", "verdict")
    key, found = fresh(kept, "url", "best")
    best = fits.groupBy(F.col("u").alias(key)).agg(
        F.max(F.struct(F.length("entry").alias("n"), "host_chars", "verdict", "entry")).alias(found)
    )
    out = kept.join(best, kept[f"`{url}`"].eqNullSafe(F.col(key)), "left")
    return out.select(
        *[kept[f"`{c}`"] for c in kept.columns],
        host_of(kept[f"`{url}`"]).alias("host"),
        path_of(kept[f"`{url}`"]).alias("path"),
        F.col(f"{found}.entry").alias("rule"),
        F.coalesce(F.col(f"{found}.verdict"), F.lit(default)).alias("verdict"),
    )


def _all_set() -> Column:
    test = F.lit(True)
    for k in range(WORDS):
        bit = _bit(F.col("entry"), k)
        test = test & (F.col(f"w{k}").bitwiseAND(bit) == bit)
    return test
