"""Placement of rows on shards through a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: slot
(offset + j * skip) mod size for j = 0, 1, 2, ... The shards take turns; at its turn a shard
claims the first slot it prefers that nobody holds. The finished table has as many rows as
slots, so its size is bounded by a parameter, and it is broadcast: placing a row is one hash
and one lookup, without any shuffle. When a shard comes or goes, few other rows move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.llm.arrays import let
from cartmill.llm.store import without

#: A prime well over a hundred times the number of shards keeps shares within about 1 %.
SLOTS = 2039


def key_number(key: Column) -> Column:
    """60 bits of MD5 over the key's text as a long; null counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): who holds each slot. `slots` must be a prime; `shards` distinct names."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct names, at least one and at most one per slot")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} is not a prime")
    names = spark.createDataFrame([(i, n) for i, n in enumerate(shards)], "id int, name string")
    wishes = (
        names.withColumn("offset", key_number(F.concat("name", F.lit("/offset"))) % slots)
        .withColumn("skip", key_number(F.concat("name", F.lit("/skip"))) % (slots - 1) + 1)
        .selectExpr(
            f"""struct(id, name, transform(sequence(0L, {slots - 1}L),
                  j -> CAST((offset + j * skip) % {slots} AS INT)) AS prefers) AS wish"""
        )
        .agg(F.sort_array(F.collect_list("wish")).alias("wish"))
    )
    # At each turn the slots a shard prefers are looked up in order; -1 is free.
    turn = let(
        "w",
        f"wish[turn % {len(shards)}]",
        let(
            "slot",
            "w.prefers[CAST(array_position(transform(w.prefers, s -> held[s]), -1) AS INT) - 1]",
            "concat(slice(held, 1, slot), array(w.id), slice(held, slot + 2, size(held)))",
        ),
    )
    filled = wishes.selectExpr(
        "wish",
        f"aggregate(sequence(0, {slots - 1}), array_repeat(-1, {slots}), (held, turn) -> {turn}) AS held",
    )
    return filled.selectExpr("posexplode(transform(held, i -> wish[i].name)) AS (slot, shard)")


def place(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The rows with `slot` int and `shard` string.

    Equal keys meet on one shard, whatever the order or the number of rows; a null key is
    placed as empty text. Every row is kept, repeated ones too; an empty frame stays empty.
    Input columns called slot or shard are replaced. A hot key goes to one shard by
    definition, but no row is shuffled for it: files are cut by size when they are written.
    """
    table = lookup_table(rows.sparkSession, shards, slots)
    at = (key_number(rows[f"`{key}`"]) % slots).cast("int")
    return without(rows.withColumn("__slot", at), "slot", "shard").withColumnRenamed("__slot", "slot").join(
        F.broadcast(table), "slot", "left"
    )


def shares(placed: DataFrame) -> DataFrame:
    """(shard, rows): how evenly the rows fell."""
    return placed.groupBy("shard").agg(F.count("*").alias("rows"))
