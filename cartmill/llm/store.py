"""Written tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: A table is only broadcast while its rows, each of a bounded width, stay under this.
BROADCAST_BYTES = 64 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, below the warehouse.

    It goes when the driver's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def keep(frame: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write the rows once and read them back: a lost executor repeats nothing before this.

    The shuffle files of the write go when it is done, as nothing reads them any more. `batch`
    is how many rows Python functions get at once, where these are wide.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    settings = {CLEANUP: "true", **({BATCH: str(batch)} if batch else {})}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    kept = spark.read.schema(frame.schema).parquet(path)
    kept.written_to = path
    return kept


def keep_observed(frame: DataFrame, name: str, *measures: Column) -> tuple[DataFrame, Row]:
    """keep, and what the measures (aggregates with names) come to over the rows, taken while writing."""
    seen = Observation(name)
    return keep(frame.observe(seen, *measures), name), Row(**seen.get)


def discard(*frames: DataFrame) -> None:
    """Delete tables made by keep, once all that was made from them has been written itself."""
    for frame in frames:
        at = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame.written_to)
        at.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def small(frame: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast a table whose counted rows fit; a larger one is left to a shuffled join."""
    return F.broadcast(frame) if rows * row_bytes <= BROADCAST_BYTES else frame


def only(frame: DataFrame, column: str, picked: DataFrame) -> DataFrame:
    """The rows whose whole number in `column` is in the column of that name of `picked`.

    What is picked travels as words of 64 neighbouring numbers, a bit each: where numbers are dense,
    as row numbers are, wide rows stay where they are at 60 times as many rows as `small` takes.
    """
    word, bits = fresh(frame, "word", "bits")
    words = picked.where(F.col(column).isNotNull()).groupBy(F.expr(f"shiftright(`{column}`, 6)").alias(word)).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST(`{column}` & 63 AS INT)))").alias(bits)
    )
    words, seen = keep_observed(words, "words", F.count("*").alias("rows"))
    met = frame.join(small(words, seen["rows"], 64), F.expr(f"shiftright(`{column}`, 6)") == F.col(word))
    return met.where(f"shiftright(`{bits}`, CAST(`{column}` & 63 AS INT)) & 1 = 1").select([frame[f"`{c}`"] for c in frame.columns])


def without(frame: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that bear the name of a result column, in any case."""
    taken = {n.lower() for n in names}
    return frame.select([frame[f"`{c}`"] for c in frame.columns if c.lower() not in taken])


def fresh(frame: DataFrame, *stems: str) -> list[str]:
    """Working column names that the frame doesn't have."""
    there = {c.lower() for c in frame.columns}
    out = []
    for stem in stems:
        while f"__{stem}" in there:
            stem += "_"
        out.append(f"__{stem}")
    return out


def process_cache(name: str) -> dict:
    """A dict that the tasks of one Python worker share."""
    return sys.modules.setdefault("_cartmill_llm_cache", types.ModuleType("_cartmill_llm_cache")).__dict__.setdefault(name, {})


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
