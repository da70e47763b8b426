"""Append load of the fact: every silver file is loaded once, however late it arrives.

Which files were taken is a table. A call lists the files that are there, leaves out those of
the table, and deals the rest into batches of bounded size. A batch has a folder of its own in
gold and one in the table of files, which is written first: a batch that broke off is found
again by its number, with the very files it had, and written anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartmill.operators import load
from cartmill.schemas import FACT_ORDERS
from cartmill.sources import silver
from cartmill.sources.lake import Lake

LEAST = 1 << 20
LISTED = "file string, modified timestamp, bytes bigint"


def listing(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Every silver file of a table, whatever its age: (file, modified, bytes).

    Spark lists folders in parallel; no file is opened.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(lake.silver_root(name))
    )
    return files.select(
        F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes")
    )


def taken(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Files of all batches, begun or done: (file, modified, bytes, batch)."""
    schema = f"{LISTED}, batch string"
    folder = lake.loaded_files(name)
    if not _exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def arrived(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Files that no batch has taken. A file that is written anew counts as a new one."""
    return listing(spark, lake, name).join(taken(spark, lake, name).select("file", "modified"), ["file", "modified"], "left_anti")


def _batches(files: DataFrame, most: int, first: int) -> DataFrame:
    """The files with the number of their batch: in order of age and name, about `most` bytes each."""
    # A running sum over file names, not rows: they are few beside what is in them. A small file
    # counts as LEAST bytes, so that the names of a batch stay few, too.
    size = f"greatest(bytes, {LEAST})"
    upto = f"sum({size}) OVER (ORDER BY modified, file ROWS UNBOUNDED PRECEDING) - {size}"
    return files.selectExpr("*", f"format_string('stream-%05d', {first} + CAST(({upto}) div {most} AS INT)) AS batch")


def append_new_files(spark: SparkSession, lake: Lake, bytes_per_trigger: int = 64 << 30) -> tuple:
    """Load what has arrived in silver since the last call; returns the load's result row
    (table, staged, loaded, rejected, superseded).

    A backlog is cut into batches of about bytes_per_trigger. No file is too old to be seen. The
    fact must be loaded in this mode alone: loads that replace run dates would bring the same
    lines again, and are refused there. Calls for one lake must not run at the same time.
    """
    name = FACT_ORDERS.name
    if load.has_loads(spark, lake, "run"):
        raise ValueError("the fact holds lines loaded by run date, which this would add again")
    root = lake.loaded_files(name)
    known = taken(spark, lake, name).groupBy("batch").agg(F.count("*").alias("files")).collect()
    numbers = [int(r["batch"].removeprefix("stream-")) for r in known]
    # A batch that was begun and not finished comes first, with its own files.
    unfinished = sorted(r["batch"] for r in known if not _exists(spark, f"{root}/batch={r['batch']}/_DONE"))
    new = _batches(arrived(spark, lake, name), bytes_per_trigger, max(numbers, default=-1) + 1)
    planned = sorted(r["batch"] for r in new.select("batch").distinct().collect())
    if planned:
        new.repartition("batch").write.mode("append").partitionBy("batch").parquet(root)
    totals = [0, 0, 0]
    for batch in (*unfinished, *planned):
        for i, n in enumerate(_load_batch(spark, lake, batch)):
            totals[i] += n
        _touch(spark, f"{root}/batch={batch}/_DONE")
    return (name, *totals, 0)


def _touch(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True).close()


def _load_batch(spark: SparkSession, lake: Lake, batch: str) -> tuple[int, int, int]:
    """Write one batch's rows, rejects and results by file; all are replaced where they are there already."""
    name = FACT_ORDERS.name
    files = [r["file"] for r in taken(spark, lake, name).where(F.col("batch") == batch).select("file").collect()]
    stored = spark.read.schema(f"{silver.SCHEMAS[name]}, run_date date").option("basePath", lake.silver_root(name)).parquet(*files)
    rows = load.placed(stored)
    loaded = load.write_fact(spark, stored.select("*", load.tie().alias(load.TIE)), lake, batch)
    total = stored.count()
    turned = 0
    dated = [F.col("run_date"), F.lit(batch).alias("batch")]
    if loaded < total:
        seen = Observation(f"rejected_{batch}")
        bad = load.rejected(rows, FACT_ORDERS).select(
            "*", F.get_json_object("source_row", "$.run_date").cast("date").alias("run_date"), dated[1]
        )
        _write(bad.observe(seen, F.count(F.lit(1)).alias("rows")), lake.rejects(name))
        turned = seen.get["rows"]
    kept = load.read_rejects(spark, lake, name).where(F.col("batch") == batch) if turned else None
    results = load.file_results(rows, kept)
    day = F.regexp_extract("file", "run_date=([0-9-]+)", 1).cast("date").alias("run_date")
    _write(results.select("*", day, dated[1]), lake.file_results(name))
    return total, loaded, turned


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy("run_date", "batch").option("partitionOverwriteMode", "dynamic").parquet(path)
