"""Tables that are replaced as a whole, without a moment in which a reader finds none.

A new version is written to a folder of its own; a marker, created when all its files are there,
makes it the current one. Readers take the newest folder that has a marker, so they see the old
rows or the new ones. The version before is kept until the next replacement, for readers that
have begun; a version that broke off has no marker and is never seen.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

MARKER = "_COMPLETE"
_NAME = re.compile(r"v(\d{9})-[0-9a-f]{8}")


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _entries(spark: SparkSession, path: str) -> list[str]:
    at, system = _system(spark, path)
    return [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []


def _complete(spark: SparkSession, path: str, names: list[str]) -> list[str]:
    """Complete versions, the newest first; of two that were made at the same time, one is."""
    found = sorted((n for n in names if _NAME.fullmatch(n)), reverse=True)
    return [n for n in found if _exists(spark, f"{path}/{n}/{MARKER}")]


def _exists(spark: SparkSession, path: str) -> bool:
    at, system = _system(spark, path)
    return system.exists(at)


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: the newest complete version, or the path itself where there is none."""
    versions = sorted((n for n in _entries(spark, path) if _NAME.fullmatch(n)), reverse=True)
    newest = next((n for n in versions if _exists(spark, f"{path}/{n}/{MARKER}")), None)
    return f"{path}/{newest}" if newest else path


def replace(rows: DataFrame, path: str) -> str:
    """Write the rows as the next version, make it the current one, and return its folder.

    Rows may be read from the table itself. What is older than the version before goes.
    """
    spark = rows.sparkSession
    names = _entries(spark, path)
    numbers = [int(m[1]) for n in names if (m := _NAME.fullmatch(n))]
    folder = f"{path}/v{max(numbers, default=0) + 1:09d}-{uuid.uuid4().hex[:8]}"
    rows.write.option("compression", "snappy").parquet(folder)
    at, system = _system(spark, f"{folder}/{MARKER}")
    system.create(at, True).close()
    kept = _complete(spark, path, _entries(spark, path))[:2]
    if len(kept) == 2:
        oldest = min(kept)
        for name in names:
            # Files without a version are from before there were any.
            if not _NAME.fullmatch(name) or name < oldest:
                at, system = _system(spark, f"{path}/{name}")
                system.delete(at, True)
    return folder
