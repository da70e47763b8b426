"""Session settings and the shared work folder."""

from __future__ import annotations

import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings the jobs rely on; all can be changed on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot order, product or customer is split even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A repeated JSON key keeps its last value instead of spoiling the element.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Marks a session that has them.
TUNED = "spark.cartmill.tuned"

# Only a new session takes these: plans are built faster without a Python call site kept
# per expression.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "cartmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **AT_START, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME once to a session somebody else made; what is changed later stays."""
    if spark.conf.get(TUNED, None) is None:
        for key, value in {**RUNTIME, TUNED: "true"}.items():
            spark.conf.set(key, value)
    return spark


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: Counter[str] = Counter()
_before: dict[str, str | None] = {}
_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written within go when it is written, as nothing reads them any more.

    Else they stay until the driver happens to collect its garbage. The setting is the session's,
    so where threads write at the same time, it holds from the first one's begin to the last one's end.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _writing[session]:
            _before[session] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _writing[session] += 1
    try:
        yield
    finally:
        with _lock:
            _writing[session] -= 1
            if not _writing[session]:
                before = _before.pop(session)
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def drop_folders(spark: SparkSession, *paths: str) -> None:
    """Delete folders whose tables have been used up."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def at_once(*steps: Callable[[], Any]) -> list:
    """Run steps that don't need each other's results at the same time; returns their results in order.

    Their jobs share the session's cores: small ones run while a large one's last tasks leave some
    idle. An error is raised when all steps have ended.
    """
    inheriting = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(len(steps), 1)) as pool:
        begun = [pool.submit(inheriting(step)) for step in steps]
    return [step.result() for step in begun]


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir, or below the warehouse where that is unset:
    both are shared by all executors. It goes when the driver's JVM ends."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/cartmill/{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path
