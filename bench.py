"""Time the headline queries: one warm-up, then the median of three runs each.

Every run derives its tables from the Parquet input again; results go to Spark's noop
sink. `stored` has the same reports over gold tables loaded beforehand, which is how the
daily job serves them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartmill.operators import load, reports
from cartmill.plans import job
from cartmill.plans.catalog import DAY_1, QUERIES
from cartmill.session import build_session, work_folder
from cartmill.sources import silver, tables
from cartmill.sources.lake import Lake

HEADLINE = (*reports.REPORTS, "fact_orders")


def seconds(run) -> float:
    times = []
    for _ in range(4):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {name: seconds(lambda name=name: QUERIES[name](spark, folder)) for name in HEADLINE}

    lake = Lake(work_folder(spark))
    for name, rows in job.silver_tables(tables.feed(spark, folder)).items():
        silver.write(rows, lake, name, DAY_1)
    start = time.perf_counter()
    load.load_all(spark, lake, DAY_1)
    loading = round(time.perf_counter() - start, 3)
    star = reports.read_star(spark, lake)
    stored = {name: seconds(lambda f=f: f(star)) for name, f in reports.REPORTS.items()}

    print(
        json.dumps(
            {
                "metric": "six reports and the fact build, from raw tables, warm median of 3",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "stored": stored,
                "load_all": loading,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
