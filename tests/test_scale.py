"""A third of all rows on one order, product, customer and day, with joins that may not
broadcast: the results must stay whole and equal the SQL, and the work must be spread."""

import duckdb
import pytest
from compare import differences
from conftest import SMALL
from pyspark.sql import functions as F

from cartmill.operators import reports
from cartmill.plans import job
from cartmill.plans.catalog import QUERIES
from cartmill.plans.oracle import ORACLE
from cartmill.sources import tables

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))

    def hot(column, value):
        return F.when(F.col(column) % 3 == 0, F.lit(value)).otherwise(F.col(column))

    changed = {
        "lineitem": {"l_orderkey": hot("l_orderkey", 11), "l_partkey": hot("l_partkey", 7)},
        "orders": {
            "o_custkey": hot("o_custkey", 4),
            "o_orderdate": F.when(F.col("o_orderkey") % 3 == 0, F.lit("1997-06-15").cast("timestamp_ntz"))
            .otherwise(F.col("o_orderdate")),
        },
    }
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        rows = tables.table(spark, SMALL, name)
        for column, value in changed.get(name, {}).items():
            rows = rows.withColumn(column, value.cast(rows.schema[column].dataType))
        rows.repartition(4).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def duck(skewed):
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{skewed}/{name}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize(
    "name", [*reports.REPORTS, "fact_orders", "fact_orders_dirty", "rpt_orders_by_country", "load_summary", "fact_clustered_scan"]
)
def test_hot_keys_without_broadcast(spark, no_broadcast, skewed, duck, name):
    found = QUERIES[name](spark, skewed)
    assert differences(found.collect(), dict(found.dtypes), duck.sql(ORACLE[name])) == []


def test_hot_join_keys_are_split(spark, no_broadcast, skewed):
    """The price join's hot product ends up in several tasks."""
    star = job.star(tables.feed(spark, skewed))
    report = reports.revenue_by_category(star)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
