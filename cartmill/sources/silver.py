"""Silver: cleaned, typed Parquet, one folder per table and run date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartmill.session import shuffles_dropped
from cartmill.sources.bronze import FEED_ORDER
from cartmill.sources.lake import Lake

_ORDER = "doc string, block bigint, pos bigint"
# What the load needs to tell why a row is turned away, and what it was.
_KEPT = "_faults array<string>, _raw string"
# What the builders write; wider than gold, so that an oversized value is seen at load.
SCHEMAS = {
    "dim_product": "product_id bigint, name string, category string, price_usd decimal(18,2), "
    f"rating_rate decimal(18,6), rating_count bigint, {_ORDER}, {_KEPT}",
    "dim_customer": "customer_id bigint, first_name string, last_name string, email string, "
    "city string, zipcode string, lat decimal(18,6), lon decimal(18,6), country_code string, "
    f"{_ORDER}, {_KEPT}",
    "dim_date": "date_id int, full_date date, year int, quarter int, month int, "
    "month_name string, day int, weekday_num int, weekday_name string, is_weekend boolean",
    "dim_currency": "currency_id int, currency_code string, rate_to_usd decimal(38,8)",
    "fact_orders": "order_id bigint, date_id int, product_id bigint, customer_id bigint, "
    f"quantity int, unit_price_usd decimal(18,2), total_usd decimal(18,2), {_ORDER}, {_KEPT}",
    # Carts unfolded to items, the step between the cart JSON and two of the tables.
    "carts": f"{_ORDER}, order_id bigint, customer_id bigint, day date, product_id bigint, quantity int, "
    f"has_item boolean, nth int, reason string, unreadable string, {_KEPT}",
    "dim_country": "country_code string, country string, region string, subregion string, "
    "currency_code string, lat decimal(9,6), lon decimal(9,6), population bigint",
}
# Columns that say which of several rows with one key came last.
RECENCY = {"dim_product": FEED_ORDER, "dim_customer": FEED_ORDER}


def write(rows: DataFrame, lake: Lake, table: str, run_date: date) -> tuple[str, int]:
    """Replace one table's folder for one run date; returns its path and row count.

    The count is observed while writing, so nothing is computed twice.
    """
    path = lake.silver(table, run_date)
    seen = Observation(f"silver_{table}")
    with shuffles_dropped(rows.sparkSession):
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
            "compression", "snappy"
        ).parquet(path)
    return path, seen.get["rows"]


def read(spark: SparkSession, lake: Lake, table: str, run_date: date) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(lake.silver(table, run_date))
