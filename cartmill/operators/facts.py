"""The order-line fact and the price lookup it needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.functions import clean
from cartmill.sources.bronze import FEED_ORDER


def last_per_key(rows: DataFrame, key: str, order: Sequence[str] = FEED_ORDER) -> DataFrame:
    """The last row of each key. Spark cuts each partition to one row per key before the
    shuffle, so a key repeated many times moves only one row per partition."""
    latest = ", ".join(f"{column} DESC" for column in order)
    nth = f"row_number() OVER (PARTITION BY {key} ORDER BY {latest}) AS _nth"
    return rows.selectExpr("*", nth).where("_nth = 1").drop("_nth")


def lookup(
    rows: DataFrame, table: DataFrame, key: str, value: str, default: Column
) -> DataFrame:
    """Left join on a key that is unique in `table`: unmatched keys get the default, a
    matched null stays null. Whether to broadcast is left to Spark's size check; beyond
    that it is a shuffled join whose hot keys AQE splits."""
    found = table.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(value).alias("_value")
    )
    joined = rows.join(found, rows[key] == found["_key"], "left")
    chosen = F.when(F.col("_key").isNull(), default).otherwise(F.col("_value"))
    return joined.withColumn(value, chosen).drop("_key", "_value")


def fact_orders(cart_lines: DataFrame, dim_product: DataFrame, fits: str = "price_usd IS NOT NULL") -> DataFrame:
    """One row per order line, priced from the product list. `dim_product` is the silver
    one; of repeated ids the last that fits counts, as in the gold table, and a product
    whose entries all don't has no price."""
    extra = [c for c in (*FEED_ORDER, "_faults", "_raw") if c in cart_lines.columns]
    lines = cart_lines.select(
        "order_id",
        clean.date_key(F.col("day")).alias("date_id"),
        "product_id",
        "customer_id",
        "quantity",
        *extra,
    )
    entries = dim_product.withColumn("_fits", F.coalesce(F.expr(fits), F.lit(False))).select(
        "product_id", F.when(F.col("_fits"), F.col("price_usd")).alias("price_usd"), "_fits", *FEED_ORDER
    )
    prices = last_per_key(entries, "product_id", ("_fits", *FEED_ORDER))
    priced = lookup(lines, prices, "product_id", "price_usd", F.lit(0).cast(clean.MONEY))
    return priced.select(
        "order_id",
        "date_id",
        "product_id",
        "customer_id",
        "quantity",
        F.col("price_usd").alias("unit_price_usd"),
        F.try_multiply("price_usd", F.col("quantity").cast("decimal(10,0)"))
        .try_cast(clean.MONEY)
        .alias("total_usd"),
        *extra,
    )
