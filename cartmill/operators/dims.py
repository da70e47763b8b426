"""Silver dimensions from the feeds' extracted records.

Products and customers keep every row and their place in the feed: which of two rows
with one key counts is decided where it is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartmill.functions import clean
from cartmill.sources.bronze import FEED_ORDER


def kept(records: DataFrame) -> list[str]:
    """The columns with faults and elements, of records that come from JSON."""
    return [c for c in ("_faults", "_raw") if c in records.columns]


def dim_product(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("id").alias("product_id"),
        F.col("title").alias("name"),
        clean.label(F.col("category")).alias("category"),
        clean.money(F.col("price")).alias("price_usd"),
        clean.number(F.col("rating_rate")).try_cast("decimal(18,6)").alias("rating_rate"),
        clean.number(F.col("rating_count")).try_cast("bigint").alias("rating_count"),
        *FEED_ORDER,
        *kept(records),
    )


def dim_customer(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("id").alias("customer_id"),
        "first_name",
        "last_name",
        "email",
        "city",
        "zipcode",
        clean.position(F.col("lat")).try_cast("decimal(18,6)").alias("lat"),
        clean.position(F.col("lon")).try_cast("decimal(18,6)").alias("lon"),
        "country_code",
        *FEED_ORDER,
        *kept(records),
    )


def dim_date(cart_days: DataFrame) -> DataFrame:
    """Distinct days first, calendar attributes on those few rows only."""
    return cart_days.distinct().where("day IS NOT NULL").selectExpr(*clean.calendar("day"))


def dim_currency(rates: DataFrame) -> DataFrame:
    """Rates of zero, null or empty text are left out, then numbered 1..n in document order.

    One task numbers the rows: they are the currencies of one rates document.
    """
    given = F.col("rate").isNotNull() & (F.col("rate") != "")
    usable = rates.where(given & ~clean.number(F.col("rate")).eqNullSafe(0))
    return usable.select(
        F.row_number().over(Window.orderBy("pos")).alias("currency_id"),
        F.col("code").alias("currency_code"),
        clean.reciprocal(F.col("rate")).try_cast("decimal(38,8)").alias("rate_to_usd"),
    )
