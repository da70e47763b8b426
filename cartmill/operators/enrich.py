"""Country and currency enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.operators.facts import last_per_key, lookup
from cartmill.operators.reports import USD, Star


def customer_country(customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Country, region and currency for each customer with a `country_code`; unknown or
    missing codes keep the customer, with nulls. Of several countries with one code the
    last by name counts."""
    details = ("country", "region", "subregion", "currency_code")
    country = last_per_key(countries.select("country_code", *details), "country_code", details)
    return customers.join(country, "country_code", "left")


def _with_rate(rows: DataFrame, currencies: DataFrame, code: str) -> DataFrame:
    rates = currencies.select(F.col("currency_code").alias(code), "rate_to_usd")
    return lookup(rows, rates, code, "rate_to_usd", F.lit(None).cast("decimal(18,8)"))


def from_usd(rows: DataFrame, currencies: DataFrame, amount: str, code: str, name: str) -> DataFrame:
    """USD amount in the currency named by column `code`; unknown code gives null."""
    converted = F.try_divide(F.col(amount), F.col("rate_to_usd"))
    return _with_rate(rows, currencies, code).withColumn(name, _cents(converted)).drop("rate_to_usd")


def to_usd(rows: DataFrame, currencies: DataFrame, amount: str, code: str, name: str) -> DataFrame:
    """Amount in the currency named by column `code`, in USD; unknown code gives null."""
    converted = F.try_multiply(F.col(amount), F.col("rate_to_usd"))
    return _with_rate(rows, currencies, code).withColumn(name, _cents(converted)).drop("rate_to_usd")


def _cents(value: Column) -> Column:
    return F.round(value, 2).try_cast(USD)


def orders_by_country(star: Star, customers: DataFrame) -> DataFrame:
    """Orders, units and revenue per country; `customers` carries country and region."""
    lines = star["fact_orders"].select("order_id", "customer_id", "quantity", "total_usd")
    return (
        lines.join(customers.select("customer_id", "country", "region"), "customer_id")
        .groupBy("country", "region")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("units_sold"),
            F.sum("total_usd").cast(USD).alias("revenue_usd"),
        )
        .orderBy(F.desc("revenue_usd"))
    )
