"""The reports over the gold star schema, as DataFrame queries and as views.

Facts are narrowed or aggregated before they meet a dimension wherever the grouping
allows it. No join carries a broadcast hint: Spark checks sizes, and splits hot keys
where a dimension is too big to send around.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartmill.functions.clean import exact_mean
from cartmill.operators import load
from cartmill.schemas import LOAD_ORDER
from cartmill.sources import versions
from cartmill.sources.lake import Lake

Star = Mapping[str, DataFrame]
USD = "decimal(22,2)"
TOP = 10


def _orders():
    return F.count_distinct("order_id").alias("total_orders")


def _units():
    return F.sum("quantity")


def _revenue():
    return F.sum("total_usd").cast(USD)


def daily_revenue(star: Star) -> DataFrame:
    """Per day with sales. The mean is per order line, not per order.

    The fact is aggregated by its own date key first, so only one row per day is joined.
    """
    days = star["fact_orders"].groupBy("date_id").agg(
        _orders(),
        _units().alias("units_sold"),
        _revenue().alias("revenue_usd"),
        exact_mean(F.col("total_usd")).alias("avg_order_value_usd"),
    )
    return days.join(star["dim_date"], "date_id").select(
        "full_date",
        "year",
        "month_name",
        "weekday_name",
        "is_weekend",
        "total_orders",
        "units_sold",
        "revenue_usd",
        "avg_order_value_usd",
    ).orderBy("full_date")


def revenue_by_category(star: Star) -> DataFrame:
    """Mean price and rating are weighted by order lines; null ratings are left out."""
    lines = star["fact_orders"].select("order_id", "product_id", "quantity", "total_usd")
    product = star["dim_product"].select("product_id", "category", "price_usd", "rating_rate")
    return (
        lines.join(product, "product_id")
        .groupBy("category")
        .agg(
            _orders(),
            _units().alias("units_sold"),
            _revenue().alias("revenue_usd"),
            exact_mean(F.col("price_usd")).alias("avg_product_price_usd"),
            exact_mean(F.col("rating_rate")).alias("avg_rating"),
        )
        .orderBy(F.desc("revenue_usd"))
    )


def top_products(star: Star) -> DataFrame:
    """The ten best ranks by revenue; a tie at the end gives more than ten rows.

    Ranks are given to revenue values: a value's rank is one more than the products above
    it, so the ten highest values with their numbers of products settle all ranks, however
    many products share a value.
    """
    sold = star["fact_orders"].groupBy("product_id").agg(
        _units().alias("units_sold"), _revenue().alias("revenue_usd")
    )
    product = star["dim_product"].select("product_id", "name", "category", "price_usd")
    known = sold.join(product.select("product_id"), "product_id", "left_semi")
    # The values take a column of each product's row that they need no more than for this: so
    # both uses of `known` are one and the same plan, and the fact is read and added up once.
    values = known.groupBy(F.col("revenue_usd").alias("_value")).agg(
        F.count("*").alias("_products"), F.max(F.coalesce("units_sold", F.lit(0))).alias("_most")
    )
    best = values.orderBy(F.desc_nulls_last("_value")).limit(TOP)
    # One task, over TOP values.
    above = Window.orderBy(F.desc_nulls_last("_value")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = best.select(
        "_value", "_most", (F.coalesce(F.sum("_products").over(above), F.lit(0)) + 1).cast("int").alias("revenue_rank")
    ).where(F.col("revenue_rank") <= TOP)
    same = known["revenue_usd"].eqNullSafe(F.col("_value")) & (F.coalesce(known["units_sold"], F.lit(0)) <= F.col("_most"))
    # Names and prices are only looked up for the winners.
    ranked = known.join(F.broadcast(ranks), same).join(product, "product_id")
    return ranked.select(
        "product_id",
        F.col("name").alias("product_name"),
        "category",
        "price_usd",
        "units_sold",
        "revenue_usd",
        "revenue_rank",
    ).orderBy("revenue_rank")


def orders_by_city(star: Star) -> DataFrame:
    """Per city and position: one city at two positions gives two rows."""
    lines = star["fact_orders"].select("order_id", "customer_id", "quantity", "total_usd")
    customer = star["dim_customer"].select("customer_id", "city", "lat", "lon")
    return (
        lines.join(customer, "customer_id")
        .groupBy("city", "lat", "lon")
        .agg(_orders(), _units().alias("units_sold"), _revenue().alias("revenue_usd"))
        .orderBy(F.desc("revenue_usd"))
    )


def customer_ltv(star: Star) -> DataFrame:
    """Per customer: orders, value, first and last day, days between them.

    Aggregated by customer before the customer columns are joined on, which then needs
    no further shuffle of the fact. Date keys order as their days do, so only the first and
    the last key of each customer are turned into days.
    """
    lines = star["fact_orders"].select("order_id", "customer_id", "date_id", "quantity", "total_usd")

    def day(key: str) -> Column:
        return F.make_date(F.expr(f"{key} div 10000"), F.expr(f"{key} div 100 % 100"), F.expr(f"{key} % 100"))

    totals = (
        lines.join(star["dim_date"].select("date_id"), "date_id", "left_semi")
        .groupBy("customer_id")
        .agg(
            _orders(),
            _units().alias("total_units"),
            _revenue().alias("lifetime_value_usd"),
            F.min("date_id").alias("_first"),
            F.max("date_id").alias("_last"),
        )
        .withColumns({"first_order_date": day("_first"), "last_order_date": day("_last")})
    )
    return totals.join(star["dim_customer"], "customer_id").select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "city",
        "total_orders",
        "total_units",
        "lifetime_value_usd",
        "first_order_date",
        "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("customer_tenure_days"),
    ).orderBy(F.desc("lifetime_value_usd"))


def weekly_revenue(star: Star) -> DataFrame:
    """Per calendar year and ISO week, with the sum over it and the three rows before.

    The two can disagree around New Year: 1 January and 31 December of one year may
    share a week number and then one row. `week_start` is the week's first day with
    sales, and weeks without sales are not filled in.
    """
    orders = star["fact_orders"].groupBy("date_id", "order_id").agg(F.sum("total_usd").alias("_sum"))
    dates = star["dim_date"].select(
        "date_id", "full_date", "year", F.weekofyear("full_date").alias("week_num")
    )
    weeks = (
        orders.join(dates, "date_id")
        .groupBy("year", "week_num")
        .agg(
            F.min("full_date").alias("week_start"), _orders(), F.sum("_sum").cast(USD).alias("revenue_usd")
        )
    )
    # One task, but it sees one row per week of the calendar, whatever the fact's size.
    last_four = Window.orderBy("year", "week_num").rowsBetween(-3, Window.currentRow)
    rolling = F.sum("revenue_usd").over(last_four).cast(USD)
    return weeks.withColumn("rolling_4wk_revenue_usd", rolling).orderBy("year", "week_num")


REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    "rpt_daily_revenue": daily_revenue,
    "rpt_revenue_by_category": revenue_by_category,
    "rpt_top_products": top_products,
    "rpt_orders_by_city": orders_by_city,
    "rpt_customer_ltv": customer_ltv,
    "rpt_weekly_revenue": weekly_revenue,
}


def read_star(spark: SparkSession, lake: Lake) -> Star:
    return {t.name: load.read_gold(spark, lake, t.name) for t in LOAD_ORDER}


def define(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """(Re)define the tables and reports as views of the session; returns the reports."""
    star = read_star(spark, lake)
    found = {name: report(star) for name, report in REPORTS.items()}
    for name, rows in {**star, **found}.items():
        rows.createOrReplaceTempView(name)
    return found


def publish(spark: SparkSession, lake: Lake, materialise: bool = False) -> list[str]:
    """Define the views, and optionally store each report as Parquet (read_report), replacing
    it in one step. Reports always read the whole gold fact. Every load brings the views up to
    date, as each holds folders and listings of files (load.follow)."""
    for name, result in define(spark, lake).items():
        if materialise:
            versions.replace(result, lake.report(name))
    load.follow_loads(spark, lake, [*(t.name for t in LOAD_ORDER), *REPORTS], lambda: define(spark, lake))
    return list(REPORTS)


def read_report(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A stored report."""
    return spark.read.parquet(versions.current(spark, lake.report(name)))
