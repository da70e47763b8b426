"""Partial results that add up, and reports kept up load by load."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from cartmill.operators import load, partials
from cartmill.schemas import FACT_ORDERS
from cartmill.sources import silver
from test_load import line, stage

DAYS = (date(2024, 1, 5), date(2024, 1, 6))


def test_orders_and_sums_add_up(spark):
    lines = spark.createDataFrame(
        [(o, d, q, t) for o, d, q, t in [
            (1, 1, 1, "1.00"), (1, 1, 2, "2.00"), (1, 2, 1, "3.00"), (40_000, 1, 1, None), (2**40, 2, 1, "0.01"), (-5, 2, 1, "1.00"),
            (5, 2, None, "1.00"), (0, 2, 1, "1.00"), (None, 3, 4, "2.00"), (32_768, 3, 1, "0.05"), (32_769, 3, 1, "0.05")]],
        "order_id long, date_id int, quantity int, total_usd string",
    ).withColumn("total_usd", F.col("total_usd").cast("decimal(12,2)"))
    halves = partials.partial(lines.where("quantity = 1"), "date_id").unionByName(
        partials.partial(lines.where("coalesce(quantity, 0) <> 1"), "date_id"))
    found = {r.date_id: (r.total_orders, r.lines, r.units_sold, r.revenue_usd) for r in partials.totals(halves, "date_id").collect()}
    expected = lines.groupBy("date_id").agg(
        F.count_distinct("order_id"), F.count("*"), F.sum("quantity"), F.sum("total_usd").cast("decimal(22,2)")).collect()
    assert found == {r[0]: tuple(r[1:]) for r in expected}
    over_all = partials.totals(partials.merged(halves, "date_id").withColumn("all", F.lit(1)), "all").first()
    assert over_all.total_orders == lines.select("order_id").where("order_id IS NOT NULL").distinct().count()
    assert partials.totals(halves.where("false"), "date_id").count() == 0


def test_only_changed_loads_are_read(spark, lake):
    stage(spark, lake, "fact_orders", [line(1), line(2)], DAYS[0])
    stage(spark, lake, "fact_orders", [line(2, price="5.00"), line(3)], DAYS[1])
    stored = lambda: partials.totals(partials.read(spark, lake.partials(FACT_ORDERS.name)), "date_id").first()
    load.load_fact(spark, lake, DAYS[0], "replace_run")
    assert partials.refresh(spark, lake) == ["run_date=2024-01-05/batch=run"]
    load.load_fact(spark, lake, DAYS[1], "replace_run")
    assert partials.refresh(spark, lake) == ["run_date=2024-01-06/batch=run"]
    assert partials.refresh(spark, lake) == []
    # Order 2 has lines in both loads and counts once.
    assert stored()[1:4] == (3, 4, 4)
    silver.write(spark.createDataFrame([line(9, price="7.00")], silver.SCHEMAS["fact_orders"]), lake, "fact_orders", DAYS[0])
    load.load_fact(spark, lake, DAYS[0], "replace_run")
    assert partials.refresh(spark, lake) == ["run_date=2024-01-05/batch=run"]
    assert stored()[1:5] == (3, 3, 3, Decimal("13.00"))
    load.load_fact(spark, lake, DAYS[1], "snapshot")
    partials.refresh(spark, lake)
    assert stored()[1:3] == (2, 2)


def test_the_mean_is_exact_over_many_lines(spark):
    """100.00 over 20,001 lines is 0.00499975…, which six places would round up to half a cent."""
    lines = spark.range(20_001).select(
        F.col("id").alias("order_id"), F.lit(1).alias("date_id"), F.lit(1).alias("quantity"),
        F.when(F.col("id") < 10_000, Decimal("0.01")).otherwise(Decimal("0.00")).cast("decimal(12,2)").alias("total_usd"))
    found = partials.totals(partials.partial(lines, "date_id"), "date_id").first()
    assert (found.revenue_usd, found.avg_order_value_usd) == (Decimal("100.00"), Decimal("0.00"))


def test_rows_are_added_up_without_sorting(spark):
    """Rows of 4 kB were sorted to be added up, and there were as many as days times buckets."""
    lines = spark.range(1).selectExpr("id AS order_id", "1 AS date_id", "1 AS quantity", "1.00BD AS total_usd")
    each = partials.partial(lines, "date_id")
    plan = partials.totals(each, "date_id")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan.replace("isSorted", "")


def test_folders_in_another_layout_are_made_anew(spark, lake, monkeypatch):
    stage(spark, lake, "fact_orders", [line(1)], DAYS[0])
    load.load_fact(spark, lake, DAYS[0], "replace_run")
    with monkeypatch.context() as older:
        older.setattr(partials, "LAYOUT", "older")
        assert partials.refresh(spark, lake) == ["run_date=2024-01-05/batch=run"]
    assert partials.refresh(spark, lake) == ["run_date=2024-01-05/batch=run"]
    assert partials.refresh(spark, lake) == []
