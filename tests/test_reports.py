from datetime import date
from decimal import Decimal

import pytest
from conftest import SMALL

from cartmill.operators import audit, enrich, reports
from cartmill.plans import job
from cartmill.schemas import DIM_CURRENCY, FACT_ORDERS
from cartmill.sources import tables

FACT = "order_id bigint, date_id int, product_id bigint, customer_id bigint, quantity int, unit_price_usd decimal(10,2), total_usd decimal(12,2)"
CALENDAR = "date_id int, full_date date, year int, month_name string, weekday_name string, is_weekend boolean"


def line(order, day, product, customer, quantity, total):
    return (order, int(day.strftime("%Y%m%d")), product, customer, quantity, Decimal("1.00"), Decimal(total))


def make_star(spark, lines, products=(), customers=()):
    days = {date.fromisoformat(f"{d[1]}"[:4] + "-" + f"{d[1]}"[4:6] + "-" + f"{d[1]}"[6:]) for d in lines}
    dates = [
        (int(d.strftime("%Y%m%d")), d, d.year, d.strftime("%B"), d.strftime("%A"), d.weekday() >= 5) for d in days
    ]
    return {
        "fact_orders": spark.createDataFrame(list(lines), FACT),
        "dim_date": spark.createDataFrame(dates, CALENDAR),
        "dim_product": spark.createDataFrame(
            list(products), "product_id bigint, name string, category string, price_usd decimal(10,2), rating_rate decimal(3,2)"
        ),
        "dim_customer": spark.createDataFrame(
            list(customers),
            "customer_id bigint, first_name string, last_name string, email string, city string, lat decimal(9,6), lon decimal(9,6)",
        ),
    }


def test_daily_mean_is_per_line(spark):
    day = date(2024, 1, 6)
    star = make_star(spark, [line(1, day, 1, 1, 1, "10.00"), line(1, day, 2, 1, 2, "20.00"), line(2, day, 1, 1, 3, "30.01")])
    row = reports.daily_revenue(star).first()
    assert (row.total_orders, row.units_sold, row.revenue_usd) == (2, 6, Decimal("60.01"))
    assert row.avg_order_value_usd == Decimal("20.00") and row.is_weekend and row.weekday_name == "Saturday"


def test_categories_weigh_by_line_and_drop_unknown_products(spark):
    day = date(2024, 1, 6)
    star = make_star(
        spark,
        [line(1, day, 1, 1, 1, "1.00"), line(2, day, 1, 1, 1, "1.00"), line(2, day, 2, 1, 1, "5.00"), line(3, day, 99, 1, 1, "7.00")],
        [(1, "a", "toys", Decimal("1.00"), None), (2, "b", "toys", Decimal("5.00"), Decimal("4.00"))],
    )
    (row,) = reports.revenue_by_category(star).collect()
    assert (row.total_orders, row.revenue_usd) == (2, Decimal("7.00"))
    assert row.avg_product_price_usd == Decimal("2.33") and row.avg_rating == Decimal("4.00")


def test_ties_at_rank_ten_keep_all_and_ranks_skip(spark):
    day = date(2024, 1, 6)
    worth = ["50"] * 2 + ["40"] * 7 + ["30"] * 4 + ["20"] * 3
    star = make_star(
        spark,
        [line(i, day, i, 1, 1, w) for i, w in enumerate(worth)],
        [(i, f"p{i}", "c", Decimal("1.00"), None) for i in range(len(worth))],
    )
    found = reports.top_products(star).collect()
    assert [r.revenue_rank for r in found] == [1] * 2 + [3] * 7 + [10] * 4


def test_one_city_at_two_positions_gives_two_rows(spark):
    day = date(2024, 1, 6)
    person = (None, None, None, "X")
    star = make_star(
        spark,
        [line(1, day, 1, 1, 1, "1.00"), line(2, day, 1, 2, 1, "2.00"), line(3, day, 1, 3, 1, "4.00")],
        customers=[(1, *person, Decimal("0"), Decimal("0")), (2, *person, Decimal("1"), Decimal("0"))],
    )
    assert [(r.lat, r.revenue_usd) for r in reports.orders_by_city(star).collect()] == [
        (Decimal("1"), Decimal("2.00")), (Decimal("0"), Decimal("1.00"))]


def test_customer_value(spark):
    star = make_star(
        spark,
        [line(1, date(2024, 1, 6), 1, 1, 2, "1.00"), line(2, date(2024, 3, 1), 1, 1, 1, "2.00"), line(3, date(2024, 1, 6), 1, 2, 1, "9.00")],
        customers=[(1, "A", "B", "e", "X", None, None), (2, None, "B", "e", "X", None, None)],
    )
    second, first = reports.customer_ltv(star).collect()
    assert (first.full_name, first.total_orders, first.total_units) == ("A B", 2, 3)
    assert (first.first_order_date, first.last_order_date, first.customer_tenure_days) == (
        date(2024, 1, 6), date(2024, 3, 1), 55)
    assert second.full_name is None and second.customer_tenure_days == 0


def test_weeks_roll_over_rows_and_share_a_number_around_new_year(spark):
    days = [date(1996, 1, 1), date(1996, 12, 31), date(1996, 1, 8), date(1996, 1, 29), date(1996, 2, 5), date(1996, 2, 12)]
    star = make_star(spark, [line(i, d, 1, 1, 1, str(10**i)) for i, d in enumerate(days)])
    found = reports.weekly_revenue(star).collect()
    assert [r.week_num for r in found] == [1, 2, 5, 6, 7]
    assert found[0].week_start == date(1996, 1, 1) and found[0].revenue_usd == 11
    assert [r.rolling_4wk_revenue_usd for r in found] == [11, 111, 1111, 11111, 111100]


def test_reports_agree_on_the_total(spark):
    star = job.star(tables.feed(spark, SMALL))
    total = star["fact_orders"].agg({"total_usd": "sum"}).first()[0]

    def summed(report, column):
        return report(star).agg({column: "sum"}).first()[0]

    assert summed(reports.daily_revenue, "revenue_usd") == total
    assert summed(reports.weekly_revenue, "revenue_usd") == total
    assert summed(reports.revenue_by_category, "revenue_usd") == total
    assert summed(reports.orders_by_city, "revenue_usd") == total
    assert summed(reports.customer_ltv, "lifetime_value_usd") == total


def test_audits(spark):
    day = date(2024, 1, 6)
    star = make_star(spark, [line(1, day, 1, 1, 1, "1.00"), line(2, day, 9, 1, 1, "1.00"), line(3, day, 9, 8, 1, "1.00")],
                     [(1, "a", "c", None, None)], [(1, None, None, None, None, None, None)])
    assert sorted(tuple(r) for r in audit.orphans(star).collect()) == [("customer_id", 8, 1), ("product_id", 9, 2)]
    rates = spark.createDataFrame([(1, "EUR"), (2, "EUR"), (2, "USD"), (3, None)], "currency_id int, currency_code string")
    assert sorted(tuple(r) for r in audit.duplicate_keys(rates, DIM_CURRENCY).collect()) == [
        ("dim_currency", "currency_code", "EUR", 2), ("dim_currency", "currency_id", "2", 2)]
    assert {r.column_name: r.null_rows for r in audit.nulls(rates, DIM_CURRENCY).collect()} == {
        "currency_id": 0, "currency_code": 1}
    assert all(r.null_rows == 0 for r in audit.nulls(star["fact_orders"], FACT_ORDERS).collect())


def test_country_and_currency(spark):
    customers = spark.createDataFrame([(1, "PE"), (2, "XX"), (3, None)], "customer_id bigint, country_code string")
    countries = spark.createDataFrame([("PE", "Peru", "Americas", None, "PEN")],
                                      "country_code string, country string, region string, subregion string, currency_code string")
    found = {r.customer_id: r.region for r in enrich.customer_country(customers, countries).collect()}
    assert found == {1: "Americas", 2: None, 3: None}
    rates = spark.createDataFrame([("PEN", Decimal("0.3"))], "currency_code string, rate_to_usd decimal(18,8)")
    money = spark.createDataFrame([("PEN", Decimal("10.00")), ("XXX", Decimal("1.00")), (None, Decimal("1.00"))],
                                  "code string, amount decimal(12,2)")
    local = {r.code: r.x for r in enrich.from_usd(money, rates, "amount", "code", "x").collect()}
    assert local == {"PEN": Decimal("33.33"), "XXX": None, None: None}
    usd = {r.code: r.x for r in enrich.to_usd(money, rates, "amount", "code", "x").collect()}
    assert usd == {"PEN": Decimal("3.00"), "XXX": None, None: None}


@pytest.mark.parametrize("name", list(reports.REPORTS))
def test_plans_stay_in_the_jvm_and_read_few_columns(spark, name):
    star = job.star(tables.feed(spark, SMALL))
    plan = reports.REPORTS[name](star)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    scans = [p.split("ReadSchema: ")[1].splitlines()[0] for p in plan.split("FileScan")[1:]]
    fact = next(p for p in scans if "l_orderkey" in p or "l_partkey" in p)
    assert "l_extendedprice" not in fact and "l_shipdate" not in fact
    if name == "rpt_top_products":
        assert plan.count("WindowGroupLimit [revenue") >= 1 or "WindowGroupLimit" in plan
