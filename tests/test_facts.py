from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from cartmill.operators import facts

LINES = "order_id bigint, customer_id bigint, day date, product_id bigint, quantity int"
PRODUCTS = "product_id bigint, price_usd decimal(18,2), doc string, block bigint, pos bigint"


def test_prices(spark):
    day = date(1996, 12, 31)
    lines = spark.createDataFrame(
        [(1, 5, day, 10, 3), (1, 5, day, 11, 1), (2, 5, day, 12, 2), (2, 5, day, None, 2), (3, 5, day, 10, None)],
        LINES,
    )
    products = spark.createDataFrame(
        [
            (10, Decimal("1.00"), "a", 0, 0),
            (10, Decimal("2.50"), "a", 0, 4),  # the last entry counts
            (11, None, "a", 0, 1),  # known, but without a price
            (None, Decimal("9.00"), "a", 0, 2),
        ],
        PRODUCTS,
    )
    found = facts.fact_orders(lines, products).collect()
    rows = sorted((r.order_id, r.product_id or 0, r.unit_price_usd, r.total_usd) for r in found if r.total_usd is not None)
    assert rows == [
        (1, 10, Decimal("2.50"), Decimal("7.50")),
        (2, 0, Decimal("0.00"), Decimal("0.00")),
        (2, 12, Decimal("0.00"), Decimal("0.00")),
    ]
    assert sum(r.unit_price_usd is None for r in found) == 1
    assert {r.date_id for r in found} == {19961231}


def test_last_per_key_orders_by_document_then_place(spark):
    rows = spark.createDataFrame(
        [(1, "b", 0, 0, "x"), (1, "a", 9, 9, "y"), (2, "a", 0, 5, "z"), (2, "a", 1, 0, "w")],
        "k int, doc string, block bigint, pos bigint, v string",
    )
    assert {r.k: r.v for r in facts.last_per_key(rows, "k").collect()} == {1: "x", 2: "w"}


def test_lookup_survives_a_hot_key_without_broadcast(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 1L, id) AS k")
        table = spark.range(20_000).selectExpr("id AS k", "cast(id as decimal(18,2)) AS v")
        found = facts.lookup(rows, table, "k", "v", F.lit(-1).cast("decimal(18,2)"))
        assert found.count() == 30_000
        assert found.where("v = 1").count() == 10_001
        expected = sum(1 for i in range(30_000) if i % 3 and i >= 20_000)
        assert found.where("v = -1").count() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
