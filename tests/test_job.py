import json
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

from cartmill.operators import load, reports
from cartmill.plans import job
from cartmill.schemas import TABLES
from cartmill.sources import bronze

DAY_1, DAY_2 = date(2024, 1, 5), date(2024, 1, 6)

PRODUCTS = [
    {"id": 1, "title": "Shirt", "price": 22.3, "category": " Men's Clothing ", "rating": {"rate": 4.1, "count": 259}},
    {"id": 2, "title": "Ring", "price": "695", "category": "jewelery", "rating": 5},
    {"id": 3, "title": "Broken", "price": "n/a", "category": "jewelery"},
]
CARTS = [
    {"id": 1, "userId": 1, "date": "2020-03-02T00:00:00.000Z", "products": [{"productId": 1, "quantity": 4}, {"productId": 2}]},
    {"id": 2, "userId": 2, "date": "2020-03-09T00:00:00.000Z", "products": [{"productId": 77, "quantity": 1}, {"productId": 3, "quantity": 1}]},
    {"id": 3, "date": "2020-03-10", "products": [{"productId": 1, "quantity": 1}]},
    {"id": 4, "userId": 2, "date": "?", "products": [{"productId": 1, "quantity": 1}]},
]
USERS = [
    {"id": 1, "email": "a@example.com", "name": {"firstname": "Ann", "lastname": "Lee"},
     "address": {"city": "Lima", "zipcode": "1", "country": "PE", "geolocation": {"lat": "-12.05", "long": "-77.04"}}},
    {"id": 2, "email": "b@example.com", "name": {"firstname": "Bo"}, "address": {"city": "Oslo"}},
]
COUNTRIES = [{"name": {"common": "Peru"}, "cca2": "PE", "region": "Americas", "currencies": {"PEN": {}}}]
RATES = {"base": "USD", "rates": {"PEN": 3.75, "EUR": 0.9, "XXX": 0}}


def drop(lake, run_date, carts=CARTS):
    documents = {"products": PRODUCTS, "carts": carts, "users": USERS, "countries": COUNTRIES, "fx_rates": RATES}
    for source, document in documents.items():
        path = Path(lake.incoming(source, run_date))
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(document, indent=1))


def facts(spark, lake):
    rows = load.read_gold(spark, lake, "fact_orders").drop("loaded_at").collect()
    return sorted(tuple(r) for r in rows)


def test_a_day_from_the_drop_folder(spark, lake):
    drop(lake, DAY_1)
    results = {r.table_name: tuple(r)[1:] for r in job.run(spark, lake, DAY_1, materialise=True).collect()}
    assert results == {
        "carts": (4, 3, 1, 0),
        "dim_product": (3, 2, 1, 0),
        "dim_customer": (2, 2, 0, 0),
        "dim_date": (3, 3, 0, 0),
        "dim_currency": (2, 2, 0, 0),
        "fact_orders": (5, 3, 2, 0),  # no price, no customer
    }
    by_day = job.ask(spark, "SELECT * FROM rpt_daily_revenue WHERE full_date = :day", {"day": date(2020, 3, 2)})
    row = by_day.first()
    assert (row.total_orders, row.units_sold, row.revenue_usd) == (1, 5, Decimal("784.20"))
    assert spark.sql("SELECT count(*) FROM rpt_revenue_by_category").first()[0] == 2
    country = spark.table("rpt_orders_by_country").orderBy("total_orders").collect()
    assert {(r.country, r.region, r.revenue_usd) for r in country} == {
        ("Peru", "Americas", Decimal("784.20")), (None, None, Decimal("0.00"))}
    assert reports.read_report(spark, lake, "rpt_weekly_revenue").count() == 2

    rejected = load.read_rejects(spark, lake, "dim_product").first()
    assert rejected.reasons == ["price_usd: not a number"] and '"n/a"' in json.loads(rejected.source_row)["_raw"]
    undated = load.read_rejects(spark, lake, "carts").first()
    assert undated.reasons == ["date: not a date"] and json.loads(undated.source_row)["id"] == 4

    before = without_keys(spark, lake)
    job.run(spark, lake, DAY_1)
    assert without_keys(spark, lake) == before
    assert spark.table("fact_orders").count() == 3
    catalog = spark.table(f"spark_catalog.{spark.catalog.currentDatabase()}.fact_orders")
    assert catalog.count() == load.read_gold(spark, lake, "fact_orders").count() == 3
    totals = [sum(r.revenue_usd for r in spark.table(n).collect()) for n in ("rpt_orders_by_city", "rpt_orders_by_country")]
    assert totals[0] == totals[1]


@pytest.mark.parametrize("source", ["carts", "products", "fx_rates"])
def test_a_truncated_document_leaves_gold_as_it_was(spark, lake, source):
    drop(lake, DAY_1)
    job.run(spark, lake, DAY_1)
    before = {t: load.read_gold(spark, lake, t).collect() for t in TABLES}
    path = Path(lake.incoming(source, DAY_1))
    path.write_text(path.read_text()[:-20])
    with pytest.raises(ValueError, match="unreadable documents"):
        job.run(spark, lake, DAY_1)
    assert {t: load.read_gold(spark, lake, t).collect() for t in TABLES} == before


def test_a_day_from_lines(spark, lake):
    drop(lake, DAY_1)
    lines = {"carts": CARTS, "products": PRODUCTS}
    for source, rows in lines.items():
        Path(lake.incoming(source, DAY_1)).write_text("\n".join(json.dumps(r) for r in rows))
    job.run(spark, lake, DAY_1, formats=dict.fromkeys(lines, "lines"))
    assert spark.table("fact_orders").count() == 3
    with pytest.raises(ValueError, match="unknown formats"):
        job.land_incoming(spark, lake, DAY_1, {"carts": "xml"})


def test_lines_are_landed_by_several_tasks(spark, lake, tmp_path):
    bodies = [json.dumps({"id": k, "price": "1.10", "pad": "x" * 200}) for k in range(2000)]
    path = tmp_path / "p.json"
    path.write_text("\n".join(bodies))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        bronze.land(bronze.read_lines(spark, str(path)), lake, "products", DAY_1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    landed = bronze.scan(spark, lake, "products", DAY_1)
    assert sorted(r.body for r in landed.collect()) == sorted(bodies)
    assert len(list(Path(lake.bronze("products", DAY_1)).glob("part-*"))) > 1


def test_files_once_and_unknown_modes_through_the_job(spark, lake):
    drop(lake, DAY_1)
    with pytest.raises(ValueError, match="sometimes"):
        job.run(spark, lake, DAY_1, fact_mode="sometimes")
    assert not Path(lake.root, "gold").exists()
    results = {r.table_name: r.loaded for r in job.run(spark, lake, DAY_1, fact_mode="append_new_files").collect()}
    assert results["fact_orders"] == 3 and spark.table("fact_orders").count() == 3


def test_the_last_entry_that_fits_counts_everywhere(spark, lake):
    drop(lake, DAY_1)
    later = [*PRODUCTS, {"id": 1, "title": "Shirt", "price": None, "category": "c"}]
    Path(lake.incoming("products", DAY_1)).write_text(json.dumps(later))
    job.run(spark, lake, DAY_1)
    prices = {r.product_id: r.price_usd for r in load.read_gold(spark, lake, "dim_product").collect()}
    assert prices[1] == Decimal("22.30")
    assert {r.unit_price_usd for r in spark.table("fact_orders").where("product_id = 1").collect()} == {Decimal("22.30")}


def without_keys(spark, lake):
    return sorted(row[1:] for row in facts(spark, lake))


def test_days_in_both_modes(spark, lake):
    drop(lake, DAY_1)
    drop(lake, DAY_2, carts=CARTS[:1])
    for mode, expected in (("replace_run", {DAY_1: 3, DAY_2: 2}), ("snapshot", {DAY_2: 2})):
        for run_date in (DAY_1, DAY_2):
            job.run(spark, lake, run_date, fact_mode=mode)
        rows = load.read_gold(spark, lake, "fact_orders").groupBy("run_date").count().collect()
        assert {r.run_date: r["count"] for r in rows} == expected


def test_elements_that_are_not_json_are_kept(spark, lake):
    drop(lake, DAY_1)
    job.land_incoming(spark, lake, DAY_1)
    broken = spark.createDataFrame([("d", 0, 0, "{broken"), ("d", 0, 1, json.dumps(CARTS[0]))], bronze.SCHEMA)
    bronze.land(broken, lake, "carts", DAY_1)
    assert job.build_silver(spark, lake, DAY_1)["fact_orders"][1] == 2
    bad = load.read_rejects(spark, lake, "carts").first()
    assert (bad.reasons, bad.source_row, bad.run_date) == (["not JSON"], "{broken", DAY_1)


def test_silver_returns_path_and_rows(spark, lake):
    drop(lake, DAY_1)
    job.land_incoming(spark, lake, DAY_1)
    written = job.build_silver(spark, lake, DAY_1)
    assert written["fact_orders"] == (lake.silver("fact_orders", DAY_1), 5)
    assert written["dim_product"][1] == 3 and set(written) >= {"dim_date", "dim_customer", "dim_currency"}
