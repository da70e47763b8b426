from datetime import date
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartmill.operators import load
from cartmill.schemas import DIM_CURRENCY, DIM_CUSTOMER, DIM_PRODUCT, TABLES
from cartmill.sources import silver
from cartmill.streaming.append import append_new_files

DAY_1, DAY_2 = date(2024, 1, 5), date(2024, 1, 6)


def stage(spark, lake, table, rows, run_date=DAY_1):
    silver.write(spark.createDataFrame(rows, silver.SCHEMAS[table]), lake, table, run_date)


def line(order, product=1, date_id=19960101, customer=1, quantity=1, price="1.00"):
    price = None if price is None else Decimal(price)
    total = None if price is None or quantity is None else price * quantity
    return (order, date_id, product, customer, quantity, price, total, "d", 0, order, None, None)


def test_columns_match_by_name_in_any_case_and_order(spark):
    rows = spark.createDataFrame([("9.994", "x", "Toy", "n", "7")], "PRICE_USD string, extra string, Category string, name string, PRODUCT_ID string")
    found = load.accepted(rows, DIM_PRODUCT)
    assert found.columns == [c.name for c in DIM_PRODUCT.columns]
    assert found.schema.simpleString() == DIM_PRODUCT.schema.simpleString()
    row = found.first()
    assert (row.product_id, row.price_usd, row.category, row.rating_rate) == (7, Decimal("9.99"), "Toy", None)


@pytest.mark.parametrize(
    "values, reason",
    [
        ((None, "n", "c", "1", None), "product_id: missing"),
        ((1, "n", "c", None, None), "price_usd: missing"),
        ((1, "n", "c", "abc", None), "price_usd: not decimal(10,2)"),
        ((1, "n", "c", "123456789012", None), "price_usd: not decimal(10,2)"),
        ((1, "n" * 501, "c", "1", None), "name: longer than 500"),
        ((1, "n", "c" * 101, "1", None), "category: longer than 100"),
        ((1, "n", "c", "1", "12.5"), "rating_rate: not decimal(3,2)"),
    ],
)
def test_bad_rows_are_kept_with_their_reason(spark, values, reason):
    rows = spark.createDataFrame([values], "product_id bigint, name string, category string, price_usd string, rating_rate string")
    assert load.accepted(rows, DIM_PRODUCT).count() == 0
    bad = load.rejected(rows, DIM_PRODUCT).first()
    assert reason in bad.reasons
    assert bad.source_row.startswith("{")


def test_limits_are_inclusive_and_other_tables_check_too(spark):
    rows = spark.createDataFrame([(1, "ABC", "0.1"), (2, "ABCD", "0.1"), (3, "XYZ", "1e12")], "currency_id int, currency_code string, rate_to_usd string")
    assert [r.currency_id for r in load.accepted(rows, DIM_CURRENCY).collect()] == [1]
    people = spark.createDataFrame([(1, None, "1"), (2, "0", "0")], "customer_id bigint, lat string, lon string")
    assert [r.customer_id for r in load.accepted(people, DIM_CUSTOMER).collect()] == [2]


def test_required_column_that_is_absent_rejects_everything(spark):
    rows = spark.createDataFrame([(1,)], "product_id bigint")
    assert load.accepted(rows, DIM_PRODUCT).count() == 0
    assert "price_usd: no such column" in load.rejected(rows, DIM_PRODUCT).first().reasons


def test_dimension_is_replaced_and_last_entry_counts(spark, lake):
    def product(key, price, pos):
        return (key, "n", "c", None if price is None else Decimal(price), None, None, "d", 0, pos, None, None)

    stage(spark, lake, "dim_product", [product(1, "1", 0), product(1, "2", 1), product(2, None, 2), product(3, "4", 3)])
    assert load.load_dimension(spark, lake, "dim_product", DAY_1) == ("dim_product", 4, 2, 1, 1)
    stored = {r.product_id: r.price_usd for r in load.read_gold(spark, lake, "dim_product").collect()}
    assert stored == {1: Decimal("2.00"), 3: Decimal("4.00")}
    stage(spark, lake, "dim_product", [product(9, "9", 0)], DAY_2)
    load.load_dimension(spark, lake, "dim_product", DAY_2)
    assert [r.product_id for r in load.read_gold(spark, lake, "dim_product").collect()] == [9]
    assert load.read_rejects(spark, lake, "dim_product").where("run_date = date'2024-01-05'").count() == 1


def totals(spark, lake):
    rows = load.read_gold(spark, lake, "fact_orders").groupBy("run_date").agg(F.sum("total_usd")).collect()
    return {r[0]: r[1] for r in rows}


def test_fact_modes(spark, lake):
    stage(spark, lake, "fact_orders", [line(1), line(2, quantity=None)])
    stage(spark, lake, "fact_orders", [line(3, price="5.00"), line(4, price="6.00")], DAY_2)
    assert load.load_fact(spark, lake, DAY_1, "replace_run")[1:4] == (2, 1, 1)
    load.load_fact(spark, lake, DAY_2, "replace_run")
    load.load_fact(spark, lake, DAY_2, "replace_run")
    assert totals(spark, lake) == {DAY_1: Decimal("1.00"), DAY_2: Decimal("11.00")}
    keys = load.read_gold(spark, lake, "fact_orders").select("order_line_id")
    assert keys.count() == keys.distinct().count() == 3
    load.load_fact(spark, lake, DAY_2, "snapshot")
    assert totals(spark, lake) == {DAY_2: Decimal("11.00")}
    with pytest.raises(ValueError, match="sometimes"):
        load.load_fact(spark, lake, DAY_2, "sometimes")
    stage(spark, lake, "fact_orders", [line(3, customer=None)], DAY_2)
    assert load.load_fact(spark, lake, DAY_2, "replace_run")[1:4] == (1, 0, 1)
    assert totals(spark, lake) == {}


def test_every_file_is_loaded_once(spark, lake):
    stage(spark, lake, "fact_orders", [line(1), line(2, customer=None)])
    assert append_new_files(spark, lake) == ("fact_orders", 2, 1, 1, 0)
    assert append_new_files(spark, lake) == ("fact_orders", 0, 0, 0, 0)
    assert totals(spark, lake) == {DAY_1: Decimal("1.00")}
    stage(spark, lake, "fact_orders", [line(3, price="5.00")], DAY_2)
    append_new_files(spark, lake)
    assert totals(spark, lake) == {DAY_1: Decimal("1.00"), DAY_2: Decimal("5.00")}
    stored = load.read_gold(spark, lake, "fact_orders")
    assert {r.batch for r in stored.collect()} == {"stream-00000", "stream-00001"}
    assert stored.select("order_line_id").distinct().count() == 2
    bad = load.read_rejects(spark, lake, "fact_orders").first()
    assert bad.reasons == ["customer_id: missing"] and bad.run_date == DAY_1
    with pytest.raises(ValueError, match="add again"):
        load.load_fact(spark, lake, DAY_1, "replace_run")


def test_results_by_file_sum_up_to_the_load(spark, lake):
    stage(spark, lake, "fact_orders", [line(1), line(2, customer=None), line(3, quantity=None)])
    first = lake.silver("fact_orders", DAY_1)
    more = spark.createDataFrame([line(4), line(5)], silver.SCHEMAS["fact_orders"])
    more.coalesce(1).write.mode("append").parquet(first)
    none = spark.createDataFrame([line(6, customer=None)], silver.SCHEMAS["fact_orders"])
    none.coalesce(1).write.mode("append").parquet(first)
    result = load.load_fact(spark, lake, DAY_1, "replace_run")
    rows = load.read_file_results(spark, lake, "fact_orders").collect()
    assert tuple(sum(r[k] for r in rows) for k in ("staged", "loaded", "rejected", "superseded")) == result[1:]
    assert {r.status for r in rows if r.staged == 2 and r.loaded == 2} == {"loaded"}
    failed = [r for r in rows if r.status == "failed" and r.staged == 1 and r.first_error == "customer_id: missing"]
    assert failed and all(r.first_error_row == 0 for r in failed)
    # Loading again replaces that load's results.
    load.load_fact(spark, lake, DAY_1, "replace_run")
    assert load.read_file_results(spark, lake, "fact_orders").count() == len(rows)
    assert load.read_rejects(spark, lake, "fact_orders").where("file IS NULL OR row IS NULL").count() == 0


def test_a_batch_that_broke_off_is_loaded_with_its_own_files(spark, lake, monkeypatch):
    stage(spark, lake, "fact_orders", [line(1), line(2, customer=None)])
    whole = load.write_fact

    def breaks(*args, **kwargs):
        whole(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(load, "write_fact", breaks)
    with pytest.raises(RuntimeError):
        append_new_files(spark, lake)
    monkeypatch.setattr(load, "write_fact", whole)
    stage(spark, lake, "fact_orders", [line(3, price="5.00")], DAY_2)
    assert append_new_files(spark, lake, bytes_per_trigger=1) == ("fact_orders", 3, 2, 1, 0)
    assert totals(spark, lake) == {DAY_1: Decimal("1.00"), DAY_2: Decimal("5.00")}
    results = load.read_file_results(spark, lake, "fact_orders")
    assert results.agg(F.sum("loaded"), F.sum("rejected")).first() == (2, 1)
    assert append_new_files(spark, lake) == ("fact_orders", 0, 0, 0, 0)


def test_small_files_are_dealt_into_batches(spark, lake):
    for n in range(5):
        stage(spark, lake, "fact_orders", [line(n)], date(2024, 3, n + 1))
    assert append_new_files(spark, lake, bytes_per_trigger=2 << 20)[1:3] == (5, 5)
    assert load.read_gold(spark, lake, "fact_orders").select("batch").distinct().count() >= 3


def test_a_stream_load_writes_few_files_for_many_dates(spark, lake):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in range(6):
            stage(spark, lake, "fact_orders", [line(k, product=k % 7) for k in range(200)], date(2024, 2, n + 1))
        append_new_files(spark, lake)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = load.read_gold(spark, lake, "fact_orders").select(F.col("_metadata.file_path")).distinct().count()
    assert files <= 4 + 6


def test_run_loads_refuse_files_loaded_by_date(spark, lake):
    stage(spark, lake, "fact_orders", [line(1)])
    load.load_fact(spark, lake, DAY_1, "replace_run")
    with pytest.raises(ValueError, match="add again"):
        append_new_files(spark, lake)


def test_inserted_rows_cannot_be_added_twice(spark, lake):
    rows = spark.createDataFrame([line(1), line(2, quantity=None)], silver.SCHEMAS["fact_orders"])
    assert load.append_rows(rows, lake, "fact_orders", DAY_1, 0) == ("fact_orders", 1, 1)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        load.append_rows(rows, lake, "fact_orders", DAY_1, 0)
    assert load.read_gold(spark, lake, "fact_orders").count() == 1
    dates = spark.sql("SELECT 1 currency_id, 'EUR' currency_code, 1.1 rate_to_usd")
    for _ in range(2):
        load.append_rows(dates, lake, "dim_currency", DAY_1)
    assert load.read_gold(spark, lake, "dim_currency").count() == 2


def test_line_keys_of_different_loads_never_meet(spark, lake):
    def keys(lease):
        found = {r.k for r in spark.range(0, 1000, 1, 8).select(load.line_key(lease.first).alias("k")).collect()}
        assert lease.first <= min(found) and max(found) < lease.end
        return found

    leases = [load.lease_keys(spark, lake, tasks) for tasks in (8, 3000, 8)]
    assert len(set().union(*map(keys, leases))) == 3000
    assert [(x.end - x.first) // load.UNIT for x in leases] == [1, 3, 1]
    with pytest.raises(RuntimeError, match="beyond"):
        leases[0].check(leases[1].first)


def test_leases_taken_at_once_never_meet(spark, lake):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        leases = sorted(pool.map(lambda n: load.lease_keys(spark, lake, 1 + n % 3 * 1024), range(40)), key=lambda x: x.first)
    assert all(x.end <= y.first for x, y in zip(leases, leases[1:]))
    assert all((x.end - x.first) // load.UNIT in (1, 2, 3) for x in leases)


def test_two_loads_at_once_have_keys_of_their_own(spark, lake):
    from concurrent.futures import ThreadPoolExecutor

    days = (DAY_1, DAY_2)
    for k, day in enumerate(days):
        stage(spark, lake, "fact_orders", [line(100 * k + i) for i in range(50)], day)
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda day: load.load_fact(spark, lake, day, "replace_run"), days))
    assert [r[2] for r in results] == [50, 50]
    keys = load.read_gold(spark, lake, "fact_orders").select("order_line_id")
    assert keys.count() == keys.distinct().count() == 100


def test_keys_go_on_after_a_load_that_broke_off(spark, lake):
    stage(spark, lake, "fact_orders", [line(k) for k in range(50)])
    load.load_fact(spark, lake, DAY_1, "replace_run")
    load.lease_keys(spark, lake)  # a load that ends here
    stage(spark, lake, "fact_orders", [line(k) for k in range(50)], DAY_2)
    load.load_fact(spark, lake, DAY_2, "replace_run")
    rows = spark.createDataFrame([line(k) for k in range(50)], silver.SCHEMAS["fact_orders"])
    load.append_rows(rows, lake, "fact_orders", DAY_2, 40_000)
    keys = load.read_gold(spark, lake, "fact_orders").select("order_line_id")
    assert keys.count() == keys.distinct().count() == 150


def test_a_lake_without_units_begins_above_its_lines(spark, lake):
    import shutil

    stage(spark, lake, "fact_orders", [line(1)])
    load.load_fact(spark, lake, DAY_1, "replace_run")
    highest = load.read_gold(spark, lake, "fact_orders").first().order_line_id
    shutil.rmtree(lake.ledger)
    assert load.lease_keys(spark, lake).first > highest


def test_hot_day_and_product_is_cut_into_several_files(spark, lake):
    """A third of the lines, all alike, must not end up in one task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(12_000).selectExpr(
            "id AS order_id", "if(id % 3 = 0, 19960615, 19960101 + id % 28) AS date_id",
            "if(id % 3 = 0, 5L, id % 40) AS product_id", "1L AS customer_id", "1 AS quantity",
            "1.00 AS unit_price_usd", "1.00 AS total_usd",
        ).selectExpr("order_id", "cast(date_id as int) date_id", "product_id", "customer_id", "quantity",
                     "cast(unit_price_usd as decimal(18,2)) unit_price_usd", "cast(total_usd as decimal(18,2)) total_usd")
        silver.write(rows, lake, "fact_orders", DAY_1)
        load.load_fact(spark, lake, DAY_1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = load.read_gold(spark, lake, "fact_orders")
    assert stored.count() == stored.select("order_line_id").distinct().count() == 12_000
    sizes = stored.groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 4_500
    for r in sizes:
        pairs = pq.ParquetFile(r.f.removeprefix("file:")).read(["date_id", "product_id"]).to_pandas()
        assert pairs.equals(pairs.sort_values(["date_id", "product_id"], ignore_index=True))
    plan = stored.where("date_id = 19960615")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(date_id,19960615)" in plan


def test_catalog_tables_fill_defaults(spark, lake):
    load.create_tables(spark, lake, "_ddl")
    spark.sql(
        "INSERT INTO fact_orders_ddl BY NAME SELECT 1L order_line_id, 1L order_id, 20240101 date_id, 1L product_id, "
        "1L customer_id, 2.50 unit_price_usd, 2.50 total_usd, date'2024-01-05' run_date, 'rows-00000' batch"
    )
    row = spark.table("fact_orders_ddl").first()
    assert row.quantity == 1 and row.loaded_at is not None
    assert load.read_gold(spark, lake, "fact_orders").count() == 1
    assert "NOT NULL" in TABLES["dim_date"].create_sql("x", "/y") and "VARCHAR" in TABLES["dim_date"].create_sql("x", "/y").upper()
    for table in TABLES:
        spark.sql(f"DROP TABLE {table}_ddl")
