import json
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from cartmill.operators import dims, facts
from cartmill.sources import bronze, tables

DAY = date(2024, 1, 5)


def elements(spark, *bodies):
    rows = [("d", 0, i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, bronze.SCHEMA)


def drop(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_documents_keep_text_and_order(spark, tmp_path):
    path = drop(tmp_path, "p.json", '[{"b":1,"a":"x  y"},\n {"id":2}, 7]')
    found = bronze.read_documents(spark, path).orderBy("pos").collect()
    assert [(r.pos, r.body) for r in found] == [(0, '{"b":1,"a":"x  y"}'), (1, '{"id":2}'), (2, "7")]
    assert found[0].doc.endswith("p.json")


def test_documents_keep_digits_quotes_and_nulls(spark, tmp_path):
    path = drop(tmp_path, "p.json", '[{"x":12345678901234567890.123456}, "t", null]')
    found = bronze.read_documents(spark, path).orderBy("pos").collect()
    assert [r.body for r in found] == ['{"x":12345678901234567890.123456}', '"t"', "null"]


def test_unreadable_documents_are_named(spark, tmp_path):
    for name, text, listed, fits in (
        ("a.json", '[{"id":1}', True, False), ("b.json", '{"a":1}', True, False), ("c.json", "[]", True, True),
        ("d.json", '{"rates":{}}', False, True), ("e.json", "[1]", False, False), ("f.json", "", True, False),
    ):
        found = bronze.unreadable(spark, drop(tmp_path, name, text), listed)
        assert (found == []) == fits, name


def test_numbers_that_are_not_whole_are_faults(spark):
    carts = bronze.carts(elements(spark, {"id": 1.9, "userId": 1, "date": "2024-01-05", "products": [
        {"productId": 2.7, "quantity": True}, {"productId": "3", "quantity": 2.0}, {"productId": 4, "quantity": 2.7}]}))
    rows = bronze.cart_lines(carts).collect()
    assert [(r.order_id, r.product_id, r.quantity) for r in rows] == [(None, None, None), (None, 3, 2), (None, 4, None)]
    assert rows[0]._faults == ["order_id: not a whole number", "product_id: not a whole number", "quantity: not a whole number"]
    assert rows[1]._faults == ["order_id: not a whole number"]


def test_lines_keep_their_text(spark, tmp_path):
    body = '{"id":1,"price":1.10, "t":"\\u00e9"}'
    assert bronze.read_lines(spark, drop(tmp_path, "p.jsonl", body + "\n")).first().body == body


def test_empty_list_gives_typed_empty_tables(spark, tmp_path):
    nothing = bronze.read_documents(spark, drop(tmp_path, "c.json", "[]"))
    product = dims.dim_product(bronze.products(nothing))
    assert dims.dim_date(bronze.cart_days(bronze.carts(nothing))).collect() == []
    assert dims.dim_customer(bronze.users(nothing)).collect() == []
    fact = facts.fact_orders(bronze.cart_lines(bronze.carts(nothing)), product)
    assert fact.collect() == [] and dict(fact.dtypes)["total_usd"] == "decimal(18,2)"


def test_lines_keep_file_order(spark, tmp_path, lake):
    path = drop(tmp_path, "p.jsonl", '{"id":1,"price":1}\n\n{"id":1,"price":2}\n')
    bronze.land(bronze.read_lines(spark, path), lake, "products", DAY)
    last = facts.last_per_key(
        dims.dim_product(bronze.products(bronze.scan(spark, lake, "products", DAY))), "product_id"
    )
    assert [r.price_usd for r in last.collect()] == [Decimal("2.00")]


def test_landing_replaces_only_its_run_date(spark, lake):
    other = date(2024, 1, 6)
    bronze.land(elements(spark, {"id": 1}), lake, "users", DAY)
    bronze.land(elements(spark, {"id": 2}), lake, "users", other)
    bronze.land(elements(spark, {"id": 3}, {"id": 4}), lake, "users", DAY)
    assert bronze.scan(spark, lake, "users", DAY).count() == 2
    assert bronze.scan(spark, lake, "users", other).count() == 1


def test_incoming_address():
    from cartmill.sources.lake import Lake

    assert Lake("/x").incoming("carts", DAY) == "/x/incoming/2024/01/05/carts.json"


def test_rating_guard(spark):
    found = bronze.products(
        elements(
            spark,
            {"id": 1, "rating": {"rate": 3.9, "count": 120}},
            {"id": 2, "rating": 5},
            {"id": 3},
            {"id": 4, "rating": None},
        )
    )
    rows = {r.product_id: (r.rating_rate, r.rating_count) for r in dims.dim_product(found).collect()}
    assert rows == {1: (Decimal("3.9"), 120), 2: (None, None), 3: (None, None), 4: (None, None)}


def test_user_defaults(spark):
    found = bronze.users(
        elements(
            spark,
            {"id": 1, "email": None, "name": {"firstname": "A"}, "address": {"city": "X", "geolocation": {"lat": "", "long": None}}},
            {"id": 2, "address": None},
            {"id": 3, "address": {"geolocation": {"lat": "abc", "long": 1.5}}},
        )
    )
    rows = {r.customer_id: r for r in dims.dim_customer(found).collect()}
    assert (rows[1].email, rows[1].first_name, rows[1].last_name, rows[1].city) == (None, "A", "", "X")
    assert (rows[1].lat, rows[1].lon) == (0, 0)
    assert (rows[2].email, rows[2].city, rows[2].zipcode, rows[2].lat) == ("", "", "", 0)
    assert (rows[3].lat, rows[3].lon) == (None, Decimal("1.5"))


def test_cart_items(spark):
    carts = bronze.carts(
        elements(
            spark,
            {"id": 1, "userId": 9, "date": "2024-01-05", "products": [
                {"productId": 1, "quantity": 2}, {"productId": 2}, {"productId": 3, "quantity": None}, {"quantity": 4.0}]},
            {"id": 2, "date": "nonsense", "products": [{"productId": 1, "quantity": 1}]},
            {"id": 3, "date": "2024-01-06", "products": []},
            {"id": 4, "date": "2024-01-07"},
            "{broken",
        )
    )
    found = bronze.cart_lines(carts)
    rows = sorted((r.order_id, r.customer_id, r.product_id or 0, r.quantity) for r in found.collect() if r.quantity)
    assert rows == [(1, 9, 0, 4), (1, 9, 1, 2), (1, 9, 2, 1)]
    assert found.where("quantity is null").count() == 1


def test_days_of_carts_without_items_count(spark):
    days = dims.dim_date(bronze.cart_days(bronze.carts(elements(spark, {"id": 1, "date": "2024-01-05"}, {"id": 2, "date": ""}, {"id": 3}))))
    assert [r.date_id for r in days.collect()] == [20240105]


def test_broken_elements_keep_their_text(spark):
    found = bronze.carts(elements(spark, {"id": 1}, "{broken"))
    kept = {r.unreadable: r.reason for r in found.where("unreadable is not null").collect()}
    assert kept == {'{"id": 1}': "date: missing", "{broken": "not JSON"}


def test_repeated_key_keeps_last_value(spark):
    assert [r.id for r in bronze.products(elements(spark, '{"id":1,"id":2}')).collect()] == [2]


def test_rates_keep_document_order_and_skip_zero(spark):
    doc = '{"base":"USD","rates":{"ZZZ":2,"AAA":0,"BBB":null,"EUR":0.9,"BAD":"x"}}'
    found = dims.dim_currency(bronze.fx_rates(elements(spark, doc))).orderBy("currency_id").collect()
    assert [(r.currency_id, r.currency_code) for r in found] == [(1, "ZZZ"), (2, "EUR"), (3, "BAD")]
    assert found[1].rate_to_usd == Decimal("1.11111111") and found[2].rate_to_usd is None


def test_countries(spark):
    found = bronze.countries(
        elements(
            spark,
            {"name": {"common": "Peru"}, "cca2": "PE", "region": "Americas", "subregion": "South America",
             "currencies": {"PEN": {"name": "sol"}, "AAA": {}}, "latlng": [-10.0, -76.0], "population": 32971846},
            {"name": "Plain", "cca2": "PL"},
        )
    ).orderBy("country_code").collect()
    assert (found[0].country, found[0].currency_code, found[0].lat, found[0].population) == (
        "Peru", "PEN", Decimal("-10"), 32971846)
    assert (found[1].country, found[1].currency_code) == ("Plain", None)


def test_a_hot_order_is_cut_into_bounded_carts(spark, tmp_path):
    """One order with most lines: no cart document may hold them all, and none is lost."""
    spark.sql(
        "SELECT cast(id as bigint) o_orderkey, 1L o_custkey, 'O' o_orderstatus, 1.0D o_totalprice, "
        "timestamp_ntz'1996-01-01' o_orderdate, 'x' o_orderpriority FROM range(50)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        "SELECT if(id % 3 = 0, id % 50, 7) l_orderkey, id % 11 l_partkey, 1L l_suppkey, 1 l_linenumber, "
        "2.0D l_quantity, 1.0D l_extendedprice, 0.0D l_discount, 0.0D l_tax, 'A' l_returnflag, "
        "'F' l_linestatus, timestamp_ntz'1996-01-02' l_shipdate FROM range(9000)"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    carts = tables.cart_elements(spark, str(tmp_path))
    sizes = carts.selectExpr("size(from_json(body, 'products array<string>').products) AS n")
    assert sizes.agg({"n": "max"}).first()[0] <= tables.ITEMS_PER_CART
    lines = bronze.cart_lines(bronze.carts(carts))
    assert lines.count() == 9000
    assert lines.where("order_id = 7").count() == 6000 + 60


def test_only_long_orders_are_cut_into_several_carts(spark, tmp_path):
    """Runs of items may not begin a new cart within an order that fits into one."""
    spark.sql(
        "SELECT cast(id as bigint) o_orderkey, 1L o_custkey, 'O' o_orderstatus, 1.0D o_totalprice, "
        "timestamp_ntz'1996-01-01' o_orderdate, 'x' o_orderpriority FROM range(300)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        "SELECT id % 299 l_orderkey, id l_partkey, 1L l_suppkey, 1 l_linenumber, "
        "2.0D l_quantity, 1.0D l_extendedprice, 0.0D l_discount, 0.0D l_tax, 'A' l_returnflag, "
        "'F' l_linestatus, timestamp_ntz'1996-01-02' l_shipdate FROM range(2093) "
        "UNION ALL SELECT 5L, id, 1L, 1, 2.0D, 1.0D, 0.0D, 0.0D, 'A', 'F', timestamp_ntz'1996-01-02' FROM range(40)"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    for most in (10, 100):
        carts = tables.cart_elements(spark, str(tmp_path), items_per_cart=most)
        found = {r["pos"]: r["carts"] for r in carts.groupBy("pos").agg(F.count("*").alias("carts")).collect()}
        assert set(found) == set(range(300)) and {k for k, n in found.items() if n > 1} == ({5} if most == 10 else set())
        sizes = carts.selectExpr("size(from_json(body, 'products array<string>').products) AS n")
        assert sizes.agg({"n": "max"}).first()[0] <= most
        assert bronze.cart_lines(bronze.carts(carts)).count() == 2133


def test_long_orders_are_found_by_runs_of_neighbours(spark, tmp_path):
    """A run of 64 keys may have more lines than the limit without any of its orders having so many."""
    def lines(keys: str) -> str:
        folder = f"{tmp_path}/{len(list(tmp_path.iterdir()))}"
        spark.sql(
            f"SELECT {keys} l_orderkey, id l_partkey, 1L l_suppkey, 1 l_linenumber, 2.0D l_quantity, 1.0D l_extendedprice, "
            "0.0D l_discount, 0.0D l_tax, 'A' l_returnflag, 'F' l_linestatus, timestamp_ntz'1996-01-02' l_shipdate FROM range(1000)"
        ).write.parquet(f"{folder}/lineitem.parquet")
        return folder

    assert tables._long_orders(spark, lines("id"), 64) is None
    assert tables._long_orders(spark, lines("id % 40"), 25) is None
    assert tables._long_orders(spark, lines("CAST(NULL AS BIGINT)"), 64) is None
    found = tables._long_orders(spark, lines("if(id % 2 = 0, -7, id % 40)"), 400)
    assert [r["l_orderkey"] for r in found.collect()] == [-7]


def test_absent_members_of_plain_carts_are_as_in_others(spark):
    """An absent quantity is 1, a null one is missing, in carts read either way: those with an ISO date straight, the others as VARIANT."""
    items = '{"productId":1},{"productId":2,"quantity":3},{"productId":4,"quantity":null},{},{"quantity":5},{"productId":null}'
    texts = [
        f'{{"id":{n},"date":"{day}","products":[{",".join(some)}]}}'
        for n, some in enumerate([items.split(",{"), *[[i] for i in items.split(",{")]])
        for some in [[i if i.startswith("{") else "{" + i for i in some]]
        for day in ("1996-01-02T00:00:00Z", "January 2, 1996")
    ]
    rows = spark.createDataFrame([("d", 0, i, t) for i, t in enumerate(texts)], bronze.SCHEMA)
    found = bronze.carts(rows).orderBy("pos", "nth").select("pos", "order_id", "day", "nth", "product_id", "quantity", "has_item", "_faults").collect()
    plain, others = ([tuple(r)[1:] for r in found if r.pos % 2 == n] for n in (0, 1))
    assert plain == others and len(plain) == 12
    assert [(r.product_id, r.quantity) for r in found if r.pos == 0] == [(1, 1), (2, 3), (4, None), (None, 1), (None, 5), (None, 1)]


def test_carts_without_quantities_are_not_parsed_twice(spark):
    rows = spark.createDataFrame([("d", 0, 0, '{"id":1,"date":"1996-01-02T00:00:00Z","products":[{"productId":1}]}')], bronze.SCHEMA)
    plan = bronze.carts(rows)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "contains(body" in plan
