"""Feeds made from relational order tables.

Two routes to the same feeds: extracted records straight from the columns, and JSON
elements as an API would send them. The JSON route can also carry the faults a real
feed has (`faulty=True`), so that every lenient rule is met at full table size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.frames import Frames
from cartmill.sources.bronze import FEED_ORDER

# Default of cart_elements: items of one cart document.
ITEMS_PER_CART = 1000

# Types of the input tables, so that opening them reads no file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _place(doc: str, pos: Column) -> list[Column]:
    return [
        F.lit(doc).alias("doc"),
        F.lit(0).cast("bigint").alias("block"),
        pos.cast("bigint").alias("pos"),
    ]


def _currency(key: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(key.cast("string"), 2, "0"))


def _country(key: Column) -> Column:
    return F.lpad(key.cast("string"), 2, "0")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    key = F.col("c_custkey").cast("string")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        *_place("users", F.col("c_custkey")),
        F.col("c_custkey").alias("id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower("c_mktsegment"), key, F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("city"),
        F.when(F.length(key) < 5, F.lpad(key, 5, "0")).otherwise(key).alias("zipcode"),
        (F.col("n_nationkey") * F.lit(2.5).cast("decimal(3,1)") - 30).cast("string").alias("lat"),
        (F.col("n_nationkey") * 7 - 84).cast("string").alias("lon"),
        _country(F.col("c_nationkey")).alias("country_code"),
    )


def feed(spark: SparkSession, folder: str) -> Frames:
    """Extracted records straight from the columns, without a JSON detour: values that
    are typed already stay so."""

    def products() -> DataFrame:
        return table(spark, folder, "part").select(
            *_place("products", F.col("p_partkey")),
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("title"),
            F.concat(F.lit("  "), "p_type", F.lit(" ")).alias("category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
            (F.col("p_size") / 10).cast("decimal(3,2)").alias("rating_rate"),
            (F.col("p_size") * 10).alias("rating_count"),
        )

    def carts(*keys: str) -> DataFrame:
        day = F.col("o_orderdate").cast("date").alias("day")
        return table(spark, folder, "orders").select(*keys, day)

    def cart_lines() -> DataFrame:
        items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        lines = items.join(
            carts("o_orderkey", "o_custkey").where("day is not null"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        return lines.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            "day",
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
        )

    def fx_rates() -> DataFrame:
        return table(spark, folder, "nation").select(
            F.col("n_nationkey").alias("pos"),
            _currency(F.col("n_nationkey")).alias("code"),
            (F.col("n_nationkey") / 10).cast("string").alias("rate"),
        )

    def countries() -> DataFrame:
        nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
            _country(F.col("n_nationkey")).alias("country_code"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.lit(None).cast("string").alias("subregion"),
            _currency(F.col("n_nationkey")).alias("currency_code"),
            F.lit(None).cast("decimal(9,6)").alias("lat"),
            F.lit(None).cast("decimal(9,6)").alias("lon"),
            F.lit(None).cast("bigint").alias("population"),
        )

    return Frames(
        {
            "products": products,
            "users": lambda: _customers(spark, folder),
            "cart_days": carts,
            "cart_lines": cart_lines,
            "fx_rates": fx_rates,
            "countries": countries,
        }
    )


def _member(name: str, value: Column) -> Column:
    """`,"name":value` with value already JSON text; nothing where it is null."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f',"{name}":'), value))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def product_elements(spark: SparkSession, folder: str, faulty: bool = False) -> DataFrame:
    """Faults: a null price, and a second entry with another price further on."""
    part = table(spark, folder, "part")
    plain = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    price = F.when(_every("p_partkey", 61), F.lit("null")).otherwise(plain) if faulty else plain

    def element(price: Column) -> Column:
        fields = F.struct(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("title"),
            F.concat(F.lit("\t  "), "p_type", F.lit(" \n")).alias("category"),
            F.struct(
                (F.col("p_size") / 10).alias("rate"), (F.col("p_size") * 10).alias("count")
            ).alias("rating"),
        )
        text = F.to_json(fields)
        return F.concat(F.substr(text, F.lit(1), F.length(text) - 1), _member("price", price), F.lit("}"))

    first = part.select(*_place("products", F.col("p_partkey") * 2), element(price).alias("body"))
    if not faulty:
        return first
    dearer = (F.col("p_retailprice").cast("decimal(10,2)") + 1).cast("string")
    second = part.where(_every("p_partkey", 50)).select(
        *_place("products", F.col("p_partkey") * 2 + 1), element(dearer).alias("body")
    )
    return first.unionAll(second)


# Neighbouring orders that are counted together first.
_NEIGHBOURS = 6  # bits of the key


def _long_orders(spark: SparkSession, folder: str, limit: int) -> DataFrame | None:
    """Keys of the orders with more lines than the limit; None where there are none.

    Runs of 64 keys are counted first, which are far fewer than orders: where no run has more lines
    than the limit, no order has. Orders are counted in the other runs only.
    """
    keys = table(spark, folder, "lineitem").select("l_orderkey").where("l_orderkey IS NOT NULL")

    def many(rows: DataFrame, key: Column, name: str) -> DataFrame:
        counted = rows.groupBy(key.alias(name)).agg(F.count("*").alias("lines"))
        return counted.where(F.col("lines") > limit).select(name)

    run = F.shiftright("l_orderkey", _NEIGHBOURS)
    runs = many(keys, run, "run")
    if runs.isEmpty():
        return None
    long = many(keys.withColumn("run", run).join(runs, "run", "left_semi"), F.col("l_orderkey"), "l_orderkey")
    return None if long.isEmpty() else long


def cart_elements(
    spark: SparkSession, folder: str, faulty: bool = False, items_per_cart: int = ITEMS_PER_CART
) -> DataFrame:
    """Carts with their items nested: one per order, with or without items.

    Only an order of more than items_per_cart lines comes as several carts with one id, none of
    them longer, and no line is lost: its lines are dealt to carts by range and row, so that one
    order never is one task's or one row's. Whether there are such orders is counted first.
    """
    orders = table(spark, folder, "orders")

    quantity = F.col("l_quantity").cast("int").cast("string")
    product = F.col("l_partkey").cast("string")
    user = F.col("o_custkey").cast("string")
    day = F.col("o_orderdate").cast("date").cast("string")
    clean_date = F.concat(day, F.lit("T00:00:00.000Z"))
    date = _quoted(clean_date)
    if faulty:
        quantity = (
            F.when(_every("l_partkey", 83), F.lit(None))
            .when(_every("l_partkey", 73), F.lit("null"))
            .otherwise(quantity)
        )
        product = F.when(_every("l_partkey", 89), F.lit("-1")).otherwise(product)
        user = F.when(~_every("o_orderkey", 79), user)
        date = (
            F.when(_every("o_orderkey", 97), F.lit('"not-a-date"'))
            .when(_every("o_orderkey", 101), F.lit('""'))
            .when(_every("o_orderkey", 103), F.lit(None))
            .when(_every("o_orderkey", 107), _quoted(F.concat(day, F.lit("T01:00:00+05:00"))))
            .otherwise(date)
        )

    row = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    item = F.concat(F.lit('{"productId":'), product, _member("quantity", quantity), F.lit("}"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", row.alias("row"), item.alias("item"))

    def nested(lines: DataFrame, *keys: str) -> DataFrame:
        items = F.sort_array(F.collect_list(F.struct("row", "item")))
        return lines.groupBy("l_orderkey", *keys).agg(items.alias("items"))

    def element(*members: Column) -> list[Column]:
        head = F.concat(F.lit('{"id":'), F.col("o_orderkey").cast("string"))
        body = F.concat(head, _member("userId", user), _member("date", date), *members, F.lit("}"))
        return [*_place("carts", F.col("o_orderkey")), body.alias("body")]

    texts = F.array_join(F.transform("items", lambda x: x["item"]), ",")
    products = F.when(F.col("items").isNotNull(), F.concat(F.lit("["), texts, F.lit("]")))
    same = F.col("o_orderkey") == F.col("l_orderkey")
    long = _long_orders(spark, folder, items_per_cart)
    if long is None:
        return orders.join(nested(lines), same, "left").select(*element(_member("products", products)))
    rest = orders.join(long, same, "left_anti").join(nested(lines.join(long, "l_orderkey", "left_anti")), same, "left")
    # An inner join, whose hot orders Spark can split on either side.
    ranged = lines.join(long, "l_orderkey", "left_semi").repartitionByRange("l_orderkey", "row")
    runs = ranged.sortWithinPartitions("l_orderkey", "row").withColumn(
        "run", F.expr(f"monotonically_increasing_id() div {items_per_cart}")
    )
    cut = orders.join(nested(runs, "run"), same)
    return rest.select(*element(_member("products", products))).unionAll(cut.select(*element(_member("products", products))))


def user_elements(spark: SparkSession, folder: str, faulty: bool = False) -> DataFrame:
    """Faults: absent keys and parents, explicit nulls, empty and non-numeric positions."""

    def given(column: str) -> Column:
        return _quoted(F.col(column))

    last, email, lat = given("last_name"), given("email"), given("lat")
    if faulty:
        last = F.when(~_every("id", 11), last)
        email = F.when(_every("id", 7), F.lit("null")).otherwise(email)
        lat = (
            F.when(_every("id", 13), F.lit('""'))
            .when(_every("id", 17), F.lit("null"))
            .when(_every("id", 19), F.lit(None))
            .when(_every("id", 23), F.lit('"abc"'))
            .otherwise(lat)
        )
    # In steps, as a member's text is asked for twice: whether it is null, and for itself.
    members = _customers(spark, folder).withColumns({"last": last, "email_text": email, "lat_text": lat})
    name = F.concat(F.lit('{"firstname":'), given("first_name"), _member("lastname", F.col("last")), F.lit("}"))
    place = F.concat(F.lit('{"long":'), given("lon"), _member("lat", F.col("lat_text")), F.lit("}"))
    address = F.concat(
        F.lit('{"city":'),
        given("city"),
        _member("zipcode", given("zipcode")),
        _member("country", given("country_code")),
        _member("geolocation", F.col("place")),
        F.lit("}"),
    )
    if faulty:
        address = F.when(_every("id", 5), F.lit(None)).when(_every("id", 29), F.lit("null")).otherwise(address)
    nested = members.withColumns({"name": name, "place": place}).withColumn("address", address)
    return nested.select(
        *FEED_ORDER,
        F.concat(
            F.lit('{"id":'),
            F.col("id").cast("string"),
            _member("email", F.col("email_text")),
            _member("name", F.col("name")),
            _member("address", F.col("address")),
            F.lit("}"),
        ).alias("body"),
    )


def fx_document(spark: SparkSession, folder: str) -> DataFrame:
    """One object with all rates; its size is the number of currencies."""
    nation = table(spark, folder, "nation")
    entry = F.struct(
        F.col("n_nationkey").alias("pos"),
        F.concat(
            _quoted(_currency(F.col("n_nationkey"))), F.lit(":"), (F.col("n_nationkey") / 10).cast("string")
        ).alias("text"),
    )
    entries = nation.agg(F.sort_array(F.collect_list(entry)).alias("e"))
    rates = F.concat_ws(",", F.transform("e", lambda x: x["text"]))
    return entries.select(
        *_place("fx_rates", F.lit(0)),
        F.concat(F.lit('{"base":"USD","rates":{'), rates, F.lit("}}")).alias("body"),
    )


def country_elements(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    key = F.col("n_nationkey")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        *_place("countries", key),
        F.to_json(
            F.struct(
                F.struct(F.col("n_name").alias("common")).alias("name"),
                _country(key).alias("cca2"),
                F.col("r_name").alias("region"),
                F.create_map(_currency(key), F.struct(F.col("n_name").alias("name"))).alias("currencies"),
            )
        ).alias("body"),
    )


def elements(spark: SparkSession, folder: str, faulty: bool = False) -> dict[str, DataFrame]:
    """JSON elements of every source."""
    return {
        "products": product_elements(spark, folder, faulty),
        "carts": cart_elements(spark, folder, faulty),
        "users": user_elements(spark, folder, faulty),
        "countries": country_elements(spark, folder),
        "fx_rates": fx_document(spark, folder),
    }
