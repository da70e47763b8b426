"""Named queries: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.frames import Frames
from cartmill.functions import clean
from cartmill.operators import audit, dims, enrich, facts, load, partials, reports
from cartmill.plans import job
from cartmill.schemas import DIM_PRODUCT, FACT_ORDERS, SOURCES
from cartmill.session import at_once, drop_folders, tune, work_folder
from cartmill.sources import bronze, documents, silver, tables, versions
from cartmill.sources.lake import Lake
from cartmill.streaming.append import append_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY_1, DAY_2 = date(2024, 1, 5), date(2024, 1, 6)


def query(function: Query) -> Query:
    def tuned(spark: SparkSession, folder: str) -> DataFrame:
        return function(tune(spark), folder)

    QUERIES[function.__name__] = tuned
    return tuned


def _star(spark: SparkSession, folder: str) -> Frames:
    return job.star(tables.feed(spark, folder))


def _lake(spark: SparkSession) -> Lake:
    return Lake(work_folder(spark))


def _built(spark: SparkSession, elements: dict[str, DataFrame], lake: Lake | None = None) -> Lake:
    """Elements landed as bronze and built into silver for DAY_1, as the daily job does it."""
    lake = lake or _lake(spark)
    bronze.land_all(elements, lake, DAY_1)
    job.build_silver(spark, lake, DAY_1)
    return lake


def _staged(spark: SparkSession, folder: str, lake: Lake | None = None) -> Lake:
    """The faulty JSON feed, built."""
    return _built(spark, tables.elements(spark, folder, faulty=True), lake)


def _faulty(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return silver.read(spark, _staged(spark, folder), table, DAY_1)


def _faulty_elements(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    lake = _lake(spark)
    bronze.land_all(tables.elements(spark, folder, faulty=True), lake, DAY_1)
    return {source: bronze.scan(spark, lake, source, DAY_1) for source in SOURCES}


def _faulty_star(spark: SparkSession, folder: str) -> Frames:
    lake = _staged(spark, folder)
    return job.gold(lambda name: silver.read(spark, lake, name, DAY_1))


def _priced_lines(spark: SparkSession, lake: Lake, run_date: date) -> DataFrame:
    """The fact of landed carts and products, by way of silver as in the daily job: Spark would
    push the load's checks down into the parsing, and parse once for each of them."""
    silver.write(bronze.carts(bronze.scan(spark, lake, "carts", run_date)), lake, "carts", run_date)
    products = bronze.products(job.spread(bronze.scan(spark, lake, "products", run_date)))
    silver.write(dims.dim_product(products), lake, "dim_product", run_date)
    lines = bronze.cart_lines(silver.read(spark, lake, "carts", run_date))
    return load.accepted(job.priced(lines, silver.read(spark, lake, "dim_product", run_date)), FACT_ORDERS)


# --- table builders ---------------------------------------------------------------


@query
def dim_product(spark, folder):
    return _star(spark, folder)["dim_product"]


@query
def dim_customer(spark, folder):
    return _star(spark, folder)["dim_customer"]


@query
def dim_date(spark, folder):
    return _star(spark, folder)["dim_date"]


@query
def dim_currency(spark, folder):
    return _star(spark, folder)["dim_currency"]


@query
def fact_orders(spark, folder):
    return _star(spark, folder)["fact_orders"]


@query
def fact_orders_dirty(spark, folder):
    """From JSON with bad dates, absent and null values, unknown and repeated products."""
    return _faulty_star(spark, folder)["fact_orders"]


@query
def dim_date_dirty(spark, folder):
    return _faulty_star(spark, folder)["dim_date"].select("date_id", "full_date")


# --- single operators -------------------------------------------------------------


@query
def lookup_join_default(spark, folder):
    lines = tables.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_partkey") % 89 == 0, -1).otherwise(F.col("l_partkey")).alias("product_id"),
    )
    product = dims.dim_product(tables.feed(spark, folder)["products"])
    prices = facts.last_per_key(product, "product_id")
    return facts.lookup(
        lines, prices, "product_id", "price_usd", F.lit(0).cast(clean.MONEY)
    ).select("order_id", "product_id", F.col("price_usd").cast("decimal(10,2)").alias("unit_price_usd"))


@query
def lookup_last_wins(spark, folder):
    records = bronze.products(tables.product_elements(spark, folder, faulty=True))
    last = facts.last_per_key(dims.dim_product(records), "product_id")
    return last.select("product_id", F.col("price_usd").cast("decimal(10,2)").alias("price_usd"))


@query
def category_normalise(spark, folder):
    records = bronze.products(tables.product_elements(spark, folder))
    return dims.dim_product(records).select("product_id", "category")


@query
def struct_guard(spark, folder):
    """Ratings that are objects, plain numbers or absent, by product."""
    rating = (
        F.when(F.col("p_size") % 5 == 0, F.lit(""))
        .when(F.col("p_size") % 7 == 0, F.concat(F.lit(',"rating":'), F.col("p_size").cast("string")))
        .otherwise(
            F.concat(
                F.lit(',"rating":{"rate":'), (F.col("p_size") / 10).cast("string"),
                F.lit(',"count":'), (F.col("p_size") * 10).cast("string"), F.lit("}"),
            )
        )
    )
    elements = tables.table(spark, folder, "part").select(
        F.lit("products").alias("doc"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("p_partkey").alias("pos"),
        F.concat(F.lit('{"id":'), F.col("p_partkey").cast("string"), rating, F.lit("}")).alias("body"),
    )
    return dims.dim_product(bronze.products(elements)).select(
        "product_id",
        F.col("rating_rate").cast("decimal(3,2)").alias("rating_rate"),
        "rating_count",
    )


@query
def nested_default(spark, folder):
    users = dims.dim_customer(bronze.users(tables.user_elements(spark, folder, faulty=True)))
    return users.select("customer_id", "first_name", "last_name", "email", "city", "zipcode")


@query
def numeric_default(spark, folder):
    users = dims.dim_customer(bronze.users(tables.user_elements(spark, folder, faulty=True)))
    return users.select("customer_id", "lat", "lon")


@query
def date_parse_lenient(spark, folder):
    carts = bronze.carts(_faulty_elements(spark, folder)["carts"])
    return carts.select("order_id", "day").distinct()


@query
def date_key(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    day = F.col("l_shipdate").cast("date")
    return lines.groupBy(day.alias("full_date")).agg(F.count(F.lit(1)).alias("lines")).select(
        "full_date", clean.date_key(F.col("full_date")).alias("date_id"), "lines"
    )


@query
def calendar_parts(spark, folder):
    days = tables.table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    return dims.dim_date(days)


@query
def map_explode_rates(spark, folder):
    return bronze.fx_rates(tables.fx_document(spark, folder)).select(
        "pos", "code", F.col("rate").cast("decimal(9,2)").alias("rate")
    )


@query
def reciprocal_rate(spark, folder):
    rates = dims.dim_currency(bronze.fx_rates(tables.fx_document(spark, folder)))
    return rates.select(
        "currency_id", "currency_code", F.col("rate_to_usd").cast("decimal(18,8)").alias("rate_to_usd")
    )


@query
def array_explode_items(spark, folder):
    lines = bronze.cart_lines(bronze.carts(_faulty_elements(spark, folder)["carts"]))
    return lines.select("order_id", "customer_id", "day", "product_id", "quantity")


# --- layers and loads -------------------------------------------------------------


@query
def bronze_roundtrip(spark, folder):
    """Land two different snapshots, then build the fact from the second."""
    lake = _lake(spark)
    for run_date, faulty in ((DAY_1, True), (DAY_2, False)):
        bronze.land(tables.product_elements(spark, folder, faulty), lake, "products", run_date)
        bronze.land(tables.cart_elements(spark, folder, faulty), lake, "carts", run_date)
    return _priced_lines(spark, lake, DAY_2)


@query
def bronze_lines_roundtrip(spark, folder):
    """JSON lines dropped, landed in file order, last product entry wins."""
    lake = _lake(spark)
    dropped = lake.incoming("products", DAY_1)
    elements = tables.product_elements(spark, folder, faulty=True)
    elements.sort("pos").select("body").write.text(dropped)
    bronze.land(bronze.read_lines(spark, dropped), lake, "products", DAY_1)
    product = dims.dim_product(bronze.products(bronze.scan(spark, lake, "products", DAY_1)))
    return load.gold_rows(product, DIM_PRODUCT, bronze.FEED_ORDER)


@query
def bronze_documents_roundtrip(spark, folder):
    """Carts and products dropped as list documents of up to 2,000 places, then the fact."""
    lake = _lake(spark)
    given = {"products": tables.product_elements(spark, folder), "carts": tables.cart_elements(spark, folder)}
    for source, elements in given.items():
        dropped = lake.incoming(source, DAY_1)
        listed = elements.groupBy(F.expr("pos div 2000").alias("part")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "body"))).alias("e")
        )
        text = F.concat(F.lit("[\n"), F.array_join(F.transform("e", lambda e: e["body"]), ",\n"), F.lit("]"))
        listed.select("part", text.alias("value")).repartition("part").write.partitionBy("part").text(dropped)
        cut = documents.cut(spark, dropped)
        if bronze.unreadable(spark, dropped, cut=cut):
            raise ValueError(f"{source}: documents came back unreadable")
        bronze.land(cut.elements(), lake, source, DAY_1)
    return _priced_lines(spark, lake, DAY_1)


#: The beginning of an element with brackets, quotes and escapes in a string, nested, oddly spaced.
ODD_TEXT = r'''{ "a":[1.10, {"b":"]}, \\\" [{"}],''' + "\t" + '"id":'


@query
def bronze_document_bytes(spark, folder):
    """List documents of up to 5,000 orders, read in ranges of 64 kB that cut them anywhere:
    every element's bytes."""
    dropped = _lake(spark).incoming("carts", DAY_1)
    order = tables.table(spark, folder, "orders")
    body = F.concat(F.lit(ODD_TEXT), F.col("o_orderkey").cast("string"), F.lit(" }"))
    gap = F.when(F.col("o_orderkey") % 3 == 0, F.lit(" \n")).otherwise(F.lit(""))
    listed = order.groupBy(F.expr("o_orderkey div 5000").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", F.concat(gap, body).alias("body")))).alias("e")
    )
    text = F.concat(F.lit("[\r\n"), F.array_join(F.transform("e", lambda e: e["body"]), "\t,"), F.lit("\n]"))
    listed.select("part", text.alias("value")).repartition("part").write.partitionBy("part").text(dropped)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    try:
        cut = documents.cut(spark, dropped)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    if bronze.unreadable(spark, dropped, cut=cut):
        raise ValueError("documents came back unreadable")
    return cut.elements().select(
        F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"), F.octet_length("body").cast("bigint").alias("bytes")
    )


@query
def bronze_unreadable(spark, folder):
    """Elements cut short in four feeds are kept, by source."""
    cut = F.when(F.col("pos") % 97 == 0, F.lit('{"id":')).otherwise(F.col("body"))
    whole = tables.elements(spark, folder)
    lake = _built(spark, {s: e if s == "fx_rates" else e.withColumn("body", cut) for s, e in whole.items()})
    kept = [
        load.read_rejects(spark, lake, source).where("reasons[0] = 'not JSON'").agg(
            F.lit(source).alias("source"), F.count("*").alias("rows")
        )
        for source in SOURCES
    ]
    return reduce(DataFrame.unionByName, kept)


@query
def silver_roundtrip(spark, folder):
    lake = _lake(spark)
    silver.write(dims.dim_product(tables.feed(spark, folder)["products"]), lake, "dim_product", DAY_1)
    stored = silver.read(spark, lake, "dim_product", DAY_1)
    return load.accepted(stored, DIM_PRODUCT)


@query
def load_by_name(spark, folder):
    """Columns in another order and case, as text, with one too many."""
    part = tables.table(spark, folder, "part").select(
        F.col("p_retailprice").cast("string").alias("PRICE_USD"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("Category"),
        F.col("p_name").alias("NAME"),
        F.col("p_partkey").cast("string").alias("Product_Id"),
        (F.col("p_size") * 10).cast("string").alias("RATING_COUNT"),
    )
    return load.accepted(part, DIM_PRODUCT)


@query
def load_rejects(spark, folder):
    """Every reason for turning order lines away, with its rows."""
    reasons = load.rejected(_faulty(spark, folder, "fact_orders"), FACT_ORDERS).select(F.explode("reasons").alias("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def reject_values(spark, folder):
    """Products and lines whose numbers aren't what they should be: every reason, and the
    values as they came."""

    def place(table: DataFrame, doc: str) -> list[Column]:
        return [F.lit(doc).alias("doc"), F.lit(0).cast("bigint").alias("block"), F.monotonically_increasing_id().alias("pos")]

    part = tables.table(spark, folder, "part")
    products = part.select(
        *place(part, "products"),
        F.format_string(
            '{"id":%s,"title":"t","category":"c","price":%s,"rating":{"rate":%s,"count":%s}}',
            F.concat(F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 83 == 0, ".5").otherwise("")),
            F.when(F.col("p_partkey") % 59 == 0, '"n/a"').otherwise("1.10"),
            F.when(F.col("p_partkey") % 67 == 0, '"good"').otherwise("4.5"),
            F.when(F.col("p_partkey") % 71 == 0, '"12.7"').otherwise("12"),
        ).alias("body"),
    )
    line = tables.table(spark, folder, "lineitem")
    carts = line.select(
        *place(line, "carts"),
        F.format_string(
            '{"id":%d,"userId":1,"date":"2024-01-05","products":[{"productId":%s,"quantity":%s}]}',
            "l_orderkey",
            F.concat(F.col("l_partkey").cast("string"), F.when(F.col("l_partkey") % 83 == 0, ".5").otherwise("")),
            F.when(F.col("l_partkey") % 59 == 0, "2.7").when(F.col("l_partkey") % 67 == 0, "true").otherwise("2"),
        ).alias("body"),
    )
    # By way of silver, as in the daily job, so that the load's checks aren't pushed into the parsing.
    lake = _lake(spark)
    silver.write(dims.dim_product(bronze.products(job.spread(products))), lake, "dim_product", DAY_1)
    silver.write(bronze.carts(carts), lake, "carts", DAY_1)
    price = F.lit(1).cast(clean.MONEY)
    lines = bronze.cart_lines(silver.read(spark, lake, "carts", DAY_1)).select(
        "*", clean.date_key(F.col("day")).alias("date_id"), price.alias("unit_price_usd"), price.alias("total_usd")
    )
    entries = silver.read(spark, lake, "dim_product", DAY_1)
    bad = load.rejected(entries, DIM_PRODUCT).select(F.lit("products").alias("source"), "*")
    bad = bad.unionByName(load.rejected(lines, FACT_ORDERS).select(F.lit("lines").alias("source"), "*"))
    raw = F.get_json_object("source_row", "$._raw")
    return bad.groupBy(
        "source",
        F.array_join("reasons", ", ").alias("reasons"),
        F.nullif(F.regexp_extract(raw, '"price":"?([^",]*)', 1), F.lit("")).alias("price"),
        F.nullif(F.regexp_extract(raw, '"quantity":"?([^",}]*)', 1), F.lit("")).alias("quantity"),
    ).agg(F.count("*").alias("rows"))


@query
def load_summary(spark, folder):
    return job.run(spark, _lake(spark), DAY_1, _faulty_elements(spark, folder))


@query
def full_refresh_twice(spark, folder):
    """A second refresh leaves nothing of the first."""
    lake = _lake(spark)
    for run_date, faulty in ((DAY_1, True), (DAY_2, False)):
        records = bronze.products(tables.product_elements(spark, folder, faulty))
        silver.write(dims.dim_product(records), lake, "dim_product", run_date)
        load.load_dimension(spark, lake, "dim_product", run_date)
    return load.read_gold(spark, lake, "dim_product")


@query
def refresh_seen_by_readers(spark, folder):
    """A dimension replaced while it is read: what readers see that began before, between
    writing the new rows and their becoming the table, and after."""
    lake = _lake(spark)
    for run_date, faulty in ((DAY_1, True), (DAY_2, False)):
        records = bronze.products(tables.product_elements(spark, folder, faulty))
        silver.write(dims.dim_product(records), lake, "dim_product", run_date)
    load.load_dimension(spark, lake, "dim_product", DAY_1)
    began = load.read_gold(spark, lake, "dim_product")
    # A load that broke off: all its files are there, but not its marker.
    fresh = versions.replace(load.read_gold(spark, lake, "dim_product").limit(0), f"{lake.root}/other")
    spark.read.parquet(fresh).write.parquet(f"{lake.gold('dim_product')}/v000000009-00000000")
    between = load.read_gold(spark, lake, "dim_product").agg(F.count("*").alias("products")).collect()[0][0]
    load.load_dimension(spark, lake, "dim_product", DAY_2)
    seen = {"began before": began, "after": load.read_gold(spark, lake, "dim_product")}
    rows = [r.agg(F.lit(k).alias("reader"), F.count("*").alias("products")) for k, r in seen.items()]
    rows.append(spark.createDataFrame([("between", between)], "reader string, products bigint"))
    return reduce(DataFrame.unionByName, rows)


def _stage_two_days(
    spark: SparkSession, folder: str, lake: Lake, days: tuple[date, ...] = (DAY_1, DAY_2), faulty: DataFrame | None = None
) -> None:
    """Silver facts of two run dates: faulty lines (given, where they are built already; else built in this
    very lake), then clean ones."""

    def first() -> None:
        if faulty is None:
            _staged(spark, folder, lake)
        else:
            silver.write(faulty, lake, "fact_orders", DAY_1)

    def second() -> None:
        feed = tables.feed(spark, folder)
        silver.write(facts.fact_orders(feed["cart_lines"], dims.dim_product(feed["products"])), lake, "fact_orders", DAY_2)

    steps = {DAY_1: first, DAY_2: second}
    at_once(*[steps[day] for day in days if day])


def _per_run(spark: SparkSession, lake: Lake) -> DataFrame:
    return load.read_gold(spark, lake, "fact_orders").groupBy("run_date").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("total_usd").cast(reports.USD).alias("revenue_usd")
    )


@query
def fact_replace_run(spark, folder):
    """Two run dates add up; running the first again replaces only its own rows."""
    lake = _lake(spark)
    _stage_two_days(spark, folder, lake)
    for run_date in (DAY_1, DAY_2, DAY_1):
        load.load_fact(spark, lake, run_date, "replace_run")
    return _per_run(spark, lake)


@query
def fact_replace_run_empty(spark, folder):
    """A rerun that turns every line away leaves nothing of that date, and the other date."""
    lake, faulty = _lake(spark), _faulty(spark, folder, "fact_orders")
    _stage_two_days(spark, folder, lake, faulty=faulty)
    for run_date in (DAY_1, DAY_2):
        load.load_fact(spark, lake, run_date, "replace_run")
    bad = faulty.withColumn("customer_id", F.lit(None).cast("bigint"))
    silver.write(bad, lake, "fact_orders", DAY_1)
    load.load_fact(spark, lake, DAY_1, "replace_run")
    return _per_run(spark, lake)


@query
def views_after_reload(spark, folder):
    """Views and the catalog's table, published over the first load, show the second."""
    lake = _lake(spark)
    _stage_two_days(spark, folder, lake)
    for name, rows in _star(spark, folder).items():
        if name != "fact_orders":
            rows.write.parquet(lake.gold(name))
    load.load_fact(spark, lake, DAY_1)
    reports.publish(spark, lake)
    load.create_tables(spark, lake)
    load.load_fact(spark, lake, DAY_2, "replace_run")
    lines = "count(*) AS lines, sum(quantity) AS units"
    return job.ask(
        spark,
        f"""SELECT 'view' AS shown, {lines} FROM fact_orders
            UNION ALL SELECT 'catalog', {lines} FROM spark_catalog.`{spark.catalog.currentDatabase()}`.fact_orders
            UNION ALL SELECT 'report', sum(units_sold), sum(units_sold) FROM rpt_daily_revenue""",
    )


@query
def fact_snapshot(spark, folder):
    """Each run date's full extract replaces the fact."""
    lake = _lake(spark)
    _stage_two_days(spark, folder, lake)
    for run_date in (DAY_1, DAY_2):
        load.load_fact(spark, lake, run_date, "snapshot")
    return _per_run(spark, lake)


@query
def fact_append_files_once(spark, folder):
    """Three calls, files arriving before the first and the second: every file is loaded by one call only."""
    lake = _lake(spark)
    for day in (DAY_1, DAY_2):
        _stage_two_days(spark, folder, lake, (day,))
        append_new_files(spark, lake)
    append_new_files(spark, lake)
    return _per_run(spark, lake)


@query
def fact_append_late_files(spark, folder):
    """Files of the second day, then those of the first, which are 500 days older than all
    others by then; then nothing. What each call loaded, and what is there in the end."""
    lake = _lake(spark)
    calls = []
    for day in (DAY_2, DAY_1, None):
        _stage_two_days(spark, folder, lake, (day,))
        if day == DAY_1:
            _age(spark, lake.silver("fact_orders", DAY_1), days=500)
        calls.append((f"call {len(calls) + 1}", *append_new_files(spark, lake)[1:4]))
    called = spark.createDataFrame(calls, "what string, staged bigint, loaded bigint, rejected bigint")
    stored = load.read_gold(spark, lake, "fact_orders").groupBy("run_date").agg(F.count("*").alias("lines"))
    return called.unionByName(
        stored.select(
            F.concat(F.lit("stored "), F.col("run_date").cast("string")).alias("what"),
            F.lit(None).cast("bigint").alias("staged"),
            F.col("lines").alias("loaded"),
            F.lit(None).cast("bigint").alias("rejected"),
        )
    )


def _age(spark: SparkSession, folder: str, days: int) -> None:
    """Make a folder's files older by so many days."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(at):
        system.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@query
def distinct_orders_merged(spark, folder):
    """Orders by day and category as bitmaps, added up to days, weeks and categories."""
    star = _star(spark, folder)
    lines = star["fact_orders"].join(star["dim_product"].select("product_id", "category"), "product_id")
    each = partials.partial(lines, "date_id", "category")
    # Weeks are added up from days, of which there are far fewer rows.
    by_day = partials.merged(each, "date_id").join(
        star["dim_date"].select("date_id", "year", F.weekofyear("full_date").alias("week_num")), "date_id"
    )
    labels = {
        "day": (by_day, F.col("date_id").cast("string")),
        "week": (by_day, F.format_string("%d-%02d", "year", "week_num")),
        "category": (each, F.col("category")),
    }
    found = [
        partials.totals(rows.withColumn("label", label), "label").select(
            F.lit(kind).alias("kind"), "label", "total_orders", "lines", "units_sold", "revenue_usd"
        )
        for kind, (rows, label) in labels.items()
    ]
    return reduce(DataFrame.unionByName, found)


def _two_loads(spark: SparkSession, folder: str) -> tuple[Lake, list[list[str]]]:
    """Two loads and the first one again, each followed by a refresh: which folders those read."""
    lake = _lake(spark)
    at_once(
        lambda: _stage_two_days(spark, folder, lake),
        lambda: _star(spark, folder)["dim_date"].write.parquet(lake.gold("dim_date")),
    )
    refreshed = []
    for run_date in (DAY_1, DAY_2, DAY_1):
        load.load_fact(spark, lake, run_date, "replace_run")
        refreshed.append(partials.refresh(spark, lake))
    return lake, refreshed


@query
def rpt_daily_incremental(spark, folder):
    """The daily report kept up load by load."""
    return partials.daily_revenue(spark, _two_loads(spark, folder)[0])


@query
def weekly_orders_incremental(spark, folder):
    """Weeks whose orders come from two loads, which repeat orders of each other."""
    lake, refreshed = _two_loads(spark, folder)
    if [len(folders) for folders in refreshed] != [1, 1, 1] or partials.refresh(spark, lake):
        raise ValueError(f"a refresh read more than its load: {refreshed}")
    return partials.weekly_orders(spark, lake)


@query
def load_file_results(spark, folder):
    """Silver of lines in four files and of products in two: what became of each file's rows."""
    lake, source = _lake(spark), _staged(spark, folder)
    parts = (("fact_orders", "order_id", 4, ("order_id", "product_id", "quantity")), ("dim_product", "product_id", 2, ("product_id", *bronze.FEED_ORDER)))
    for name, key, files, order in parts:
        rows = silver.read(spark, source, name, DAY_1).withColumn("part", F.col(key) % files)
        rows.repartition("part").sortWithinPartitions("part", *order).write.partitionBy("part").parquet(lake.silver(name, DAY_1))
    load.load_dimension(spark, lake, "dim_product", DAY_1)
    load.load_fact(spark, lake, DAY_1)
    found = [load.read_file_results(spark, lake, name).withColumn("table_name", F.lit(name)) for name, *_ in parts]
    return reduce(DataFrame.unionByName, found).select(
        "table_name",
        F.regexp_extract("file", "part=([0-9]+)", 1).cast("int").alias("part"),
        "status", "staged", "loaded", "rejected", "superseded", "first_error", "first_error_row",
    )


@query
def fact_insert_rows(spark, folder):
    """Two inserts of DataFrame rows."""
    lake = _lake(spark)
    star = _star(spark, folder)
    for number in (0, 1):
        load.append_rows(star["fact_orders"], lake, "fact_orders", DAY_1, number)
    stored = load.read_gold(spark, lake, "fact_orders")
    return stored.groupBy("batch").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("order_line_id").alias("line_keys"),
        F.sum("total_usd").cast(reports.USD).alias("revenue_usd"),
    )


@query
def fact_defaults(spark, folder):
    """Rows inserted by name without quantity and load time get the declared defaults."""
    lake = _lake(spark)
    suffix = "_" + lake.root.rsplit("/", 1)[-1]
    load.create_tables(spark, lake, suffix)
    lines = _star(spark, folder)["fact_orders"].drop("quantity")
    lines.withColumns(
        {
            "order_line_id": F.monotonically_increasing_id(),
            "run_date": F.lit(DAY_1),
            "batch": F.lit("rows-00000"),
        }
    ).createOrReplaceTempView(f"lines{suffix}")
    spark.sql(f"INSERT INTO fact_orders{suffix} BY NAME SELECT * FROM lines{suffix}")
    return spark.table(f"fact_orders{suffix}").groupBy("date_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        F.count("loaded_at").alias("stamped"),
    )


def _loaded_fact(spark: SparkSession, folder: str) -> DataFrame:
    lake = _lake(spark)
    feed = tables.feed(spark, folder)
    fact = facts.fact_orders(feed["cart_lines"], dims.dim_product(feed["products"]))
    silver.write(fact, lake, "fact_orders", DAY_1)
    load.load_fact(spark, lake, DAY_1)
    return load.read_gold(spark, lake, "fact_orders")


@query
def line_key_unique(spark, folder):
    """Keys of two run dates, one of them loaded again, and an insert; then of a stream."""
    by_run, by_file, built = _lake(spark), _lake(spark), _staged(spark, folder)
    faulty = silver.read(spark, built, "fact_orders", DAY_1)

    def counted(lake: Lake, how: str) -> DataFrame:
        gold = load.read_gold(spark, lake, "fact_orders")
        return partials.count_numbers(gold, "order_line_id", F.lit(how).alias("loaded_by"))

    # Tables go when the last step that reads them is done: there would be a dozen copies of the lines else.
    drop_folders(spark, built.bronze_root, built.silver_root("carts"))
    _stage_two_days(spark, folder, by_run, faulty=faulty)
    for run_date in (DAY_1, DAY_2, DAY_1):
        load.load_fact(spark, by_run, run_date, "replace_run")
    drop_folders(spark, by_run.silver_root("fact_orders"))
    load.append_rows(_star(spark, folder)["fact_orders"], by_run, "fact_orders", DAY_2)
    run = counted(by_run, "run")
    run = spark.createDataFrame(run.collect(), run.schema)
    drop_folders(spark, by_run.root)
    _stage_two_days(spark, folder, by_file, faulty=faulty)
    drop_folders(spark, built.root)
    append_new_files(spark, by_file)
    return run.unionByName(counted(by_file, "file"))


@query
def load_timestamp(spark, folder):
    """Rows stamped with a time within this very load."""
    begin = datetime.now(timezone.utc).replace(tzinfo=None)
    fact = _loaded_fact(spark, folder)
    end = datetime.now(timezone.utc).replace(tzinfo=None)
    return fact.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("loaded_at").between(_ntz(begin), _ntz(end))).alias("stamped_lines"),
    )


def _ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


@query
def fact_clustered_scan(spark, folder):
    return _loaded_fact(spark, folder).groupBy("date_id", "product_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("total_usd").cast(reports.USD).alias("revenue_usd")
    )


@query
def fact_sample(spark, folder):
    """Five rows to look at: the first by all their columns."""
    fact = _star(spark, folder)["fact_orders"]
    return fact.orderBy(*fact.columns).limit(5)


@query
def param_sql(spark, folder):
    name = "product_" + _lake(spark).root.rsplit("/", 1)[-1]
    _star(spark, folder)["dim_product"].createOrReplaceTempView(name)
    return job.ask(
        spark,
        f"""SELECT category, price_usd >= :floor AS is_dear, count(*) AS products
            FROM {name} GROUP BY category, price_usd >= :floor""",
        {"floor": 950},
    )


# --- reports ----------------------------------------------------------------------


def _report(name: str, report: Callable[[reports.Star], DataFrame]) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return report(_star(spark, folder))

    def faulty(spark: SparkSession, folder: str) -> DataFrame:
        return report(_faulty_star(spark, folder))

    run.__name__, faulty.__name__ = name, f"{name}_dirty"
    query(run)
    if name != "rpt_daily_revenue":  # daily_run has it
        query(faulty)


for _name, _function in reports.REPORTS.items():
    _report(_name, _function)


@query
def top_products_ties(spark, folder):
    """Every line worth 1, so that products tie around the tenth rank."""
    star = _star(spark, folder)
    worth_one = star["fact_orders"].withColumn("total_usd", F.lit(1).cast("decimal(12,2)"))
    ranked = reports.top_products(star.replaced("fact_orders", worth_one))
    return ranked.select("product_id", "revenue_usd", "revenue_rank")


@query
def rolling_four_rows(spark, folder):
    """All orders, with days pulled 14 times further apart so that weeks are missing."""
    feed = tables.feed(spark, folder)
    first = F.lit(date(1995, 1, 1))

    def apart(rows: DataFrame) -> DataFrame:
        return rows.withColumn("day", F.date_add(first, F.datediff("day", first) * 14))

    for name in ("cart_days", "cart_lines"):
        feed = feed.replaced(name, apart(feed[name]))
    return reports.weekly_revenue(job.star(feed))


# --- audits -----------------------------------------------------------------------


@query
def audit_duplicate_keys(spark, folder):
    return audit.duplicate_keys(_faulty(spark, folder, "dim_product"), DIM_PRODUCT)


@query
def audit_nulls(spark, folder):
    return audit.nulls(_faulty(spark, folder, "fact_orders"), FACT_ORDERS)


@query
def audit_orphans(spark, folder):
    return audit.orphans(_faulty_star(spark, folder))


@query
def audit_row_counts(spark, folder):
    return audit.row_counts(_faulty_star(spark, folder))


# --- country and currency ---------------------------------------------------------


def _countries(spark: SparkSession, folder: str) -> DataFrame:
    feed = tables.feed(spark, folder)
    return enrich.customer_country(
        dims.dim_customer(feed["users"]), bronze.countries(tables.country_elements(spark, folder))
    )


@query
def customer_country(spark, folder):
    return _countries(spark, folder).select(
        "customer_id", "country_code", "country", "region", "currency_code"
    )


@query
def revenue_in_currency(spark, folder):
    """Revenue per customer currency, in USD, converted, and converted back."""
    star = _star(spark, folder)
    customers = _countries(spark, folder).select("customer_id", "currency_code")
    revenue = (
        star["fact_orders"].join(customers, "customer_id")
        .groupBy("currency_code")
        .agg(F.sum("total_usd").cast(reports.USD).alias("revenue_usd"))
    )
    local = enrich.from_usd(revenue, star["dim_currency"], "revenue_usd", "currency_code", "revenue_local")
    return enrich.to_usd(local, star["dim_currency"], "revenue_local", "currency_code", "back_in_usd")


@query
def rpt_orders_by_country(spark, folder):
    return enrich.orders_by_country(_star(spark, folder), _countries(spark, folder))


@query
def rpt_orders_by_country_dirty(spark, folder):
    """By the job's own route: customers of gold, over the faulty feed."""
    lake = _staged(spark, folder)
    load.load_all(spark, lake, DAY_1)
    job.load_countries(spark, lake, DAY_1)
    job.publish(spark, lake)
    return spark.table("rpt_orders_by_country")


# --- the whole job ----------------------------------------------------------------


@query
def daily_run(spark, folder):
    """Two daily runs and a repeat over the faulty feed, then the published view."""
    lake = _lake(spark)
    elements = _faulty_elements(spark, folder)
    for run_date in (DAY_1, DAY_2, DAY_2):
        job.run(spark, lake, run_date, elements)
    return spark.table("rpt_daily_revenue")
