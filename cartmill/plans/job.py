"""The daily run for one logical date: land, build silver, load gold, publish reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.frames import Frames
from cartmill.operators import dims, enrich, facts, load, reports
from cartmill.schemas import SOURCES, TABLES, Table
from cartmill.session import at_once
from cartmill.sources import bronze, documents, silver, versions
from cartmill.sources.lake import Lake

COUNTRY_COLUMNS = (
    "customer_id", "country_code", "country", "region", "subregion", "currency_code"
)


def extract(elements: Mapping[str, DataFrame]) -> Frames:
    """Records of all sources from their JSON elements."""
    return Frames(
        {
            "products": lambda: bronze.products(elements["products"]),
            "users": lambda: bronze.users(elements["users"]),
            "cart_days": lambda: bronze.cart_days(bronze.carts(elements["carts"])),
            "cart_lines": lambda: bronze.cart_lines(bronze.carts(elements["carts"])),
            "fx_rates": lambda: bronze.fx_rates(elements["fx_rates"]),
            "countries": lambda: bronze.countries(elements["countries"]),
        }
    )


def silver_tables(feed: Mapping[str, DataFrame]) -> Frames:
    """The five star-schema tables and the countries, cleaned and typed."""
    return Frames(
        {
            "dim_product": lambda: dims.dim_product(feed["products"]),
            "dim_customer": lambda: dims.dim_customer(feed["users"]),
            "dim_date": lambda: dims.dim_date(feed["cart_days"]),
            "dim_currency": lambda: dims.dim_currency(feed["fx_rates"]),
            "fact_orders": lambda: priced(feed["cart_lines"], dims.dim_product(feed["products"])),
            "dim_country": lambda: feed["countries"],
        }
    )


def priced(cart_lines: DataFrame, product: DataFrame) -> DataFrame:
    """Order lines with the prices of the product entries that gold takes."""
    return facts.fact_orders(cart_lines, product, load.fits(product, TABLES["dim_product"]))


def gold(silver_table: Callable[[str], DataFrame]) -> Frames:
    """Gold rows of every table, nothing written. Columns the load assigns (line key,
    load time) are absent."""

    def builder(table: Table) -> Callable[[], DataFrame]:
        recency = silver.RECENCY.get(table.name, ())
        return lambda: load.gold_rows(silver_table(table.name), table, recency)

    return Frames({name: builder(table) for name, table in TABLES.items()})


def star(feed: Mapping[str, DataFrame]) -> Frames:
    """Gold rows straight from a feed, as one lazy plan.

    Meant for typed feeds. With JSON feeds go through silver: Spark would push the load's
    checks down into the parsing and repeat it for each of them.
    """
    return gold(silver_tables(feed).__getitem__)


DOCUMENT, LINES = "document", "lines"
#: Sources whose document is one object.
OBJECTS = ("fx_rates",)
#: Sources whose rows take far longer to parse than to move, and whose files are few.
SPREAD = ("products", "users")


def land_incoming(
    spark: SparkSession, lake: Lake, run_date: date, formats: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Land the run date's raw feeds from the drop folder.

    A feed is a document (a list, for fx_rates an object), or in `formats` lines: JSON lines,
    which many tasks can read. Documents that can't be read raise before anything is landed;
    a single bad element or line doesn't.
    """
    formats = {source: (formats or {}).get(source, DOCUMENT) for source in SOURCES}
    odd = {s: f for s, f in formats.items() if f not in (DOCUMENT, LINES)}
    if odd:
        raise ValueError(f"unknown formats: {odd}")
    incoming = {source: lake.incoming(source, run_date) for source in SOURCES}
    lists = {s: documents.cut(spark, incoming[s]) for s, f in formats.items() if f == DOCUMENT and s not in OBJECTS}
    bad = {
        source: found
        for source, form in formats.items()
        if form == DOCUMENT
        and (found := bronze.unreadable(spark, incoming[source], source not in OBJECTS, lists.get(source)))
    }
    if bad:
        raise ValueError(f"unreadable documents, nothing was landed: {bad}")
    landed = {}
    for source, form in formats.items():
        if form == LINES:
            elements = bronze.read_lines(spark, incoming[source])
        elif source in lists:
            elements = lists[source].elements()
        else:
            elements = bronze.read_documents(spark, incoming[source], listed=False)
        landed[source] = bronze.land(elements, lake, source, run_date)
    return landed


def spread(elements: DataFrame) -> DataFrame:
    """Elements dealt to all cores."""
    return elements.repartition(elements.sparkSession.sparkContext.defaultParallelism)


def build_silver(spark: SparkSession, lake: Lake, run_date: date) -> dict[str, tuple[str, int]]:
    """Build every silver table from bronze; returns {table: (path, rows)}.

    The carts are parsed once, into a table of their own that the days and the fact are
    read from; the fact is priced from the product table just written. Products and users
    are small files, which one task would parse, so they are dealt to all cores before.
    What doesn't need the carts is built while they are parsed.
    """
    elements = {source: bronze.scan(spark, lake, source, run_date) for source in SOURCES}
    elements |= {source: spread(elements[source]) for source in SPREAD}
    tables = silver_tables(extract(elements))

    def write(name: str, rows: Callable[[], DataFrame]) -> Callable[[], tuple]:
        return lambda: (name, silver.write(rows(), lake, name, run_date))

    def table(name: str) -> Callable[[], tuple]:
        return write(name, lambda: tables[name])

    def reject(source: str, bad: DataFrame) -> Callable[[], tuple]:
        return lambda: ("rejects", load.keep_rejects(bad, lake, source, run_date))

    written = at_once(
        write("carts", lambda: bronze.carts(elements["carts"])),
        *[table(name) for name in ("dim_product", "dim_customer", "dim_currency", "dim_country")],
        *[reject(source, bronze.broken(elements[source])) for source in ("products", "users", "countries", "fx_rates")],
    )
    carts, product = (silver.read(spark, lake, name, run_date) for name in ("carts", "dim_product"))
    written += at_once(
        write("fact_orders", lambda: priced(bronze.cart_lines(carts), product)),
        write("dim_date", lambda: dims.dim_date(bronze.cart_days(carts))),
        reject("carts", bronze.undated(carts)),
    )
    return {name: result for name, result in written if name != "rejects"}


def load_countries(spark: SparkSession, lake: Lake, run_date: date) -> None:
    """Refresh country, region and currency of each customer of gold."""
    customers = silver.read(spark, lake, "dim_customer", run_date)
    latest = load.gold_rows(
        customers, TABLES["dim_customer"], silver.RECENCY["dim_customer"], keep=("country_code",)
    )
    countries = silver.read(spark, lake, "dim_country", run_date)
    enriched = enrich.customer_country(latest, countries).select(*COUNTRY_COLUMNS)
    versions.replace(enriched, lake.gold("customer_country"))
    load.follow(spark, lake, "customer_country")


def define(spark: SparkSession, lake: Lake) -> DataFrame:
    """(Re)define all views; returns orders by country."""
    reports.define(spark, lake)
    customers = spark.read.schema(
        "customer_id bigint, country_code string, country string, region string, "
        "subregion string, currency_code string"
    ).parquet(versions.current(spark, lake.gold("customer_country")))
    customers.createOrReplaceTempView("customer_country")
    by_country = enrich.orders_by_country(reports.read_star(spark, lake), customers)
    by_country.createOrReplaceTempView("rpt_orders_by_country")
    return by_country


def publish(spark: SparkSession, lake: Lake, materialise: bool = False) -> list[str]:
    """All views: tables, the six reports, customer countries and orders by country; and the
    catalog's tables. Loads keep both up to date from then on."""
    names = reports.publish(spark, lake, materialise)
    by_country = define(spark, lake)
    if materialise:
        versions.replace(by_country, lake.report("rpt_orders_by_country"))
    load.create_tables(spark, lake)
    views = [*TABLES, *names, "customer_country", "rpt_orders_by_country"]
    load.follow_loads(spark, lake, views, lambda: define(spark, lake))
    return [*names, "rpt_orders_by_country"]


def run(
    spark: SparkSession,
    lake: Lake,
    run_date: date,
    elements: dict[str, DataFrame] | None = None,
    fact_mode: str = "snapshot",
    materialise: bool = False,
    formats: Mapping[str, str] | None = None,
    **stream: str,
) -> DataFrame:
    """One daily run; returns staged, loaded, rejected and superseded rows per table.

    The row `carts` counts carts: dated ones, and those turned away for want of a readable
    date. Sources come from the drop folder, in the given `formats`, or from `elements` (JSON
    elements per source). Repeating a run date replaces what it wrote at every layer, but in
    the mode append_new_files, which loads every silver file once; `stream` are its options.
    """
    if fact_mode not in load.FACT_MODES:
        raise ValueError(f"{fact_mode} is none of {load.FACT_MODES}")
    if elements is None:
        land_incoming(spark, lake, run_date, formats)
    else:
        bronze.land_all({source: elements[source] for source in SOURCES}, lake, run_date)
    build_silver(spark, lake, run_date)
    results = load.load_all(spark, lake, run_date, fact_mode, **stream)
    load_countries(spark, lake, run_date)
    publish(spark, lake, materialise)
    return cart_counts(spark, lake, run_date).unionByName(results)


def cart_counts(spark: SparkSession, lake: Lake, run_date: date) -> DataFrame:
    """How many places of the feed had carts, and how many of them a readable date."""
    carts = silver.read(spark, lake, "carts", run_date).where("nth = 0")
    places = carts.groupBy(*bronze.FEED_ORDER).agg(F.max("reason").alias("reason"))
    return places.agg(
        F.lit("carts").alias("table_name"),
        F.count("*").alias("staged"),
        F.count_if(F.col("reason").isNull()).alias("loaded"),
        F.count("reason").alias("rejected"),
        F.lit(0).cast("bigint").alias("superseded"),
    )


def ask(spark: SparkSession, sql: str, args: dict | list | None = None) -> DataFrame:
    """Parameterised SQL over the published tables and reports."""
    return spark.sql(sql, args=args)
