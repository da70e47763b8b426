"""Bronze: JSON elements, one row each, per source and run date.

A row is one element of the source's list (the whole document where the source is a
single object) with its place in the feed. Elements keep their text byte for byte, whether
they come as lines or in a list document (see documents). Parquet around them keeps the
snapshot compressed and splittable, which one long document or gzip lines are not.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.functions import clean
from cartmill.session import at_once, shuffles_dropped
from cartmill.sources import documents
from cartmill.sources.lake import Lake

SCHEMA = "doc string, block bigint, pos bigint, body string"
# Later in the feed = greater in this order.
FEED_ORDER = ("doc", "block", "pos")


def read_documents(spark: SparkSession, path: str, listed: bool = True) -> DataFrame:
    """Elements of whole JSON documents: each is a list (listed) or one object.

    Lists are cut by as many tasks as their files have splits, objects are one task's work each.
    A document that is no list gives whatever can be cut from it: see unreadable.
    """
    if listed:
        return documents.cut(spark, path).elements()
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc"),
        F.lit(0).cast("bigint").alias("block"),
        F.lit(0).cast("bigint").alias("pos"),
        F.col("value").alias("body"),
    )


def unreadable(spark: SparkSession, path: str, listed: bool = True, cut: documents.Documents | None = None) -> list[str]:
    """Up to ten of the documents that are empty or not one whole list (not listed: no object).

    `cut` are the documents where they have been cut already.
    """
    if listed:
        found = (cut or documents.cut(spark, path)).unreadable()
    else:
        kind = F.schema_of_variant(F.try_parse_json("value"))
        broken = spark.read.text(path, wholetext=True).where(~F.coalesce(kind.startswith("OBJECT<"), F.lit(False)))
        found = [r["doc"] for r in broken.select(F.col("_metadata.file_path").alias("doc")).limit(10).collect()]
    # Spark reads no row from a file without a byte.
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, True)
    while files.hasNext() and len(found) < 10:
        file = files.next()
        if file.getLen() == 0 and file.getPath().getName()[0] not in "._":
            found.append(file.getPath().toString())
    return found


def broken(elements: DataFrame) -> DataFrame:
    """Elements that are not JSON, as rejects."""
    return elements.where(F.try_parse_json("body").isNull()).selectExpr(
        "array('not JSON') AS reasons", "body AS source_row"
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Elements of JSON-lines files, split by Spark; order is file, split, row in split."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("doc"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("body"),
    )
    return lines.where(F.trim("body") != "")


def land(elements: DataFrame, lake: Lake, source: str, run_date: date) -> str:
    """Store one source's elements for one run date, replacing that snapshot only."""
    path = lake.bronze(source, run_date)
    with shuffles_dropped(elements.sparkSession):
        elements.select(*FEED_ORDER, "body").write.mode("overwrite").option(
            "compression", "snappy"
        ).parquet(path)
    return path


def land_all(elements: Mapping[str, DataFrame], lake: Lake, run_date: date) -> None:
    """Store the elements of several sources, at the same time."""
    at_once(*[lambda source=source, rows=rows: land(rows, lake, source, run_date) for source, rows in elements.items()])


def scan(spark: SparkSession, lake: Lake, source: str, run_date: date) -> DataFrame:
    """One snapshot, by its own folder: no other run date is even listed."""
    return spark.read.schema(SCHEMA).parquet(lake.bronze(source, run_date))


def _parsed(elements: DataFrame) -> DataFrame:
    return elements.select(*FEED_ORDER, "body", F.try_parse_json("body").alias("v"))


def _get(path: str, kind: str = "string", v: str = "v") -> Column:
    return F.try_variant_get(v, path, kind)


def _missing(path: str, v: str = "v") -> Column:
    """True where the key is absent; an explicit null is present."""
    return F.try_variant_get(v, path, "variant").isNull()


def _text(path: str) -> Column:
    """Text with "" for an absent key (or parent); an explicit null stays null."""
    return F.when(_missing(path), F.lit("")).otherwise(_get(path))


def _whole(text: str, kind: str = "bigint") -> Column:
    """A whole number; null for anything else, as 1.9, "x" or true. 2.0 and "2" are whole."""
    # Plain digits, which nearly all are, need no decimal.
    exact = F.col(text).try_cast("decimal(38,18)")
    other = F.when(exact == F.floor(exact), exact).try_cast("bigint")
    return F.when(F.col(text).rlike("^-?[0-9]{1,18}$"), F.col(text).try_cast("bigint")).otherwise(other).try_cast(kind)


def _fault(name: str, what: str, text: str, value: str | Column) -> Column:
    """`name: not what` where something is given that isn't it."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.col(text).isNotNull() & value.isNull(), F.lit(f"{name}: not {what}"))


def _faults(*faults: Column) -> Column:
    return F.array_compact(F.array(*faults)).alias("_faults")


def _any_faults(*whole: tuple[str, str]) -> Column:
    """Faults of whole numbers, given as (name, column of the text); null where there are none,
    which nearly always is so and costs no array."""
    wrong = [F.col(text).isNotNull() & F.col(name).isNull() for name, text in whole]
    found = F.array(*[_fault(name, "a whole number", text, name) for name, text in whole])
    return F.when(reduce(Column.__or__, wrong), F.array_compact(found))


# Records are read in steps, each a projection of its own: the members' texts, the values made
# of them, what is wrong with those. A step's columns are used more than once, so Spark keeps
# the steps apart and computes each column once a row; written as one projection it would read
# a member again for every place that asks for it.


def products(elements: DataFrame) -> DataFrame:
    """A rating that is not an object gives null rate and count."""
    texts = _parsed(elements).select(
        *FEED_ORDER,
        "body",
        _get("$.id").alias("id_text"),
        _get("$.title").alias("title"),
        _get("$.category").alias("category"),
        _get("$.price").alias("price"),
        _get("$.rating.rate").alias("rating_rate"),
        _get("$.rating.count").alias("rating_count"),
    )
    values = texts.withColumns({"id": _whole("id_text"), "whole_count": _whole("rating_count")})
    return values.select(
        *FEED_ORDER,
        "id",
        "title",
        "category",
        "price",
        "rating_rate",
        "rating_count",
        _faults(
            _fault("product_id", "a whole number", "id_text", "id"),
            _fault("price_usd", "a number", "price", clean.number(F.col("price"))),
            _fault("rating_rate", "a number", "rating_rate", clean.number(F.col("rating_rate"))),
            _fault("rating_count", "a whole number", "rating_count", "whole_count"),
        ),
        F.col("body").alias("_raw"),
    )


def users(elements: DataFrame) -> DataFrame:
    texts = _parsed(elements).select(
        *FEED_ORDER,
        "body",
        _get("$.id").alias("id_text"),
        _text("$.name.firstname").alias("first_name"),
        _text("$.name.lastname").alias("last_name"),
        _text("$.email").alias("email"),
        _text("$.address.city").alias("city"),
        _text("$.address.zipcode").alias("zipcode"),
        _get("$.address.geolocation.lat").alias("lat"),
        _get("$.address.geolocation.long").alias("lon"),
        _get("$.address.country").alias("country_code"),
    )
    return texts.withColumn("id", _whole("id_text")).select(
        *FEED_ORDER,
        "id",
        "first_name",
        "last_name",
        "email",
        "city",
        "zipcode",
        "lat",
        "lon",
        "country_code",
        _faults(
            _fault("customer_id", "a whole number", "id_text", "id"),
            _fault("lat", "a number", "lat", clean.position(F.col("lat"))),
            _fault("lon", "a number", "lon", clean.position(F.col("lon"))),
        ),
        F.col("body").alias("_raw"),
    )


PLAIN_ITEMS = "array<struct<productId: bigint, quantity: int>>"
#: A cart whose numbers are all JSON whole numbers; `_unfit` has the text of one that isn't.
PLAIN_CART = f"id bigint, userId bigint, date string, products {PLAIN_ITEMS}, _unfit string"
#: JSON and nothing more lenient, as a VARIANT is read.
STRICT = {
    "columnNameOfCorruptRecord": "_unfit",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
#: How a date begins that can be no number or object, whose text a VARIANT may spell otherwise.
ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T"


def carts(elements: DataFrame) -> DataFrame:
    """One row per cart item; a cart without items, or without a readable date, is one
    row with has_item false.

    Days and order lines both come from this, so that the largest source is parsed once.
    Cart fields are read before the items are unfolded, so their cost is per cart; items
    of undated carts are emptied, not filtered, or Spark would parse each cart again for
    the filter. Plain carts are read straight into their types: an ISO date, numbers that are
    whole or absent, and no null (or, where there is one, a quantity with every item): without a
    null in its text what is null after reading was absent. All others are read as VARIANT, which tells
    an absent member from a null one and gives the text of any value. A cart that is not JSON, or has no readable date, keeps its text in
    `unreadable` and says why in `reason`; a line with a fault keeps its cart's place in the
    feed, its item and what is wrong.
    """
    typed = elements.select(*FEED_ORDER, "body", F.from_json("body", PLAIN_CART, STRICT).alias("cart"))
    iso = typed.withColumn("iso_day", F.when(F.col("cart.date").rlike(ISO_DATE), clean.iso_day(F.col("cart.date"))))
    given = F.col("cart._unfit").isNull() & F.col("iso_day").isNotNull()
    no_gap = ~F.contains("body", F.lit("null")) | ~F.exists(
        F.coalesce("cart.products", F.array()), lambda item: item.isNull() | item["quantity"].isNull()
    )
    plain = iso.withColumn("plain", F.coalesce(given & no_gap, F.lit(False)))
    parsed = plain.select(
        *FEED_ORDER,
        "body",
        "plain",
        "iso_day",
        *[F.when(F.col("plain"), F.col(f"cart.{member}")).alias(member) for member in ("id", "userId", "products")],
        F.when(~F.col("plain"), F.try_parse_json("body")).alias("v"),
    )
    texts = parsed.select(
        *FEED_ORDER,
        "body",
        "plain",
        "iso_day",
        "id",
        "userId",
        "products",
        (~F.col("plain") & F.col("v").isNull()).alias("no_json"),
        _get("$.id").alias("order_text"),
        _get("$.userId").alias("customer_text"),
        _get("$.date").alias("date_text"),
        _get("$.products", "array<variant>").alias("odd_items"),
    )
    values = texts.withColumns(
        {
            "order_id": F.when(F.col("plain"), F.col("id")).otherwise(_whole("order_text")),
            "customer_id": F.when(F.col("plain"), F.col("userId")).otherwise(_whole("customer_text")),
            "day": F.when(F.col("plain"), F.col("iso_day")).otherwise(clean.day(F.col("date_text"))),
        }
    )
    dated = F.col("day").isNotNull()
    reason = (
        F.when(F.col("no_json"), F.lit("not JSON"))
        .when(F.coalesce(F.btrim("date_text"), F.lit("")) == "", F.lit("date: missing"))
        .otherwise(F.lit("date: not a date"))
    )
    # A cart has plain items or others, and the shorter list, here the empty one, is filled up with nulls.
    items = F.arrays_zip(
        F.coalesce("products", F.array().cast(PLAIN_ITEMS)).alias("plain"),
        F.coalesce("odd_items", F.array().cast("array<variant>")).alias("odd"),
    )
    heads = values.select(
        *FEED_ORDER,
        "order_id",
        "customer_id",
        "day",
        F.when(~dated, reason).alias("reason"),
        F.when(~dated, F.col("body")).alias("unreadable"),
        _any_faults(("order_id", "order_text"), ("customer_id", "customer_text")).alias("cart_faults"),
        F.when(dated, items).alias("items"),
    )
    unfolded = heads.select("*", F.posexplode_outer("items").alias("nth", "either")).select(
        *[c for c in heads.columns if c != "items"], "nth", F.col("either.plain").alias("plain"), F.col("either.odd").alias("item")
    )
    read = unfolded.withColumns(
        {
            "product_text": _get("$.productId", v="item"),
            "quantity_text": _get("$.quantity", v="item"),
        }
    )
    is_plain = F.col("plain").isNotNull()
    whole = read.withColumns(
        {
            "product_id": F.when(is_plain, F.col("plain.productId")).otherwise(_whole("product_text")),
            "quantity": F.when(is_plain, F.coalesce("plain.quantity", F.lit(1)))
            .when(F.col("quantity_text").isNotNull(), _whole("quantity_text", "int"))
            .when(_missing("$.quantity", "item"), F.lit(1)),
        }
    )
    found = whole.withColumn("item_faults", _any_faults(("product_id", "product_text"), ("quantity", "quantity_text")))
    faulty = F.coalesce(F.col("cart_faults"), F.col("item_faults")).isNotNull()
    none = F.array().cast("array<string>")
    faults = F.concat(F.coalesce("cart_faults", none), F.coalesce("item_faults", none))
    return found.select(
        *FEED_ORDER,
        "order_id",
        "customer_id",
        "day",
        "product_id",
        "quantity",
        (is_plain | F.col("item").isNotNull()).alias("has_item"),
        F.coalesce(F.col("nth"), F.lit(0)).alias("nth"),
        "reason",
        "unreadable",
        F.when(faulty, faults).alias("_faults"),
        F.when(faulty, F.to_json("item")).alias("_raw"),
    )


def cart_days(carts: DataFrame) -> DataFrame:
    return carts.select("day")


def cart_lines(carts: DataFrame) -> DataFrame:
    return carts.where("has_item").drop("has_item", "nth", "reason", "unreadable")


def undated(carts: DataFrame) -> DataFrame:
    """Carts without a readable date, and elements that aren't JSON, as rejects."""
    return carts.where("unreadable IS NOT NULL").selectExpr(
        "array(reason) AS reasons", "unreadable AS source_row"
    )


def fx_rates(elements: DataFrame) -> DataFrame:
    """One row per currency, in document order (a VARIANT would sort the codes)."""
    doc = F.from_json("body", "base string, rates map<string,string>")
    return elements.select(F.posexplode(doc["rates"]).alias("pos", "code", "rate"))


def countries(elements: DataFrame) -> DataFrame:
    """The name may be text or an object with a common form; the currency is the first."""
    first_currency = F.map_keys(F.from_json("body", "currencies map<string,string>")["currencies"])
    return elements.select("body", F.try_parse_json("body").alias("v")).select(
        _get("$.cca2").alias("country_code"),
        F.coalesce(_get("$.name.common"), _get("$.name")).alias("country"),
        _get("$.region").alias("region"),
        _get("$.subregion").alias("subregion"),
        F.get(first_currency, F.lit(0)).alias("currency_code"),
        _get("$.latlng[0]", "decimal(9,6)").alias("lat"),
        _get("$.latlng[1]", "decimal(9,6)").alias("lon"),
        _get("$.population", "bigint").alias("population"),
    )
