"""Partial results of order lines that can be added up exactly, also for distinct orders.

Counting distinct orders a day doesn't tell how many there are a week, as an order may have
lines of several days. A bitmap does: bit n of a word stands for one order, words are
joined by OR, and their bits counted. A partial result is a row a group and word (64 neighbouring
orders), with the sums of the lines behind it: all of it adds up, over days or over loads.

Each load of the fact has partial results by day in a folder of its own, which remembers the
files it was made from. Keeping reports up means making the folders that lack or have changed;
the lines of other loads aren't read. There are never more rows than pairs of group and order,
and all columns have fixed widths, so Spark adds rows up by hash, without sorting them: larger
bitmaps (4 kB for 32,768 orders) held 14 orders of a day each and had to be sorted, as did the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.operators import load, reports
from cartmill.schemas import FACT_ORDERS
from cartmill.sources.lake import Lake

#: The measures of a partial result, which add up. Cents are whole numbers, which add up much faster
#: than decimals: a row has room for 9 million lines of the largest amount that gold stores.
SUMS = "lines bigint, units bigint, cents bigint, priced bigint"
BY_DAY = f"date_id int, word bigint, orders bigint, {SUMS}, source string"
#: Part of what a folder remembers; folders in another layout are made anew.
LAYOUT = "words of 64 orders, cents"


def partial(lines: DataFrame, *groups: str) -> DataFrame:
    """A row a group and word of orders: bits and sums. Lines without an order have a null word."""
    return lines.groupBy(*groups, F.expr("shiftright(order_id, 6)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(order_id & 63 AS INT)))").alias("orders"),
        F.count("*").alias("lines"),
        F.sum("quantity").cast("bigint").alias("units"),
        F.sum((F.col("total_usd") * 100).cast("bigint")).alias("cents"),
        F.count("total_usd").alias("priced"),
    )


def count_numbers(rows: DataFrame, column: str, *also: Column) -> DataFrame:
    """One row: `also`, then lines, line_keys (the distinct whole numbers in `column`, as count_distinct finds
    them) and null_keys.

    Numbers are joined to words of 64 before they travel, so that where neighbours lie together, as line
    keys do, a sixty-fourth of the rows is shuffled and none is sorted.
    """
    words = rows.groupBy(F.expr(f"shiftright({column}, 6)").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST({column} & 63 AS INT)))").alias("bits"), F.count("*").alias("lines")
    )

    def total(of: Column) -> Column:
        return F.coalesce(F.sum(of), F.lit(0).cast("bigint"))

    return words.agg(
        *also,
        total(F.col("lines")).alias("lines"),
        total(F.bit_count("bits")).alias("line_keys"),
        total(F.when(F.col("word").isNull(), F.col("lines"))).alias("null_keys"),
    )


def merged(partials: DataFrame, *groups: str) -> DataFrame:
    """Partial results added up to coarser groups, or over loads: still one row a group and word."""
    return partials.groupBy("word", *groups).agg(
        F.bit_or("orders").alias("orders"),
        *[F.sum(c).cast(k).alias(c) for c, k in (x.rsplit(" ", 1) for x in SUMS.split(", "))],
    )


def totals(partials: DataFrame, *groups: str) -> DataFrame:
    """Results by group: total_orders, lines, units_sold, revenue_usd, avg_order_value_usd.

    Orders are those that count_distinct finds; the mean is the revenue a line that has one.
    """
    each = merged(partials, *groups)
    # A group may stand for any number of lines: whole dollars and what is left are added up apart.
    dollars, rest = F.sum(F.expr("cents div 100")), F.sum(F.expr("cents % 100"))
    revenue = (dollars.cast("decimal(20,0)") + rest.cast("decimal(20,0)") / 100).cast(reports.USD)
    return each.groupBy(*groups).agg(
        F.coalesce(F.sum(F.bit_count("orders")), F.lit(0)).alias("total_orders"),
        F.sum("lines").alias("lines"),
        F.sum("units").alias("units_sold"),
        revenue.alias("revenue_usd"),
        _mean(revenue, F.sum("priced")).alias("avg_order_value_usd"),
    )


def _mean(total: Column, n: Column) -> Column:
    """As clean.exact_mean, of a sum and a count: the sum's 22 digits leave the quotient 18 places."""
    return F.round(F.try_divide(total, n.cast("decimal(20,0)")), 2).cast("decimal(18,2)")


def _folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder of each load below a table, as run_date=…/batch=…, with a summary of its files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/run_date=*/batch=*/*.parquet")
    found: dict[str, list[str]] = {}
    for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []:
        path = status.getPath()
        folder = f"{path.getParent().getParent().getName()}/{path.getParent().getName()}"
        found.setdefault(folder, []).append(f"{path.getName()} {status.getLen()}")
    return {folder: " ".join(sorted(files)) for folder, files in found.items()}


def refresh(spark: SparkSession, lake: Lake) -> list[str]:
    """Make the partial results of loads that have none, or whose files have changed since;
    drop those of loads that are gone. Returns the folders that were read.

    File names are random, so a load that was written anew has other files. The driver sees a
    line a file, as a scan's planning does.
    """
    gold, root = lake.gold(FACT_ORDERS.name), lake.partials(FACT_ORDERS.name)
    stored, loads = _sources(spark, root), _folders(spark, gold)
    changed = sorted(f for f, files in loads.items() if stored.get(f) != _short(files))
    for folder in changed:
        lines = spark.read.schema(FACT_ORDERS.schema).parquet(f"{gold}/{folder}")
        rows = partial(lines, "date_id").withColumn("source", F.lit(_short(loads[folder])))
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{folder}")
    for folder in stored.keys() - loads.keys():
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return changed


def _short(files: str) -> str:
    import hashlib

    return hashlib.sha256(f"{LAYOUT} {files}".encode()).hexdigest()


def _sources(spark: SparkSession, root: str) -> dict[str, str]:
    """What each stored folder was made from; one row of each is looked at."""
    if not _folders(spark, root):
        return {}
    rows = read(spark, root).groupBy("run_date", "batch").agg(F.any_value("source").alias("source")).collect()
    return {f"run_date={r['run_date']}/batch={r['batch']}": r["source"] for r in rows}


def read(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{BY_DAY}, run_date date, batch string").parquet(root)


def daily_revenue(spark: SparkSession, lake: Lake) -> DataFrame:
    """The daily report, from partial results alone: equal to reports.daily_revenue after refresh."""
    days = totals(read(spark, lake.partials(FACT_ORDERS.name)), "date_id")
    return days.join(load.read_gold(spark, lake, "dim_date"), "date_id").select(
        "full_date", "year", "month_name", "weekday_name", "is_weekend", "total_orders", "units_sold", "revenue_usd", "avg_order_value_usd"
    ).orderBy("full_date")


def weekly_orders(spark: SparkSession, lake: Lake) -> DataFrame:
    """Orders and revenue by calendar year and ISO week, from partial results alone."""
    dates = load.read_gold(spark, lake, "dim_date").select("date_id", "year", F.weekofyear("full_date").alias("week_num"))
    by_week = read(spark, lake.partials(FACT_ORDERS.name)).join(dates, "date_id")
    return totals(by_week, "year", "week_num").select("year", "week_num", "total_orders", "revenue_usd")
