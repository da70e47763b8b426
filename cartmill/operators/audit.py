"""Checks of the declared keys, which Parquet tables do not enforce."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmill.schemas import TABLES, Table

Star = Mapping[str, DataFrame]


def duplicate_keys(rows: DataFrame, table: Table) -> DataFrame:
    """Values of the key and of other unique columns held by more than one row."""
    found = []
    for column in (table.key, *table.unique):
        counted = rows.where(F.col(column).isNotNull()).groupBy(column).agg(
            F.count(F.lit(1)).alias("copies")
        )
        found.append(
            counted.where("copies > 1").select(
                F.lit(table.name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.col(column).cast("string").alias("key_value"),
                "copies",
            )
        )
    return reduce(DataFrame.unionByName, found)


def nulls(rows: DataFrame, table: Table) -> DataFrame:
    """Null count of each required column the rows have, in one pass over them."""
    present = {c.lower() for c in rows.columns}
    columns = [c.name for c in table.columns if c.required and c.name in present]
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_rows").select(
        F.lit(table.name).alias("table_name"), "column_name", "null_rows"
    )


def orphans(star: Star, fact: str = "fact_orders") -> DataFrame:
    """Fact keys without a dimension row, and how many lines hold each.

    The fact is counted per key before the join, so a hot key is one row in it.
    """
    found = []
    for column, name in TABLES[fact].references.items():
        held = star[fact].where(F.col(column).isNotNull()).groupBy(column).agg(
            F.count(F.lit(1)).alias("lines")
        )
        keys = star[name].select(F.col(TABLES[name].key).alias(column))
        found.append(
            held.join(keys, column, "left_anti").select(
                F.lit(column).alias("column_name"),
                F.col(column).cast("bigint").alias("key_value"),
                "lines",
            )
        )
    return reduce(DataFrame.unionByName, found)


def row_counts(star: Star) -> DataFrame:
    counts = [
        rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, rows in star.items()
    ]
    return reduce(DataFrame.unionByName, counts)
