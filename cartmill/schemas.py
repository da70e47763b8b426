"""Gold table definitions: types, required columns, keys, defaults and layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = False
    default: str | None = None  # SQL text
    always_read: bool = False  # nullable in storage, but a null from the feed is a bad value

    @property
    def storage_type(self) -> T.DataType:
        return T.StringType() if isinstance(self.type, T.VarcharType) else self.type

    @property
    def max_length(self) -> int | None:
        return self.type.length if isinstance(self.type, T.VarcharType) else None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: str
    unique: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)  # column -> table
    assigned: tuple[str, ...] = ()  # filled while loading, never read from the feed
    partition_by: tuple[Column, ...] = ()
    cluster_by: tuple[str, ...] = ()

    @property
    def fed_columns(self) -> tuple[Column, ...]:
        return tuple(c for c in self.columns if c.name not in self.assigned)

    @property
    def schema(self) -> T.StructType:
        """Stored schema. Parquet does not enforce NOT NULL, so every field is nullable
        here; the load step and the audits do the enforcing."""
        return T.StructType(
            [T.StructField(c.name, c.storage_type) for c in (*self.columns, *self.partition_by)]
        )

    def create_sql(self, name: str, location: str) -> str:
        """CREATE TABLE for a catalog, NOT NULL and DEFAULT included."""
        lines = []
        for c in (*self.columns, *self.partition_by):
            line = f"{c.name} {c.type.simpleString()}"
            if c.required:
                line += " NOT NULL"
            if c.default:
                line += f" DEFAULT {c.default}"
            lines.append(line)
        sql = f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(lines)}) USING parquet"
        if self.partition_by:
            sql += f" PARTITIONED BY ({', '.join(c.name for c in self.partition_by)})"
        return f"{sql} LOCATION '{location}'"


def _need(name: str, kind: T.DataType, default: str | None = None) -> Column:
    return Column(name, kind, required=True, default=default)


INT, LONG, DATE, BOOL = T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType()

# Column names, text lengths and decimal sizes of the published star schema.
DIM_PRODUCT = Table(
    "dim_product",
    (
        _need("product_id", LONG),
        _need("name", T.VarcharType(500)),
        _need("category", T.VarcharType(100)),
        _need("price_usd", T.DecimalType(10, 2)),
        Column("rating_rate", T.DecimalType(3, 2)),
        Column("rating_count", INT),
    ),
    key="product_id",
)
DIM_CUSTOMER = Table(
    "dim_customer",
    (
        _need("customer_id", LONG),
        Column("first_name", T.VarcharType(100)),
        Column("last_name", T.VarcharType(100)),
        Column("email", T.VarcharType(255)),
        Column("city", T.VarcharType(100)),
        Column("zipcode", T.VarcharType(20)),
        # Empty positions are read as 0, so a null here was not a number.
        Column("lat", T.DecimalType(9, 6), always_read=True),
        Column("lon", T.DecimalType(9, 6), always_read=True),
    ),
    key="customer_id",
)
DIM_DATE = Table(
    "dim_date",
    (
        _need("date_id", INT),
        _need("full_date", DATE),
        _need("year", INT),
        _need("quarter", INT),
        _need("month", INT),
        _need("month_name", T.VarcharType(10)),
        _need("day", INT),
        _need("weekday_num", INT),
        _need("weekday_name", T.VarcharType(10)),
        _need("is_weekend", BOOL),
    ),
    key="date_id",
)
DIM_CURRENCY = Table(
    "dim_currency",
    (
        _need("currency_id", INT),
        _need("currency_code", T.VarcharType(3)),
        _need("rate_to_usd", T.DecimalType(18, 8)),
    ),
    key="currency_id",
    unique=("currency_code",),
)
FACT_ORDERS = Table(
    "fact_orders",
    (
        _need("order_line_id", LONG),
        _need("order_id", LONG),
        _need("date_id", INT),
        _need("product_id", LONG),
        _need("customer_id", LONG),
        _need("quantity", INT, default="1"),
        _need("unit_price_usd", T.DecimalType(10, 2)),
        _need("total_usd", T.DecimalType(12, 2)),
        Column("loaded_at", T.TimestampNTZType(), default="current_timestamp()"),
    ),
    key="order_line_id",
    references={
        "date_id": "dim_date",
        "product_id": "dim_product",
        "customer_id": "dim_customer",
    },
    assigned=("order_line_id", "loaded_at"),
    partition_by=(Column("run_date", DATE), Column("batch", T.StringType())),
    cluster_by=("date_id", "product_id"),
)

# Fixed order: dimensions before the fact.
LOAD_ORDER = (DIM_PRODUCT, DIM_CUSTOMER, DIM_DATE, DIM_CURRENCY, FACT_ORDERS)
TABLES = {t.name: t for t in LOAD_ORDER}
DIMENSIONS = LOAD_ORDER[:-1]

# The five JSON feeds.
SOURCES = ("products", "carts", "users", "countries", "fx_rates")
