"""Cleaning rules as Column expressions; none of them raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Our choice of day formats read besides ISO 8601, in the order they are tried: month first
# as in US dates, then day first where that is the only reading.
OTHER_DAY_FORMATS = (
    "yyyyMMdd",
    "yyyy-M-d",
    "yyyy/M/d",
    "yyyy.M.d",
    "M/d/yyyy",
    "d/M/yyyy",
    "MMM d, yyyy",
    "MMM d yyyy",
    "MMMM d, yyyy",
    "MMMM d yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "d-MMM-yyyy",
)
# A weekday before the day, and a time of day after it with or without a zone.
WEEKDAY = r"^(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+"
TIME = (
    r"(?:[T\s]\s*(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?\s*(?i:am|pm)?|T(?:[01]\d|2[0-3])[0-5]\d(?:[0-5]\d)?)"
    r"\s*(?i:z|gmt|utc|[+-]\d{2}:?\d{2})?$"
)
WHITESPACE = " \t\n\r\f\v"
MONEY = "decimal(18,2)"  # fits a long, so arithmetic stays in fixed-width rows


def strip(text: Column) -> Column:
    """Cut every kind of whitespace from both ends; SQL trim cuts only blanks."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def label(text: Column) -> Column:
    """Stripped and lower-cased, for values used as group labels."""
    return F.lower(strip(text))


def number(value: Column) -> Column:
    """Text or number as an exact decimal; null where it is not a number."""
    return value.try_cast("decimal(38,18)")


def money(value: Column) -> Column:
    """Rounded half up to cents."""
    return F.round(number(value), 2).try_cast(MONEY)


def position(value: Column) -> Column:
    """A latitude or longitude: 0 where null or empty, null where not a number."""
    return F.when(value.isNull() | (value == ""), F.lit(0)).otherwise(number(value)).cast(
        "decimal(38,18)"
    )


def day(text: Column) -> Column:
    """The calendar day of a date text, as written.

    An offset does not move the day: 01:00 at +05:00 stays on its own day, although the
    instant is the day before in UTC. Null for whatever is not a whole, valid date.
    """
    text = F.btrim(text, F.lit(WHITESPACE))
    # Every format has digits; a text without any is spared thirteen attempts, which are slow to fail.
    return F.coalesce(iso_day(text), F.when(text.rlike("[0-9]"), _other_day(text)))


def iso_day(text: Column) -> Column:
    """The calendar day of a trimmed ISO 8601 text, as written; null for other ways to write it."""
    return F.when(F.try_to_timestamp(text).isNotNull(), F.substring(text, 1, 10).try_cast("date"))


def _other_day(text: Column) -> Column:
    """The day in the first of the other formats that fits.

    They are tried within lambdas, which Spark evaluates as they are: written out, thirteen formats
    make the generated method of the whole stage larger than the JVM compiles (8,000 bytes).
    """

    def bare(text: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(text, WEEKDAY, ""), TIME, "")

    def first(text: Column) -> Column:
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in OTHER_DAY_FORMATS])

    return F.get(F.transform(F.transform(F.array(text), bare), first), F.lit(0))


def date_key(date: Column) -> Column:
    """Day as the integer YYYYMMDD."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def calendar(date: str) -> list[str]:
    """Calendar attributes of a date column as SQL; weeks start on Monday, which is 0."""
    return [
        f"year({date}) * 10000 + month({date}) * 100 + day({date}) AS date_id",
        f"{date} AS full_date",
        f"year({date}) AS year",
        f"quarter({date}) AS quarter",
        f"month({date}) AS month",
        f"date_format({date}, 'MMMM') AS month_name",
        f"day({date}) AS day",
        f"weekday({date}) AS weekday_num",
        f"date_format({date}, 'EEEE') AS weekday_name",
        f"weekday({date}) IN (5, 6) AS is_weekend",
    ]


def reciprocal(rate: Column) -> Column:
    """1 / rate; null where the rate is null, zero or not a number."""
    return F.try_divide(F.lit(1).cast("decimal(1,0)"), number(rate))


def exact_mean(value: Column) -> Column:
    """Mean of a decimal column to cents, half up, nulls skipped.

    avg() rounds to six places first, which can push a value over a half-cent tie; the
    18 places kept here cannot below 10^15 rows.
    """
    mean = F.try_divide(F.sum(value), F.count(value).cast("decimal(20,0)"))
    return F.round(mean, 2).cast(MONEY)
