"""Column expressions shared by the operators. All are built-in Spark expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
RATE = "decimal(9,4)"

# What a NULL counts as when NULL and "empty" are to compare equal.
NULL_DEFAULTS = {"string": "", "number": -1, "date": "1900-01-01", "timestamp": "1900-01-01", "boolean": "false"}


def try_as(column: str | Column, type_name: str) -> Column:
    """Cast that turns an unreadable value into NULL instead of failing."""
    return _col(column).try_cast(type_name)


def default_zero(column: str | Column, type_name: str = MONEY) -> Column:
    return F.coalesce(try_as(column, type_name), F.lit(0).cast(type_name))


def date_key(column: str | Column) -> Column:
    """Date as the integer yyyyMMdd; NULL when it is no date."""
    day = try_as(column, "date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def snapshot_key(load_date: dt.date) -> Column:
    return F.lit(int(load_date.strftime("%Y%m%d")))


def changed(
    left: str, right: str, columns: Iterable[str], types: Mapping[str, str], null_as_default: bool = False
) -> str:
    """SQL condition: some column of struct ``left`` differs from struct ``right``.

    NULL equals only NULL, unless ``null_as_default`` lets it equal the type's default.
    """

    def side(struct: str, name: str) -> str:
        value = f"{struct}.`{name}`"
        return f"coalesce({value}, {null_default(types[name])})" if null_as_default else value

    tests = [f"NOT ({side(left, c)} <=> {side(right, c)})" for c in columns]
    return f"({' OR '.join(tests)})" if tests else "false"


def null_default(type_name: str) -> str:
    kind = type_name if type_name in NULL_DEFAULTS else "number"
    return f"CAST('{NULL_DEFAULTS[kind]}' AS {type_name})"


def order_discount(quantity: Column, price: Column, percent: Column) -> Column:
    """Discount amount of an order line, rounded half up to four places; NULL if it is too large."""
    share = F.coalesce(percent, F.lit(0).cast(RATE))
    return F.round(F.try_multiply(quantity * price, share) / F.lit(100), 4).try_cast(MONEY)


def pass_fail(condition: Column) -> Column:
    return F.when(condition, F.lit("PASS")).otherwise(F.lit("FAIL"))


def calendar_attributes(day: str) -> dict[str, Column]:
    """The calendar columns of one date, keyed by column name."""
    d = F.col(day)
    weekday = F.dayofweek(d)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "day_of_week": weekday,
        "day_name": F.date_format(d, "EEEE"),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "month_number": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter_number": F.quarter(d),
        "year_number": F.year(d),
        "is_weekend": weekday.isin(1, 7),
        "is_holiday": F.lit(False),
        "fiscal_year": F.lit(None).cast("int"),
        "fiscal_quarter": F.lit(None).cast("int"),
        "fiscal_period": F.lit(None).cast("int"),
    }


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def utc_text(value: dt.datetime) -> str:
    """A time as text in UTC, the zone of the sessions; one without a zone is taken as UTC, whatever the driver's zone is."""
    return (value if value.tzinfo is None else value.astimezone(dt.timezone.utc).replace(tzinfo=None)).isoformat(sep=" ")


def utc_time(value: dt.datetime) -> Column:
    """A time as a literal, whatever the driver's zone is; sessions run in UTC."""
    return F.lit(utc_text(value)).cast("timestamp")
