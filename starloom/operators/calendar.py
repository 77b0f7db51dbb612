"""The calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import calendar_attributes

# The default range of the calendar.
FIRST_DAY = dt.date(2015, 1, 1)
LAST_DAY = dt.date(2035, 12, 31)


def day_range(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    """One row per day, both ends included."""
    days = spark.range((last - first).days + 1)
    return days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))


def with_calendar(days: DataFrame, day: str = "day") -> DataFrame:
    return days.select(*[value.alias(name) for name, value in calendar_attributes(day).items()])


def dim_date(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY, existing: DataFrame | None = None
) -> DataFrame:
    """Calendar rows missing from ``existing``."""
    rows = with_calendar(day_range(spark, first, last))
    if existing is None:
        return rows
    return rows.join(existing.select("full_date"), "full_date", "left_anti").select(*rows.columns)
