"""Calendar and hour dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import date_key
from tidemark.functions.labels import day_part


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day between the ``first_day`` and ``last_day`` of a one-row frame."""
    days = F.sequence(F.col("first_day").cast("date"), F.col("last_day").cast("date"))
    return bounds.select(F.explode(days).alias("date_utc"))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``date_utc`` column (ISO weeks and week days)."""
    d = F.col("date_utc")
    iso_day = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        (iso_day >= 6).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, first: date, last: date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return calendar(date_spine(bounds))


def dim_hour(spark: SparkSession) -> DataFrame:
    hour = F.col("id").cast("int")
    return spark.range(24).select(
        hour.alias("hour_utc"),
        F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00")).alias("hour_label"),
        day_part(hour).alias("day_part"),
    )
