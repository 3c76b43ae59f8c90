"""Conformed type-1 dimensions (C8-C11)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.functions.scalars import day_of_week0, is_fixed_holiday
from starlane.sources.series import date_series, date_series_between, literal_rows

# Reference default range: 2020-01-01 up to, not including, 2026-12-31.
DEFAULT_DATE_START = date(2020, 1, 1)
DEFAULT_DATE_END_EXCLUSIVE = date(2026, 12, 31)

DIM_DATE_COLUMNS = [
    "date_key", "full_date", "year", "quarter", "month_num", "month_name", "week_of_year",
    "day_of_month", "day_of_week", "day_name", "is_weekend", "is_holiday",
]


def date_attributes(days: DataFrame, col: str = "date_day") -> DataFrame:
    d = F.col(col).cast("date")
    dow = day_of_week0(d)
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        is_fixed_holiday(d).alias("is_holiday"),
    )


def dim_date(
    spark: SparkSession,
    start: date = DEFAULT_DATE_START,
    end_exclusive: date = DEFAULT_DATE_END_EXCLUSIVE,
) -> DataFrame:
    """One row per day in [start, end_exclusive)."""
    return date_attributes(date_series(spark, start, end_exclusive))


def dim_date_spanning(df: DataFrame, ts: str | Column) -> DataFrame:
    """Date dimension over the days from min to max of a timestamp column.

    The span is one aggregate row that stays on the executors; no collect.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    span = df.agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi")).where(
        F.col("lo").isNotNull()
    )
    return date_attributes(date_series_between(span, F.col("lo"), F.col("hi")))


def dim_time(spark: SparkSession, evening_rush: tuple[int, int] = (16, 19)) -> DataFrame:
    """1,440 minutes of the day, HHMM keys. Built from one range, no cross join."""
    minutes = spark.range(0, 24 * 60)
    h = (F.col("id") / 60).cast("long")
    m = F.col("id") % 60
    return minutes.select(
        (h * 100 + m).cast("int").alias("time_key"),
        h.alias("hour"),
        m.alias("minute"),
        F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), F.lpad(m.cast("string"), 2, "0")).alias("time_string"),
        F.when(h.between(5, 11), "Morning")
        .when(h.between(12, 16), "Afternoon")
        .when(h.between(17, 20), "Evening")
        .otherwise("Night")
        .alias("time_of_day"),
        (h.between(7, 9) | h.between(*evening_rush)).alias("is_rush_hour"),
        F.when(h.between(6, 13), "Day").when(h.between(14, 21), "Evening").otherwise("Night").alias("shift"),
    )


def order_time(df: DataFrame) -> DataFrame:
    """The time dimension's serving order."""
    return df.orderBy("time_key")


# The Unknown member that NULL locations of the fact point to.
UNKNOWN_LOCATION = (0, "Unknown", "Unknown", "Unknown", True)
DIM_LOCATION_SCHEMA = "location_id int, zone_name string, borough string, service_zone string, is_unknown boolean"


def dim_with_unknown(df: DataFrame, member: tuple, schema: str) -> DataFrame:
    """UNION ALL of a dimension with one literal member row."""
    spark = df.sparkSession
    return df.unionByName(literal_rows(spark, [member], schema))


def dim_location(zones: DataFrame) -> DataFrame:
    """Staged zones + flag + the Unknown member (location 0)."""
    base = zones.select("location_id", "zone_name", "borough", "service_zone", F.lit(False).alias("is_unknown"))
    return dim_with_unknown(base, UNKNOWN_LOCATION, DIM_LOCATION_SCHEMA)


def dim_rate_code(lookup: DataFrame) -> DataFrame:
    return lookup.select("rate_code_id", "rate_code_name", "description")


def dim_payment_type(lookup: DataFrame) -> DataFrame:
    return lookup.select("payment_type_id", "payment_name", "is_cash")
