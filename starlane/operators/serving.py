"""Serving queries over the marts (C17-C20)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.functions.scalars import exact_avg, exact_sum, round2, round_half_away

# Groups left out of the borough revenue report.
EXCLUDED_BOROUGHS = ("Unknown", "N/A", "EWR")

# Period labels of the rush-hour report.
MORNING_RUSH_LABEL = "Morning Rush (7-9 AM)"
EVENING_RUSH_LABEL = "Evening Rush (5-7 PM)"
OFF_PEAK_LABEL = "Off-Peak"


def revenue_by_borough(daily: DataFrame, exclude: Sequence[str] = EXCLUDED_BOROUGHS) -> DataFrame:
    """Trips and revenue per borough; the average fare is the unweighted
    mean of the daily averages, as the reference reports it."""
    b = F.col("borough")
    return (
        daily.where(b.isNotNull() & ~b.isin(*exclude))
        .groupBy("borough")
        .agg(
            F.sum("total_trips").alias("trips"),
            round2(exact_sum("total_revenue")).alias("revenue"),
            round2(exact_avg("avg_fare_amount")).alias("avg_fare"),
        )
        .orderBy(F.col("revenue").desc(), F.col("borough").asc())
    )


def revenue_by_borough_weighted(daily: DataFrame, exclude: Sequence[str] = EXCLUDED_BOROUGHS) -> DataFrame:
    """Variant with the trip-weighted average fare (total fares / trips)."""
    b = F.col("borough")
    return (
        daily.where(b.isNotNull() & ~b.isin(*exclude))
        .groupBy("borough")
        .agg(
            F.sum("total_trips").alias("trips"),
            round2(exact_sum("total_revenue")).alias("revenue"),
            round2(exact_sum("total_fare_amount") / F.sum("total_trips")).alias("avg_fare"),
        )
        .orderBy(F.col("revenue").desc(), F.col("borough").asc())
    )


def rush_vs_off_peak(
    hourly: DataFrame,
    morning: tuple[int, int] = (7, 9),
    evening: tuple[int, int] = (17, 19),
) -> DataFrame:
    h = F.col("hour_of_day")
    period = (
        F.when(h.between(*morning), MORNING_RUSH_LABEL)
        .when(h.between(*evening), EVENING_RUSH_LABEL)
        .otherwise(OFF_PEAK_LABEL)
    )
    return (
        hourly.groupBy(period.alias("period"))
        .agg(
            F.sum("total_trips").alias("trips"),
            round_half_away(exact_avg("avg_speed_mph"), 1).alias("avg_speed"),
            round2(exact_avg("avg_fare_amount")).alias("avg_fare"),
        )
        .orderBy(F.col("trips").desc(), F.col("period").asc())
    )


def _route_order():
    return [
        F.col("total_trips").desc(),
        F.col("pickup_location_id").asc_nulls_last(),
        F.col("dropoff_location_id").asc_nulls_last(),
    ]


def top_routes(zones: DataFrame, k: int = 5) -> DataFrame:
    """The k busiest routes (TakeOrderedAndProject: k rows per task, no full sort)."""
    return (
        zones.orderBy(*_route_order())
        .limit(k)
        .select(
            "pickup_zone_name",
            "dropoff_zone_name",
            "total_trips",
            round2("total_revenue").alias("revenue"),
        )
    )


def routes_matching(zones: DataFrame, pattern: str = "Airport", k: int = 5) -> DataFrame:
    """Busiest routes with ``pattern`` in either zone name (LIKE '%pattern%')."""
    hit = F.col("pickup_zone_name").contains(pattern) | F.col("dropoff_zone_name").contains(pattern)
    return (
        zones.where(hit)
        .orderBy(*_route_order())
        .limit(k)
        .select(
            "pickup_zone_name",
            "dropoff_zone_name",
            "total_trips",
            round2("avg_fare_amount").alias("avg_fare"),
            round_half_away("avg_tip_percentage", 1).alias("tip_pct"),
        )
    )
