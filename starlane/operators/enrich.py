"""Derived trip measures and the duration / speed filters (C3)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.functions.scalars import elapsed_seconds, round2, rounded_at_most

DERIVED = ["trip_duration_minutes", "tip_percentage", "avg_speed_mph", "fare_per_mile"]


@dataclass(frozen=True)
class EnrichParams:
    min_seconds: float = 60.0
    max_seconds: float = 14400.0
    max_speed_mph: float = 100.0
    min_distance_for_fare: float = 0.1
    card_payment_id: int = 1


def with_seconds(df: DataFrame) -> DataFrame:
    return df.withColumn("_seconds", elapsed_seconds("pickup_datetime", "dropoff_datetime"))


def filter_duration(df: DataFrame, p: EnrichParams = EnrichParams()) -> DataFrame:
    """Keep trips of min..max seconds inclusive, on unrounded seconds.

    Written on the raw timestamps (dropoff within [pickup + min, pickup +
    max]), which is exact to the microsecond and needs no derived column.
    """
    pu, do = F.col("pickup_datetime"), F.col("dropoff_datetime")
    lo = F.make_dt_interval(secs=F.lit(p.min_seconds))
    hi = F.make_dt_interval(secs=F.lit(p.max_seconds))
    return df.where((do >= pu + lo) & (do <= pu + hi))


def _raw_speed(p: EnrichParams) -> Column:
    secs, dist = F.col("_seconds"), F.col("trip_distance")
    return F.when((secs > F.lit(60.0)) & (dist > 0), dist / (secs / F.lit(3600.0)))


def add_measures(df: DataFrame, p: EnrichParams = EnrichParams()) -> DataFrame:
    """Duration in minutes plus three guarded ratios (NULL where undefined)."""
    secs = F.col("_seconds")
    dist, fare = F.col("trip_distance"), F.col("fare_amount")
    return df.withColumns(
        {
            "trip_duration_minutes": round2(secs / F.lit(60.0)),
            "tip_percentage": F.when(
                (F.col("payment_type_id") == p.card_payment_id) & (fare > 0),
                round2((F.col("tip_amount") / fare) * F.lit(100.0)),
            ),
            "avg_speed_mph": round2(_raw_speed(p)),
            "fare_per_mile": F.when(dist >= p.min_distance_for_fare, round2(fare / dist)),
        }
    )


def filter_speed(df: DataFrame, p: EnrichParams = EnrichParams()) -> DataFrame:
    """Drop trips faster than the cap, on the rounded speed; NULL speed is kept.

    Needs ``_seconds``. Tested as ``rounded_at_most`` on the raw speed (exact,
    speeds are positive), which keeps the pushed-down predicate small.
    """
    speed = _raw_speed(p)
    return df.where(speed.isNull() | rounded_at_most(speed, p.max_speed_mph))


def enrich(df: DataFrame, p: EnrichParams = EnrichParams()) -> DataFrame:
    """Canonical trips -> canonical + 4 derived measures, filtered."""
    out = add_measures(filter_speed(with_seconds(filter_duration(df, p)), p), p)
    return out.drop("_seconds")
