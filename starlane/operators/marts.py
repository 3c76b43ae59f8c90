"""Aggregated marts over the trip fact (C13-C15) and events (A6 on events).

Measures are exact: the parts of ``exact_parts`` summed as longs plus non-null
counts, so results do not depend on partitioning or addition order, and a hot
borough or route is absorbed by the map-side partial aggregate.

Dimensions carry no broadcast hint: Spark broadcasts them by their size in
bytes, known from the files or, under AQE, from the shuffle. Where to join the
dimensions depends on cardinality. The daily and hourly
marts group by borough (few) rather than zone (many), so every fact row
probes the small dimension and the partial aggregate is as small
as the final result. The zone-pair mart's dimension attributes are 1:1
with the fact's two integer ids, so it aggregates the fact on those ids
first (int keys in the shuffle) and joins names to the partials only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.functions.scalars import SUM_PARTS, day_of_week0, exact_avg, exact_parts, exact_sum, hour_of_key, round2, time_key, total_of


# A mart measure: (output name, "sum" | "avg", fact column).
Measure = tuple[str, str, str]


def _partials(fact: DataFrame, keys: list, measures: list[Measure]) -> DataFrame:
    """Phase 1, on the fact: group by integer keys into mergeable exact
    partials (trip count, passenger sum, parts of the sum and non-null count
    per measured column). Map-side partial aggregation makes this one
    shuffle of group partials; no dimension is touched yet."""
    cols = sorted({c for _, _, c in measures})
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum("passenger_count").cast("long").alias("_pax")]
    for c in cols:
        aggs += [part.alias(f"_{name}_{c}") for name, part in exact_parts(c).items()]
        aggs.append(F.count(c).alias(f"_c_{c}"))
    return fact.groupBy(*keys).agg(*aggs)


def _merge(partials: DataFrame, keys: list, measures: list[Measure]) -> DataFrame:
    """Merge partials that share a final key (e.g. all unmatched zones)."""
    cols = sorted({c for _, _, c in measures})
    return partials.groupBy(*keys).agg(
        F.sum("_n").alias("_n"),
        F.sum("_pax").alias("_pax"),
        *[F.sum(f"_{part}_{c}").alias(f"_{part}_{c}") for c in cols for part in (*SUM_PARTS, "c")],
    )


def _output(merged: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """Final columns from one row of sums per key: rounded sums and averages."""
    cols = sorted({c for _, _, c in measures})
    # Sums first, as columns: rounding names its operand several times.
    totals = [total_of(**{part: F.col(f"_{part}_{c}") for part in SUM_PARTS}).alias(f"_sum_{c}") for c in cols]
    sums = merged.select(*keys, "_n", "_pax", *[f"_c_{c}" for c in cols], *totals)
    out = []
    for name, kind, c in measures:
        n, total = F.col(f"_c_{c}"), F.col(f"_sum_{c}")
        out.append(round2(total if kind == "sum" else F.when(n > 0, total / n)).alias(name))
    return sums.select(*keys, F.col("_n").alias("total_trips"), F.col("_pax").alias("total_passengers"), *out)


DAILY_MEASURES: list[Measure] = [
    ("total_distance_miles", "sum", "trip_distance"),
    ("avg_distance_miles", "avg", "trip_distance"),
    ("total_duration_minutes", "sum", "trip_duration_minutes"),
    ("avg_duration_minutes", "avg", "trip_duration_minutes"),
    ("total_fare_amount", "sum", "fare_amount"),
    ("total_tip_amount", "sum", "tip_amount"),
    ("total_revenue", "sum", "total_amount"),
    ("avg_fare_amount", "avg", "fare_amount"),
    ("avg_tip_amount", "avg", "tip_amount"),
    ("avg_tip_percentage", "avg", "tip_percentage"),
    ("avg_speed_mph", "avg", "avg_speed_mph"),
    ("avg_fare_per_mile", "avg", "fare_per_mile"),
]

HOURLY_MEASURES: list[Measure] = [
    ("total_revenue", "sum", "total_amount"),
    ("avg_fare_amount", "avg", "fare_amount"),
    ("avg_distance_miles", "avg", "trip_distance"),
    ("avg_duration_minutes", "avg", "trip_duration_minutes"),
    ("avg_speed_mph", "avg", "avg_speed_mph"),
]

ZONE_MEASURES: list[Measure] = [
    ("total_distance_miles", "sum", "trip_distance"),
    ("avg_distance_miles", "avg", "trip_distance"),
    ("avg_duration_minutes", "avg", "trip_duration_minutes"),
    ("total_revenue", "sum", "total_amount"),
    ("avg_fare_amount", "avg", "fare_amount"),
    ("avg_tip_percentage", "avg", "tip_percentage"),
    ("avg_speed_mph", "avg", "avg_speed_mph"),
    ("avg_fare_per_mile", "avg", "fare_per_mile"),
]


def mart_daily(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Per (pickup date, pickup borough, feed): 14 measures. Borough NULL for unmatched zones.

    Boroughs are far fewer than zones, so each fact row probes the small
    dimension and aggregates straight to the final key: the
    partial aggregate holds at most dates x boroughs x feeds rows per task.
    """
    keys = ["pickup_date_key", "borough", "taxi_type"]
    loc = dim_location.select(F.col("location_id").alias("pickup_location_id"), "borough")
    joined = fact.join(loc, "pickup_location_id", "left")
    return _output(_partials(joined, keys, DAILY_MEASURES), keys, DAILY_MEASURES)


def mart_hourly(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_location: DataFrame,
) -> DataFrame:
    """Per (weekday, day name, hour, borough), all weeks pooled.

    The date join is inner: trips outside the date dimension are dropped.
    Both dimensions are probed per row, so the aggregate
    goes straight to its at most 7 x 24 x boroughs groups.
    """
    keys = ["day_of_week", "day_name", "hour_of_day", "borough"]
    dates = dim_date.select(F.col("date_key").alias("pickup_date_key"), "day_of_week", "day_name")
    loc = dim_location.select(F.col("location_id").alias("pickup_location_id"), "borough")
    joined = (
        fact.join(dates, "pickup_date_key", "inner")
        .join(loc, "pickup_location_id", "left")
        .withColumn("hour_of_day", hour_of_key("pickup_time_key"))
    )
    return _output(_partials(joined, keys, HOURLY_MEASURES), keys, HOURLY_MEASURES)


def mart_zone_pairs(fact: DataFrame, dim_location: DataFrame, min_trips: int = 10) -> DataFrame:
    """Per (pickup zone, dropoff zone) route with at least ``min_trips`` trips.

    The location dimension plays two roles; ids come from the dimension, so
    unmatched zones group under NULL. Trips are first aggregated by the
    fact's two integer ids (a shuffle of int keys, at most ids² groups);
    names are joined to those partials.
    """
    part = _partials(fact, ["pickup_location_id", "dropoff_location_id"], ZONE_MEASURES)
    loc = dim_location.select("location_id", "zone_name", "borough")
    pl = loc.select(
        F.col("location_id").alias("_pl_id"),
        F.col("zone_name").alias("pickup_zone_name"),
        F.col("borough").alias("pickup_borough"),
    )
    dl = loc.select(
        F.col("location_id").alias("_dl_id"),
        F.col("zone_name").alias("dropoff_zone_name"),
        F.col("borough").alias("dropoff_borough"),
    )
    joined = (
        part.join(pl, part["pickup_location_id"] == pl["_pl_id"], "left")
        .join(dl, part["dropoff_location_id"] == dl["_dl_id"], "left")
        .drop("pickup_location_id", "dropoff_location_id")
        .withColumnsRenamed({"_pl_id": "pickup_location_id", "_dl_id": "dropoff_location_id"})
    )
    keys = [
        "pickup_location_id", "pickup_zone_name", "pickup_borough",
        "dropoff_location_id", "dropoff_zone_name", "dropoff_borough",
    ]
    merged = _merge(joined, keys, ZONE_MEASURES)
    return _output(merged, keys, ZONE_MEASURES).where(F.col("total_trips") >= min_trips)


def mart_hourly_events(events: DataFrame) -> DataFrame:
    """Events by weekday (0 = Sunday), hour (HHMM key // 100) and type."""
    return events.groupBy(
        day_of_week0(F.to_date("ts")).alias("day_of_week"),
        hour_of_key(time_key("ts")).alias("hour_of_day"),
        "event_type",
    ).agg(
        F.count(F.lit(1)).alias("total_events"),
        round2(exact_sum("value")).alias("total_value"),
        round2(exact_avg("value")).alias("avg_value"),
    )


# Serving order of each mart (stored tables carry no order in Spark).
def order_daily(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in ("pickup_date_key", "borough", "taxi_type")])


def order_hourly(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in ("day_of_week", "hour_of_day", "borough")])


def order_zone_pairs(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.col("total_trips").desc(),
        F.col("pickup_location_id").asc_nulls_last(),
        F.col("dropoff_location_id").asc_nulls_last(),
    )
