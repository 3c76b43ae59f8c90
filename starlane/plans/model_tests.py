"""The reference's 75 data tests, run over every layer as one report.

One row per test: (model, test_name, column_name, failures, status).
Tests run on the stored tables (dims, fact, marts) and on the lazy views
(staging, intermediate), as a build would. Each table is scanned once for
all its row-level tests; the fact's six relationship tests are folded into
that same scan by left-joining the dimensions'
key sets and counting the misses. Unique tests are partially aggregated
counts of repeated values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which columns each test covers, by model.
NOT_NULL = {
    "stg_yellow_trips": ["rate_code_id", "pickup_location_id", "dropoff_location_id", "payment_type_id",
                         "pickup_datetime", "dropoff_datetime"],
    "stg_green_trips": ["rate_code_id", "pickup_location_id", "dropoff_location_id", "payment_type_id",
                        "pickup_datetime", "dropoff_datetime"],
    "stg_taxi_zones": ["location_id", "borough", "zone_name"],
    "int_trips_union": ["taxi_type", "pickup_datetime", "dropoff_datetime"],
    "int_trips_enriched": ["taxi_type", "pickup_datetime", "trip_duration_minutes"],
    "dim_date": ["date_key", "full_date"],
    "dim_time": ["time_key", "hour", "minute"],
    "dim_location": ["location_id", "zone_name", "borough"],
    "dim_rate_code": ["rate_code_id", "rate_code_name"],
    "dim_payment_type": ["payment_type_id", "payment_name"],
    "fct_trips": ["trip_id", "pickup_date_key", "pickup_time_key", "dropoff_date_key", "dropoff_time_key",
                  "pickup_location_id", "dropoff_location_id", "rate_code_id", "payment_type_id", "taxi_type",
                  "trip_distance", "trip_duration_minutes", "fare_amount", "tip_amount", "total_amount"],
    "mart_daily_summary": ["pickup_date_key", "taxi_type", "total_trips"],
    "mart_hourly_patterns": ["day_of_week", "hour_of_day", "total_trips"],
    "mart_zone_performance": ["pickup_location_id", "dropoff_location_id", "total_trips"],
}

ACCEPTED = {
    "stg_yellow_trips": ("taxi_type", ["yellow"]),
    "stg_green_trips": ("taxi_type", ["green"]),
    "int_trips_union": ("taxi_type", ["yellow", "green"]),
    "fct_trips": ("taxi_type", ["yellow", "green"]),
}

RANGES = {"mart_hourly_patterns": ("hour_of_day", 0, 23)}

UNIQUE = {
    "stg_taxi_zones": "location_id",
    "dim_date": "date_key",
    "dim_time": "time_key",
    "dim_location": "location_id",
    "dim_rate_code": "rate_code_id",
    "dim_payment_type": "payment_type_id",
    "fct_trips": "trip_id",
}

# fact column -> (dimension model, dimension key)
RELATIONSHIPS = {
    "pickup_date_key": ("dim_date", "date_key"),
    "pickup_time_key": ("dim_time", "time_key"),
    "pickup_location_id": ("dim_location", "location_id"),
    "dropoff_location_id": ("dim_location", "location_id"),
    "rate_code_id": ("dim_rate_code", "rate_code_id"),
    "payment_type_id": ("dim_payment_type", "payment_type_id"),
}


def _row_checks(model: str, df: DataFrame) -> DataFrame:
    """All row-level tests of one table in a single aggregate."""
    checks: list[tuple[str, str, Column]] = [("not_null", c, F.col(c).isNull()) for c in NOT_NULL.get(model, [])]
    if model in ACCEPTED:
        c, values = ACCEPTED[model]
        checks.append(("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(*values)))
    if model in RANGES:
        c, lo, hi = RANGES[model]
        checks.append(("accepted_range", c, F.col(c).isNotNull() & ~F.col(c).between(lo, hi)))
    extra = [name for name in df.columns if name.startswith("_miss_")]
    for flag in extra:
        checks.append(("relationships", flag.removeprefix("_miss_"), F.col(flag)))
    counts = df.agg(*[F.count(F.when(cond, F.lit(1))).alias(f"_c{i}") for i, (_, _, cond) in enumerate(checks)])
    args = ", ".join(f"'{t}', '{c}', _c{i}" for i, (t, c, _) in enumerate(checks))
    return counts.select(
        F.lit(model).alias("model"),
        F.expr(f"stack({len(checks)}, {args}) as (test_name, column_name, failures)"),
    )


def _unique(model: str, df: DataFrame, col: str) -> DataFrame:
    repeated = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit("unique").alias("test_name"), F.lit(col).alias("column_name"), "failures"
    )


def _fact_with_relationship_flags(fact: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    out = fact
    for col, (dim, key) in RELATIONSHIPS.items():
        keys = tables[dim].select(F.col(key).alias(col)).where(F.col(col).isNotNull()).distinct()
        keys = keys.withColumn(f"_hit_{col}", F.lit(True))
        out = out.join(keys, col, "left").withColumn(
            f"_miss_{col}", F.col(col).isNotNull() & F.col(f"_hit_{col}").isNull()
        ).drop(f"_hit_{col}")
    return out


def reference_tests(tables: dict[str, DataFrame]) -> DataFrame:
    """Run every test on the given models (name -> DataFrame)."""
    parts = []
    for model in NOT_NULL:
        df = tables[model]
        if model == "fct_trips":
            df = _fact_with_relationship_flags(df, tables)
        parts.append(_row_checks(model, df))
    parts += [_unique(model, tables[model], col) for model, col in UNIQUE.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", F.when(F.col("failures") > 0, "fail").otherwise("pass"))
