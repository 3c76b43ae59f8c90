"""Surrogate key, deduplication and the trip fact (C4, C5, C7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlane.functions.scalars import date_key, surrogate_key, time_key
from starlane.operators.enrich import DERIVED, EnrichParams, add_measures, with_seconds

# Business columns hashed into trip_id, in order.
TRIP_KEY_COLUMNS = [
    "taxi_type",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
]

# Winner among equal keys: load time first (one value per run), then the
# columns not covered by the key, so the choice is deterministic.
DEDUPE_ORDER = ["_loaded_at", "payment_type_id", "rate_code_id", "passenger_count"]

FACT_COLUMNS = [
    "trip_id",
    "pickup_date_key",
    "pickup_time_key",
    "dropoff_date_key",
    "dropoff_time_key",
    "pickup_location_id",
    "dropoff_location_id",
    "rate_code_id",
    "payment_type_id",
    "taxi_type",
    "vendor_id",
    "passenger_count",
    "trip_distance",
    "trip_duration_minutes",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "tip_percentage",
    "avg_speed_mph",
    "fare_per_mile",
    "pickup_datetime",
    "dropoff_datetime",
    "_loaded_at",
]


FACT_TYPES = dict.fromkeys(FACT_COLUMNS, "double") | {
    "trip_id": "string",
    "taxi_type": "string",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "_loaded_at": "timestamp",
} | dict.fromkeys(
    [c for c in FACT_COLUMNS if c.endswith(("_key", "location_id", "code_id", "type_id"))] + ["vendor_id", "passenger_count"], "int"
)


PARTITION_COLUMN = "pickup_month"


def month_of(day_key: Column) -> Column:
    return F.floor(day_key / 100).cast("int")


def with_trip_id(df: DataFrame, key_columns: Sequence[str] = TRIP_KEY_COLUMNS) -> DataFrame:
    """Add ``trip_id`` from the raw (not yet defaulted) key columns."""
    doubles = [n for n, t in df.dtypes if t == "double"]
    return df.withColumn("trip_id", surrogate_key(key_columns, doubles=doubles))


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c).asc_nulls_last() for c in cols]


def rank_duplicates(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Add ``_rn``: 1 for the first row per key under a total order."""
    w = Window.partitionBy(*key).orderBy(*_order(order))
    return df.withColumn("_rn", F.row_number().over(w))


def dedupe(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key under a total order.

    Planned as one hash Exchange on the key with a partial WindowGroupLimit
    before it, so each map task ships at most one row per key: a hot key
    cannot pile its duplicates onto one reducer.
    """
    return rank_duplicates(df, key, order).where(F.col("_rn") == 1).drop("_rn")


def dedupe_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows in, rows kept by ``dedupe``, rows dropped.

    Counts per key are partially aggregated map-side, so a hot key costs
    one row per map task in the shuffle, not all of its duplicates.
    """
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").alias("rows_in"), F.count(F.lit(1)).alias("rows_out")
    ).select(
        F.coalesce("rows_in", F.lit(0)).cast("long").alias("rows_in"),
        "rows_out",
        (F.coalesce("rows_in", F.lit(0)) - F.col("rows_out")).cast("long").alias("rows_dropped"),
    )


def fact_rows(enriched: DataFrame) -> DataFrame:
    """Enriched trips -> fact columns (before dedupe).

    The key is computed from the raw location ids; only afterwards do NULL
    locations become 0, the Unknown member of the location dimension.
    """
    keyed = with_trip_id(enriched)
    return keyed.select(
        "trip_id",
        date_key("pickup_datetime").alias("pickup_date_key"),
        time_key("pickup_datetime").alias("pickup_time_key"),
        date_key("dropoff_datetime").alias("dropoff_date_key"),
        time_key("dropoff_datetime").alias("dropoff_time_key"),
        F.coalesce("pickup_location_id", F.lit(0)).alias("pickup_location_id"),
        F.coalesce("dropoff_location_id", F.lit(0)).alias("dropoff_location_id"),
        *FACT_COLUMNS[7:],
    )


# Fact columns that follow from a trip's two times.
_TIME_KEYS = {
    f"{end}_{kind}_key": (key, f"{end}_datetime") for end in ("pickup", "dropoff") for kind, key in (("date", date_key), ("time", time_key))
}


def _kept_rows(enriched: DataFrame, order: Sequence[str | Column], params: EnrichParams | None) -> DataFrame:
    """The deduplicated fact without the columns that ``_completed`` makes: a
    row is shuffled with its key in 16 bytes and no more than it is made from."""
    later = [*_TIME_KEYS, *(DERIVED if params else [])]
    named = all(isinstance(c, str) for c in order)
    rows = fact_rows(enriched).drop(*[c for c in later if named and c not in order])
    return dedupe(rows.withColumn("trip_id", F.unhex("trip_id")), ["trip_id"], order)


def _completed(rows: DataFrame, params: EnrichParams | None) -> DataFrame:
    rows = rows.withColumns({n: key(at) for n, (key, at) in _TIME_KEYS.items()} | {"trip_id": F.lower(F.hex("trip_id"))})
    return add_measures(with_seconds(rows), params) if params else rows


def build_fact(
    enriched: DataFrame, order: Sequence[str | Column] = DEDUPE_ORDER, params: EnrichParams | None = None
) -> DataFrame:
    """The deduplicated 23-column trip fact.

    With the ``params`` that ``enriched`` was made with, its measures are made
    from the rows that stay, not shuffled.
    """
    return _completed(_kept_rows(enriched, order, params), params).select(*FACT_COLUMNS)


def build_fact_by_month(
    enriched: DataFrame, order: Sequence[str | Column] = DEDUPE_ORDER, params: EnrichParams | None = None
) -> DataFrame:
    """``build_fact`` with ``pickup_month``, rebalanced on it before the columns
    that follow from others are made: as ``write_by_month`` writes it."""
    rows = _kept_rows(enriched, order, params)
    rows = rows.withColumn(PARTITION_COLUMN, month_of(date_key("pickup_datetime"))).hint("rebalance", PARTITION_COLUMN)
    return _completed(rows, params).select(*FACT_COLUMNS, PARTITION_COLUMN)
