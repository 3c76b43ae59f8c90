"""Standardise raw feeds to the canonical trip schema, and union them (C1, C2, C12)."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.functions.scalars import int_rounded, ntz

# Canonical trip columns, in order (both feeds emit exactly these).
CANONICAL = [
    "vendor_id",
    "rate_code_id",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "store_and_fwd_flag",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "taxi_type",
    "_loaded_at",
]

# Types of the canonical columns, whatever a month's files have.
CANONICAL_TYPES = (
    dict.fromkeys(CANONICAL, "double")
    | dict.fromkeys(
        ["vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id", "payment_type_id", "passenger_count"], "int"
    )
    | dict.fromkeys(["pickup_datetime", "dropoff_datetime"], "timestamp_ntz")
    | dict.fromkeys(["store_and_fwd_flag", "taxi_type"], "string")
    | {"_loaded_at": "timestamp"}
)

# Money fields: null -> 0, double. Source name = canonical name.
MONEY_FIELDS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
]


@dataclass(frozen=True)
class FeedSpec:
    """How one raw feed maps onto the canonical schema.

    Source names are matched case-insensitively. A source column that is
    missing from the files is read as all-NULL, then defaulted like any
    other NULL. ``airport_fee=None`` means the feed has no such field and
    gets a constant 0.0.
    """

    tag: str
    pickup: str
    dropoff: str
    airport_fee: str | None = "Airport_fee"
    names: dict[str, str] = field(
        default_factory=lambda: {
            "vendor_id": "VendorID",
            "rate_code_id": "RatecodeID",
            "pickup_location_id": "PULocationID",
            "dropoff_location_id": "DOLocationID",
            "payment_type_id": "payment_type",
            "passenger_count": "passenger_count",
            "trip_distance": "trip_distance",
            "store_and_fwd_flag": "store_and_fwd_flag",
        }
    )


YELLOW = FeedSpec("yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime", "Airport_fee")
GREEN = FeedSpec("green", "lpep_pickup_datetime", "lpep_dropoff_datetime", None)


@dataclass(frozen=True)
class DateWindow:
    """Pickup window; the end day is included (``< end + 1 day``)."""

    start: date
    end: date


@dataclass(frozen=True)
class Bounds:
    min_distance: float = 0.0
    min_fare: float = 0.0
    max_fare_exclusive: float = 1000.0


def _resolver(df: DataFrame):
    by_lower = {f.name.lower(): f for f in df.schema.fields}

    def get(name: str | None, null_type: str = "double") -> tuple[Column, T.DataType | None]:
        if name is not None and name.lower() in by_lower:
            f = by_lower[name.lower()]
            return F.col(f"`{f.name}`"), f.dataType
        return F.lit(None).cast(null_type), None

    return get


def standardize(
    df: DataFrame,
    spec: FeedSpec,
    window: DateWindow,
    bounds: Bounds = Bounds(),
    loaded_at: Column | None = None,
) -> DataFrame:
    """Rename, default and type one raw feed (``CANONICAL_TYPES``), then drop garbage rows.

    Filters apply to the standardised values: a NULL fare is 0 and passes
    the fare bounds. Required-timestamp and window filters reach the
    Parquet scan as pushed filters.
    """
    get = _resolver(df)
    n = spec.names
    rate, rate_t = get(n["rate_code_id"])
    pay, pay_t = get(n["payment_type_id"])
    pax, pax_t = get(n["passenger_count"])
    fee_col = get(spec.airport_fee)[0] if spec.airport_fee else None
    cols = [
        int_rounded(*get(n["vendor_id"], "int")).alias("vendor_id"),
        int_rounded(F.coalesce(rate, F.lit(99)), rate_t).alias("rate_code_id"),
        int_rounded(*get(n["pickup_location_id"], "int")).alias("pickup_location_id"),
        int_rounded(*get(n["dropoff_location_id"], "int")).alias("dropoff_location_id"),
        int_rounded(F.coalesce(pay, F.lit(0)), pay_t).alias("payment_type_id"),
        get(spec.pickup, "timestamp_ntz")[0].cast("timestamp_ntz").alias("pickup_datetime"),
        get(spec.dropoff, "timestamp_ntz")[0].cast("timestamp_ntz").alias("dropoff_datetime"),
        int_rounded(F.coalesce(pax, F.lit(1)), pax_t).alias("passenger_count"),
        F.coalesce(get(n["trip_distance"])[0], F.lit(0)).cast("double").alias("trip_distance"),
        get(n["store_and_fwd_flag"], "string")[0].cast("string").alias("store_and_fwd_flag"),
    ]
    cols += [F.coalesce(get(m)[0], F.lit(0)).cast("double").alias(m) for m in MONEY_FIELDS]
    cols += [
        (F.coalesce(fee_col, F.lit(0)) if fee_col is not None else F.lit(0)).cast("double").alias("airport_fee"),
        F.lit(spec.tag).alias("taxi_type"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("_loaded_at"),
    ]
    out = df.select(*cols).select(*CANONICAL)
    pu, do = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return out.where(
        pu.isNotNull()
        & do.isNotNull()
        & (pu < do)
        & (pu >= ntz(window.start))
        & (pu < ntz(window.end + timedelta(days=1)))
        & (F.col("trip_distance") >= bounds.min_distance)
        & (F.col("fare_amount") >= bounds.min_fare)
        & (F.col("fare_amount") < bounds.max_fare_exclusive)
    )


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """UNION ALL of standardised feeds by canonical column name (no dedupe)."""
    first, *rest = [f.select(*CANONICAL) for f in feeds]
    for other in rest:
        first = first.unionByName(other)
    return first


def stage_zones(lookup: DataFrame) -> DataFrame:
    """Zone lookup (LocationID, Borough, Zone, service_zone) to snake_case."""
    return lookup.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone").alias("service_zone"),
    )
