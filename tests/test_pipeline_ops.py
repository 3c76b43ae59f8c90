"""Boundary rows of each operator (one literal frame per group)."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starlane.operators.enrich import enrich
from starlane.operators.facts import FACT_COLUMNS, build_fact, dedupe, dedupe_report, fact_rows
from starlane.operators.standardize import CANONICAL, GREEN, YELLOW, DateWindow, standardize, union_feeds

RAW_SCHEMA = (
    "VendorID int, RatecodeID double, PULocationID int, DOLocationID int, payment_type bigint, "
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
    "trip_distance double, store_and_fwd_flag string, fare_amount double, extra double, mta_tax double, "
    "tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double, "
    "congestion_surcharge double, Airport_fee double"
)
WINDOW = DateWindow(date(2024, 10, 1), date(2024, 11, 30))
T0 = datetime(2024, 10, 10, 12, 0)


def raw(spark, rows):
    """rows: dicts of overrides on a valid trip."""
    base = dict(
        VendorID=1, RatecodeID=1.0, PULocationID=10, DOLocationID=20, payment_type=1,
        tpep_pickup_datetime=T0, tpep_dropoff_datetime=T0 + timedelta(minutes=10), passenger_count=1.0,
        trip_distance=2.0, store_and_fwd_flag="N", fare_amount=10.0, extra=0.0, mta_tax=0.5, tip_amount=2.0,
        tolls_amount=0.0, improvement_surcharge=0.3, total_amount=12.8, congestion_surcharge=2.5, Airport_fee=None,
    )
    cols = [c.split()[0] for c in RAW_SCHEMA.split(", ")]
    data = [tuple({**base, **r}[c] for c in cols) for r in rows]
    return spark.createDataFrame(data, RAW_SCHEMA)


def std(spark, rows, spec=YELLOW):
    return standardize(raw(spark, rows), spec, WINDOW)


def test_window_boundaries(spark):
    ts = [datetime(2024, 9, 30, 23, 59, 59), datetime(2024, 10, 1), datetime(2024, 11, 30, 23, 59, 59, 999999), datetime(2024, 12, 1)]
    rows = [dict(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + timedelta(minutes=5)) for t in ts]
    kept = sorted(r.pickup_datetime for r in std(spark, rows).collect())
    assert kept == [ts[1], ts[2]]


def test_order_and_required_timestamps(spark):
    rows = [
        dict(tpep_dropoff_datetime=T0),  # equal: drop
        dict(tpep_dropoff_datetime=T0 + timedelta(microseconds=1)),  # keep
        dict(tpep_pickup_datetime=None),
        dict(tpep_dropoff_datetime=None),
    ]
    assert std(spark, rows).count() == 1


def test_measure_bounds_after_defaults(spark):
    rows = [
        dict(trip_distance=-0.01), dict(trip_distance=0.0), dict(trip_distance=None),
        dict(fare_amount=-0.01), dict(fare_amount=0.0), dict(fare_amount=None), dict(fare_amount=999.99),
        dict(fare_amount=1000.0), dict(fare_amount=float("nan")),
    ]
    out = std(spark, rows).collect()
    assert len(out) == 5
    assert sorted(r.fare_amount for r in out) == [0.0, 0.0, 10.0, 10.0, 999.99]


def test_defaults_and_rounding_casts(spark):
    rows = [dict(RatecodeID=None, payment_type=None, passenger_count=None), dict(RatecodeID=1.5), dict(RatecodeID=2.5)]
    out = std(spark, rows).orderBy("rate_code_id").collect()
    assert [r.rate_code_id for r in out] == [2, 2, 99]
    nulls = [r for r in out if r.rate_code_id == 99][0]
    assert (nulls.payment_type_id, nulls.passenger_count) == (0, 1)
    assert nulls.airport_fee == 0.0 and nulls.taxi_type == "yellow"


def test_green_feed_has_no_airport_fee_and_lpep_names(spark):
    df = raw(spark, [dict(Airport_fee=5.0)]).withColumnsRenamed(
        {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
    )
    out = standardize(df, GREEN, WINDOW).collect()
    assert out[0].airport_fee == 0.0 and out[0].taxi_type == "green"


def test_case_insensitive_names_and_missing_columns(spark):
    df = raw(spark, [dict(Airport_fee=3.0)]).withColumnRenamed("Airport_fee", "airport_fee").drop("extra")
    out = standardize(df, YELLOW, WINDOW).collect()[0]
    assert out.airport_fee == 3.0 and out.extra == 0.0


def test_union_is_all_and_canonical(spark):
    y = std(spark, [{}, {}])
    u = union_feeds(y, y)
    assert u.columns == CANONICAL and u.count() == 4


def secs(s):
    return dict(tpep_dropoff_datetime=T0 + timedelta(seconds=s))


def test_duration_window(spark):
    rows = [secs(59.999999), secs(60), secs(14400), secs(14400.000001)]
    got = sorted(r.trip_duration_minutes for r in enrich(std(spark, rows)).collect())
    assert got == [1.0, 240.0]


def test_speed_guard_and_cap(spark):
    rows = [
        dict(**secs(60), trip_distance=1.0),  # exactly 60 s -> speed null, kept
        dict(**secs(600), trip_distance=0.0),  # distance 0 -> null, kept
        dict(**secs(3600), trip_distance=100.004),  # rounds to 100.0, kept
        dict(**secs(3600), trip_distance=100.01),  # drop
    ]
    out = enrich(std(spark, rows)).collect()
    assert sorted((r.avg_speed_mph is None, r.trip_distance) for r in out) == [(False, 100.004), (True, 0.0), (True, 1.0)]


def test_tip_percentage_and_fare_per_mile(spark):
    rows = [
        dict(payment_type=1, fare_amount=10.0, tip_amount=2.5, trip_distance=0.0999),
        dict(payment_type=1, fare_amount=0.0, tip_amount=1.0, trip_distance=0.1),
        dict(payment_type=2, fare_amount=10.0, tip_amount=1.0, trip_distance=0.1),
        dict(payment_type=None, fare_amount=10.0, tip_amount=1.0, trip_distance=0.1),
    ]
    out = enrich(std(spark, rows)).orderBy("payment_type_id", F.col("fare_amount").desc()).collect()
    assert [r.tip_percentage for r in out] == [None, 25.0, None, None]
    # order: payment 0 (null -> 0), card fare 10 (0.0999 mi), card fare 0, cash
    assert [r.fare_per_mile for r in out] == [100.0, None, 0.0, 100.0]


def test_key_dedupe_and_unknown_location(spark):
    rows = [
        dict(RatecodeID=3.0, payment_type=2),
        dict(RatecodeID=2.0, payment_type=2),
        dict(RatecodeID=5.0, payment_type=1),  # same 11 key columns: one trip
        dict(PULocationID=None, VendorID=None),
    ]
    enriched = enrich(std(spark, rows))
    fact = build_fact(enriched)
    assert fact.columns == FACT_COLUMNS
    out = fact.orderBy("pickup_location_id").collect()
    assert len(out) == 2
    assert out[0].pickup_location_id == 0 and out[0].vendor_id is None
    winner = out[1]
    assert (winner.payment_type_id, winner.rate_code_id) == (1, 5)
    rep = dedupe_report(fact_rows(enriched), ["trip_id"]).first()
    assert (rep.rows_in, rep.rows_out, rep.rows_dropped) == (4, 2, 2)


def test_dedupe_is_partition_independent(spark):
    df = spark.range(0, 2000).select((F.col("id") % 37).alias("k"), (F.col("id") * 7919 % 1000).alias("v"))
    a = {tuple(r) for r in dedupe(df, ["k"], ["v"]).collect()}
    b = {tuple(r) for r in dedupe(df.repartition(13), ["k"], ["v"]).collect()}
    want = {(k, min(i * 7919 % 1000 for i in range(2000) if i % 37 == k)) for k in range(37)}
    assert a == b == want


def test_hot_key_dedupe_plan_and_result(spark):
    """A third of all rows share one key: result stays exact and the plan
    limits each map task to one row per key before the shuffle."""
    n = 3000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 7919 % 100003).alias("v"),
    )
    out = dedupe(df.repartition(8), ["k"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) + final
    rows = {r.k: r.v for r in out.collect()}
    assert len(rows) == 1 + 2 * n // 3
    assert rows[-1] == min(i * 7919 % 100003 for i in range(0, n, 3))
