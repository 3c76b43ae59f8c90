from datetime import date, datetime

from pyspark.sql import functions as F

from starlane.operators import checks, dims, marts, serving
from starlane.operators.facts import FACT_COLUMNS

FACT_SCHEMA = (
    "trip_id string, pickup_date_key int, pickup_time_key int, dropoff_date_key int, dropoff_time_key int, "
    "pickup_location_id int, dropoff_location_id int, rate_code_id int, payment_type_id int, taxi_type string, "
    "vendor_id int, passenger_count int, trip_distance double, trip_duration_minutes double, fare_amount double, "
    "tip_amount double, total_amount double, tip_percentage double, avg_speed_mph double, fare_per_mile double, "
    "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, _loaded_at timestamp"
)


def fact(spark, rows):
    base = dict(
        trip_id="x", pickup_date_key=20241001, pickup_time_key=705, dropoff_date_key=20241001, dropoff_time_key=720,
        pickup_location_id=1, dropoff_location_id=2, rate_code_id=1, payment_type_id=1, taxi_type="yellow",
        vendor_id=1, passenger_count=1, trip_distance=1.0, trip_duration_minutes=15.0, fare_amount=10.0,
        tip_amount=2.0, total_amount=13.0, tip_percentage=20.0, avg_speed_mph=4.0, fare_per_mile=10.0,
        pickup_datetime=datetime(2024, 10, 1, 7, 5), dropoff_datetime=datetime(2024, 10, 1, 7, 20), _loaded_at=None,
    )
    return spark.createDataFrame([tuple({**base, **r}[c] for c in FACT_COLUMNS) for r in rows], FACT_SCHEMA)


def zones(spark):
    df = spark.createDataFrame(
        [(1, "Alpha Airport", "Queens", "Airports"), (2, "Beta", "Manhattan", "Yellow Zone")],
        "location_id int, zone_name string, borough string, service_zone string",
    )
    return dims.dim_location(df)


def test_dim_date_reference_range(spark):
    d = dims.dim_date(spark)
    assert d.count() == 2556
    first = d.where("date_key = 20200101").first()
    assert first.is_holiday and first.day_of_week == 3 and first.day_name == "Wednesday" and not first.is_weekend
    last = d.agg(F.max("full_date")).first()[0]
    assert last == date(2026, 12, 30)
    assert d.where("date_key = 20261230").first().week_of_year == 53
    assert d.where("date_key = 20240706").first().is_weekend  # Saturday
    assert d.where("is_holiday").count() == 7 * 4  # 2026-12-25 is in, 12-31 is not a holiday


def test_dim_time_buckets(spark):
    t = {r.time_key: r for r in dims.dim_time(spark).collect()}
    assert len(t) == 1440
    assert [t[k].time_of_day for k in (459, 500, 1159, 1200, 1659, 1700, 2059, 2100)] == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night"]
    assert [t[k].is_rush_hour for k in (659, 700, 959, 1000, 1559, 1600, 1959, 2000)] == [
        False, True, True, False, False, True, True, False]
    assert [t[k].shift for k in (559, 600, 1359, 1400, 2159, 2200)] == ["Night", "Day", "Day", "Evening", "Evening", "Night"]
    assert t[905].time_string == "09:05"


def test_daily_mart_unknown_and_unmatched(spark):
    f = fact(spark, [dict(pickup_location_id=0), dict(pickup_location_id=77), dict(), dict(fare_amount=20.0, tip_percentage=None)])
    out = marts.order_daily(marts.mart_daily(f, zones(spark))).collect()
    assert [r.borough for r in out] == ["Queens", "Unknown", None]  # NULL group sorts last
    q = out[0]
    assert (q.total_trips, q.total_passengers, q.avg_fare_amount, q.avg_tip_percentage) == (2, 2, 15.0, 20.0)


def test_hourly_mart_inner_date_join(spark):
    f = fact(spark, [dict(), dict(pickup_date_key=20261231, pickup_time_key=1230)])
    out = marts.mart_hourly(f, dims.dim_date(spark), zones(spark)).collect()
    assert len(out) == 1 and out[0].hour_of_day == 7 and out[0].day_of_week == 2
    daily = marts.mart_daily(f, zones(spark)).collect()
    assert {r.pickup_date_key for r in daily} == {20241001, 20261231}


def test_zone_pairs_having(spark):
    f = fact(spark, [dict()] * 10 + [dict(dropoff_location_id=1)] * 9)
    out = marts.mart_zone_pairs(f, zones(spark)).collect()
    assert [(r.pickup_zone_name, r.dropoff_zone_name, r.total_trips) for r in out] == [("Alpha Airport", "Beta", 10)]


def test_serving(spark):
    f = fact(spark, [dict()] * 12 + [dict(pickup_location_id=2, dropoff_location_id=1)] * 11)
    z = zones(spark)
    top = serving.top_routes(marts.mart_zone_pairs(f, z), 1).collect()
    assert top[0].total_trips == 12 and top[0].revenue == 156.0
    air = serving.routes_matching(marts.mart_zone_pairs(f, z)).collect()
    assert len(air) == 2 and air[0].tip_pct == 20.0
    by = serving.revenue_by_borough(marts.mart_daily(f, z)).collect()
    assert [r.borough for r in by] == ["Queens", "Manhattan"]
    hourly = marts.mart_hourly(f, dims.dim_date(spark), z)
    rush = serving.rush_vs_off_peak(hourly).collect()
    assert rush[0].period == "Morning Rush (7-9 AM)" and rush[0].trips == 23


def test_checks_pass_and_fail(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", -1), (2, None, None), (None, "z", 30)], "id int, s string, h int")
    assert checks.not_null(df, "id").count() == 1
    assert checks.not_null(df.where("id is not null"), "id").count() == 0
    assert [tuple(r) for r in checks.unique(df, "id").collect()] == [(2, 2)]
    assert checks.unique(df.where("id = 1"), "id").count() == 0
    assert {r.value_field for r in checks.accepted_values(df, "s", ["a", "b"]).collect()} == {"z"}  # null passes
    assert checks.accepted_range(df, "h", 0, 23).count() == 2  # -1 and 30; null passes
    assert checks.non_negative(df, "h").count() == 1
    assert checks.non_negative(spark.createDataFrame([(0,)], "h int"), "h").count() == 0  # zero passes
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert checks.relationships(df, "id", parent, "id").count() == 0
    assert checks.relationships(df, "id", parent.where("id = 1"), "id").count() == 2
    suite = {(r.check_name, r.column_name): r.failures for r in checks.check_suite(
        df, [checks.not_null_check("id"), checks.range_check("h", 0, 23), checks.non_negative_check("h"),
             checks.accepted_values_check("s", ["a", "b"])]).collect()}
    assert suite == {("not_null", "id"): 1, ("accepted_range", "h"): 2, ("non_negative", "h"): 1, ("accepted_values", "s"): 1}


def test_quality_report_status(spark):
    f = fact(spark, [dict()] * 10)
    z = zones(spark)
    daily, hourly, zp = marts.mart_daily(f, z), marts.mart_hourly(f, dims.dim_date(spark), z), marts.mart_zone_pairs(f, z)
    rep = {r.mart: r for r in checks.quality_report(daily, hourly, zp).collect()}
    assert rep["mart_daily_summary"].status == "PASSED" and rep["mart_daily_summary"].keys_covered == 1
    assert rep["mart_zone_performance"].avg_distance == 1.0
    assert rep["mart_hourly_patterns"].weekdays_covered == 1
    bad = daily.withColumn("total_trips", F.lit(-1).cast("long"))
    assert checks.quality_report(bad, hourly, zp).where("status = 'WARNING'").count() == 1
