import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starlane.operators.enrich import enrich
from starlane.operators.incremental import high_water, load_incremental, read_fact
from starlane.operators.standardize import YELLOW, DateWindow, standardize
from starlane.sources.files import expected_files_between, file_manifest, land_feed, sample_slice, scan_feed
from starlane.sources.lookups import ZONE_SCHEMA, lookup_count, read_lookup, write_lookup

from tests.test_pipeline_ops import RAW_SCHEMA, raw

WINDOW = DateWindow(date(2024, 1, 1), date(2024, 12, 31))


def trips(spark, pickups, **extra):
    rows = [dict(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + timedelta(minutes=10), **extra) for p in pickups]
    return enrich(standardize(raw(spark, rows), YELLOW, WINDOW))


def test_append_high_water_is_strict_and_idempotent(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    t = [datetime(2024, 10, 1, 8), datetime(2024, 10, 2, 8)]
    assert high_water(spark, target) == datetime(1900, 1, 1)
    load_incremental(spark, target, trips(spark, t), "append")
    assert high_water(spark, target) == t[1]
    batch = trips(spark, [t[1] - timedelta(hours=1), t[1], t[1] + timedelta(seconds=1)], VendorID=2)
    load_incremental(spark, target, batch, "append")  # < max skip, = max skip, > max append
    load_incremental(spark, target, batch, "append")  # rerun adds nothing
    got = sorted(r.pickup_datetime for r in read_fact(spark, target).collect())
    assert got == t + [t[1] + timedelta(seconds=1)]
    load_incremental(spark, target, batch, "full")  # full picks everything in the batch
    assert read_fact(spark, target).count() == 3


def test_upsert_replaces_keys_and_keeps_other_months(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    first = trips(spark, [datetime(2024, 9, 1, 8), datetime(2024, 10, 1, 8)], payment_type=2)
    load_incremental(spark, target, first, "upsert")
    again = trips(spark, [datetime(2024, 10, 1, 8), datetime(2024, 10, 5, 8)], payment_type=1)
    load_incremental(spark, target, again, "upsert")
    out = sorted((r.pickup_datetime, r.payment_type_id) for r in read_fact(spark, target).collect())
    assert out == [(datetime(2024, 9, 1, 8), 2), (datetime(2024, 10, 1, 8), 1), (datetime(2024, 10, 5, 8), 1)]


def test_month_files_rollover_and_bad_text(spark):
    rows = expected_files_between(spark, "2024-11", "2025-02", ["yellow"]).collect()
    assert [r.file_name for r in rows] == [
        "yellow_tripdata_2024-11.parquet", "yellow_tripdata_2024-12.parquet",
        "yellow_tripdata_2025-01.parquet", "yellow_tripdata_2025-02.parquet"]
    with pytest.raises(ValueError):
        expected_files_between(spark, "2024-13", "2025-01", ["yellow"])


def test_manifest_presence(spark, tmp_dir):
    df = spark.createDataFrame(
        [("yellow", datetime(2024, 10, 3)), ("green", datetime(2024, 11, 3)), ("yellow", None)],
        "taxi_type string, pickup_datetime timestamp_ntz")
    root = land_feed(df, f"{tmp_dir}/landing")
    expected = expected_files_between(spark, "2024-10", "2024-11", ["yellow", "green"])
    got = {(r.feed, r.month): r.file_present for r in file_manifest(spark, root, expected).collect()}
    assert got == {("yellow", 10): True, ("yellow", 11): False, ("green", 10): False, ("green", 11): True}


def test_scan_feed_with_type_drift(spark, tmp_dir):
    a = raw(spark, [dict(RatecodeID=2.0)])
    b = raw(spark, [dict()]).withColumn("RatecodeID", F.lit(3).cast("bigint")).withColumnRenamed("Airport_fee", "airport_fee")
    a.write.parquet(f"{tmp_dir}/a.parquet")
    b.write.parquet(f"{tmp_dir}/b.parquet")
    with pytest.raises(Exception):
        spark.read.parquet(f"{tmp_dir}/a.parquet", f"{tmp_dir}/b.parquet").collect()
    df = scan_feed(spark, [f"{tmp_dir}/a.parquet", f"{tmp_dir}/b.parquet"])
    assert sorted(r.RatecodeID for r in df.collect()) == [2.0, 3.0]
    assert sorted(r.rate_code_id for r in standardize(df, YELLOW, WINDOW).collect()) == [2, 3]


def test_sample_slice_and_lookup_csv(spark, tmp_dir):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v"))
    assert sample_slice(df, 5, ["v"], f"{tmp_dir}/s") == 5
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_dir}/s").collect()) == [0, 1, 2, 3, 4]
    lk = spark.createDataFrame([(1, "EWR", "Newark Airport", "EWR"), (264, "Unknown", "N/A", "N/A")], ZONE_SCHEMA)
    path = write_lookup(lk, f"{tmp_dir}/zones")
    text = open([p for p in __import__("glob").glob(f"{path}/*.csv")][0], newline="").read()
    assert text.startswith('"LocationID","Borough","Zone","service_zone"\r\n')
    assert lookup_count(spark, path, ZONE_SCHEMA) == 2
    assert read_lookup(spark, path, ZONE_SCHEMA).where("Zone = 'N/A'").count() == 1  # "N/A" stays text


def test_manifest_summary(spark, tmp_dir):
    from starlane.sources.files import manifest_summary

    df = spark.createDataFrame(
        [("yellow", datetime(2024, 10, 3)), ("yellow", datetime(2024, 12, 3)), ("green", datetime(2024, 11, 3))],
        "taxi_type string, pickup_datetime timestamp_ntz")
    root = land_feed(df, f"{tmp_dir}/landing")
    expected = expected_files_between(spark, "2024-10", "2024-11", ["yellow", "green"])
    manifest = file_manifest(spark, root, expected)
    row = manifest_summary(manifest).first()
    assert (row.files_present, row.files_missing) == (2, 2)
    assert row.date_range == "2024-10 to 2024-11" and row.taxi_types == "green, yellow"
    n_bytes = manifest.agg({"bytes": "sum"}).first()[0]
    assert n_bytes > 0 and row.total_size_mb == round(n_bytes / 2**20, 2)


def test_an_unreadable_table_is_not_taken_for_a_missing_one(spark, tmp_dir):
    from starlane.operators.incremental import table_exists

    assert not table_exists(spark, f"{tmp_dir}/none")
    spark.range(1).write.parquet(f"{tmp_dir}/table")
    assert table_exists(spark, f"{tmp_dir}/table")
    with open(f"{tmp_dir}/broken.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        table_exists(spark, f"{tmp_dir}/broken.parquet")


def test_a_fact_of_other_types_is_not_written(spark, tmp_dir):
    from starlane.operators.facts import build_fact
    from starlane.operators.incremental import write_fact

    fact = build_fact(trips(spark, [datetime(2024, 10, 1, 8)]))
    with pytest.raises(TypeError):
        write_fact(fact.withColumn("vendor_id", F.col("vendor_id").cast("bigint")), f"{tmp_dir}/fact")


def test_upsert_builds_the_batch_once(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    load_incremental(spark, target, trips(spark, [datetime(2024, 9, 1, 8)]), "upsert")
    load_incremental(spark, target, trips(spark, [datetime(2024, 10, 1, 8)]), "upsert")
    load_incremental(spark, target, trips(spark, [datetime(2024, 10, 1, 8)]), "upsert")
    assert read_fact(spark, target).count() == 2


def test_manifest_knows_files_by_name(spark, tmp_dir):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from starlane.sources.files import monthly_files

    os.makedirs(f"{tmp_dir}/yellow")
    pq.write_table(pa.table({"x": [1]}), f"{tmp_dir}/yellow/yellow_tripdata_2024-10.parquet")
    expected = expected_files_between(spark, "2024-10", "2024-11", ["yellow"])
    rows = file_manifest(spark, tmp_dir, expected).orderBy("month").collect()
    assert [(r.file_present, r.n_files) for r in rows] == [(True, 1), (False, 0)]
    assert len(monthly_files(spark, tmp_dir, "yellow", "2024-10", "2024-12")) == 1


def test_scan_feed_widens_without_loss_in_any_order(spark, tmp_dir):
    a = spark.sql("select 16777217L as n, cast(1.25 as decimal(6,2)) as d, cast(null as int) as t")
    b = spark.sql("select cast(0.5 as float) as n, cast(1.2599 as decimal(12,4)) as d, 'text' as t")
    for first, second in ((a, b), (b, a)):
        first.write.mode("overwrite").parquet(f"{tmp_dir}/p1")
        second.write.mode("overwrite").parquet(f"{tmp_dir}/p2")
        got = scan_feed(spark, [f"{tmp_dir}/p1", f"{tmp_dir}/p2"])
        assert sorted((r.n, str(r.d), r.t or "") for r in got.collect()) == [(0.5, "1.2599", "text"), (16777217.0, "1.2500", "")]


@pytest.fixture()
def far(spark, tmp_dir):
    """The folder under a path that only Spark's own readers open."""
    mount = f"far{uuid.uuid4().hex[:8]}"  # open file systems are kept by name
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{mount}.link./in", f"file://{tmp_dir}")
    return f"viewfs://{mount}/in"


def test_feeds_are_scanned_by_any_path_that_spark_reads(spark, tmp_dir, far):
    raw(spark, [dict(RatecodeID=2.0)]).write.parquet(f"{tmp_dir}/a.parquet")
    raw(spark, [dict()]).withColumn("RatecodeID", F.lit(3).cast("bigint")).write.parquet(f"{tmp_dir}/b.parquet")
    raw(spark, [dict()]).withColumn("RatecodeID", F.lit(4).cast("int")).drop("Airport_fee").write.parquet(f"{tmp_dir}/c.parquet")
    df = scan_feed(spark, [f"{far}/{n}.parquet" for n in "abc"])
    assert sorted(r.RatecodeID for r in df.collect()) == [2.0, 3.0, 4.0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # int is widened by the reader, beside the doubles


def test_a_fact_is_kept_under_any_path_that_spark_writes(spark, tmp_dir, far):
    target = f"{far}/fact"
    load_incremental(spark, target, trips(spark, [datetime(2024, 10, 1, 8)]), "upsert")
    load_incremental(spark, target, trips(spark, [datetime(2024, 10, 1, 8), datetime(2024, 10, 2, 8)]), "upsert")
    assert read_fact(spark, target).count() == 2 and high_water(spark, target) == datetime(2024, 10, 2, 8)


def test_a_bigint_that_no_double_holds_is_not_changed_in_silence(spark, tmp_dir):
    spark.sql("select 9007199254740993L as n").write.parquet(f"{tmp_dir}/p1")
    spark.sql("select 0.5D as n").write.parquet(f"{tmp_dir}/p2")
    with pytest.raises(Exception, match="no double holds 9007199254740993"):
        scan_feed(spark, [f"{tmp_dir}/p1", f"{tmp_dir}/p2"]).collect()
    spark.sql("select 9007199254740992L as n union all select null").write.parquet(f"{tmp_dir}/p3")
    rows = scan_feed(spark, [f"{tmp_dir}/p3", f"{tmp_dir}/p2"]).collect()
    assert sorted(r.n for r in rows if r.n is not None) == [0.5, 9007199254740992.0] and len(rows) == 3
