"""Plan shapes that the scale design relies on (checked on the physical plan)."""

import contextlib
import io
import re

from starlane.plans.trips import TripModel

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_one_exchange_with_partial_limit_and_pushdown(spark):
    m = TripModel(spark, SF_SMALL)
    p = _plan(m.fact)
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", p)
    assert len(exchanges) == 1 and exchanges[0][0] == "hashpartitioning" and "trip_id" in exchanges[0][1]
    assert "WindowGroupLimit" in p and ", Partial" in p and ", Final" in p
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        m.fact.explain("formatted")
    formatted = buf.getvalue()
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", formatted)
    assert len(pushed) == 2  # one scan per feed
    assert all("GreaterThanOrEqual(pickup_datetime" in f and "LessThan(pickup_datetime" in f for f in pushed)


def test_marts_broadcast_and_never_sort_merge(spark):
    m = TripModel(spark, SF_SMALL)
    for df in (m.daily(), m.hourly(), m.zone_pairs()):
        p = _plan(df)
        assert "BroadcastHashJoin" in p
        assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p


def test_zone_pairs_shuffle_integer_ids_before_names(spark):
    m = TripModel(spark, SF_SMALL)
    p = _plan(m.zone_pairs())
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert any(k.startswith("pickup_location_id") and "zone_name" not in k for k in keys)


def test_places_are_numbered_in_the_sorted_partitions(spark):
    from starlane.plans.catalog import _ranked

    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ranked = _ranked(spark.range(1000).selectExpr("(id * 7) % 1000 as k").orderBy("k"), "k")
        rows = ranked.selectExpr("k", "place", "spark_partition_id() as task").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.k, r.place) for r in rows) == [(i, i + 1) for i in range(1000)]
    assert len({r.task for r in rows}) > 1


def test_landing_shuffles_each_table_once_for_its_join_at_every_size(spark, tmp_dir):
    import glob

    from pyspark.sql import functions as F

    from starlane.sources import fixture

    p = _plan(fixture.trip_feed(spark, SF_SMALL))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", p)
    assert sorted(keys) == ["c_custkey", "l_orderkey", "o_custkey", "o_orderkey"]
    # The rows are written from the partitions they come in, not shuffled again.
    raw = spark.range(0, 600, 1, 3).select("id", F.when(F.col("id") % 2 == 0, "yellow").otherwise("green").alias("taxi_type"))
    root = fixture.land_raw(raw, f"{tmp_dir}/raw")
    assert len(glob.glob(f"{root}/taxi_type=green/*.parquet")) == 3
    assert spark.read.parquet(root).count() == 600


def test_fact_is_shuffled_without_the_columns_that_follow_from_others(spark):
    from starlane.operators.enrich import DERIVED
    from starlane.operators.facts import build_fact_by_month

    m = TripModel(spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        build_fact_by_month(m.enriched, params=m.p.enrich).explain("formatted")
    shuffled = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", buf.getvalue())
    assert len(shuffled) == 2  # for the dedupe, for the months
    for columns in shuffled:
        names = {c.split("#")[0].strip() for c in columns.split(",")}
        assert {"trip_id", "pickup_datetime", "total_amount"} <= names
        assert not names & {*DERIVED, "pickup_date_key", "pickup_time_key", "dropoff_date_key", "dropoff_time_key"}


def test_fact_by_month_has_the_rows_of_the_plain_one(spark, tmp_dir):
    """With other parameters than the defaults, and orders by a derived column, by name or not."""
    import glob

    from pyspark.sql import functions as F

    from starlane.operators.enrich import EnrichParams, enrich
    from starlane.operators.facts import FACT_COLUMNS, build_fact_by_month, dedupe, fact_rows
    from starlane.operators.incremental import read_fact, write_fact

    m = TripModel(spark, SF_SMALL)
    p = EnrichParams(card_payment_id=2, min_distance_for_fare=3.0)
    rows = enrich(m.trips_union.withColumn("_loaded_at", F.lit("2024-01-01 00:00:00").cast("timestamp")), p)
    for i, order in enumerate((["payment_type_id"], ["tip_percentage", "payment_type_id"], [F.col("tip_percentage").desc(), "payment_type_id"])):
        plain = dedupe(fact_rows(rows), ["trip_id"], order).select(*FACT_COLUMNS)
        write_fact(build_fact_by_month(rows, order, p), f"{tmp_dir}/{i}", balanced=True)
        got = read_fact(spark, f"{tmp_dir}/{i}")
        assert got.dtypes == plain.dtypes
        assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0 < got.count()
        months = glob.glob(f"{tmp_dir}/{i}/pickup_month=*")
        assert len(glob.glob(f"{tmp_dir}/{i}/pickup_month=*/*.parquet")) == len(months) > 12
