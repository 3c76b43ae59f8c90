from datetime import datetime

from pyspark.sql import functions as F

from starlane.functions.scalars import (
    SURROGATE_NULL_TOKEN,
    date_key,
    day_of_week0,
    double_text,
    elapsed_seconds,
    exact_avg,
    exact_sum,
    hour_of_key,
    int_rounded,
    round2,
    round_half_away,
    surrogate_key,
    time_key,
)


def test_round2_scales_in_binary(spark):
    df = spark.createDataFrame([(0.145,), (0.285,), (-0.145,), (2.675,), (None,), (float("nan"),), (1e16,)], "x double")
    got = [r[0] for r in df.select(round2("x")).collect()]
    assert got[:4] == [0.14, 0.28, -0.14, 2.68]
    assert got[4] is None
    assert got[5] != got[5]  # NaN stays NaN
    assert got[6] == 1e16


def test_round_matches_duckdb(spark):
    import random

    import duckdb

    random.seed(7)
    vals = [round(random.uniform(-500, 500), 3) for _ in range(2000)] + [18.45, 14.75, -0.25, 0.005, 1.005]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for digits in (1, 2):
        got = [r[0] for r in df.select(round_half_away("x", digits)).collect()]
        con = duckdb.connect()
        con.execute("create table t(i int, x double)")
        con.executemany("insert into t values (?, ?)", list(enumerate(vals)))
        want_all = [r[0] for r in con.execute(f"select round(x, {digits}) from t order by i").fetchall()]
        assert got == want_all


def test_elapsed_seconds_wall_clock_across_dst(spark):
    # 2024-11-03 00:30 -> 02:30 is 7,200 s on the wall clock whatever the zone.
    df = spark.createDataFrame(
        [(datetime(2024, 11, 3, 0, 30), datetime(2024, 11, 3, 2, 30)), (datetime(2024, 1, 1), datetime(2024, 1, 3, 1, 0, 0, 250000))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in df.select(elapsed_seconds("a", "b")).collect()] == [7200.0, 176400.25]


def test_int_rounded_half_even_for_doubles(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (2.7,), (None,)], "x double")
    got = [r[0] for r in df.select(int_rounded(F.coalesce("x", F.lit(99)), df.schema["x"].dataType)).collect()]
    assert got == [2, 2, 3, 99]


def test_date_time_keys(spark):
    df = spark.createDataFrame([(datetime(2024, 10, 1, 7, 5),), (datetime(2026, 12, 30, 23, 59),)], "t timestamp_ntz")
    rows = df.select(date_key("t"), time_key("t"), hour_of_key(time_key("t")), day_of_week0(F.to_date("t"))).collect()
    assert [tuple(r) for r in rows] == [(20241001, 705, 7, 2), (20261230, 2359, 23, 3)]


def test_surrogate_key_null_differs_from_text_null(spark):
    df = spark.createDataFrame([(None, 1), ("null", 1)], "a string, b int")
    keys = [r[0] for r in df.select(surrogate_key(["a", "b"])).collect()]
    assert keys[0] != keys[1]
    import hashlib

    assert keys[0] == hashlib.md5(f"{SURROGATE_NULL_TOKEN}-1".encode()).hexdigest()
    assert keys[1] == hashlib.md5(b"null-1").hexdigest()


def test_exact_sum_and_avg_are_order_free(spark):
    vals = [(0.1,), (0.2,), (0.3,), (None,), (1.005,)]
    row = spark.createDataFrame(vals, "x double").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert row.s == 1.605 and row.a == 1.605 / 4
    empty = spark.createDataFrame([(None,)], "x double").agg(exact_avg("x")).first()[0]
    assert empty is None


def test_exact_sum_keeps_small_parts_and_nan(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("x"), F.lit(1.239).alias("y"))
    assert tuple(small.agg(exact_sum("x"), exact_sum("y")).first()) == (4.0, 1239.0)
    odd = spark.createDataFrame([(1.5,), (float("nan"),)], "x double").agg(exact_sum("x"), exact_avg("x")).first()
    assert all(v != v for v in odd)
    large = spark.createDataFrame([(1e300,), (2.25,)], "x double").agg(exact_sum("x")).first()[0]
    assert large == 1e300
    assert spark.createDataFrame([(float("inf"),)], "x double").agg(exact_sum("x")).first()[0] == float("inf")


def test_elapsed_seconds_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("select timestamp_ntz'2024-11-03 00:30:00' a, timestamp_ntz'2024-11-03 02:30:00.25' b")
        assert df.select(elapsed_seconds("a", "b")).first()[0] == 7200.25
        spring = spark.sql("select timestamp_ntz'2024-03-10 01:30:00' a, timestamp_ntz'2024-03-10 02:30:00' b")
        assert spring.select(elapsed_seconds("a", "b")).first()[0] == 3600.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rounding_stops_where_digits_end(spark):
    df = spark.createDataFrame([(123456789012345.12,), (2.5e14,)], "x double")
    assert [r[0] for r in df.select(round_half_away("x", 4)).collect()] == [123456789012345.12, 2.5e14]


def test_sizing_conf_scales_with_input():
    from starlane.session import sizing_conf

    small = sizing_conf(10 * 2**20, 8)
    big = sizing_conf(100 * 2**40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 2**20)


def test_double_text_is_the_reference_engines(spark):
    import duckdb

    values = [0.0, 0.5, -12345678.5, 1e7, 9999999.5, 123456789012345.0, 1e15, 1e16, 1.5e17, 0.0005, 0.0001, 0.00012345678901234567, 1e-5, 1.25e-100]
    values += [float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(double_text("x"))
    assert [r[0] for r in df.collect()] == [duckdb.execute("select ?::double::varchar", [v]).fetchall()[0][0] for v in values]


def test_exact_sums_drop_nothing_and_do_not_overflow(spark):
    import math
    import random

    from starlane.functions.scalars import exact_avg, exact_sum

    r = random.Random(1)
    groups = {
        0: [1e-11] * 1000, 1: [9e8] * 100, 2: [1e16, -1e16, 3e-13], 3: [0.1] * 10, 4: [-0.1] * 10, 5: [1e300, 1.0], 6: [1e-200] * 5,
        7: [r.uniform(-1, 1) * 10 ** r.randint(-12, 12) for _ in range(3000)], 8: [None], 9: [0.0, -0.0], 10: [1.0, -1.0],
        11: [-4e15, 2.0**-70], 12: [float("inf"), 1.0], 13: [3e16] * 50, 14: [12.34, 19.07], 15: [2.0**53 + 2, 0.25, -0.5],
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    r.shuffle(rows)
    seen = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "k int, v double").repartition(parts)
        got = {x.k: (x.s, x.a) for x in df.groupBy("k").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).collect()}
        for k, values in groups.items():
            known = [v for v in values if v is not None]
            want = math.fsum(known) if known else None
            if want is None:
                assert got[k] == (None, None)
            else:  # to the last place of the sum, or 1e-18 a value
                near = lambda a, b: a == b or math.isclose(a, b, rel_tol=3e-16, abs_tol=1e-18 * len(known))
                assert near(got[k][0], want) and near(got[k][1], want / len(known)), (k, got[k], want)
        seen.append(got)
    assert seen[0] == seen[1]
    assert got[14] == (31.41, 15.705)  # the decimals that the doubles stand for
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "v double").agg(exact_sum("v")).first()[0]
    assert math.isnan(nan)


def test_exact_sums_hold_many_large_values(spark):
    from starlane.functions.scalars import exact_sum

    got = spark.range(0, 20_000_000, 1, 4).select(exact_sum((F.col("id") % 2 + 9e8).cast("double"))).first()[0]
    assert got == 20_000_000 * 9e8 + 10_000_000
