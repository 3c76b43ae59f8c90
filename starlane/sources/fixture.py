"""A raw, trip-shaped feed derived from the TPC-H-like driver tables.

The driver tables carry no trip data, so this builds one: every lineitem
becomes a trip whose times, locations and amounts are integer functions of
its keys, with nulls, negatives, duplicates and an unmatched zone injected.
The rules are the test fixture's; the DuckDB oracle builds the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.sources.tables import read_table

RAW_TRIP_COLUMNS = [
    "VendorID",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "taxi_type",
]


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet their customers first, so that the lineitems, several times as
    # many, are shuffled once. Both joins are of tables that grow together: by
    # shuffle at every size, theirs is in proportion to the input.
    placed = orders.join(customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    return li.join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )


def trip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips of both feeds (13 columns incl. ``taxi_type``), in one pass.

    Every 25th order is delivered twice, the copy paid in cash; the copy is
    made with ``explode`` so the joined input is read once.
    """
    ok, ln, pk, sk = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    minute = (ok * 37 + ln * 11) % 1440
    second = (pk * 7 + sk * 13 + ln * 1009 + ok * 3) % 20000 - 200
    pickup = F.timestamp_add("MINUTE", minute, F.col("o_orderdate"))
    dropoff = F.timestamp_add("SECOND", second, pickup)
    price = F.col("l_extendedprice")
    copies = F.when(ok % 25 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    payment = F.when(ok % 40 == 0, F.lit(None)).otherwise((1 + sk % 6).cast("int"))
    return _base(spark, sf_dir).select(
        (1 + ln % 2).cast("int").alias("VendorID"),
        F.when(ok % 50 == 0, F.lit(None)).otherwise((1 + pk % 6).cast("int")).alias("RatecodeID"),
        F.when(ok % 90 == 0, F.lit(None))
        .when(ok % 70 == 0, F.lit(99))
        .otherwise((F.col("c_nationkey") + 1).cast("int"))
        .cast("int")
        .alias("PULocationID"),
        (F.col("s_nationkey") + 1).cast("int").alias("DOLocationID"),
        payment.alias("payment_type"),
        F.when(ok % 77 == 0, F.lit(None)).otherwise(pickup).alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        F.when(ln == 7, F.lit(None)).otherwise((1 + pk % 5).cast("int")).alias("passenger_count"),
        F.when(pk % 97 == 0, F.lit(0.05))
        .when(pk % 101 == 0, F.lit(None))
        .when(pk % 103 == 0, F.lit(-1.0))
        .otherwise(F.col("l_quantity") / F.lit(4.0))
        .cast("double")
        .alias("trip_distance"),
        (F.floor(price) / F.lit(100.0)).alias("fare_amount"),
        (F.floor(price * F.col("l_discount")) / F.lit(100.0)).alias("tip_amount"),
        (F.floor(price * (1 + F.col("l_tax"))) / F.lit(100.0)).alias("total_amount"),
        F.when(ok % 4 != 0, F.lit("yellow")).otherwise(F.lit("green")).alias("taxi_type"),
        F.explode(copies).alias("_copy"),
    ).select(
        *[
            F.when(F.col("_copy"), F.lit(2)).otherwise(F.col(c)).alias(c) if c == "payment_type" else F.col(c)
            for c in RAW_TRIP_COLUMNS
        ]
    )


_LANDED: dict[tuple[str, str], str] = {}


def land_trip_feeds(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Write the raw trips as Parquet, one folder per feed (``taxi_type=...``).

    Real feeds arrive as files, and reading files back keeps the derived
    fixture expressions out of every downstream plan. The landing is a
    written table under the checkpoint root, so it also cuts lineage; it is
    done once per session and driver-table folder.
    """
    memo = (spark.sparkContext.applicationId, sf_dir)
    if root is None and memo in _LANDED:
        return _LANDED[memo]
    from starlane.session import scratch_path

    target = root or scratch_path(spark, "landed-trips")
    land_raw(trip_feed(spark, sf_dir), target)
    if root is None:
        _LANDED[memo] = target
    return target


def land_raw(raw: DataFrame, target: str) -> str:
    """Write raw trips as Parquet partitioned by feed.

    Written from the partitions it comes in (AQE merges small ones of the
    joins): two feeds give each task two files at most, so the number of
    files follows the data without another shuffle of all rows.
    """
    raw.write.mode("overwrite").option("compression", "zstd").partitionBy("taxi_type").parquet(target)
    return target


def landed_feed(spark: SparkSession, root: str, taxi_type: str) -> DataFrame:
    """One landed feed with its native timestamp names (a Parquet folder scan)."""
    prefix = "tpep" if taxi_type == "yellow" else "lpep"
    return spark.read.parquet(f"{root}/taxi_type={taxi_type}").withColumnsRenamed(
        {
            "pickup_datetime": f"{prefix}_pickup_datetime",
            "dropoff_datetime": f"{prefix}_dropoff_datetime",
        }
    )


def feed(raw: DataFrame, taxi_type: str) -> DataFrame:
    """One feed with its native timestamp names (tpep_ for yellow, lpep_ for green)."""
    prefix = "tpep" if taxi_type == "yellow" else "lpep"
    return (
        raw.where(F.col("taxi_type") == taxi_type)
        .drop("taxi_type")
        .withColumnsRenamed(
            {
                "pickup_datetime": f"{prefix}_pickup_datetime",
                "dropoff_datetime": f"{prefix}_dropoff_datetime",
            }
        )
    )


def location_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in the shape of the raw zone CSV (LocationID, Borough, Zone, service_zone).

    Location 0 stays free for the Unknown member; 99 is deliberately absent.
    """
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.when(F.col("n_nationkey") % 8 == 0, F.concat("n_name", F.lit(" Airport"))).otherwise(F.col("n_name")).alias("Zone"),
        F.concat(F.lit("Zone "), F.col("r_regionkey").cast("string")).alias("service_zone"),
    )
