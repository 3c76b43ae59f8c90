"""Data-quality operators (Q1-Q8). Each check returns the violating rows:
an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.functions.scalars import exact_avg, round2


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Non-null values that occur more than once, with their count.

    Partial aggregation keeps a hot value to one row per map task.
    """
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Value groups outside the accepted list; NULL passes."""
    c = F.col(col)
    return (
        df.where(c.isNotNull() & ~c.isin(*values))
        .groupBy(c.alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key is missing from the parent (anti-join).

    No hint and no look at the data while planning: Spark picks the join from
    the sizes in bytes it knows or, under AQE, measures.
    """
    keys = parent.select(F.col(parent_col).alias(col)).where(F.col(col).isNotNull()).distinct()
    return child.where(F.col(col).isNotNull()).join(keys, col, "left_anti")


def accepted_range(
    df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    """Rows outside [min, max] (or the open interval); NULL passes."""
    c = F.col(col)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c >= min_value) if inclusive else (c > min_value))
    if max_value is not None:
        ok = ok & ((c <= max_value) if inclusive else (c < max_value))
    return df.where(c.isNotNull() & ~ok)


def non_negative(df: DataFrame, col: str) -> DataFrame:
    """The ``positive_value`` test: rows with a negative value (zero passes)."""
    return df.where(F.col(col) < 0)


@dataclass(frozen=True)
class Check:
    """One row-level rule for ``check_suite``: ``fails`` is true on a bad row."""

    name: str
    column: str
    fails: Column


def not_null_check(col: str) -> Check:
    return Check("not_null", col, F.col(col).isNull())


def range_check(col: str, lo=None, hi=None) -> Check:
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < lo)
    if hi is not None:
        bad = bad | (c > hi)
    return Check("accepted_range", col, c.isNotNull() & bad)


def non_negative_check(col: str) -> Check:
    return Check("non_negative", col, F.col(col) < 0)


def accepted_values_check(col: str, values: Sequence) -> Check:
    c = F.col(col)
    return Check("accepted_values", col, c.isNotNull() & ~c.isin(*values))


def check_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of a table in one scan: (check, column, failures).

    One global aggregate of conditional counts, unpivoted with ``stack``;
    the table is read once however many checks there are.
    """
    sums = [F.count(F.when(c.fails, F.lit(1))).alias(f"_c{i}") for i, c in enumerate(checks)]
    counts = df.agg(*sums)
    stack_args = ", ".join(f"'{c.name}', '{c.column}', _c{i}" for i, c in enumerate(checks))
    return counts.select(F.expr(f"stack({len(checks)}, {stack_args}) as (check_name, column_name, failures)"))


def quality_report(daily: DataFrame, hourly: DataFrame, zones: DataFrame) -> DataFrame:
    """One row per mart: rows, key range, coverage (of weekdays too, for the
    hourly mart), null/negative trip counters, average route distance, and a status.

    The status is WARNING when null or negative trip counts are found,
    else PASSED. Three global aggregates, unioned; no joins.
    """
    no_weekdays = F.lit(None).cast("long").alias("weekdays_covered")

    def counters(df: DataFrame) -> list[Column]:
        t = F.col("total_trips")
        return [
            F.count(F.when(t.isNull(), F.lit(1))).alias("null_trips"),
            F.count(F.when(t < 0, F.lit(1))).alias("negative_trips"),
        ]

    d = daily.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("pickup_date_key").cast("long").alias("min_key"),
        F.max("pickup_date_key").cast("long").alias("max_key"),
        F.countDistinct("pickup_date_key").alias("keys_covered"),
        no_weekdays,
        *counters(daily),
        F.lit(None).cast("double").alias("avg_distance"),
    ).withColumn("mart", F.lit("mart_daily_summary"))
    h = hourly.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("hour_of_day").cast("long").alias("min_key"),
        F.max("hour_of_day").cast("long").alias("max_key"),
        F.countDistinct("hour_of_day").alias("keys_covered"),
        F.countDistinct("day_of_week").alias("weekdays_covered"),
        *counters(hourly),
        F.lit(None).cast("double").alias("avg_distance"),
    ).withColumn("mart", F.lit("mart_hourly_patterns"))
    z = zones.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(None).cast("long").alias("min_key"),
        F.lit(None).cast("long").alias("max_key"),
        F.countDistinct("pickup_zone_name").alias("keys_covered"),
        no_weekdays,
        *counters(zones),
        F.coalesce(round2(exact_avg("avg_distance_miles")), F.lit(0.0)).alias("avg_distance"),
    ).withColumn("mart", F.lit("mart_zone_performance"))
    out = d.unionByName(h).unionByName(z)
    status = F.when((F.col("null_trips") > 0) | (F.col("negative_trips") > 0), "WARNING").otherwise("PASSED")
    return out.select(
        "mart", "row_count", "min_key", "max_key", "keys_covered", "weekdays_covered", "null_trips", "negative_trips",
        "avg_distance", status.alias("status"),
    )
