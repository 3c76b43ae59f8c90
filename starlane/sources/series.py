"""Generated series of dates (end exclusive) and literal rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_series(spark: SparkSession, start: date, end_exclusive: date, name: str = "date_day") -> DataFrame:
    """One row per day in [start, end_exclusive); empty if end <= start."""
    n_days = (end_exclusive - start).days
    return spark.range(0, max(n_days, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(name)
    )


def date_series_between(df: DataFrame, start: Column, end_inclusive: Column, name: str = "date_day") -> DataFrame:
    """Days from ``start`` to ``end_inclusive`` for each row of ``df`` (usually one
    aggregate row), so the range can come from the data without a collect."""
    return df.select(F.explode(F.sequence(start, end_inclusive)).alias(name))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few literal rows as a plan node of known size (so a join may broadcast
    it by bytes), without shipping Python data."""
    types = [part.rsplit(" ", 1) for part in schema.split(", ")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, types, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
