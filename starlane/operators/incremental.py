"""Incremental fact load (C6): append past a high-water mark, upsert by key,
insert of new keys, or full refresh, into a snapshot table (``snapshots``)."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.functions.scalars import ntz
from starlane.operators.enrich import EnrichParams
from starlane.operators.facts import DEDUPE_ORDER, FACT_COLUMNS, build_fact_by_month
from starlane.operators.snapshots import DEFAULT_HIGH_WATER, PARTITION_COLUMN, FactTable, check_types, now, read_text, stamped, write_by_month

__all__ = [
    "DEFAULT_HIGH_WATER",
    "PARTITION_COLUMN",
    "check_types",
    "high_water",
    "insert_new",
    "load_incremental",
    "load_ledger",
    "read_fact",
    "table_exists",
    "write_fact",
]


def table_exists(spark: SparkSession, path: str) -> bool:
    """True once a load or a write to ``path`` has committed.

    Only a missing or empty folder means "no table"; anything else that
    keeps the table from being read is raised, so it is never overwritten
    for being unreadable.
    """
    if read_text(spark, f"{path.rstrip('/')}/_current") is not None:
        return True
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact as of its current snapshot, or as ``write_fact`` left it."""
    if read_text(spark, f"{path.rstrip('/')}/_current") is not None:
        return FactTable(spark, path).read()
    return spark.read.parquet(path).select(*FACT_COLUMNS)


def high_water(spark: SparkSession, path: str) -> datetime:
    """max(pickup_datetime) of the stored fact, or 1900-01-01 for an empty or
    missing one.

    Taken from the snapshot's metadata: no data file is opened (only of a
    table that ``write_fact`` left are the pickups read). One scalar reaches
    the driver and filters the next batch as a literal, so the comparison is
    pushed into the Parquet scan.
    """
    return FactTable(spark, path).high_water()


def write_fact(fact: DataFrame, path: str, mode: str = "overwrite", static: bool = True, balanced: bool = False) -> None:
    """Write the fact as a plain Parquet folder partitioned by pickup month
    (``write_by_month``)."""
    write_by_month(fact, path, mode, balanced, "static" if static else "dynamic")


def load_incremental(
    spark: SparkSession,
    target: str,
    enriched_batch: DataFrame,
    mode: str = "append",
    order=DEDUPE_ORDER,
    at: datetime | None = None,
    params: EnrichParams | None = None,
) -> str:
    """Load a batch of enriched trips into the stored fact at ``target``.

    - ``full``: the fact is rebuilt from the batch alone.
    - ``append``: keep only batch rows with pickup strictly after the
      target's high-water mark, key and dedupe them, append. Late rows and
      a late file of the other feed are skipped (one shared mark), exactly
      like the reference; re-running the same batch adds nothing.
    - ``upsert``: delete+insert on ``trip_id`` for the whole batch. Only the
      pieces of the touched months whose Bloom filter has a trip of the batch
      are read and written anew.

    Each load becomes visible at once, when the pointer moves to its
    snapshot; one that fails before leaves the table as it was. Rows carry
    the load's time (``at``, default now) as ``_loaded_at``. ``params``: those
    the batch was enriched with, so that its measures need not be shuffled.
    """
    if mode not in ("full", "append", "upsert"):
        raise ValueError(f"unknown mode {mode!r}")
    table, at = FactTable(spark, target), at or now()
    batch = stamped(enriched_batch, at)
    if mode == "full" or not table_exists(spark, target):
        table.replace(build_fact_by_month(batch, order, params), at, balanced=True)
    elif mode == "append":
        batch = batch.where(F.col("pickup_datetime") > ntz(table.high_water()))
        table.append(build_fact_by_month(batch, order, params), at, balanced=True)
    else:
        table.upsert(build_fact_by_month(batch, order, params), at, balanced=True)
    return target


def insert_new(
    spark: SparkSession,
    target: str,
    enriched_batch: DataFrame,
    order=DEDUPE_ORDER,
    at: datetime | None = None,
    params: EnrichParams | None = None,
) -> str:
    """Append the batch's trips whose ``trip_id`` the stored fact has not got.

    Complete whatever the order and size of batches, and safe to repeat: a
    trip's month is part of its key, so the stored pieces of the batch's
    months are asked, by their Bloom filters first. A batch of new trips
    reads no stored row.
    """
    at = at or now()
    fact = build_fact_by_month(stamped(enriched_batch, at), order, params)
    FactTable(spark, target).insert(fact, at, balanced=True)
    return target


def load_ledger(spark: SparkSession, target: str) -> DataFrame:
    """version, load, mode, loaded_at, rows_in, rows_added, rows_removed and
    rows_total of each load, and rows_live: rows it brought that are still
    in the fact."""
    table = FactTable(spark, target)
    live = table.read().groupBy(F.col("_loaded_at").alias("loaded_at")).agg(F.count(F.lit(1)).alias("rows_live"))
    loads = table.loads().where("mode <> 'merge'")
    return loads.join(live, "loaded_at", "left").select(*[c for c in loads.columns], F.coalesce("rows_live", F.lit(0)).alias("rows_live"))
