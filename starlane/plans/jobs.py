"""Driver-side job functions: the full build and the marts-only refresh.

These are plain functions over the operators (what a scheduler would call),
not a scheduler. ``run_all`` is the full pipeline job: landed feeds ->
staging views -> incremental fact -> dimensions -> marts -> quality report.
``refresh_marts`` (in ``plans.refresh``) is the marts-only job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starlane.operators.incremental import load_incremental
from starlane.plans.layers import Layout, register_view
from starlane.plans.refresh import refresh_marts
from starlane.plans.trips import TripModel


def run_all(model: TripModel, layout: Layout, mode: str = "append") -> DataFrame:
    """Build every layer under ``layout`` and return the stored quality report.

    Staging and intermediate layers stay lazy (temp views); the fact is
    loaded incrementally (``mode``: append / upsert / full); dimensions and
    marts are rewritten in full.
    """
    spark = model.spark
    register_view(model.stg_yellow, "staging", "stg_yellow_trips")
    register_view(model.stg_green, "staging", "stg_green_trips")
    register_view(model.stg_zones, "staging", "stg_taxi_zones")
    register_view(model.trips_union, "intermediate", "int_trips_union")
    register_view(model.enriched, "intermediate", "int_trips_enriched")
    load_incremental(spark, layout.path("facts", "fct_trips"), model.enriched, mode, params=model.p.enrich)
    layout.write(model.dim_date, "dimensions", "dim_date")
    layout.write(model.dim_time, "dimensions", "dim_time")
    layout.write(model.dim_location, "dimensions", "dim_location")
    layout.write(model.dim_rate_code, "dimensions", "dim_rate_code")
    layout.write(model.dim_payment_type, "dimensions", "dim_payment_type")
    refresh_marts(model, layout)
    return layout.read(spark, "marts", "data_quality_report")
