"""The trip star schema as one lazy composition.

raw feeds -> standardise -> union -> enrich -> fact (keyed, deduplicated)
-> dims -> marts -> quality -> serving. Every attribute is a lazy
DataFrame; nothing runs until an action, so Catalyst sees the whole chain
(prunes columns to the scan, pushes the window filter into Parquet).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.operators import dims, marts, serving
from starlane.operators.enrich import EnrichParams, enrich
from starlane.operators.facts import build_fact, build_fact_by_month, fact_rows
from starlane.operators.incremental import read_fact, write_fact
from starlane.operators.standardize import GREEN, YELLOW, Bounds, DateWindow, stage_zones, standardize, union_feeds
from starlane.session import configure, scratch_path
from starlane.sources import fixture
from starlane.sources.files import scan_feed
from starlane.sources.lookups import ZONE_SCHEMA, payment_types, rate_codes, read_lookup
from starlane.sources.tables import read_table


@dataclass(frozen=True)
class TripParams:
    """Thresholds and ranges. Defaults fit the driver tables (1995-2001);
    the reference's own window is 2024-10-01..2024-11-30 with a date
    dimension over 2020-01-01..2026-12-30."""

    window: DateWindow = DateWindow(date(1995, 6, 1), date(2001, 6, 30))
    bounds: Bounds = Bounds()
    enrich: EnrichParams = field(default_factory=EnrichParams)
    dim_date_start: date = date(1995, 1, 1)
    dim_date_end_exclusive: date = date(2001, 12, 31)
    min_route_trips: int = 10


@dataclass(frozen=True)
class TripSources:
    """A user's own feeds: Parquet files or folders per feed, whose column
    types may drift from file to file, and the zone lookup as CSV."""

    yellow: Sequence[str]
    green: Sequence[str]
    zones: str


class TripModel:
    """All layers of the trip star schema, over ``sources`` or, without them,
    over feeds derived from the driver tables in ``sf_dir``."""

    def __init__(
        self, spark: SparkSession, sf_dir: str | None = None, params: TripParams = TripParams(), sources: TripSources | None = None
    ):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.p = params
        self.sources = sources

    # -- sources -------------------------------------------------------
    @cached_property
    def landed(self) -> str:
        return fixture.land_trip_feeds(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        """Both landed feeds, with ``taxi_type``."""
        return self.spark.read.parquet(self.landed)

    @cached_property
    def raw_yellow(self) -> DataFrame:
        if self.sources:
            return scan_feed(self.spark, self.sources.yellow)
        return fixture.landed_feed(self.spark, self.landed, "yellow")

    @cached_property
    def raw_green(self) -> DataFrame:
        if self.sources:
            return scan_feed(self.spark, self.sources.green)
        return fixture.landed_feed(self.spark, self.landed, "green")

    @cached_property
    def zone_lookup(self) -> DataFrame:
        if self.sources:
            return read_lookup(self.spark, self.sources.zones, ZONE_SCHEMA)
        return fixture.location_lookup(self.spark, self.sf_dir)

    # -- staging / intermediate (views) --------------------------------
    @cached_property
    def stg_yellow(self) -> DataFrame:
        return standardize(self.raw_yellow, YELLOW, self.p.window, self.p.bounds)

    @cached_property
    def stg_green(self) -> DataFrame:
        return standardize(self.raw_green, GREEN, self.p.window, self.p.bounds)

    @cached_property
    def stg_zones(self) -> DataFrame:
        return stage_zones(self.zone_lookup)

    @cached_property
    def trips_union(self) -> DataFrame:
        return union_feeds(self.stg_yellow, self.stg_green)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.trips_union, self.p.enrich)

    # -- fact and dimensions -------------------------------------------
    @cached_property
    def fact_rows(self) -> DataFrame:
        return fact_rows(self.enriched)

    @cached_property
    def fact(self) -> DataFrame:
        return build_fact(self.enriched, params=self.p.enrich)

    @cached_property
    def dim_location(self) -> DataFrame:
        return dims.dim_location(self.stg_zones)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark, self.p.dim_date_start, self.p.dim_date_end_exclusive)

    @cached_property
    def dim_time(self) -> DataFrame:
        return dims.dim_time(self.spark)

    @cached_property
    def dim_rate_code(self) -> DataFrame:
        return dims.dim_rate_code(rate_codes(self.spark))

    @cached_property
    def dim_payment_type(self) -> DataFrame:
        return dims.dim_payment_type(payment_types(self.spark))

    # -- marts -----------------------------------------------------------
    def daily(self, fact: DataFrame | None = None) -> DataFrame:
        return marts.mart_daily(self.fact if fact is None else fact, self.dim_location)

    def hourly(self, fact: DataFrame | None = None) -> DataFrame:
        return marts.mart_hourly(self.fact if fact is None else fact, self.dim_date, self.dim_location)

    def zone_pairs(self, fact: DataFrame | None = None) -> DataFrame:
        return marts.mart_zone_pairs(self.fact if fact is None else fact, self.dim_location, self.p.min_route_trips)

    def stored_fact(self) -> DataFrame:
        """The fact built once, written to the checkpoint folder and read back."""
        return read_fact(self.spark, self.write_fact(scratch_path(self.spark, "fact")))

    def write_fact(self, path: str) -> str:
        write_fact(build_fact_by_month(self.enriched, params=self.p.enrich), path, balanced=True)
        return path

    # -- serving ---------------------------------------------------------
    def by_borough(self) -> DataFrame:
        return serving.revenue_by_borough(self.daily())

    def rush(self) -> DataFrame:
        return serving.rush_vs_off_peak(self.hourly())

    def top_routes(self, k: int = 5) -> DataFrame:
        return serving.top_routes(self.zone_pairs(), k)

    def airport_routes(self, pattern: str = "Airport", k: int = 5) -> DataFrame:
        return serving.routes_matching(self.zone_pairs(), pattern, k)

    # -- other tables ------------------------------------------------------
    @cached_property
    def events(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "events")


def usage_counts(fact: DataFrame, key: str, name: str = "trips") -> DataFrame:
    """Fact rows per foreign-key value (partially aggregated)."""
    return fact.groupBy(key).agg(F.count(F.lit(1)).alias(name))
