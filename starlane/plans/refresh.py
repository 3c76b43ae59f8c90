"""Refresh the marts and the quality report from the stored fact (C16).

Upstream layers are not touched: the fact is read from its layer folder,
the three marts are rewritten, then the report is computed from the
written marts (read back, so it reports on what was stored).
"""

from __future__ import annotations

from starlane.operators import checks
from starlane.operators.incremental import read_fact
from starlane.plans.layers import Layout
from starlane.plans.trips import TripModel

MART_TABLES = ("mart_daily_summary", "mart_hourly_patterns", "mart_zone_performance")


def refresh_marts(model: TripModel, layout: Layout) -> dict[str, str]:
    spark = model.spark
    fact = read_fact(spark, layout.path("facts", "fct_trips"))
    paths = {
        "mart_daily_summary": layout.write(model.daily(fact), "marts", "mart_daily_summary"),
        "mart_hourly_patterns": layout.write(model.hourly(fact), "marts", "mart_hourly_patterns"),
        "mart_zone_performance": layout.write(model.zone_pairs(fact), "marts", "mart_zone_performance"),
    }
    daily, hourly, zones = (layout.read(spark, "marts", t) for t in MART_TABLES)
    paths["data_quality_report"] = layout.write(checks.quality_report(daily, hourly, zones), "marts", "data_quality_report")
    return paths
