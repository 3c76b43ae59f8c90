"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and,
for each, ``ORACLE[name]``: DuckDB SQL over the same driver tables.

Every query reads the driver tables (or data Spark derives from them and
writes to the checkpoint folder) end to end, over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.operators import checks, dims, marts, serving
from starlane.operators.enrich import add_measures, filter_duration, filter_speed, with_seconds
from starlane.operators.facts import FACT_COLUMNS, TRIP_KEY_COLUMNS, dedupe, dedupe_report, with_trip_id
from starlane.operators.standardize import CANONICAL
from starlane.plans import oracle as O
from starlane.plans.trips import TripModel, usage_counts
from starlane.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

STD_OUT = [c for c in CANONICAL if c != "_loaded_at"]
FACT_OUT = [c for c in FACT_COLUMNS if c != "_loaded_at"]


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[TripModel], DataFrame]) -> Callable[[TripModel], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(TripModel(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


W = O.with_

# -- staging, union, enrich ------------------------------------------------


@register("standardize_feed", W(*O.STAGED) + f"select {O.STD_COLUMNS} from stg_yellow")
def q_standardize_feed(m: TripModel) -> DataFrame:
    return m.stg_yellow.select(*STD_OUT)


@register("standardize_two_feeds", W(*O.STAGED) + f"select {O.STD_COLUMNS} from stg_green")
def q_standardize_green(m: TripModel) -> DataFrame:
    return m.stg_green.select(*STD_OUT)


@register(
    "union_feeds",
    W(*O.STAGED, "trips_union as (select * from stg_yellow union all select * from stg_green)")
    + f"select {O.STD_COLUMNS} from trips_union",
)
def q_union(m: TripModel) -> DataFrame:
    return m.trips_union.select(*STD_OUT)


ENRICHED_OUT = STD_OUT + ["trip_duration_minutes", "tip_percentage", "avg_speed_mph", "fare_per_mile"]
ENRICHED_COLS_SQL = O.STD_COLUMNS + ", trip_duration_minutes, tip_percentage, avg_speed_mph, fare_per_mile"


@register("enrich_trips", W(*O.CHAIN) + f"select {ENRICHED_COLS_SQL} from enriched")
def q_enrich(m: TripModel) -> DataFrame:
    return m.enriched.select(*ENRICHED_OUT)


@register(
    "guarded_ratios",
    W(*O.STAGED, "trips_union as (select * from stg_yellow union all select * from stg_green)")
    + f"select {ENRICHED_COLS_SQL} from (select *, {O.MEASURES} from trips_union) x",
)
def q_guarded_ratios(m: TripModel) -> DataFrame:
    return add_measures(with_seconds(m.trips_union)).select(*ENRICHED_OUT)


@register(
    "duration_filter",
    W(*O.CHAIN) + f"select {ENRICHED_COLS_SQL} from enriched_d",
)
def q_duration_filter(m: TripModel) -> DataFrame:
    return add_measures(with_seconds(filter_duration(m.trips_union))).select(*ENRICHED_OUT)


@register(
    "speed_cap",
    W(*O.STAGED, "trips_union as (select * from stg_yellow union all select * from stg_green)")
    + f"select {ENRICHED_COLS_SQL} from (select *, {O.MEASURES} from trips_union) x "
    "where avg_speed_mph is null or avg_speed_mph <= 100",
)
def q_speed_cap(m: TripModel) -> DataFrame:
    return add_measures(filter_speed(with_seconds(m.trips_union))).select(*ENRICHED_OUT)


# -- key, dedupe, fact -------------------------------------------------------

KEY_COLS_SQL = ", ".join(TRIP_KEY_COLUMNS)


@register("surrogate_key", W(*O.CHAIN) + f"select {O.key_sql()} as trip_id, {KEY_COLS_SQL} from enriched")
def q_surrogate_key(m: TripModel) -> DataFrame:
    return with_trip_id(m.enriched).select("trip_id", *TRIP_KEY_COLUMNS)


@register(
    "dedupe_first",
    W(*O.CHAIN, f"k as (select {O.key_sql()} as trip_id, * from enriched)")
    + "select trip_id, taxi_type, pickup_datetime, payment_type_id, rate_code_id, passenger_count from ("
    "select *, row_number() over (partition by trip_id order by " + O.DEDUPE_ORDER_SQL + ") rn from k) r "
    "where rn = 1",
)
def q_dedupe_first(m: TripModel) -> DataFrame:
    keyed = with_trip_id(m.enriched)
    return dedupe(keyed, ["trip_id"], ["payment_type_id", "rate_code_id", "passenger_count"]).select(
        "trip_id", "taxi_type", "pickup_datetime", "payment_type_id", "rate_code_id", "passenger_count"
    )


@register(
    "dedupe_dropped_count",
    W(*O.FACT_CHAIN)
    + "select count(*) as rows_in, count(distinct trip_id) as rows_out, "
    "count(*) - count(distinct trip_id) as rows_dropped from fact_keyed",
)
def q_dedupe_count(m: TripModel) -> DataFrame:
    return dedupe_report(m.fact_rows, ["trip_id"])


@register("fact_trips", W(*O.FACT_CHAIN) + f"select {O.FACT_COLS} from fact")
def q_fact(m: TripModel) -> DataFrame:
    return m.fact.select(*FACT_OUT)


# -- marts ---------------------------------------------------------------------


@register("mart_daily", W(*O.MART_CHAIN) + "select * from mart_daily")
def q_mart_daily(m: TripModel) -> DataFrame:
    return m.daily()


@register("mart_hourly", W(*O.MART_CHAIN) + "select * from mart_hourly")
def q_mart_hourly(m: TripModel) -> DataFrame:
    return m.hourly()


@register("mart_zone_pairs", W(*O.MART_CHAIN) + "select * from mart_zone")
def q_mart_zone(m: TripModel) -> DataFrame:
    return m.zone_pairs()


@register(
    "mart_hourly_events",
    "select extract(dayofweek from ts)::integer as day_of_week, "
    "((cast(strftime(ts, '%H') as integer) * 100 + cast(strftime(ts, '%M') as integer)) // 100)::integer as hour_of_day, "
    f"event_type, count(*) as total_events, {O.xsum('value')} as total_value, {O.xavg('value')} as avg_value "
    "from events group by 1, 2, 3",
)
def q_mart_events(m: TripModel) -> DataFrame:
    return marts.mart_hourly_events(m.events)


# -- serving -----------------------------------------------------------------------


@register(
    "serve_by_borough",
    W(*O.MART_CHAIN)
    + f"select borough, sum(total_trips)::bigint as trips, {O.xsum('total_revenue')} as revenue, "
    f"{O.xavg('avg_fare_amount')} as avg_fare from mart_daily "
    "where borough is not null and borough not in ('Unknown', 'N/A', 'EWR') group by borough",
)
def q_by_borough(m: TripModel) -> DataFrame:
    return m.by_borough()


@register(
    "serve_by_borough_weighted",
    W(*O.MART_CHAIN)
    + f"select borough, sum(total_trips)::bigint as trips, {O.xsum('total_revenue')} as revenue, "
    "round(sum(total_fare_amount::decimal(18,2))::double / sum(total_trips), 2) as avg_fare from mart_daily "
    "where borough is not null and borough not in ('Unknown', 'N/A', 'EWR') group by borough",
)
def q_by_borough_weighted(m: TripModel) -> DataFrame:
    return serving.revenue_by_borough_weighted(m.daily())


@register(
    "serve_rush",
    W(*O.MART_CHAIN)
    + "select case when hour_of_day between 7 and 9 then 'Morning Rush (7-9 AM)' "
    "when hour_of_day between 17 and 19 then 'Evening Rush (5-7 PM)' else 'Off-Peak' end as period, "
    "sum(total_trips)::bigint as trips, "
    "round(sum(avg_speed_mph::decimal(18,2))::double / count(avg_speed_mph), 1) as avg_speed, "
    f"{O.xavg('avg_fare_amount')} as avg_fare from mart_hourly group by 1",
)
def q_rush(m: TripModel) -> DataFrame:
    return m.rush()


@register(
    "serve_top_routes",
    W(*O.MART_CHAIN)
    + "select pickup_zone_name, dropoff_zone_name, total_trips, round(total_revenue, 2) as revenue "
    f"from mart_zone order by {O.ROUTE_ORDER} limit 5",
)
def q_top_routes(m: TripModel) -> DataFrame:
    return m.top_routes(5)


def _airport_sql(pattern: str) -> str:
    return W(*O.MART_CHAIN) + (
        "select pickup_zone_name, dropoff_zone_name, total_trips, round(avg_fare_amount, 2) as avg_fare, "
        "round(avg_tip_percentage, 1) as tip_pct from mart_zone "
        f"where pickup_zone_name like '%{pattern}%' or dropoff_zone_name like '%{pattern}%' "
        f"order by {O.ROUTE_ORDER} limit 5"
    )


@register("serve_airport", _airport_sql("Airport"))
def q_airport(m: TripModel) -> DataFrame:
    return m.airport_routes("Airport", 5)


@register("serve_zone_match", _airport_sql("1"))
def q_zone_match(m: TripModel) -> DataFrame:
    """The same LIKE '%..%' top-k with a pattern the driver tables' zones
    hit (zone names are NATION_0..NATION_24)."""
    return m.airport_routes("1", 5)


# -- dimensions (each with its usage by the fact, so the work grows with it) --


def _with_usage(dim: DataFrame, dim_key: str, fact: DataFrame, fact_key: str) -> DataFrame:
    used = usage_counts(fact, fact_key).withColumnRenamed(fact_key, dim_key)
    return dim.join(used, dim_key, "left").withColumn("trips", F.coalesce("trips", F.lit(0)).cast("long"))


def _usage_sql(dim_cte: str, dim_key: str, fact_key: str) -> str:
    return (
        f"select d.*, coalesce(u.trips, 0)::bigint as trips from {dim_cte} d left join "
        f"(select {fact_key} as k, count(*) as trips from fact group by 1) u on d.{dim_key} = u.k"
    )


@register(
    "dim_date",
    W(
        *O.FACT_CHAIN,
        "span as (select min(pickup_datetime)::date as lo, max(pickup_datetime)::date as hi from fact)",
        "days as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as d from span)",
        f"dd as ({O.date_attrs('days')})",
    )
    + _usage_sql("dd", "date_key", "pickup_date_key"),
)
def q_dim_date(m: TripModel) -> DataFrame:
    """Date dimension spanning the fact's pickup days (range from the data)."""
    fact = m.stored_fact()
    return _with_usage(dims.dim_date_spanning(fact, "pickup_datetime"), "date_key", fact, "pickup_date_key")


@register("dim_time", W(*O.FACT_CHAIN, O.DIM_TIME) + _usage_sql("dim_time", "time_key", "pickup_time_key"))
def q_dim_time(m: TripModel) -> DataFrame:
    return _with_usage(m.dim_time, "time_key", m.fact, "pickup_time_key")


@register(
    "dim_location",
    W(*O.FACT_CHAIN, O.DIM_LOCATION) + _usage_sql("dim_location", "location_id", "pickup_location_id"),
)
def q_dim_location(m: TripModel) -> DataFrame:
    """Zone lookup written as a quoted CRLF CSV, read back with a declared
    schema, staged, plus the Unknown member."""
    from starlane.operators.standardize import stage_zones
    from starlane.sources.lookups import ZONE_SCHEMA, read_lookup, write_lookup

    path = write_lookup(m.zone_lookup, scratch_path(m.spark, "zone-lookup"))
    dim = dims.dim_location(stage_zones(read_lookup(m.spark, path, ZONE_SCHEMA)))
    return _with_usage(dim, "location_id", m.fact, "pickup_location_id")


def _dim_lookup_sql() -> str:
    return W(*O.FACT_CHAIN, O.RATE_CODES, O.PAYMENT_TYPES) + (
        "select 'rate_code' as lookup, rc.id::integer as id, rc.name, coalesce(u.trips, 0)::bigint as trips "
        "from rc left join (select rate_code_id as k, count(*) as trips from fact group by 1) u on rc.id = u.k "
        "union all "
        "select 'payment_type', pt.id::integer, pt.name, coalesce(u.trips, 0)::bigint "
        "from pt left join (select payment_type_id as k, count(*) as trips from fact group by 1) u on pt.id = u.k"
    )


@register("dim_lookup", _dim_lookup_sql())
def q_dim_lookup(m: TripModel) -> DataFrame:
    """Rate-code and payment-type dimensions with their fact usage; both
    seeds go through the CSV reader (written quoted, read with a schema)."""
    from starlane.sources.lookups import (
        PAYMENT_TYPE_SCHEMA, RATE_CODE_SCHEMA, payment_types, rate_codes, read_lookup, write_lookup,
    )

    root, fact = scratch_path(m.spark, "seeds"), m.stored_fact()
    rc_seed = read_lookup(m.spark, write_lookup(rate_codes(m.spark), f"{root}/rate_codes"), RATE_CODE_SCHEMA)
    pt_seed = read_lookup(m.spark, write_lookup(payment_types(m.spark), f"{root}/payment_types"), PAYMENT_TYPE_SCHEMA)
    rc = _with_usage(dims.dim_rate_code(rc_seed), "rate_code_id", fact, "rate_code_id").select(
        F.lit("rate_code").alias("lookup"), F.col("rate_code_id").alias("id"), F.col("rate_code_name").alias("name"),
        "trips",
    )
    pt = _with_usage(dims.dim_payment_type(pt_seed), "payment_type_id", fact, "payment_type_id").select(
        F.lit("payment_type").alias("lookup"), F.col("payment_type_id").alias("id"),
        F.col("payment_name").alias("name"), "trips",
    )
    return rc.unionByName(pt)


# -- data-quality checks ---------------------------------------------------------


@register(
    "check_not_null",
    W(*O.STAGED) + f"select {O.STD_COLUMNS} from stg_yellow where pickup_location_id is null",
)
def q_check_not_null(m: TripModel) -> DataFrame:
    return checks.not_null(m.stg_yellow, "pickup_location_id").select(*STD_OUT)


@register(
    "check_unique",
    W(*O.FACT_CHAIN)
    + "select trip_id, count(*) as n_records from fact_keyed where trip_id is not null "
    "group by trip_id having count(*) > 1",
)
def q_check_unique(m: TripModel) -> DataFrame:
    """Trip ids repeated before deduplication."""
    return checks.unique(m.fact_rows, "trip_id")


@register(
    "check_accepted_values",
    W(*O.STAGED, "trips_union as (select * from stg_yellow union all select * from stg_green)")
    + "select taxi_type as value_field, count(*) as n_records from trips_union "
    "where taxi_type is not null and taxi_type not in ('yellow') group by 1",
)
def q_check_accepted_values(m: TripModel) -> DataFrame:
    """The yellow-staging rule (taxi_type in {yellow}) applied to the union."""
    return checks.accepted_values(m.trips_union, "taxi_type", ["yellow"])


@register(
    "check_relationships",
    W(*O.FACT_CHAIN, O.DIM_LOCATION)
    + f"select {O.FACT_COLS} from fact f where pickup_location_id is not null and not exists "
    "(select 1 from dim_location d where d.location_id = f.pickup_location_id)",
)
def q_check_relationships(m: TripModel) -> DataFrame:
    return checks.relationships(m.fact, "pickup_location_id", m.dim_location, "location_id").select(*FACT_OUT)


@register(
    "check_accepted_range",
    W(*O.MART_CHAIN) + "select * from mart_hourly where hour_of_day is not null and not (hour_of_day between 5 and 22)",
)
def q_check_accepted_range(m: TripModel) -> DataFrame:
    """The range rule with bounds that some hours of the fixture violate."""
    return checks.accepted_range(m.hourly(), "hour_of_day", 5, 22)


@register(
    "check_non_negative",
    W(O.FIXTURE, O.raw_feed("yellow")) + "select * from raw_yellow where trip_distance < 0",
)
def q_check_non_negative(m: TripModel) -> DataFrame:
    """The positive_value test on the raw yellow feed (zero passes)."""
    return checks.non_negative(m.raw_yellow, "trip_distance")


FACT_NOT_NULL = [
    "trip_id", "pickup_date_key", "pickup_time_key", "dropoff_date_key", "dropoff_time_key",
    "pickup_location_id", "dropoff_location_id", "rate_code_id", "payment_type_id", "taxi_type",
    "trip_distance", "trip_duration_minutes", "fare_amount", "tip_amount", "total_amount",
]


def _suite_checks():
    return (
        [checks.not_null_check(c) for c in FACT_NOT_NULL]
        + [checks.accepted_values_check("taxi_type", ["yellow", "green"])]
        + [checks.non_negative_check(c) for c in ("trip_distance", "fare_amount", "tip_percentage")]
        + [checks.range_check("pickup_time_key", 0, 2359), checks.range_check("passenger_count", 1, 4)]
    )


def _suite_sql() -> str:
    parts = [f"select 'not_null' as check_name, '{c}' as column_name, count(*) filter (where {c} is null) as failures from fact" for c in FACT_NOT_NULL]
    parts.append("select 'accepted_values', 'taxi_type', count(*) filter (where taxi_type is not null and taxi_type not in ('yellow', 'green')) from fact")
    parts += [f"select 'non_negative', '{c}', count(*) filter (where {c} < 0) from fact" for c in ("trip_distance", "fare_amount", "tip_percentage")]
    parts.append("select 'accepted_range', 'pickup_time_key', count(*) filter (where pickup_time_key < 0 or pickup_time_key > 2359) from fact")
    parts.append("select 'accepted_range', 'passenger_count', count(*) filter (where passenger_count < 1 or passenger_count > 4) from fact")
    return W(*O.FACT_CHAIN) + " union all ".join(parts)


@register("check_suite", _suite_sql())
def q_check_suite(m: TripModel) -> DataFrame:
    """All fact checks in one scan."""
    return checks.check_suite(m.fact, _suite_checks())


@register("quality_report", O.quality_sql())
def q_quality(m: TripModel) -> DataFrame:
    """The report on marts stored from one build of the fact."""
    fact = m.stored_fact()
    root = scratch_path(m.spark, "marts")
    stored = []
    for name, mart in (("daily", m.daily(fact)), ("hourly", m.hourly(fact)), ("zones", m.zone_pairs(fact))):
        mart.write.parquet(f"{root}/{name}")
        stored.append(m.spark.read.parquet(f"{root}/{name}"))
    return checks.quality_report(*stored)


# -- incremental loads (each writes a fact under the checkpoint root) -------------


def _pu(ts: str):
    from starlane.functions.scalars import ntz

    return ntz(ts)


def _inc_sql(b1: str, b2: str, final: str) -> str:
    return W(
        *O.CHAIN,
        f"b1 as (select * from enriched where {b1})",
        f"b2 as (select * from enriched where {b2})",
        O.fact_from("b1", "f1"),
        "hw as (select coalesce(max(pickup_datetime), timestamp '1900-01-01') as m from f1)",
        "b2n as (select * from b2 where pickup_datetime > (select m from hw))",
        O.fact_from("b2n", "f2"),
        O.fact_from("b2", "f2all"),
    ) + final


@register(
    "incremental_append",
    _inc_sql(
        "pickup_datetime < timestamp '1999-01-01'",
        "pickup_datetime >= timestamp '1999-01-01'",
        f"select {O.FACT_COLS} from f1 union all select {O.FACT_COLS} from f2",
    ),
)
def q_incremental_append(m: TripModel) -> DataFrame:
    """First load, then an appended batch, then the same batch again (adds 0 rows)."""
    from starlane.operators.incremental import load_incremental, read_fact

    target = scratch_path(m.spark, "fact-append")
    pu = F.col("pickup_datetime")
    load_incremental(m.spark, target, m.enriched.where(pu < _pu("1999-01-01")), "append", params=m.p.enrich)
    batch = m.enriched.where(pu >= _pu("1999-01-01"))
    load_incremental(m.spark, target, batch, "append", params=m.p.enrich)
    load_incremental(m.spark, target, batch, "append", params=m.p.enrich)
    return read_fact(m.spark, target).select(*FACT_OUT)


@register(
    "incremental_late_rows",
    _inc_sql(
        "(taxi_type = 'yellow' and pickup_datetime < timestamp '1999-01-01') "
        "or (taxi_type = 'green' and pickup_datetime < timestamp '1998-01-01')",
        "pickup_datetime >= timestamp '1998-01-01'",
        f"select {O.FACT_COLS} from f1 union all select {O.FACT_COLS} from f2",
    ),
)
def q_incremental_late(m: TripModel) -> DataFrame:
    """The green feed lags a year; its late rows fall under the shared
    high-water mark and are skipped, as in the reference."""
    from starlane.operators.incremental import load_incremental, read_fact

    target = scratch_path(m.spark, "fact-late")
    pu, tt = F.col("pickup_datetime"), F.col("taxi_type")
    first = ((tt == "yellow") & (pu < _pu("1999-01-01"))) | ((tt == "green") & (pu < _pu("1998-01-01")))
    load_incremental(m.spark, target, m.enriched.where(first), "append", params=m.p.enrich)
    load_incremental(m.spark, target, m.enriched.where(pu >= _pu("1998-01-01")), "append", params=m.p.enrich)
    return read_fact(m.spark, target).select(*FACT_OUT)


@register(
    "incremental_upsert",
    _inc_sql(
        "pickup_datetime < timestamp '1999-01-01'",
        "pickup_datetime >= timestamp '1998-07-01'",
        f"select {O.FACT_COLS} from f1 where trip_id not in (select trip_id from f2all) "
        f"union all select {O.FACT_COLS} from f2all",
    ),
)
def q_incremental_upsert(m: TripModel) -> DataFrame:
    """Delete+insert by trip_id with an overlapping second batch (late rows kept)."""
    from starlane.operators.incremental import load_incremental, read_fact

    target = scratch_path(m.spark, "fact-upsert")
    pu = F.col("pickup_datetime")
    load_incremental(m.spark, target, m.enriched.where(pu < _pu("1999-01-01")), "upsert", params=m.p.enrich)
    load_incremental(m.spark, target, m.enriched.where(pu >= _pu("1998-07-01")), "upsert", params=m.p.enrich)
    return read_fact(m.spark, target).select(*FACT_OUT)


@register(
    "load_ledger",
    W(
        *O.CHAIN,
        "b1 as (select * from enriched where pickup_datetime < timestamp '1998-07-01')",
        "b2 as (select * from enriched where pickup_datetime >= timestamp '1998-01-01')",
        O.fact_from("b1", "f1"),
        "b2n as (select * from b2 where pickup_datetime > (select max(pickup_datetime) from f1))",
        O.fact_from("b2n", "f2"),
        O.fact_from("b2", "f3"),
        """counts as (select (select count(*) from f1) as a, (select count(*) from f2) as n, (select count(*) from f3) as c,
          (select count(*) from f1 where trip_id in (select trip_id from f3)) as gone)""",
    )
    + """select 1::bigint as version, 'full' as mode, a as rows_in, a as rows_added, 0::bigint as rows_removed, a as rows_total,
      a - gone as rows_live, 0::bigint as stray_rows from counts
    union all select 2, 'append', n, n, 0, a + n, 0, 0 from counts
    union all select 3, 'append', 0, 0, 0, a + n, 0, 0 from counts
    union all select 4, 'upsert', c, c, gone + n, a - gone + c, c, 0 from counts""",
)
def q_load_ledger(m: TripModel) -> DataFrame:
    """What each load brought, took out and still has in the fact: a first load,
    an appended batch, the same again (adds nothing), an upsert over both; and
    the rows whose load time is no load's."""
    from starlane.operators.incremental import load_incremental, load_ledger, read_fact

    target = scratch_path(m.spark, "fact-ledger")
    pu = F.col("pickup_datetime")
    batch = m.enriched.where(pu >= _pu("1998-01-01"))
    load_incremental(m.spark, target, m.enriched.where(pu < _pu("1998-07-01")), "append", params=m.p.enrich)
    for mode in ("append", "append", "upsert"):
        load_incremental(m.spark, target, batch, mode, params=m.p.enrich)
    ledger = load_ledger(m.spark, target)
    known = ledger.select(F.col("loaded_at").alias("_loaded_at"))
    stray = read_fact(m.spark, target).join(known, "_loaded_at", "left_anti").count()
    columns = ["version", "mode", "rows_in", "rows_added", "rows_removed", "rows_total", "rows_live"]
    return ledger.select(*columns, F.lit(stray).cast("long").alias("stray_rows"))


@register(
    "exact_sums_wide",
    """
    with v as (select l_returnflag, l_linestatus, (l_orderkey * 8 + l_linenumber) % 16777216 as k from lineitem)
    select l_returnflag, l_linestatus, 3 * count(*) as n_values, sum(k % 1000 + 1)::bigint as small_units, sum(k % 1000 + 1)::bigint as left_units
    from v group by l_returnflag, l_linestatus
    """,
)
def q_exact_sums_wide(m: TripModel) -> DataFrame:
    """Sums of values from 1e-12 to 1e16: the large ones cancel, and what is left
    is the small ones' sum to the last unit (2^-40)."""
    from starlane.functions.scalars import exact_sum
    from starlane.sources.tables import read_table

    k = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) % 16777216
    large, small = k * F.lit(2.0**30), (k % 1000 + 1) * F.lit(2.0**-40)
    rows = read_table(m.spark, m.sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.explode(F.array(large, -large, small)).alias("v"))
    units = lambda x: F.rint(x * F.lit(2.0**40)).cast("long")
    sums = rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("v").alias("n_values"),
        exact_sum(F.when(F.abs("v") < 1, F.col("v"))).alias("small_sum"),
        exact_sum("v").alias("all_sum"),
    )
    return sums.select("l_returnflag", "l_linestatus", "n_values", units(F.col("small_sum")).alias("small_units"), units(F.col("all_sum")).alias("left_units"))


@register("full_refresh", W(*O.FACT_CHAIN) + f"select {O.FACT_COLS} from fact")
def q_full_refresh(m: TripModel) -> DataFrame:
    """A partial load, then a full refresh that rebuilds from all trips."""
    from starlane.operators.incremental import load_incremental, read_fact

    target = scratch_path(m.spark, "fact-full")
    load_incremental(m.spark, target, m.enriched.where(F.col("pickup_datetime") < _pu("1997-01-01")), "full", params=m.p.enrich)
    load_incremental(m.spark, target, m.enriched, "full", params=m.p.enrich)
    return read_fact(m.spark, target).select(*FACT_OUT)


# -- files: month selection, manifest, schema drift, samples, lookups ------------


@register(
    "month_files",
    "with span as (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders), "
    "months as (select unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), interval 1 month)) as m from span), "
    "feeds as (select unnest(['yellow', 'green']) as feed) "
    "select feed, year(m)::integer as year, month(m)::integer as month, "
    "feed || '_tripdata_' || strftime(m, '%Y-%m') || '.parquet' as file_name from months, feeds",
)
def q_month_files(m: TripModel) -> DataFrame:
    """Expected monthly files of both feeds over the months the orders span."""
    from starlane.sources.files import expected_files
    from starlane.sources.tables import read_table

    span = read_table(m.spark, m.sf_dir, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return expected_files(span, F.col("lo"), F.col("hi"), ["yellow", "green"])


@register(
    "file_manifest",
    W(O.FIXTURE)
    + ", months as (select unnest(generate_series(date '1995-01-01', date '2001-12-01', interval 1 month)) as m), "
    "feeds as (select unnest(['yellow', 'green']) as feed), "
    "present as (select distinct taxi_type as feed, strftime(pickup_datetime, '%Y-%m') as ym from raw "
    "where pickup_datetime is not null) "
    "select f.feed, year(m)::integer as year, month(m)::integer as month, "
    "f.feed || '_tripdata_' || strftime(m, '%Y-%m') || '.parquet' as file_name, "
    "exists (select 1 from present p where p.feed = f.feed and p.ym = strftime(m, '%Y-%m')) as file_present "
    "from months, feeds f",
)
def q_file_manifest(m: TripModel) -> DataFrame:
    """Raw trips landed by feed and month, then checked against the expected
    months 1995-01..2001-12 (sizes vary by writer, so only presence is output)."""
    from starlane.sources.files import expected_files_between, file_manifest, land_feed

    root = land_feed(m.raw, scratch_path(m.spark, "landing"))
    expected = expected_files_between(m.spark, "1995-01", "2001-12", ["yellow", "green"])
    return file_manifest(m.spark, root, expected).select("feed", "year", "month", "file_name", "file_present")


RAW_ORDER = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "VendorID", "PULocationID", "DOLocationID", "payment_type",
    "RatecodeID", "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount",
]


@register(
    "sample_slice",
    W(O.FIXTURE, O.raw_feed("yellow"))
    + "select * from raw_yellow where tpep_pickup_datetime >= timestamp '1996-03-01' "
    "and tpep_pickup_datetime < timestamp '1996-04-01' order by "
    + ", ".join(f"{c} asc nulls last" for c in RAW_ORDER)
    + " limit 500",
)
def q_sample_slice(m: TripModel) -> DataFrame:
    """First 500 yellow trips of 1996-03 under a total order, written and read back."""
    from starlane.sources.files import sample_slice

    pu = F.col("tpep_pickup_datetime")
    month = m.raw_yellow.where((pu >= _pu("1996-03-01")) & (pu < _pu("1996-04-01")))
    path = scratch_path(m.spark, "sample")
    sample_slice(month, 500, RAW_ORDER, path)
    return m.spark.read.parquet(path).select(*m.raw_yellow.columns)


@register(
    "lookup_count",
    "select count(*) as n_rows from nation join region on n_regionkey = r_regionkey",
)
def q_lookup_count(m: TripModel) -> DataFrame:
    """Data rows of the zone lookup CSV (records, header excluded)."""
    from starlane.sources.lookups import ZONE_SCHEMA, read_lookup, write_lookup

    path = write_lookup(m.zone_lookup, scratch_path(m.spark, "zone-csv"))
    return read_lookup(m.spark, path, ZONE_SCHEMA).agg(F.count(F.lit(1)).alias("n_rows"))


@register("mixed_schema_scan", W(*O.STAGED) + f"select {O.STD_COLUMNS} from stg_yellow")
def q_mixed_schema(m: TripModel) -> DataFrame:
    """Yellow trips landed as two files whose types drift (RatecodeID and
    passenger_count double vs bigint, Airport_fee vs airport_fee), scanned
    by schema group, then standardised."""
    from starlane.operators.standardize import YELLOW, standardize
    from starlane.sources.files import scan_feed

    root = scratch_path(m.spark, "drift")
    y = m.raw_yellow
    early = F.year("tpep_pickup_datetime") < 1998
    (
        y.where(early)
        .withColumn("RatecodeID", F.col("RatecodeID").cast("double"))
        .withColumn("passenger_count", F.col("passenger_count").cast("double"))
        .withColumn("Airport_fee", F.lit(None).cast("double"))
        .write.parquet(f"{root}/yellow_a.parquet")
    )
    (
        y.where(~early | early.isNull())
        .withColumn("RatecodeID", F.col("RatecodeID").cast("bigint"))
        .withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        .withColumn("airport_fee", F.lit(None).cast("double"))
        .write.parquet(f"{root}/yellow_b.parquet")
    )
    scanned = scan_feed(m.spark, [f"{root}/yellow_a.parquet", f"{root}/yellow_b.parquet"])
    return standardize(scanned, YELLOW, m.p.window).select(*STD_OUT)


# -- layered tables and mart refresh ----------------------------------------------------


def _layers_sql() -> str:
    return W(*O.MART_CHAIN, O.DIM_TIME) + " union all ".join(
        f"select '{layer}' as layer, '{name}' as table_name, count(*) as row_count from {cte}"
        for layer, name, cte in [
            ("staging", "stg_yellow_trips", "stg_yellow"),
            ("staging", "stg_green_trips", "stg_green"),
            ("intermediate", "int_trips_enriched", "enriched"),
            ("dimensions", "dim_date", "dim_date"),
            ("dimensions", "dim_time", "dim_time"),
            ("dimensions", "dim_location", "dim_location"),
            ("facts", "fct_trips", "fact"),
            ("marts", "mart_daily_summary", "mart_daily"),
            ("marts", "mart_hourly_patterns", "mart_hourly"),
            ("marts", "mart_zone_performance", "mart_zone"),
        ]
    )


@register("layered_tables", _layers_sql())
def q_layered_tables(m: TripModel) -> DataFrame:
    """Views for staging/intermediate, tables for dims, fact and marts, one
    folder per layer; row counts read back from each."""
    from starlane.operators.incremental import PARTITION_COLUMN
    from starlane.plans.layers import Layout, register_view

    lay = Layout(scratch_path(m.spark, "layers"))
    views = {
        ("staging", "stg_yellow_trips"): m.stg_yellow,
        ("staging", "stg_green_trips"): m.stg_green,
        ("intermediate", "int_trips_enriched"): m.enriched,
    }
    parts = []
    for (layer, name), df in views.items():
        view = register_view(df, layer, name)
        parts.append(m.spark.table(view).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"))
    for name, df in [("dim_date", m.dim_date), ("dim_time", m.dim_time), ("dim_location", m.dim_location)]:
        lay.write(df, "dimensions", name)
    m.write_fact(lay.path("facts", "fct_trips"))
    fact = lay.read(m.spark, "facts", "fct_trips").drop(PARTITION_COLUMN)
    lay.write(m.daily(fact), "marts", "mart_daily_summary")
    lay.write(m.hourly(fact), "marts", "mart_hourly_patterns")
    lay.write(m.zone_pairs(fact), "marts", "mart_zone_performance")
    for layer, name in [
        ("dimensions", "dim_date"), ("dimensions", "dim_time"), ("dimensions", "dim_location"),
        ("facts", "fct_trips"), ("marts", "mart_daily_summary"), ("marts", "mart_hourly_patterns"),
        ("marts", "mart_zone_performance"),
    ]:
        parts.append(lay.read(m.spark, layer, name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("refresh_marts", O.quality_sql())
def q_refresh_marts(m: TripModel) -> DataFrame:
    """Marts and the quality report rebuilt from the stored fact only."""
    from starlane.plans.layers import Layout
    from starlane.plans.refresh import refresh_marts

    lay = Layout(scratch_path(m.spark, "refresh"))
    m.write_fact(lay.path("facts", "fct_trips"))
    refresh_marts(m, lay)
    return lay.read(m.spark, "marts", "data_quality_report")


# -- streaming (optional extension) --------------------------------------------------


@register(
    "stream_dedupe",
    W(*O.FACT_CHAIN)
    + "select distinct trip_id, pickup_date_key, pickup_time_key, dropoff_date_key, dropoff_time_key, "
    "pickup_location_id, dropoff_location_id, taxi_type, vendor_id, passenger_count, trip_distance, "
    "fare_amount, tip_amount, total_amount, pickup_datetime, dropoff_datetime from fact_ranked",
)
def q_stream_dedupe(m: TripModel) -> DataFrame:
    """Both landed feeds read as streams a few files at a time, each batch
    inserted where the stored fact lacks its trips, and read back. Only
    columns fixed by the key are output (which duplicate survives a stream
    is arrival order)."""
    from starlane.operators.incremental import read_fact
    from starlane.operators.standardize import GREEN, YELLOW
    from starlane.streaming.trips_stream import STREAM_COLUMNS, enriched_stream, read_feed_stream, run_available_now

    def feed(tag, spec):
        prefix = "tpep" if tag == "yellow" else "lpep"
        df = read_feed_stream(m.spark, f"{m.landed}/taxi_type={tag}", max_files_per_trigger=2).withColumnsRenamed(
            {"pickup_datetime": f"{prefix}_pickup_datetime", "dropoff_datetime": f"{prefix}_dropoff_datetime"}
        )
        return df, spec

    base = scratch_path(m.spark, "stream")
    stream = enriched_stream([feed("yellow", YELLOW), feed("green", GREEN)], m.p.window, params=m.p.enrich)
    run_available_now(stream, f"{base}/fact", f"{base}/checkpoint", m.p.enrich)
    return read_fact(m.spark, f"{base}/fact").select(*STREAM_COLUMNS)


# -- the reference's 75 data tests over all layers ------------------------------------


def _reference_tests_sql() -> str:
    T = O
    cte_of = {
        "stg_yellow_trips": "stg_yellow", "stg_green_trips": "stg_green", "stg_taxi_zones": "stg_zones",
        "int_trips_union": "trips_union", "int_trips_enriched": "enriched", "dim_date": "dim_date",
        "dim_time": "dim_time", "dim_location": "dim_location", "dim_rate_code": "dim_rate_code",
        "dim_payment_type": "dim_payment_type", "fct_trips": "fact", "mart_daily_summary": "mart_daily",
        "mart_hourly_patterns": "mart_hourly", "mart_zone_performance": "mart_zone",
    }
    parts = []
    for model, cols in T.NOT_NULL.items():
        for c in cols:
            parts.append(f"select '{model}' as model, 'not_null' as test_name, '{c}' as column_name, "
                         f"count(*) filter (where {c} is null) as failures from {cte_of[model]}")
    for model, (c, values) in T.ACCEPTED.items():
        vals = ", ".join(f"'{v}'" for v in values)
        parts.append(f"select '{model}', 'accepted_values', '{c}', count(*) filter (where {c} is not null and {c} not in ({vals})) from {cte_of[model]}")
    for model, (c, lo, hi) in T.RANGES.items():
        parts.append(f"select '{model}', 'accepted_range', '{c}', count(*) filter (where {c} is not null and not ({c} between {lo} and {hi})) from {cte_of[model]}")
    for c, (dim, key) in T.RELATIONSHIPS.items():
        parts.append(f"select 'fct_trips', 'relationships', '{c}', count(*) filter (where {c} is not null and not exists "
                     f"(select 1 from {cte_of[dim]} d where d.{key} = f.{c})) from fact f")
    for model, c in T.UNIQUE.items():
        parts.append(f"select '{model}', 'unique', '{c}', (select count(*) from (select {c} from {cte_of[model]} "
                     f"where {c} is not null group by {c} having count(*) > 1) x)")
    ctes = W(
        *O.MART_CHAIN, O.DIM_TIME,
        "stg_zones as (select * from dim_location where not is_unknown)",
        O.RATE_CODES, "dim_rate_code as (select id as rate_code_id, name as rate_code_name from rc)",
        O.PAYMENT_TYPES, "dim_payment_type as (select id as payment_type_id, name as payment_name from pt)",
        "t as (" + " union all ".join(parts) + ")",
    )
    return ctes + "select model, test_name, column_name, failures, case when failures > 0 then 'fail' else 'pass' end as status from t"


@register("reference_tests", _reference_tests_sql())
def q_reference_tests(m: TripModel) -> DataFrame:
    """All 75 data tests: dims, fact and marts written to their layers and
    read back, staging and intermediate as lazy views."""
    from starlane.operators.incremental import PARTITION_COLUMN
    from starlane.plans.layers import Layout
    from starlane.plans.model_tests import reference_tests

    lay = Layout(scratch_path(m.spark, "tested-layers"))
    for name, df in [("dim_date", m.dim_date), ("dim_time", m.dim_time), ("dim_location", m.dim_location),
                     ("dim_rate_code", m.dim_rate_code), ("dim_payment_type", m.dim_payment_type)]:
        lay.write(df, "dimensions", name)
    m.write_fact(lay.path("facts", "fct_trips"))
    fact = lay.read(m.spark, "facts", "fct_trips").drop(PARTITION_COLUMN)
    lay.write(m.daily(fact), "marts", "mart_daily_summary")
    lay.write(m.hourly(fact), "marts", "mart_hourly_patterns")
    lay.write(m.zone_pairs(fact), "marts", "mart_zone_performance")
    tables = {
        "stg_yellow_trips": m.stg_yellow, "stg_green_trips": m.stg_green, "stg_taxi_zones": m.stg_zones,
        "int_trips_union": m.trips_union, "int_trips_enriched": m.enriched, "fct_trips": fact,
    }
    for layer, names in [("dimensions", ["dim_date", "dim_time", "dim_location", "dim_rate_code", "dim_payment_type"]),
                         ("marts", ["mart_daily_summary", "mart_hourly_patterns", "mart_zone_performance"])]:
        for n in names:
            tables[n] = lay.read(m.spark, layer, n)
    return reference_tests(tables)


# -- full-precision measures, wide key texts ------------------------------------------


@register(
    "mart_daily_precise",
    W(
        *O.FACT_CHAIN, O.DIM_LOCATION,
        "thirds as (select * replace (fare_amount / 3 as fare_amount, tip_amount / 7 as tip_amount, "
        "total_amount + 0.00012345 as total_amount) from fact)",
        O.mart_daily("precise", "thirds"),
    )
    + "select * from precise",
)
def q_mart_precise(m: TripModel) -> DataFrame:
    """The daily mart over amounts with far more than two decimals."""
    amounts = {
        "fare_amount": F.col("fare_amount") / 3,
        "tip_amount": F.col("tip_amount") / 7,
        "total_amount": F.col("total_amount") + 0.00012345,
    }
    return m.daily(m.fact.withColumns(amounts))


@register(
    "mart_daily_nan",
    W(*O.FACT_CHAIN, O.DIM_LOCATION, f"placed as (select * from fact left join {O.place('start')} on start_id = pickup_location_id)")
    + "select pickup_date_key, start_area as borough, taxi_type, count(*) as total_trips, "
    "countif(pickup_time_key % 7 = 0) > 0 as tip_is_nan, "
    f"if(countif(pickup_time_key % 7 = 0) > 0, null, {O.xsum('tip_amount')}) as total_tip_amount from placed group by 1, 2, 3",
)
def q_mart_nan(m: TripModel) -> DataFrame:
    """The daily mart with some tips NaN: their groups' sums are NaN, no other's."""
    tips = F.when(F.col("pickup_time_key") % 7 == 0, float("nan")).otherwise(F.col("tip_amount"))
    daily = m.daily(m.fact.withColumn("tip_amount", tips))
    odd = F.isnan("total_tip_amount") & F.isnan("avg_tip_amount")
    total = F.when(~odd, F.col("total_tip_amount")).alias("total_tip_amount")
    return daily.select("pickup_date_key", "borough", "taxi_type", "total_trips", odd.alias("tip_is_nan"), total)


@register(
    "surrogate_key_wide",
    W(*O.CHAIN, "wide as (select * replace (trip_distance * 1e8 as trip_distance, fare_amount * 1e6 as fare_amount, "
      "floor(total_amount) * 1e15 as total_amount, floor(tip_amount) / 1e9 as tip_amount) from enriched)")
    + f"select {O.key_sql()} as trip_id, pickup_datetime, payment_type_id from wide",
)
def q_surrogate_key_wide(m: TripModel) -> DataFrame:
    """Trip keys over doubles that Spark writes with an exponent."""
    wide = m.enriched.withColumns(
        {
            "trip_distance": F.col("trip_distance") * 1e8,
            "fare_amount": F.col("fare_amount") * 1e6,
            "total_amount": F.floor("total_amount") * F.lit(1e15),
            "tip_amount": F.floor("tip_amount") / F.lit(1e9),
        }
    )
    return with_trip_id(wide).select("trip_id", "pickup_datetime", "payment_type_id")


# -- orders, with the place in the order as a column -------------------------------------


def _ranked(df: DataFrame, *columns: str) -> DataFrame:
    """The ordered rows' values with their place, numbered in the written order.

    The id holds a row's partition and its number there: the rows stay in
    their sorted partitions, and only the partitions' counts meet in a task.
    """
    path = scratch_path(df.sparkSession, "ranked")
    df.select(*columns, F.monotonically_increasing_id().alias("_at")).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select("_part", before.alias("_before"))
    number = F.col("_at") - F.shiftleft("_part", 33)
    return rows.join(starts, "_part").select(*columns, (F.col("_before") + number + 1).alias("place"))


@register(
    "order_dim_time",
    W(*O.FACT_CHAIN, O.DIM_TIME, "used as (select pickup_time_key as k, count(*) as trips from fact group by 1)")
    + "select time_key, time_string, trips, row_number() over (order by time_key) as place from dim_time join used on k = time_key",
)
def q_order_dim_time(m: TripModel) -> DataFrame:
    """Minutes of the day in order, those with trips."""
    used = usage_counts(m.fact, "pickup_time_key").withColumnRenamed("pickup_time_key", "time_key")
    return _ranked(dims.order_time(m.dim_time.join(used, "time_key")), "time_key", "time_string", "trips")


@register(
    "order_daily",
    W(*O.MART_CHAIN)
    + "select pickup_date_key, borough, taxi_type, total_trips, "
    "row_number() over (order by pickup_date_key, borough nulls last, taxi_type) as place from mart_daily",
)
def q_order_daily(m: TripModel) -> DataFrame:
    return _ranked(marts.order_daily(m.daily()), "pickup_date_key", "borough", "taxi_type", "total_trips")


@register(
    "order_hourly",
    W(*O.MART_CHAIN)
    + "select day_of_week, hour_of_day, borough, total_trips, "
    "row_number() over (order by day_of_week, hour_of_day, borough nulls last) as place from mart_hourly",
)
def q_order_hourly(m: TripModel) -> DataFrame:
    return _ranked(marts.order_hourly(m.hourly()), "day_of_week", "hour_of_day", "borough", "total_trips")


@register(
    "order_zone_pairs",
    W(*O.MART_CHAIN)
    + "select pickup_location_id, dropoff_location_id, total_trips, "
    f"row_number() over (order by {O.ROUTE_ORDER}) as place from mart_zone",
)
def q_order_zone_pairs(m: TripModel) -> DataFrame:
    return _ranked(marts.order_zone_pairs(m.zone_pairs()), "pickup_location_id", "dropoff_location_id", "total_trips")


# -- a user's own files ----------------------------------------------------------------------


@register(
    "read_months",
    W(O.FIXTURE)
    + "select VendorID, PULocationID, pickup_datetime, total_amount from raw where taxi_type = 'yellow' "
    "and pickup_datetime >= timestamp '1996-03-01' and pickup_datetime < timestamp '1997-09-01'",
)
def q_read_months(m: TripModel) -> DataFrame:
    """Yellow trips of 1996-03..1997-08 from a landing by feed and month."""
    from starlane.sources.files import land_feed, read_months

    root = land_feed(m.raw, scratch_path(m.spark, "landing"))
    return read_months(m.spark, root, "yellow", "1996-03", "1997-08").select(
        "VendorID", "PULocationID", "pickup_datetime", "total_amount"
    )


@register(
    "manifest_summary",
    W(O.FIXTURE, "landed as (select distinct taxi_type as feed, strftime(pickup_datetime, '%Y-%m') as ym from raw "
      "where pickup_datetime >= timestamp '1995-01-01' and pickup_datetime < timestamp '2002-01-01')")
    + "select count(*) as files_present, 2 * 84 - count(*) as files_missing, true as has_size, "
    "'1995-01 to 2001-12' as date_range, 'green, yellow' as taxi_types from landed",
)
def q_manifest_summary(m: TripModel) -> DataFrame:
    """The manifest of monthly files of both feeds in one row (the size as a
    sign: it varies by writer)."""
    from starlane.sources.files import expected_files_between, file_manifest, land_monthly_files, manifest_summary

    root = land_monthly_files(m.raw, scratch_path(m.spark, "monthly"))
    expected = expected_files_between(m.spark, "1995-01", "2001-12", ["yellow", "green"])
    out = manifest_summary(file_manifest(m.spark, root, expected))
    return out.select("files_present", "files_missing", (F.col("total_size_mb") > 0).alias("has_size"), "date_range", "taxi_types")


@register("run_all_files", O.quality_sql())
def q_run_all_files(m: TripModel) -> DataFrame:
    """The whole build over monthly files of both feeds and a zone CSV, as a
    user of the library runs it: no driver table is read by the model."""
    from starlane.plans.jobs import run_all
    from starlane.plans.layers import Layout
    from starlane.plans.trips import TripSources
    from starlane.sources.files import land_monthly_files, monthly_files
    from starlane.sources.lookups import write_lookup

    base = scratch_path(m.spark, "own")
    named = m.raw.withColumnsRenamed({"pickup_datetime": "p", "dropoff_datetime": "d"})
    for feed, prefix in (("yellow", "tpep"), ("green", "lpep")):
        one = named.where(F.col("taxi_type") == feed)
        one = one.withColumnsRenamed({"p": f"{prefix}_pickup_datetime", "d": f"{prefix}_dropoff_datetime"})
        land_monthly_files(one, f"{base}/{feed}", f"{prefix}_pickup_datetime")
    zones = write_lookup(m.zone_lookup, f"{base}/zones")
    files = {feed: monthly_files(m.spark, f"{base}/{feed}", feed, "1992-01", "2002-12") for feed in ("yellow", "green")}
    own = TripModel(m.spark, params=m.p, sources=TripSources(files["yellow"], files["green"], zones))
    return run_all(own, Layout(f"{base}/layers"), "full")


@register(
    "incremental_type_drift",
    W(
        *O.CHAIN,
        "b1 as (select * from enriched where pickup_datetime < timestamp '1998-01-01')",
        "b2 as (select * from enriched where pickup_datetime >= timestamp '1998-01-01')",
        O.fact_from("b1", "f1"),
        O.fact_from("b2", "f2"),
    )
    + " union all ".join(
        f"select '{name}' as first_type, {O.FACT_COLS} from {f}" for name in ("int", "bigint") for f in ("f1", "f2")
    ),
)
def q_incremental_type_drift(m: TripModel) -> DataFrame:
    """Months whose files hold ids as int, then as bigint, and the reverse: both
    stored facts can be read, and hold the same."""
    from starlane.operators.enrich import enrich
    from starlane.operators.incremental import load_incremental, read_fact
    from starlane.operators.standardize import GREEN, YELLOW, standardize, union_feeds

    ids = ("VendorID", "PULocationID", "DOLocationID")

    def batch(kind: str, cond) -> DataFrame:
        feeds = [df.withColumns({c: F.col(c).cast(kind) for c in ids}) for df in (m.raw_yellow, m.raw_green)]
        trips = union_feeds(*[standardize(df, spec, m.p.window, m.p.bounds) for df, spec in zip(feeds, (YELLOW, GREEN), strict=True)])
        return enrich(trips, m.p.enrich).where(cond)

    out = []
    for first, second in (("int", "bigint"), ("bigint", "int")):
        target = scratch_path(m.spark, f"fact-{first}")
        pu = F.col("pickup_datetime")
        load_incremental(m.spark, target, batch(first, pu < _pu("1998-01-01")), "append", params=m.p.enrich)
        load_incremental(m.spark, target, batch(second, pu >= _pu("1998-01-01")), "append", params=m.p.enrich)
        out.append(read_fact(m.spark, target).select(F.lit(first).alias("first_type"), *FACT_OUT))
    return out[0].unionByName(out[1])


@register(
    "mixed_schema_types",
    "with k as (select l_orderkey as k, l_linenumber as n, l_quantity as q, l_extendedprice as p from lineitem) "
    "select k, n, if(n % 2 = 0, k + 16777217, q) as mixed_number, "
    "if(n % 2 = 0, (p::decimal(12,2))::varchar || '00', (floor(p * 4) / 3.2)::decimal(16,4)::varchar) as mixed_decimal, "
    "if(n % 2 = 0, null, 'n' || n) as mixed_text from k",
)
def q_mixed_schema_types(m: TripModel) -> DataFrame:
    """Files that disagree on a column: bigint and float, decimals of two
    scales, an all-null int and text. Nothing is lost whichever comes first."""
    from starlane.sources.files import scan_feed
    from starlane.sources.tables import read_table

    li = read_table(m.spark, m.sf_dir, "lineitem")
    k = li.select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("p")
    )
    root = scratch_path(m.spark, "types")
    even = F.col("n") % 2 == 0
    whole = (F.col("k") + 16777217).cast("bigint")
    k.where(even).select(
        "k", "n", whole.alias("number"), F.col("p").cast("decimal(12,2)").alias("price"), F.lit(None).cast("int").alias("note")
    ).write.parquet(f"{root}/a")
    fine = (F.floor(F.col("p") * 4) / 3.2).cast("decimal(16,4)")
    k.where(~even).select(
        "k", "n", F.col("q").cast("float").alias("number"), fine.alias("price"), F.concat(F.lit("n"), F.col("n").cast("string")).alias("note")
    ).write.parquet(f"{root}/b")
    scanned = scan_feed(m.spark, [f"{root}/a", f"{root}/b"])
    return scanned.select(
        "k", "n", F.col("number").alias("mixed_number"), F.col("price").cast("string").alias("mixed_decimal"), F.col("note").alias("mixed_text")
    )
