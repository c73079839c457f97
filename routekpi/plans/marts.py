"""Mart models (M4-M9): dimensions, the route-year fact and the three KPI marts.

Physical shape, per model:

* dim_routes -- latest snapshot per route: a WindowGroupLimit(1) on route,
  output hash-partitioned by route.
* fact -- lag, baseline and the dimension join all use one key, the route (rows
  without a route are dealt over many keys): one Exchange serves the windows and
  the join with dim_routes.
* ranking -- distributed row number per year (no single task per year).
* gap / recovery -- rollups are partial+final hash aggregates joined back.

No side carries a broadcast hint: AQE broadcasts what it has measured to be
small (the seed, top-k counts, rollups) and splits skewed joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as K
from ..operators.audit import among
from ..operators.dedupe import latest_per_key
from ..operators.ranking import rank_within, top_k, with_topk_persistence
from ..operators.rollup import mean, weighted_index, with_top
from ..operators.windows import baseline_columns, prior_columns, spread_key
from ..schemas import UNKNOWN_LABEL, KpiParams


def dim_routes(stg_line: DataFrame) -> DataFrame:
    """One row per route from its latest snapshot (ties: smallest raw code)."""
    latest = latest_per_key(
        stg_line.filter(F.col("route_number").isNotNull()),
        keys=["route_number"], newest_first=["snapshot_year"], tiebreak=["line_raw"],
    )
    return latest.select(
        "route_number",
        F.col("line_raw").alias("route_number_raw"),
        K.blank_default("line_name", F.col("route_number")).alias("route_name"),
        K.blank_default("vehicle_type", UNKNOWN_LABEL).alias("vehicle_type"),
        K.blank_default("service_type", UNKNOWN_LABEL).alias("service_type"),
        "subregion",
        "subregion_raw",
        "corridor_population",
        "corridor_employment",
        "avg_trip_dist_km",
        "shape_length",
        "annual_service_cost",
        F.col("annual_service_hours").alias("annual_service_hours_latest"),
        F.col("snapshot_year").alias("latest_snapshot_year"),
        "note",
    )


def dim_subregions(seed: DataFrame) -> DataFrame:
    return seed.select(
        "subregion_name",
        "subregion_code",
        "population_2021",
        "area_km2",
        K.density("population_2021", "area_km2").alias("population_density_per_km2"),
    )


FACT_PERF_COLUMNS = (
    "annual_boardings", "avg_daily_boardings_mf", "avg_daily_boardings_sat", "avg_daily_boardings_sunhol",
    "annual_revenue_hours", "annual_service_hours", "avg_boarding_per_revenue_hour",
    "boardings_per_service_hour", "avg_peak_passenger_load", "avg_peak_load_factor",
    "avg_capacity_utilization", "revenue_hrs_w_overcrowding", "pct_trips_overcrowded",
    "on_time_performance_pct", "bus_bunching_pct", "avg_speed_km_per_hr",
    "is_covid_year", "is_combined_route", "report_source",
)


# Total order of a route's rows within a year.
PRIOR_TIEBREAK = ("report_source", "is_combined_route", "annual_boardings", "annual_service_hours")


# Metrics that the recovery mart indexes: value, base-year value, index.
RECOVERY_METRICS = (
    ("annual_boardings", "boardings_2019", "boardings_index"),
    ("annual_revenue_hours", "revenue_hours_2019", "revenue_hours_index"),
    ("on_time_performance_pct", "on_time_2019", "on_time_index"),
    ("pct_trips_overcrowded", "overcrowding_2019", "overcrowding_index"),
)
BASE_COLUMNS = tuple(b for _, b, _ in RECOVERY_METRICS)


def fact_route_performance(perf: DataFrame, routes: DataFrame, subregions: DataFrame,
                           params: KpiParams = KpiParams(), with_base: bool = False) -> DataFrame:
    """Route x year fact: dimensions, base-year index, change vs prior available year, tier.

    `with_base` adds the base-year values of the other metrics that the recovery
    mart indexes; they come from the same window.  Several raw codes can name one route ('005' and '005/006'); its rows of one
    year then follow in the order of PRIOR_TIEBREAK.
    """
    entity, time = "route_number", "calendar_year"
    key = {"tiebreak": PRIOR_TIEBREAK, "key": "_key"}
    windows = {
        **baseline_columns(entity, time, params.base_year, {b: v for v, b, _ in RECOVERY_METRICS[: None if with_base else 1]}, **key),
        **prior_columns(entity, time, {"prior_year_boardings": "annual_boardings"}, prior_time="prior_calendar_year", **key),
    }
    p = perf.withColumn("_key", spread_key(entity, [time, *PRIOR_TIEBREAK])).withColumns(windows)
    r = routes.select(F.col(entity).alias("_key"), "route_name", "vehicle_type", "service_type", "subregion", "latest_snapshot_year")
    s = subregions.select(
        F.col("subregion_name").alias("subregion"), "subregion_code",
        F.col("population_2021").alias("subregion_population"), "population_density_per_km2",
    )
    joined = p.join(r, on="_key", how="left").join(s, on="subregion", how="left")
    return joined.select(
        entity, time,
        "route_name", "vehicle_type", "service_type", "subregion", "latest_snapshot_year",
        "subregion_code", "subregion_population", "population_density_per_km2",
        *FACT_PERF_COLUMNS,
        "boardings_2019",
        F.col("boardings_2019").isNotNull().alias("has_2019_baseline"),
        K.index_to("annual_boardings", "boardings_2019", 1).alias("recovery_rate"),
        "prior_calendar_year",
        K.pct_change("annual_boardings", "prior_year_boardings", 2).alias("yoy_ridership_change_pct"),
        K.severity_tier("pct_trips_overcrowded", params.severity_bands).alias("overcrowding_severity"),
        *(BASE_COLUMNS[1:] if with_base else ()),
    )


def to_rank(fact: DataFrame) -> tuple:
    """The rows that are ranked, and their order within a year (ties to the smallest route)."""
    perf = fact.filter(F.col("pct_trips_overcrowded").isNotNull()).select(
        "route_number", "route_name", "subregion", "calendar_year", "pct_trips_overcrowded",
        "avg_peak_load_factor", "avg_daily_boardings_mf", "annual_revenue_hours", "overcrowding_severity",
    )
    order = [F.col("pct_trips_overcrowded").desc_nulls_first(), F.col("route_number").asc_nulls_last(),
             F.col("annual_revenue_hours").asc_nulls_last(), F.col("avg_peak_load_factor").asc_nulls_last(),
             F.col("avg_daily_boardings_mf").asc_nulls_last()]
    return perf, order


def overcrowding_ranking(fact: DataFrame, params: KpiParams = KpiParams(), method: str = "range") -> DataFrame:
    """Rank by overcrowding within each year; top-k flag and persistence."""
    perf, order = to_rank(fact)
    ranked = rank_within(perf, "calendar_year", order, rank_col="overcrowding_rank", method=method)
    out = with_topk_persistence(ranked, "route_number", "overcrowding_rank", params.top_k, params.persistent_min_years)
    return _ranking_columns(out)


def _ranking_columns(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        "route_number", "route_name", "subregion", "calendar_year", "pct_trips_overcrowded",
        F.round(F.col("pct_trips_overcrowded") * 100, 2).alias("pct_trips_overcrowded_display"),
        "avg_peak_load_factor", "avg_daily_boardings_mf", "annual_revenue_hours", "overcrowding_severity",
        "overcrowding_rank", "is_top20", "years_in_top20", "is_persistent_overcrowded",
    )


def topk_years(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """(route_number, years_in_top20) of the routes that are in the top k of a year; nothing else is ranked."""
    perf, order = to_rank(fact)
    top = top_k(perf, "calendar_year", order, params.top_k)
    return top.groupBy("route_number").agg(F.count(F.lit(1)).alias("years_in_top20"))


def overcrowding_ranking_of(fact: DataFrame, years, params: KpiParams = KpiParams()) -> DataFrame:
    """The ranking mart's rows of some years: those alone are ranked, persistence is over all of them."""
    perf, order = to_rank(fact.where(among("calendar_year", years)))
    ranked = rank_within(perf, "calendar_year", order, rank_col="overcrowding_rank")
    counts = topk_years(fact, params)
    return _ranking_columns(with_topk_persistence(ranked, "route_number", "overcrowding_rank", params.top_k, params.persistent_min_years, counts=counts))


def service_gap_scored(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    perf = fact.filter(
        F.col("pct_trips_overcrowded").isNotNull()
        & F.col("avg_peak_load_factor").isNotNull()
        & F.col("avg_capacity_utilization").isNotNull()
    )
    c1, c2, c3 = K.gap_components("pct_trips_overcrowded", "avg_peak_load_factor", "avg_capacity_utilization")
    return perf.select(
        "route_number", "route_name", "subregion", "subregion_code", "calendar_year", "overcrowding_severity",
        "pct_trips_overcrowded", "avg_peak_load_factor", "avg_capacity_utilization",
        "avg_daily_boardings_mf", "annual_revenue_hours",
        F.round(c1, 2).alias("component_overcrowding_freq"),
        F.round(c2, 2).alias("component_peak_load"),
        F.round(c3, 2).alias("component_capacity_util"),
        K.gap_score("pct_trips_overcrowded", "avg_peak_load_factor", "avg_capacity_utilization",
                    params.gap_weights, 2).alias("gap_score"),
    )


def gap_rollup(scored: DataFrame) -> DataFrame:
    """Per (sub-region, code, year): counts, means of the rounded scores, max and arg-max."""
    keys = ("subregion", "subregion_code", "calendar_year")
    rows = scored.filter(F.col("subregion").isNotNull())
    rolled = (
        rows.groupBy(*keys)
        .agg(
            F.count("route_number").alias("route_count"),
            mean("gap_score", 2).alias("avg_gap_score"),
            mean("component_overcrowding_freq", 2).alias("avg_overcrowding_freq"),
            mean("component_peak_load", 2).alias("avg_peak_load_score"),
            mean("component_capacity_util", 2).alias("avg_capacity_util_score"),
            F.max("gap_score").alias("max_gap_score"),
        )
    )
    return with_top(rolled, rows.select(*keys, "gap_score", "route_number"), keys, "gap_score", "max_gap_score",
                    "route_number", "most_strained_route")


def service_gap(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """Route-level scores with their sub-region average (joined on sub-region, year)."""
    scored = service_gap_scored(fact, params)
    roll = scored.filter(F.col("subregion").isNotNull()).groupBy("subregion", "subregion_code", "calendar_year").agg(
        mean("gap_score", 2).alias("subregion_avg_gap_score"), F.count("route_number").alias("subregion_route_count"),
    ).drop("subregion_code")
    return scored.join(roll, ["subregion", "calendar_year"], "left")


def recovery_indexed(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """Four metrics indexed to the base year.

    A fact that has the base-year values is only projected; for one without them
    they come from a window over the route.
    """
    p = fact
    if missing := {b: v for v, b, _ in RECOVERY_METRICS if b not in fact.columns}:
        p = fact.withColumns(baseline_columns("route_number", "calendar_year", params.base_year, missing, tiebreak=PRIOR_TIEBREAK))
    return p.select(
        "route_number", "route_name", "subregion", "subregion_code", "calendar_year",
        "annual_boardings", "annual_revenue_hours", "on_time_performance_pct",
        "pct_trips_overcrowded", "overcrowding_severity",
        *[b for _, b, _ in RECOVERY_METRICS],
        "has_2019_baseline",
        *[K.index_to(v, b, 1, require_value=True).alias(i) for v, b, i in RECOVERY_METRICS],
    )


def recovery_rollup(indexed: DataFrame) -> DataFrame:
    """Volume-weighted boardings index (routes with a baseline) and simple index means."""
    has = F.col("has_2019_baseline")
    return (
        indexed.filter(F.col("subregion").isNotNull())
        .groupBy("subregion", "subregion_code", "calendar_year")
        .agg(
            F.sum(F.when(has, F.col("annual_boardings"))).alias("total_boardings"),
            F.sum(F.when(has, F.col("boardings_2019"))).alias("total_boardings_2019"),
            weighted_index(F.when(has, F.col("annual_boardings")), F.when(has, F.col("boardings_2019"))).alias(
                "subregion_boardings_index"
            ),
            F.count("route_number").alias("total_routes"),
            F.count_if(has).alias("routes_with_baseline"),
            mean("revenue_hours_index", 1).alias("avg_revenue_hours_index"),
            mean("on_time_index", 1).alias("avg_on_time_index"),
            mean("overcrowding_index", 1).alias("avg_overcrowding_index"),
        )
    )


def recovery_trends(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    indexed = recovery_indexed(fact, params)
    roll = recovery_rollup(indexed).select(
        "subregion", "calendar_year", "subregion_boardings_index",
        F.col("total_routes").alias("subregion_total_routes"),
    )
    return indexed.join(roll, ["subregion", "calendar_year"], "left")


# Presentation order of the KPI marts.
MART_ORDER = {
    "fct_overcrowding_ranking": ("calendar_year", "overcrowding_rank"),
    "fct_service_gap": ("calendar_year", "-gap_score", "route_number"),
    "fct_recovery_trends": ("subregion", "route_number", "calendar_year"),
}


def mart_order(name: str) -> list:
    """Sort columns of a mart; a minus stands for largest first."""
    return [F.col(c[1:]).desc_nulls_first() if c[0] == "-" else F.col(c).asc_nulls_last() for c in MART_ORDER[name]]


def in_order(mart: DataFrame, name: str) -> DataFrame:
    """A mart's rows in its presentation order: a range sort over all tasks."""
    return mart.orderBy(*mart_order(name))
