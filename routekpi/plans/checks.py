"""The data-test suites of the staging and mart layers."""

from __future__ import annotations

from ..operators import quality as Q
from ..schemas import KpiParams


def staging_checks(params: KpiParams = KpiParams()) -> dict:
    years = list(params.valid_years)
    return {
        "stg_bus_performance": [
            Q.not_null("calendar_year"),
            Q.accepted_values("calendar_year", years),
            Q.not_null("route_number"),
            Q.not_null("annual_boardings"),
            Q.not_null("report_source"),
            Q.accepted_values("report_source", params.report_sources),
            Q.not_null("is_combined_route"),
            Q.unique("route_number", "calendar_year"),
            Q.in_range("pct_trips_overcrowded", params.pct_range[0], params.pct_range[1]),
            Q.non_negative("annual_boardings"),
            Q.domain("calendar_year", params.asserted_years),
        ],
        "stg_bus_line": [
            Q.not_null("snapshot_year"),
            Q.accepted_values("snapshot_year", params.snapshot_years),
            Q.not_null("route_number"),
            Q.not_null("subregion"),
            Q.accepted_values("subregion", params.subregions),
            Q.not_null("service_type"),
            Q.unique("route_number", "snapshot_year"),
        ],
        "stg_stops": [
            Q.not_null("stop_id"),
            Q.unique("stop_id"),
            Q.not_null("stop_lat"),
            Q.not_null("stop_lon"),
            Q.not_null("stop_name"),
            Q.not_null("location_type"),
            Q.accepted_values("location_type", [0]),
        ],
    }


def mart_checks(params: KpiParams = KpiParams()) -> dict:
    years = list(params.valid_years)
    from ..schemas import SEVERITY_TIERS

    return {
        "dim_routes": [
            Q.unique("route_number"),
            Q.not_null("route_number"),
            Q.not_null("route_name"),
            Q.accepted_values("subregion", params.subregions, severity=Q.WARN),
            Q.accepted_values("latest_snapshot_year", params.snapshot_years),
        ],
        "dim_subregions": [
            Q.unique("subregion_name"),
            Q.not_null("subregion_name"),
            Q.unique("subregion_code"),
            Q.not_null("subregion_code"),
            Q.not_null("population_2021"),
            Q.not_null("population_density_per_km2"),
        ],
        "fact_route_performance": [
            Q.not_null("route_number"),
            Q.not_null("calendar_year"),
            Q.accepted_values("calendar_year", years),
            Q.not_null("annual_boardings"),
            Q.accepted_values("overcrowding_severity", SEVERITY_TIERS),
            Q.unique("route_number", "calendar_year"),
        ],
        "fct_overcrowding_ranking": [
            Q.not_null("route_number"),
            Q.not_null("calendar_year"),
            Q.not_null("overcrowding_rank"),
            Q.not_null("pct_trips_overcrowded"),
            Q.not_null("is_persistent_overcrowded"),
            Q.unique("calendar_year", "overcrowding_rank"),
            Q.unique("route_number", "calendar_year"),
        ],
        "fct_service_gap": [
            Q.not_null("route_number"),
            Q.not_null("calendar_year"),
            Q.not_null("gap_score"),
            Q.unique("route_number", "calendar_year"),
        ],
        "fct_recovery_trends": [
            Q.not_null("route_number"),
            Q.not_null("calendar_year"),
            Q.not_null("has_2019_baseline"),
            Q.unique("route_number", "calendar_year"),
        ],
    }
