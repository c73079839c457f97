"""Staging models: raw text -> cleaned, typed tables (M1-M3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as K
from ..operators.audit import bbox_filter, revision_audit
from ..operators.dedupe import latest_per_key
from ..schemas import (
    BUS_LINE_MEASURES,
    BUS_LINE_TEXT,
    KpiParams,
    YEARLINE_COLUMNS,
    YEARLINE_MEASURES,
)


def model_performance(raw: DataFrame, params: KpiParams = KpiParams(),
                      source_col: str = "report_source") -> DataFrame:
    """stg_bus_performance: one row per (route, year) from the union of report files.

    `raw` is the UNION ALL of the reports (17 text columns + `source_col`).
    The newest report wins for a (raw year, raw route) key; the raw values
    break ties so the choice is repeatable.  Casting happens after the dedup,
    on the surviving rows only.
    """
    deduped = latest_per_key(
        raw,
        keys=["CalendarYear", "Lineno_renamed"],
        newest_first=[source_col],
        tiebreak=[c for c in YEARLINE_COLUMNS if c not in ("CalendarYear", "Lineno_renamed")],
    )
    cleaned = deduped.select(
        K.try_int("CalendarYear").alias("calendar_year"),
        K.canonical_route("Lineno_renamed").alias("route_number"),
        K.combined_flag("Lineno_renamed").alias("is_combined_route"),
        *[K.try_decimal(src, p, s).alias(dst) for src, dst, p, s in YEARLINE_MEASURES],
        F.col(source_col).alias("report_source"),
    )
    return cleaned.withColumns(
        {
            "is_covid_year": K.year_flag("calendar_year", params.covid_year),
            # nine digits: the numerator's scale and six more, as the source warehouse divides
            "boardings_per_service_hour": F.round(K.guarded_ratio("annual_boardings", "annual_service_hours"), 9),
        }
    )


def union_reports(reports: dict, source_col: str = "report_source") -> DataFrame:
    """U1: UNION ALL of report frames keyed by their source label."""
    from ..sources.csv_raw import union_sources

    return union_sources(reports, source_col)


def model_line(raw: DataFrame, params: KpiParams = KpiParams(), year_col: str = "snapshot_year") -> DataFrame:
    """stg_bus_line: one row per (route, snapshot year); non-bus services dropped.

    The exclusion filter sits on the raw columns, so Catalyst pushes it into
    every file scan below the union.
    """
    kept = raw.filter(F.col("Line").isNotNull() & ~K.excluded("Line", params.excluded_services))
    line_raw = F.trim(F.col("Line"))
    subregion_raw = F.trim(F.col("Sub_Region_of_Primary_Service"))
    return kept.select(
        K.try_int(year_col).alias("snapshot_year"),
        K.canonical_route(line_raw).alias("route_number"),
        line_raw.alias("line_raw"),
        *[F.trim(F.col(src)).alias(dst) for src, dst in BUS_LINE_TEXT],
        K.try_int(F.trim(F.col("TSPR_Year"))).alias("tspr_year"),
        K.keyword_classify(subregion_raw, params.subregion_rules).alias("subregion"),
        subregion_raw.alias("subregion_raw"),
        *[K.parse_with_units(src, p, s).alias(dst) for src, dst, p, s in BUS_LINE_MEASURES],
    )


def union_snapshots(snapshots: dict, year_col: str = "snapshot_year") -> DataFrame:
    """U2: UNION ALL of snapshot frames keyed by their year label."""
    from ..sources.csv_raw import union_sources

    return union_sources(snapshots, year_col)


def model_stops(raw: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """stg_stops: typed stops, boardable ones (location_type 0 or unparsable) inside the box."""
    typed = raw.select(
        F.trim("stop_id").alias("stop_id"),
        K.try_integer("stop_code").alias("stop_code"),
        F.trim("stop_name").alias("stop_name"),
        F.trim("stop_desc").alias("stop_desc"),
        K.try_double("stop_lat").alias("stop_lat"),
        K.try_double("stop_lon").alias("stop_lon"),
        F.trim("zone_id").alias("zone_id"),
        F.trim("stop_url").alias("stop_url"),
        F.coalesce(K.try_integer("location_type"), F.lit(0).cast("decimal(38,0)")).alias("location_type"),
        F.trim("parent_station").alias("parent_station"),
        K.try_integer("wheelchair_boarding").alias("wheelchair_boarding"),
        F.trim("stop_timezone").alias("stop_timezone"),
    )
    boardable = typed.filter(F.col("location_type") == 0)
    return bbox_filter(boardable, "stop_lat", "stop_lon", params.lat_range, params.lon_range)


def report_revisions(reports: DataFrame, params: KpiParams = KpiParams(), value: str = "AnnualBoardings",
                     source_col: str = "report_source") -> DataFrame:
    """J9: (year, route) keys whose value changed from one report to the next, over all reports."""
    wanted = reports.filter(F.col("CalendarYear").isin([str(y) for y in params.valid_years]))
    out = revision_audit(wanted, ["CalendarYear", "Lineno_renamed"], source_col, K.try_decimal(value, 18, 3))
    return out.select(
        F.col("CalendarYear").alias("calendar_year_raw"),
        F.col("Lineno_renamed").alias("route_number_raw"),
        "older_report", "newer_report", "value_older", "value_newer", "max_older", "max_newer", "rows_older", "rows_newer",
        K.pct_change("value_newer", "value_older", 4).alias("revision_pct"),
    )
