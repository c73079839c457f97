"""Schemas, rename maps and fixed domain values of the route KPI engine.

Everything in the block marked FIXED VALUES must stay equal to the source
project's definitions, because results depend on it (column order of the raw
CSV files, null tokens, keyword rules, tier bands, score weights, accepted
values, the sub-region seed).  Everything else in the engine takes these as
defaults and accepts other values as parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source project's definitions)
# ---------------------------------------------------------------------------

# Text read as NULL when a raw CSV is loaded (case-exact; empty field is NULL too).
NULL_TOKENS = ("", "NULL", "N/A", "n/a")

# Yearline report files: raw column order (positional CSV).
YEARLINE_COLUMNS = (
    "CalendarYear",
    "Lineno_renamed",
    "AnnualBoardings",
    "AVG_Daily_Boardings_MF",
    "AVG_Daily_Boardings_Sat",
    "AVG_Daily_Boardings_SunHol",
    "Annual_Revenue_Hours",
    "Annual_Service_Hours",
    "Average_Boarding_Per_Revenue_Hour",
    "Average_Peak_Passenger_Load",
    "Average_Peak_Load_Factor",
    "Average_Capacity_Utilization",
    "Revenue_Hrs_w_Overcrowding",
    "Perc_Trips_w_Overcrowding",
    "On_Time_Performance_Percentage",
    "Bus_Bunching_Percentage",
    "AVG_speed_km_per_hr",
)

# Bus line snapshot files: raw column order (positional CSV).
BUS_LINE_COLUMNS = (
    "Line",
    "Line_Name",
    "Sub_Region_of_Primary_Service",
    "Predominant_Vehicle_Type",
    "TSG_Service_Type",
    "Population",
    "Employment",
    "Average_One_Way_Trip_Dist_km",
    "AVG_speed_km_per_hr",
    "RANK_Annual_Boardings",
    "Annual_Boardings",
    "AVG_Daily_Boardings_MF",
    "AVG_Daily_Boardings_Sat",
    "AVG_Daily_Boardings_SunHol",
    "Annual_Revenue_Hours_with_Overc",
    "On_Time_Performance_Percentage",
    "Annual_Service_Cost",
    "Annual_Service_Hours",
    "NOTE",
    "Exchange_Connections",
    "Rail_Connections",
    "SHAPE__Length",
    "TSPR_Year",
    "OBJECTID",
    "SHAPE__Length_2",
    "GlobalID",
)

# Stops file: raw column order (positional CSV).
STOPS_COLUMNS = (
    "stop_id",
    "stop_code",
    "stop_name",
    "stop_desc",
    "stop_lat",
    "stop_lon",
    "zone_id",
    "stop_url",
    "location_type",
    "parent_station",
    "wheelchair_boarding",
    "stop_timezone",
)

# Yearline: raw column -> (staged column, decimal precision, scale).
# CalendarYear and Lineno_renamed are handled separately (integer year, route code).
YEARLINE_MEASURES = (
    ("AnnualBoardings", "annual_boardings", 18, 3),
    ("AVG_Daily_Boardings_MF", "avg_daily_boardings_mf", 10, 1),
    ("AVG_Daily_Boardings_Sat", "avg_daily_boardings_sat", 10, 1),
    ("AVG_Daily_Boardings_SunHol", "avg_daily_boardings_sunhol", 10, 1),
    ("Annual_Revenue_Hours", "annual_revenue_hours", 10, 2),
    ("Annual_Service_Hours", "annual_service_hours", 10, 2),
    ("Average_Boarding_Per_Revenue_Hour", "avg_boarding_per_revenue_hour", 10, 2),
    ("Average_Peak_Passenger_Load", "avg_peak_passenger_load", 10, 2),
    ("Average_Peak_Load_Factor", "avg_peak_load_factor", 10, 4),
    ("Average_Capacity_Utilization", "avg_capacity_utilization", 10, 4),
    ("Revenue_Hrs_w_Overcrowding", "revenue_hrs_w_overcrowding", 10, 2),
    ("Perc_Trips_w_Overcrowding", "pct_trips_overcrowded", 10, 4),
    ("On_Time_Performance_Percentage", "on_time_performance_pct", 10, 4),
    ("Bus_Bunching_Percentage", "bus_bunching_pct", 10, 4),
    ("AVG_speed_km_per_hr", "avg_speed_km_per_hr", 10, 2),
)

# Bus line: raw text columns that are trimmed and kept as text.
BUS_LINE_TEXT = (
    ("Line_Name", "line_name"),
    ("Predominant_Vehicle_Type", "vehicle_type"),
    ("TSG_Service_Type", "service_type"),
    ("NOTE", "note"),
    ("Exchange_Connections", "exchange_connections"),
    ("Rail_Connections", "rail_connections"),
)

# Bus line: raw column -> (staged column, precision, scale); units are stripped first.
BUS_LINE_MEASURES = (
    ("Population", "corridor_population", 18, 0),
    ("Employment", "corridor_employment", 18, 0),
    ("Average_One_Way_Trip_Dist_km", "avg_trip_dist_km", 10, 2),
    ("SHAPE__Length", "shape_length", 18, 4),
    ("AVG_speed_km_per_hr", "avg_speed_km_per_hr", 10, 2),
    ("RANK_Annual_Boardings", "rank_annual_boardings", 10, 0),
    ("Annual_Boardings", "annual_boardings", 18, 3),
    ("AVG_Daily_Boardings_MF", "avg_daily_boardings_mf", 10, 1),
    ("AVG_Daily_Boardings_Sat", "avg_daily_boardings_sat", 10, 1),
    ("AVG_Daily_Boardings_SunHol", "avg_daily_boardings_sunhol", 10, 1),
    ("Annual_Revenue_Hours_with_Overc", "annual_revenue_hrs_overcrowding", 10, 2),
    ("On_Time_Performance_Percentage", "on_time_performance_pct", 10, 4),
    ("Annual_Service_Cost", "annual_service_cost", 18, 2),
    ("Annual_Service_Hours", "annual_service_hours", 10, 2),
)

# Characters kept when units are stripped from bus line numbers.
UNIT_STRIP_PATTERN = "[^0-9.-]"

# Bus line rows that are not bus services (compared on upper(trim(Line))).
EXCLUDED_SERVICES = ("SEABUS", "WEST COAST EXPRESS", "WCE")

# Sub-region keyword rules, in order; first match wins, compared on upper(text).
SUBREGION_RULES = (
    ("Vancouver/UBC", ("%VANCOUVER%", "%UBC%")),
    ("Burnaby/New Westminster", ("%BURNABY%", "%NEW WEST%")),
    ("North Shore", ("%NORTH SHORE%",)),
    ("Northeast Sector", ("%NORTHEAST%",)),
    ("Southeast (Surrey/Langley)", ("%SOUTHEAST%", "%SURREY%", "%LANGLEY%")),
    ("Southwest (Richmond/Delta)", ("%SOUTHWEST%", "%RICHMOND%", "%DELTA%")),
    ("Ridge Meadows", ("%RIDGE%", "%MEADOW%", "%MAPLE RIDGE%", "%PITT MEADOW%")),
    ("Tri-Cities", ("%TRI%", "%COQUITLAM%", "%PORT MOODY%")),
)

# The eight accepted sub-region names.
SUBREGIONS = (
    "Vancouver/UBC",
    "Burnaby/New Westminster",
    "North Shore",
    "Northeast Sector",
    "Southeast (Surrey/Langley)",
    "Southwest (Richmond/Delta)",
    "Ridge Meadows",
    "Tri-Cities",
)

# Sub-region seed: name, code, population 2021, area km2.
SUBREGION_SEED = (
    ("Vancouver/UBC", "VAN", 675218, 115),
    ("Burnaby/New Westminster", "BNW", 302574, 98),
    ("North Shore", "NSH", 191954, 272),
    ("Northeast Sector", "NES", 243101, 186),
    ("Southeast (Surrey/Langley)", "SEL", 737162, 562),
    ("Ridge Meadows", "RIM", 104884, 2771),
    ("Tri-Cities", "TRC", 237024, 374),
    ("Southwest (Richmond/Delta)", "SWD", 318392, 493),
)

# Overcrowding severity: lower bound (inclusive) -> tier, checked top-down.
SEVERITY_BANDS = ((30, "Critical"), (15, "High"), (5, "Medium"))
SEVERITY_LOW = "Low"
SEVERITY_UNKNOWN = "Unknown"
SEVERITY_TIERS = ("Low", "Medium", "High", "Critical", "Unknown")

# Service gap score: weights and caps of the three components.
GAP_WEIGHT_OVERCROWDING = Decimal("0.5")
GAP_WEIGHT_PEAK_LOAD = Decimal("0.3")
GAP_WEIGHT_UTILIZATION = Decimal("0.2")
GAP_CAP_OVERCROWDING = 100
GAP_CAP_PEAK_LOAD = 150

# Years and report sources.
BASE_YEAR = 2019
COVID_YEAR = 2020
VALID_YEARS = (2019, 2022, 2023, 2024)
ASSERTED_YEARS = (2019, 2020, 2021, 2022, 2023, 2024)
REPORT_SOURCES = ("2023", "2024")
SNAPSHOT_YEARS = (2019, 2022, 2023, 2024)

# Values of the command line's --source and the raw tables that each loads.
SOURCE_CHOICES = {"yearline": ("yearline",), "arcgis": ("bus_line",), "gtfs": ("stops",), "all": ("yearline", "bus_line", "stops")}

# Ranking.
TOP_K = 20
PERSISTENT_MIN_YEARS = 3

# Stops: inclusive bounding box.
STOP_LAT_RANGE = (48.0, 50.0)
STOP_LON_RANGE = (-124.0, -121.5)

# Overcrowding percentage valid range (0-100 scale).
PCT_RANGE = (0, 100)

# Defaults for blank dimension attributes.
UNKNOWN_LABEL = "Unknown"

# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------


def all_string_schema(columns) -> T.StructType:
    """Positional all-text schema for a raw CSV."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


SEED_SCHEMA = T.StructType(
    [
        T.StructField("subregion_name", T.StringType(), True),
        T.StructField("subregion_code", T.StringType(), True),
        T.StructField("population_2021", T.IntegerType(), True),
        T.StructField("area_km2", T.IntegerType(), True),
    ]
)


@dataclass(frozen=True)
class KpiParams:
    """Parameters of the KPI marts; defaults are the transit values."""

    base_year: int = BASE_YEAR
    covid_year: int = COVID_YEAR
    valid_years: tuple = VALID_YEARS
    asserted_years: tuple = ASSERTED_YEARS
    report_sources: tuple = REPORT_SOURCES
    snapshot_years: tuple = SNAPSHOT_YEARS
    top_k: int = TOP_K
    persistent_min_years: int = PERSISTENT_MIN_YEARS
    subregions: tuple = SUBREGIONS
    subregion_rules: tuple = SUBREGION_RULES
    excluded_services: tuple = EXCLUDED_SERVICES
    severity_bands: tuple = SEVERITY_BANDS
    pct_range: tuple = PCT_RANGE
    lat_range: tuple = STOP_LAT_RANGE
    lon_range: tuple = STOP_LON_RANGE
    gap_weights: tuple = field(
        default=(GAP_WEIGHT_OVERCROWDING, GAP_WEIGHT_PEAK_LOAD, GAP_WEIGHT_UTILIZATION)
    )
