"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written from the definitions of the results, not from either implementation:
a route's base and prior values come from its ordered list of years, counts and
sub-region figures from windows, over the same derivation of the driver's tables.
Two DuckDB differences are handled here:

* DuckDB divides DECIMALs in DOUBLE, so every rounded quotient uses `rdiv`,
  an exact integer form of ``round(num / den * mult, scale)`` (half away from
  zero, as Spark rounds decimals);
* results are typed DOUBLE (decimals) and BIGINT (integers), matching
  `registry.comparable` on the Spark side.
"""

from __future__ import annotations

from ..schemas import (
    BUS_LINE_MEASURES,
    EXCLUDED_SERVICES,
    NULL_TOKENS,
    STOPS_COLUMNS,
    UNIT_STRIP_PATTERN,
    YEARLINE_COLUMNS,
    YEARLINE_MEASURES,
)
from ..sources import testdata as TD
from .checks import mart_checks, staging_checks

P = TD.DRIVER_PARAMS


def rdiv(num: str, den: str, mult: int = 1, scale: int = 0) -> str:
    """Exact round(num / den * mult, scale) as DECIMAL (den > 0, inputs with <= 6 decimals)."""
    n = f"CAST(({num}) * 1000000 AS HUGEINT)"
    d = f"CAST(({den}) * 1000000 AS HUGEINT)"
    k = mult * 10 ** scale
    q = f"(sign({n}) * ((2 * abs({n}) * {k} + {d}) // (2 * {d})))"
    return f"(CAST({q} AS DECIMAL(18,0)) * {'1' if scale == 0 else '0.' + '0' * (scale - 1) + '1'})"


def mean(col: str, scale: int) -> str:
    return f"CASE WHEN count({col}) > 0 THEN {rdiv(f'sum({col})', f'count({col})', 1, scale)} END"


def nt(col: str) -> str:
    toks = ", ".join("'" + t + "'" for t in NULL_TOKENS)
    return f"CASE WHEN {col} IN ({toks}) THEN NULL ELSE {col} END"


def canon(x: str) -> str:
    """Text from R or N on is kept trimmed; else the number before the first slash, or NULL."""
    number = f"CAST(TRY_CAST(string_split({x}, '/')[1] AS DECIMAL(38,0)) AS VARCHAR)"
    return f"CASE WHEN regexp_matches({x}, '^[RrNn]') THEN trim({x}) ELSE {number} END"


def padded(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), CAST(greatest(3, length(CAST({x} AS VARCHAR))) AS INTEGER), '0')"


def ratio_txt(num: str, den: str) -> str:
    return f"CAST(CAST({rdiv(num, den, 1, 4)} AS DECIMAL(18,4)) AS VARCHAR)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '{UNIT_STRIP_PATTERN}', '', 'g')"


def classify(x: str, rules) -> str:
    parts = []
    for cat, pats in rules:
        cond = " OR ".join(f"upper({x}) LIKE '{p}'" for p in pats)
        parts.append(f"WHEN {cond} THEN '{cat}'")
    return "CASE " + " ".join(parts) + f" ELSE {x} END"


def D(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name or expr}"


def I(expr: str, name: str | None = None) -> str:  # noqa: E743
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


# ------------------------------------------------------------------ derived inputs

def _facts(sfx: str, cond: str | None) -> str:
    f = (lambda e: f"{e} FILTER (WHERE {cond})") if cond else (lambda e: e)
    c = (lambda p: f"count(*) FILTER (WHERE {cond} AND {p})") if cond else (lambda p: f"count(*) FILTER (WHERE {p})")
    returned = c("l_returnflag = 'R'")
    return ", ".join([
        f"{f('count(*)')} AS n_{sfx}", f"{f('sum(qty)')} AS q_{sfx}", f"{f('sum(ext)')} AS e_{sfx}",
        f"{c('qty > 40')} AS big_{sfx}", f"{c('qty >= 48')} AS full_{sfx}",
        f"{c('l_discount <= 0.05')} AS ontime_{sfx}", f"{returned} AS ret_{sfx}",
        f"{f('max(qty)')} AS maxq_{sfx}", f"{f('min(qty)')} AS minq_{sfx}",
    ])


SY = f"""
li AS (
  SELECT l_suppkey, l_shipdate, l_discount, l_returnflag,
         CAST(l_quantity AS BIGINT) AS qty, CAST(l_extendedprice AS DECIMAL(12,2)) AS ext,
         (month(l_shipdate) = 12 AND day(l_shipdate) >= {TD.LATE_DAY} AND year(l_shipdate) >= {TD.LATE_FROM}) AS late
  FROM lineitem
),
agg AS (
  SELECT l_suppkey AS suppkey, year(l_shipdate) AS year, {_facts('all', None)}, {_facts('early', 'NOT late')}
  FROM li GROUP BY 1, 2
),
sy AS (
  SELECT agg.*, s_name, s_nationkey, s_acctbal,
    CASE WHEN s_acctbal < 0 AND year < {TD.LAUNCH_YEAR} THEN 'N' || CAST(suppkey AS VARCHAR)
         WHEN s_acctbal >= {TD.DISCONTINUED_BALANCE} AND year > {TD.LAST_ACTIVE_YEAR} THEN 'R' || CAST(suppkey AS VARCHAR) || 'X'
         WHEN s_nationkey = 0 THEN {padded('suppkey')} || '/' || {padded('suppkey + 1')}
         WHEN s_nationkey = 1 THEN 'R' || CAST(suppkey AS VARCHAR)
         ELSE {padded('suppkey')} END AS route_code
  FROM agg LEFT JOIN supplier ON suppkey = s_suppkey
)"""


def _render(sfx: str, where: str, label: str, tokens: bool = True) -> str:
    cols = [
        ("CAST(year AS VARCHAR)", "CalendarYear"),
        ("route_code", "Lineno_renamed"),
        (f"CAST(q_{sfx} AS VARCHAR)", "AnnualBoardings"),
        (f"CAST(maxq_{sfx} AS VARCHAR)", "AVG_Daily_Boardings_MF"),
        (f"CAST(minq_{sfx} AS VARCHAR)", "AVG_Daily_Boardings_Sat"),
        (f"CASE WHEN minq_{sfx} = 1 THEN 'N/A' ELSE CAST(minq_{sfx} AS VARCHAR) END", "AVG_Daily_Boardings_SunHol"),
        (f"CAST(CAST(e_{sfx} AS DECIMAL(18,2)) * 0.01 AS VARCHAR)", "Annual_Revenue_Hours"),
        (f"CAST(n_{sfx} * 1.5 AS VARCHAR)", "Annual_Service_Hours"),
        (f"CASE WHEN full_{sfx} = 0 THEN '' ELSE {ratio_txt(f'q_{sfx}', f'2 * n_{sfx}')} END", "Average_Boarding_Per_Revenue_Hour"),
        (f"CAST(maxq_{sfx} AS VARCHAR)", "Average_Peak_Passenger_Load"),
        (ratio_txt(f"q_{sfx}", f"25 * n_{sfx}"), "Average_Peak_Load_Factor"),
        (ratio_txt(f"q_{sfx}", f"50 * n_{sfx}"), "Average_Capacity_Utilization"),
        (f"CAST(big_{sfx} * 1.5 AS VARCHAR)", "Revenue_Hrs_w_Overcrowding"),
        (f"CASE WHEN suppkey <= {TD.ALWAYS_FULL} THEN '100.0000' WHEN full_{sfx} = 0 THEN 'N/A' ELSE {ratio_txt(f'100 * big_{sfx}', f'n_{sfx}')} END",
         "Perc_Trips_w_Overcrowding"),
        (ratio_txt(f"100 * ontime_{sfx}", f"n_{sfx}"), "On_Time_Performance_Percentage"),
        (ratio_txt(f"100 * ret_{sfx}", f"n_{sfx}"), "Bus_Bunching_Percentage"),
        (f"CASE WHEN maxq_{sfx} < 50 THEN 'NULL' ELSE {ratio_txt(f'q_{sfx}', f'n_{sfx}')} END", "AVG_speed_km_per_hr"),
    ]
    inner = ", ".join(f"{e} AS {n}" for e, n in cols)
    outer = ", ".join((nt(n) if tokens else n) + f" AS {n}" for _, n in cols)
    return f"SELECT {outer}, '{label}' AS report_source FROM (SELECT {inner} FROM sy WHERE {where})"


LO, FO, TO = TD.OLDER_REPORT
LN, FN, TN = TD.NEWER_REPORT
REPORTS = f"""{SY},
rep_old AS ({_render('early', f'year <= {TO} AND n_early > 0', LO)}),
rep_new AS ({_render('all', f'year >= {FN}', LN)}),
reports AS (SELECT * FROM rep_old UNION ALL SELECT * FROM rep_new)"""

_MEASURES = list(YEARLINE_MEASURES)
_TIE = ", ".join(f"{c} ASC NULLS LAST" for c in YEARLINE_COLUMNS[2:])

PERF = f"""{REPORTS},
dedup AS (
  SELECT *, row_number() OVER (PARTITION BY CalendarYear, Lineno_renamed
                               ORDER BY report_source DESC NULLS FIRST, {_TIE}) AS rn
  FROM reports WHERE CalendarYear IS NOT NULL AND Lineno_renamed IS NOT NULL
),
perf0 AS (
  SELECT TRY_CAST(TRY_CAST(CalendarYear AS DECIMAL(38,0)) AS INTEGER) AS calendar_year,
         {canon('Lineno_renamed')} AS route_number,
         coalesce(contains(Lineno_renamed, '/'), false) AS is_combined_route,
         {", ".join(f"TRY_CAST({s} AS DECIMAL({p},{sc})) AS {d}" for s, d, p, sc in _MEASURES)},
         report_source
  FROM dedup WHERE rn = 1
),
perf AS (
  SELECT *, (calendar_year = {P.covid_year}) AS is_covid_year,
         CASE WHEN annual_service_hours > 0
              THEN {rdiv('annual_boardings', 'annual_service_hours', 1, 9)} END AS boardings_per_service_hour
  FROM perf0
)"""

PERF_OUT = ", ".join(
    [I("calendar_year"), "route_number", "is_combined_route"]
    + [D(d) for _, d, _, _ in _MEASURES]
    + ["report_source", "is_covid_year", D("boardings_per_service_hour")]
)

_SNAP_COLS = [
    ("CASE WHEN s_nationkey = 2 THEN ' wce ' ELSE route_code END", "Line"),
    ("CASE WHEN s_nationkey = 3 THEN '  ' ELSE s_name END", "Line_Name"),
    ("CASE WHEN s_nationkey = 4 THEN 'Atlantis' WHEN year <= 1997 THEN lower(r_name) "
     "ELSE 'Region of ' || r_name END", "Sub_Region_of_Primary_Service"),
    ("CASE WHEN s_acctbal < 1000 THEN '' ELSE 'Type ' || n_name END", "Predominant_Vehicle_Type"),
    ("CASE WHEN n_all >= 90 THEN 'Frequent' ELSE 'Local' END", "TSG_Service_Type"),
    ("format('{:,}', n_all * 1000)", "Population"),
    ("CAST(q_all AS VARCHAR) || ' jobs'", "Employment"),
    ("CAST(maxq_all AS VARCHAR) || ' km'", "Average_One_Way_Trip_Dist_km"),
    ("CAST(minq_all AS VARCHAR) || ' km/h'", "AVG_speed_km_per_hr"),
    ("'n/a'", "RANK_Annual_Boardings"),
    ("format('{:,}', q_all)", "Annual_Boardings"),
    ("CAST(maxq_all AS VARCHAR)", "AVG_Daily_Boardings_MF"),
    ("CAST(minq_all AS VARCHAR)", "AVG_Daily_Boardings_Sat"),
    ("''", "AVG_Daily_Boardings_SunHol"),
    ("CAST(big_all * 1.5 AS VARCHAR) || ' h'", "Annual_Revenue_Hours_with_Overc"),
    (ratio_txt("100 * ontime_all", "n_all") + " || '%'", "On_Time_Performance_Percentage"),
    ("'$' || CAST(e_all AS VARCHAR)", "Annual_Service_Cost"),
    ("CAST(n_all * 1.5 AS VARCHAR) || ' hrs'", "Annual_Service_Hours"),
    (f"CASE WHEN s_acctbal >= {TD.DISCONTINUED_BALANCE} THEN 'Discontinued' ELSE '' END", "NOTE"),
    ("n_name", "Exchange_Connections"),
    ("''", "Rail_Connections"),
    ("CAST(CAST(e_all AS DECIMAL(18,2)) * 0.001 AS VARCHAR)", "SHAPE__Length"),
    ("CAST(year AS VARCHAR)", "TSPR_Year"),
    ("CAST(suppkey AS VARCHAR)", "OBJECTID"),
    ("''", "SHAPE__Length_2"),
    ("''", "GlobalID"),
]
SNAPS = f"""{SY},
snap0 AS (
  SELECT {", ".join(f"{e} AS {n}" for e, n in _SNAP_COLS)}, CAST(year AS VARCHAR) AS snapshot_year
  FROM sy LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
),
snaps AS (SELECT {", ".join(nt(n) + f" AS {n}" for _, n in _SNAP_COLS)}, snapshot_year FROM snap0)"""

_LINE_MEASURES = list(BUS_LINE_MEASURES)
EXCL = ", ".join(f"'{x}'" for x in EXCLUDED_SERVICES)
LINE = f"""{SNAPS},
line AS (
  SELECT TRY_CAST(TRY_CAST(snapshot_year AS DECIMAL(38,0)) AS INTEGER) AS snapshot_year,
         {canon('trim(Line)')} AS route_number, trim(Line) AS line_raw,
         trim(Line_Name) AS line_name, trim(Predominant_Vehicle_Type) AS vehicle_type,
         trim(TSG_Service_Type) AS service_type, trim(NOTE) AS note,
         trim(Exchange_Connections) AS exchange_connections, trim(Rail_Connections) AS rail_connections,
         TRY_CAST(TRY_CAST(trim(TSPR_Year) AS DECIMAL(38,0)) AS INTEGER) AS tspr_year,
         {classify('trim(Sub_Region_of_Primary_Service)', P.subregion_rules)} AS subregion,
         trim(Sub_Region_of_Primary_Service) AS subregion_raw,
         {", ".join(f"TRY_CAST({strip(s)} AS DECIMAL({p},{sc})) AS {d}" for s, d, p, sc in _LINE_MEASURES)}
  FROM snaps
  WHERE Line IS NOT NULL AND upper(trim(Line)) NOT IN ({EXCL})
)"""
LINE_OUT = ", ".join(
    [I("snapshot_year"), "route_number", "line_raw", "line_name", "vehicle_type", "service_type", "note",
     "exchange_connections", "rail_connections", I("tspr_year"), "subregion", "subregion_raw"]
    + [D(d) for _, d, _, _ in _LINE_MEASURES]
)

def _named(column: str, default: str) -> str:
    return f"CASE WHEN trim(coalesce({column}, '')) = '' THEN {default} ELSE trim({column}) END"


DIMR = f"""{LINE},
dimr AS (
  SELECT DISTINCT ON (route_number) route_number, line_raw AS route_number_raw,
         {_named('line_name', 'route_number')} AS route_name, {_named('vehicle_type', "'Unknown'")} AS vehicle_type,
         {_named('service_type', "'Unknown'")} AS service_type, subregion, subregion_raw, note,
         corridor_population, corridor_employment, avg_trip_dist_km, shape_length, annual_service_cost,
         annual_service_hours AS annual_service_hours_latest, snapshot_year AS latest_snapshot_year
  FROM line WHERE route_number IS NOT NULL
  ORDER BY route_number, snapshot_year DESC NULLS FIRST, line_raw ASC NULLS LAST
)"""
DIMR_OUT = ", ".join(
    ["route_number", "route_number_raw", "route_name", "vehicle_type", "service_type", "subregion",
     "subregion_raw"]
    + [D(c) for c in ("corridor_population", "corridor_employment", "avg_trip_dist_km", "shape_length",
                      "annual_service_cost", "annual_service_hours_latest")]
    + [I("latest_snapshot_year"), "note"]
)

SEED = """
seed AS (
  SELECT r_name AS subregion_name, substr(r_name, 1, 3) AS subregion_code,
         CAST(cc.population AS INTEGER) AS population_2021, CAST(nn.n_nations * 100 AS INTEGER) AS area_km2
  FROM region
  LEFT JOIN (SELECT n_regionkey, count(*) AS n_nations FROM nation GROUP BY 1) nn ON r_regionkey = nn.n_regionkey
  LEFT JOIN (SELECT n_regionkey, sum(n_cust) AS population
             FROM (SELECT c_nationkey, count(*) AS n_cust FROM customer GROUP BY 1) c
             JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) cc ON r_regionkey = cc.n_regionkey
),
dims AS (
  SELECT subregion_name, subregion_code, population_2021, area_km2,
         CASE WHEN area_km2 <> 0 THEN """ + rdiv("population_2021", "area_km2", 1, 1) + """ END
           AS population_density_per_km2
  FROM seed
)"""

_FACT_PERF = [
    "annual_boardings", "avg_daily_boardings_mf", "avg_daily_boardings_sat", "avg_daily_boardings_sunhol",
    "annual_revenue_hours", "annual_service_hours", "avg_boarding_per_revenue_hour",
    "boardings_per_service_hour", "avg_peak_passenger_load", "avg_peak_load_factor",
    "avg_capacity_utilization", "revenue_hrs_w_overcrowding", "pct_trips_overcrowded",
    "on_time_performance_pct", "bus_bunching_pct", "avg_speed_km_per_hr",
]
_BANDS = " ".join(f"WHEN cur.pct_trips_overcrowded >= {b} THEN '{t}'" for b, t in P.severity_bands)
_YEARS_ORDER = ("calendar_year NULLS LAST, report_source NULLS LAST, is_combined_route, annual_boardings NULLS LAST, "
                "annual_service_hours NULLS LAST")


def _fact_cte() -> str:
    # PERF and DIMR both start with SY; DuckDB needs each CTE once.
    dimr_tail = DIMR[len(SY) + 2:]
    change = rdiv("cur.annual_boardings - was.annual_boardings", "was.annual_boardings", 100, 2)
    return f"""{PERF},
{dimr_tail},
{SEED.strip()},
years_of AS (  -- each route's rows in order, and its boardings in the base year
  SELECT list(perf ORDER BY {_YEARS_ORDER}) AS rows_,
         max(annual_boardings) FILTER (WHERE calendar_year = {P.base_year}) AS at_base
  FROM perf WHERE route_number IS NOT NULL GROUP BY route_number
),
steps AS (
  SELECT at_base, rows_[i] AS cur, rows_[i - 1] AS was FROM (SELECT *, unnest(range(1, len(rows_) + 1)) AS i FROM years_of)
  UNION ALL SELECT NULL, perf, NULL FROM perf WHERE route_number IS NULL
),
fact AS (
  SELECT cur.route_number AS route_number, cur.calendar_year AS calendar_year,
         {", ".join(f"cur.{c} AS {c}" for c in _FACT_PERF + ["is_covid_year", "is_combined_route", "report_source"])},
         at_base AS boardings_2019, at_base IS NOT NULL AS has_2019_baseline,
         CASE WHEN at_base > 0 THEN {rdiv('cur.annual_boardings', 'at_base', 100, 1)} END AS recovery_rate,
         was.calendar_year AS prior_calendar_year,
         CASE WHEN was.annual_boardings > 0 THEN {change} END AS yoy_ridership_change_pct,
         CASE WHEN cur.pct_trips_overcrowded IS NULL THEN 'Unknown' {_BANDS} ELSE 'Low' END AS overcrowding_severity,
         route_name, vehicle_type, service_type, subregion, latest_snapshot_year, subregion_code,
         population_2021 AS subregion_population, population_density_per_km2
  FROM steps LEFT JOIN dimr ON dimr.route_number = steps.cur.route_number LEFT JOIN dims ON subregion_name = subregion
)"""


FACT = _fact_cte()
FACT_OUT = ", ".join(
    ["route_number", I("calendar_year"), "route_name", "vehicle_type", "service_type", "subregion",
     I("latest_snapshot_year"), "subregion_code", I("subregion_population"), D("population_density_per_km2")]
    + [D(c) for c in _FACT_PERF]
    + ["is_covid_year", "is_combined_route", "report_source", D("boardings_2019"), "has_2019_baseline",
       D("recovery_rate"), I("prior_calendar_year"), D("yoy_ridership_change_pct"), "overcrowding_severity"]
)

_PLACE = ("pct_trips_overcrowded DESC, route_number ASC, annual_revenue_hours ASC NULLS LAST, "
          "avg_peak_load_factor ASC NULLS LAST, avg_daily_boardings_mf ASC NULLS LAST")
RANKING_CTE = f"""ranking AS (
  SELECT *, coalesce(count(*) FILTER (WHERE is_top20) OVER (PARTITION BY route_number), 0) AS years_in_top20,
         count(*) FILTER (WHERE is_top20) OVER (PARTITION BY route_number) >= {P.persistent_min_years} AS is_persistent_overcrowded
  FROM (
    SELECT *, round(pct_trips_overcrowded * 100, 2) AS pct_trips_overcrowded_display, overcrowding_rank <= {P.top_k} AS is_top20
    FROM (SELECT *, row_number() OVER (PARTITION BY calendar_year ORDER BY {_PLACE}) AS overcrowding_rank
          FROM fact WHERE pct_trips_overcrowded IS NOT NULL)
  )
)"""
RANKING = f"{FACT},\n{RANKING_CTE}"
RANKING_OUT = ", ".join(
    ["route_number", "route_name", "subregion", I("calendar_year"), D("pct_trips_overcrowded"),
     D("pct_trips_overcrowded_display"), D("avg_peak_load_factor"), D("avg_daily_boardings_mf"),
     D("annual_revenue_hours"), "overcrowding_severity", I("overcrowding_rank"), "is_top20",
     I("years_in_top20"), "is_persistent_overcrowded"]
)

# the score's parts, each at most its cap
_FREQ, _LOAD, _UTIL = "least(pct_trips_overcrowded, 100)", "least(avg_peak_load_factor * 100, 150)", "avg_capacity_utilization * 100"
SCORED_CTE = f"""scored AS (
  SELECT *, {mean('gap_score', 2).replace('sum(gap_score)', 'sum(gap_score) OVER here').replace('count(gap_score)', 'count(gap_score) OVER here')} AS here_avg,
         count(route_number) OVER here AS here_routes
  FROM (
    SELECT *, round({_FREQ}, 2) AS component_overcrowding_freq, {rdiv(_LOAD + ' * 2', '3', 1, 2)} AS component_peak_load,
           round({_UTIL}, 2) AS component_capacity_util, round(0.5 * {_FREQ} + 0.2 * {_LOAD} + 0.2 * {_UTIL}, 2) AS gap_score
    FROM fact WHERE coalesce(pct_trips_overcrowded, avg_peak_load_factor, avg_capacity_utilization) IS NOT NULL
      AND pct_trips_overcrowded + avg_peak_load_factor + avg_capacity_utilization IS NOT NULL
  ) WINDOW here AS (PARTITION BY subregion, calendar_year)
)"""
SCORED = f"""{FACT},
{SCORED_CTE},
by_region AS (
  SELECT subregion, subregion_code, calendar_year, count(route_number) AS route_count,
         {mean('gap_score', 2)} AS avg_gap_score, max(gap_score) AS max_gap_score,
         {mean('component_overcrowding_freq', 2)} AS avg_overcrowding_freq,
         {mean('component_peak_load', 2)} AS avg_peak_load_score, {mean('component_capacity_util', 2)} AS avg_capacity_util_score,
         list(route_number ORDER BY gap_score DESC, route_number ASC)[1] AS most_strained_route
  FROM scored WHERE subregion IS NOT NULL GROUP BY ALL
)"""
SCORED_OUT = ", ".join(
    ["route_number", "route_name", "subregion", "subregion_code", I("calendar_year"), "overcrowding_severity",
     D("pct_trips_overcrowded"), D("avg_peak_load_factor"), D("avg_capacity_utilization"),
     D("avg_daily_boardings_mf"), D("annual_revenue_hours"), D("component_overcrowding_freq"),
     D("component_peak_load"), D("component_capacity_util"), D("gap_score")]
)
GAPROLL_OUT = ", ".join(
    ["subregion", "subregion_code", I("calendar_year"), I("route_count"), D("avg_gap_score"),
     D("avg_overcrowding_freq"), D("avg_peak_load_score"), D("avg_capacity_util_score"), D("max_gap_score"),
     "most_strained_route"]
)

_REC = [
    ("annual_boardings", "boardings_2019", "boardings_index"),
    ("annual_revenue_hours", "revenue_hours_2019", "revenue_hours_index"),
    ("on_time_performance_pct", "on_time_2019", "on_time_index"),
    ("pct_trips_overcrowded", "overcrowding_2019", "overcrowding_index"),
]
_BASES = ", ".join(
    f"CASE WHEN route_number IS NOT NULL THEN max({v}) FILTER (WHERE calendar_year = {P.base_year}) OVER (PARTITION BY route_number) END AS {b}"
    for v, b, _ in _REC if b != "boardings_2019")
_COUNTED = "FILTER (WHERE has_2019_baseline)"
_VOLUME = f"sum(annual_boardings) {_COUNTED}", f"sum(boardings_2019) {_COUNTED}"


def _share(over: str = "") -> str:
    top, base = (f"{x}{over}" for x in _VOLUME)
    return f"CASE WHEN {base} > 0 THEN {rdiv(top, base, 100, 1)} END"


INDEXED_CTE = f"""indexed AS (
  SELECT *, {_share(" OVER here")} AS here_index, count(route_number) OVER here AS here_total
  FROM (SELECT *, {", ".join(f"CASE WHEN {b} > 0 THEN {rdiv(v, b, 100, 1)} END AS {i}" for v, b, i in _REC)}
        FROM (SELECT *, {_BASES} FROM fact))
  WINDOW here AS (PARTITION BY subregion, calendar_year)
)"""
RECOVERY = f"""{FACT},
{INDEXED_CTE},
by_region AS (
  SELECT subregion, subregion_code, calendar_year, {_VOLUME[0]} AS total_boardings, {_VOLUME[1]} AS total_boardings_2019,
         {_share()} AS subregion_boardings_index, count(route_number) AS total_routes, count(*) {_COUNTED} AS routes_with_baseline,
         {mean('revenue_hours_index', 1)} AS avg_revenue_hours_index, {mean('on_time_index', 1)} AS avg_on_time_index,
         {mean('overcrowding_index', 1)} AS avg_overcrowding_index
  FROM indexed WHERE subregion IS NOT NULL GROUP BY ALL
)"""
INDEXED_OUT = ", ".join(
    ["route_number", "route_name", "subregion", "subregion_code", I("calendar_year"), D("annual_boardings"),
     D("annual_revenue_hours"), D("on_time_performance_pct"), D("pct_trips_overcrowded"), "overcrowding_severity"]
    + [D(b) for _, b, _ in _REC] + ["has_2019_baseline"] + [D(i) for _, _, i in _REC]
)
RECROLL_OUT = ", ".join(
    ["subregion", "subregion_code", I("calendar_year"), D("total_boardings"), D("total_boardings_2019"),
     D("subregion_boardings_index"), I("total_routes"), I("routes_with_baseline"), D("avg_revenue_hours_index"),
     D("avg_on_time_index"), D("avg_overcrowding_index")]
)

STOPS = """
stops_raw AS (
  SELECT 'S' || CAST(c_custkey AS VARCHAR) AS stop_id, CAST(c_custkey AS VARCHAR) AS stop_code,
         c_name AS stop_name, c_mktsegment AS stop_desc,
         CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 0.0005 + 47.75 AS VARCHAR) AS stop_lat,
         CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 0.0003 - 124.5 AS VARCHAR) AS stop_lon,
         c_mktsegment AS zone_id, '' AS stop_url,
         CASE c_mktsegment WHEN 'BUILDING' THEN '1' WHEN 'MACHINERY' THEN '' WHEN 'FURNITURE' THEN 'x'
              ELSE '0' END AS location_type,
         '' AS parent_station, CAST(c_nationkey AS VARCHAR) AS wheelchair_boarding, 'UTC' AS stop_timezone
  FROM customer
),
stops AS (
  SELECT """ + ", ".join(nt(c) + " AS " + c for c in (
    "stop_id", "stop_code", "stop_name", "stop_desc", "stop_lat", "stop_lon", "zone_id", "stop_url",
    "location_type", "parent_station", "wheelchair_boarding", "stop_timezone")) + """ FROM stops_raw
),
stg_stops AS (
  SELECT * FROM (
    SELECT trim(stop_id) AS stop_id, TRY_CAST(stop_code AS DECIMAL(38,0)) AS stop_code,
           trim(stop_name) AS stop_name, trim(stop_desc) AS stop_desc,
           TRY_CAST(stop_lat AS DOUBLE) AS stop_lat, TRY_CAST(stop_lon AS DOUBLE) AS stop_lon,
           trim(zone_id) AS zone_id, trim(stop_url) AS stop_url,
           coalesce(TRY_CAST(location_type AS DECIMAL(38,0)), 0) AS location_type,
           trim(parent_station) AS parent_station,
           TRY_CAST(wheelchair_boarding AS DECIMAL(38,0)) AS wheelchair_boarding,
           trim(stop_timezone) AS stop_timezone
    FROM stops)
  WHERE location_type = 0 AND stop_lat IS NOT NULL AND stop_lon IS NOT NULL
    AND stop_lat BETWEEN 48.0 AND 50.0 AND stop_lon BETWEEN -124.0 AND -121.5
)"""
STOPS_OUT = ("stop_id, CAST(stop_code AS DOUBLE) AS stop_code, stop_name, stop_desc, stop_lat, stop_lon, zone_id, "
             "stop_url, CAST(location_type AS DOUBLE) AS location_type, parent_station, "
             "CAST(wheelchair_boarding AS DOUBLE) AS wheelchair_boarding, stop_timezone")

PARTS = """
parts AS (
  SELECT p_partkey, p_type, p_name,
    CASE WHEN p_type = 'PROMO' THEN 'R' || CAST(p_partkey AS VARCHAR)
         WHEN p_type = 'SMALL' THEN 'n' || CAST(p_partkey AS VARCHAR)
         WHEN p_type = 'LARGE' THEN """ + padded("p_partkey") + " || '/' || " + padded("p_partkey + 1") + """
         WHEN p_type = 'MEDIUM' THEN 'C' || CAST(p_partkey AS VARCHAR)
         WHEN p_type = 'ECONOMY' THEN """ + padded("p_partkey") + """
         ELSE CAST(p_partkey AS VARCHAR) || '.5' END AS route_raw
  FROM part
)"""


def _w(ctes: str, select: str) -> str:
    return "WITH " + ctes.strip().lstrip(",").strip() + "\n" + select


def _failures(c, src: str) -> str:
    """Number of rows (or repeated keys) of `src` that break a check."""
    col = c.columns[0]
    if c.kind == "unique":
        keys = ", ".join(c.columns)
        known = " AND ".join(f"{k} IS NOT NULL" for k in c.columns)
        return f"(SELECT count(*) FROM (SELECT {keys} FROM {src} WHERE {known} GROUP BY {keys} HAVING count(*) > 1))"
    vals = ", ".join(repr(v) if isinstance(v, str) else str(v) for v in c.values)
    broken = {
        "not_null": f"{col} IS NULL",
        "accepted_values": f"{col} IS NOT NULL AND {col} NOT IN ({vals})",
        "range": f"{col} IS NOT NULL AND ({col} < {c.low} OR {col} > {c.high})",
        "non_negative": f"{col} IS NOT NULL AND {col} < 0",
        "domain": f"{col} IS NULL OR {col} NOT IN ({vals})",
    }[c.kind]
    return f"(SELECT count(*) FROM {src} WHERE {broken})"


def _summary(ctes: str, suites: dict, srcs: dict) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c.name}' AS \"check\", '{c.kind}' AS kind, '{c.severity}' AS severity, "
        f"CAST({_failures(c, srcs[table])} AS BIGINT) AS failures"
        for table, checks in suites.items() for c in checks)
    status = "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status"
    return _w(ctes, f"SELECT *, {status} FROM ({rows})")


def _dq_summary() -> str:
    ctes = PERF + ",\n" + LINE[len(SY) + 2:] + ",\n" + STOPS.strip()
    return _summary(ctes, staging_checks(P), {"stg_bus_performance": "perf", "stg_bus_line": "line", "stg_stops": "stg_stops"})


def _dq_summary_marts() -> str:
    ctes = ",\n".join([FACT, RANKING_CTE, SCORED_CTE, INDEXED_CTE])
    return _summary(ctes, mart_checks(P), {
        "dim_routes": "dimr", "dim_subregions": "dims", "fact_route_performance": "fact", "fct_overcrowding_ranking": "ranking",
        "fct_service_gap": "scored", "fct_recovery_trends": "indexed"})


def _hard(ctes: str) -> str:
    """The same CTEs over the reports with harder keys and values."""
    hard = """hard AS (
  SELECT * REPLACE (
    CASE WHEN Lineno_renamed LIKE 'R%' THEN 'C' || substr(Lineno_renamed, 2)
         WHEN Lineno_renamed LIKE '%/%' THEN split_part(Lineno_renamed, '/', 2) || '/' || split_part(Lineno_renamed, '/', 1)
         ELSE Lineno_renamed END AS Lineno_renamed,
    CASE WHEN Lineno_renamed LIKE 'N%' THEN '-' || AnnualBoardings ELSE AnnualBoardings END AS AnnualBoardings)
  FROM reports
),
dedup AS ("""
    return ctes.replace("dedup AS (", hard, 1).replace("FROM reports WHERE CalendarYear", "FROM hard WHERE CalendarYear", 1)


def build() -> dict:
    q = {}
    reports_out = ", ".join(list(YEARLINE_COLUMNS) + ["report_source"])
    q["union_reports"] = _w(REPORTS, f"SELECT {reports_out} FROM reports")
    q["raw_csv_load"] = q["union_reports"]
    q["raw_two_loads"] = _w(REPORTS, f"SELECT {reports_out} FROM reports WHERE report_source = '{LO}' OR CAST(CalendarYear AS INT) <= 1999")
    q["load_log"] = _w(
        REPORTS, "SELECT 'raw_yearline' AS loaded, report_source AS report, "
        f"CAST(count(*) + count(*) FILTER (WHERE report_source = '{LN}' AND CalendarYear = '1997') AS BIGINT) AS rows_loaded, "
        f"CAST(count(*) FILTER (WHERE report_source = '{LN}' AND CalendarYear = '1997') AS BIGINT) AS ragged_rows FROM reports GROUP BY ALL")
    q["raw_csv_stops"] = _w(STOPS, f"SELECT {', '.join(STOPS_COLUMNS)} FROM stops")
    q["source_year_from_path"] = _w(REPORTS, "SELECT report_source, CAST(count(*) AS BIGINT) AS rows_loaded FROM reports GROUP BY 1")
    q["latest_snapshot"] = _w(
        LINE, f"SELECT DISTINCT ON (route_number) route_number, {I('snapshot_year')}, line_raw, subregion FROM line "
        "WHERE route_number IS NOT NULL ORDER BY route_number, line.snapshot_year DESC NULLS FIRST, line_raw ASC NULLS LAST")
    q["bbox_filter"] = _w(
        STOPS, "SELECT stop_id, stop_lat, stop_lon FROM (SELECT stop_id, TRY_CAST(stop_lat AS DOUBLE) AS stop_lat, "
        "TRY_CAST(stop_lon AS DOUBLE) AS stop_lon FROM stops) WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL "
        "AND stop_lat BETWEEN 48.0 AND 50.0 AND stop_lon BETWEEN -124.0 AND -121.5")
    all_ctes = REPORTS + ",\n" + SNAPS[len(SY) + 2:] + ",\n" + STOPS.strip() + ",\n" + SEED.strip()
    q["load_audit"] = _w(
        all_ctes, "SELECT 'raw_yearline' AS loaded, report_source AS label, CAST(count(*) AS BIGINT) AS rows_loaded FROM reports GROUP BY ALL "
        "UNION ALL SELECT 'raw_bus_line', snapshot_year, CAST(count(*) AS BIGINT) FROM snaps GROUP BY ALL "
        "UNION ALL SELECT 'raw_stops', NULL, CAST(count(*) AS BIGINT) FROM stops "
        "UNION ALL SELECT 'subregion_population', NULL, CAST(count(*) AS BIGINT) FROM seed")
    q["null_tokens"] = _w(
        SY + f",\nrawn AS ({_render('all', f'year >= {FN}', LN, tokens=False)})",
        "SELECT " + ", ".join(list(YEARLINE_COLUMNS) + [f"{nt(c)} AS {c}_loaded" for c in YEARLINE_COLUMNS]) + " FROM rawn")
    snap_out = ", ".join([n for _, n in _SNAP_COLS] + ["snapshot_year"])
    q["raw_csv_snapshots"] = _w(SNAPS, f"SELECT {snap_out} FROM snaps")
    q["union_snapshots"] = _w(SNAPS, f"SELECT {snap_out} FROM snaps")
    q["seed_dim"] = _w(SEED.split("),\ndims AS")[0] + ")",
                       f"SELECT subregion_name, subregion_code, {I('population_2021')}, {I('area_km2')} FROM seed")
    q["raw_csv_seed"] = q["seed_dim"]
    q["try_integer"] = _w(
        PARTS, "SELECT p_partkey, route_raw, CAST(TRY_CAST(route_raw AS DECIMAL(38,0)) AS DOUBLE) AS as_integer, "
        "CAST(TRY_CAST(split_part(route_raw, '/', 1) AS DECIMAL(38,0)) AS DOUBLE) AS first_part FROM parts")
    q["try_decimal"] = _w(
        REPORTS, "SELECT report_source, CalendarYear, Lineno_renamed, "
        + ", ".join(f"CAST(TRY_CAST({src} AS DECIMAL({p},{sc})) AS DOUBLE) AS {dst}" for src, dst, p, sc in _MEASURES) + " FROM reports")
    q["try_double"] = _w(STOPS, "SELECT stop_id, TRY_CAST(stop_lat AS DOUBLE) AS lat, "
                                "TRY_CAST(stop_lon AS DOUBLE) AS lon FROM stops")
    q["strip_units"] = _w(
        SNAPS, f"SELECT snapshot_year, Line, {strip('Population')} AS population_str, "
        + ", ".join(f"CAST(TRY_CAST({strip(src)} AS DECIMAL({p},{sc})) AS DOUBLE) AS {dst}" for src, dst, p, sc in _LINE_MEASURES) + " FROM snaps")
    q["canonical_route"] = _w(PARTS, f"SELECT p_partkey, route_raw, {canon('route_raw')} AS route_number, "
                                     "coalesce(contains(route_raw, '/'), false) AS is_combined_route FROM parts")
    q["keyword_classify"] = _w(PARTS, f"SELECT p_partkey, p_name, {classify('p_name', TD.PART_RULES)} AS category FROM parts")
    q["combined_flag"] = _w(PERF, "SELECT is_combined_route, CAST(count(*) AS BIGINT) AS rows FROM perf GROUP BY 1")
    q["year_flag"] = _w(PERF, f"SELECT route_number, {I('calendar_year')}, is_covid_year, "
                              f"calendar_year = {P.base_year} AS is_base_year FROM perf")
    q["boardings_per_hour"] = _w(PERF, f"SELECT route_number, {I('calendar_year')}, {D('boardings_per_service_hour')} FROM perf")
    q["dedupe_latest"] = _w(PERF, "SELECT CalendarYear, Lineno_renamed, report_source, AnnualBoardings FROM dedup WHERE rn = 1")
    q["model_performance"] = _w(PERF, f"SELECT {PERF_OUT} FROM perf")
    q["model_line"] = _w(LINE, f"SELECT {LINE_OUT} FROM line")
    q["exclude_list"] = _w(SNAPS, f"SELECT snapshot_year, CAST(count(*) AS BIGINT) AS excluded_rows FROM snaps "
                                  f"WHERE upper(trim(Line)) IN ({EXCL}) GROUP BY 1")
    q["model_stops"] = _w(STOPS, f"SELECT {STOPS_OUT} FROM stg_stops")
    q["model_dim_routes"] = _w(DIMR, f"SELECT {DIMR_OUT} FROM dimr")
    q["blank_default"] = _w(DIMR, "SELECT route_number, route_name, vehicle_type, service_type FROM dimr")
    q["model_dim_subregions"] = _w(SEED, f"SELECT subregion_name, subregion_code, {I('population_2021')}, "
                                         f"{I('area_km2')}, {D('population_density_per_km2')} FROM dims")
    q["density"] = _w(SEED, f"SELECT subregion_name, {D('population_density_per_km2')} FROM dims")
    periods = ", ".join(f"'{y}'" for y in P.valid_years)
    num = "TRY_CAST(AnnualBoardings AS DECIMAL(18,3))"
    q["revision_audit"] = _w(
        REPORTS + f""",
audited AS (
  SELECT report_source, CalendarYear, Lineno_renamed, {num} AS v FROM reports
  UNION ALL SELECT report_source, CalendarYear, Lineno_renamed, TRY_CAST(AVG_Daily_Boardings_MF AS DECIMAL(18,3)) FROM reports
  WHERE Lineno_renamed LIKE 'R%'
  UNION ALL SELECT '{TD.THIRD_REPORT}', CalendarYear, Lineno_renamed,
    CASE WHEN Lineno_renamed LIKE '%/%' THEN TRY_CAST(AVG_Daily_Boardings_MF AS DECIMAL(18,3)) ELSE {num} END
  FROM reports WHERE report_source = '{LN}' AND CalendarYear >= '1998'
),
held AS (  -- the values of a key in a report, in order
  SELECT CalendarYear AS y, Lineno_renamed AS r, report_source AS s, list(v ORDER BY v NULLS FIRST) AS vs
  FROM audited WHERE CalendarYear IN ({periods}) AND Lineno_renamed IS NOT NULL GROUP BY ALL
),
follows AS (SELECT a.y, a.r, a.s AS older, b.s AS newer, a.vs AS va, b.vs AS vb FROM held b
            JOIN held a ON a.y = b.y AND a.r = b.r
              AND a.s = (SELECT max(c.s) FROM held c WHERE c.y = b.y AND c.r = b.r AND c.s < b.s))""",
        "SELECT y AS calendar_year_raw, r AS route_number_raw, older AS older_report, newer AS newer_report, "
        "CAST(list_min(va) AS DOUBLE) AS value_older, CAST(list_min(vb) AS DOUBLE) AS value_newer, "
        "CAST(list_max(va) AS DOUBLE) AS max_older, CAST(list_max(vb) AS DOUBLE) AS max_newer, "
        "CAST(len(va) AS BIGINT) AS rows_older, CAST(len(vb) AS BIGINT) AS rows_newer, "
        f"CAST(CASE WHEN list_min(va) > 0 THEN {rdiv('list_min(vb) - list_min(va)', 'list_min(va)', 100, 4)} END AS DOUBLE) AS revision_pct "
        "FROM follows WHERE va IS DISTINCT FROM vb")
    q["fact_build"] = _w(FACT, f"SELECT {FACT_OUT} FROM fact")
    q["fact_hard_keys"] = _w(_hard(FACT), f"SELECT {FACT_OUT} FROM fact")
    q["baseline_index"] = _w(FACT, f"SELECT route_number, {I('calendar_year')}, {D('boardings_2019')}, "
                                   f"has_2019_baseline, {D('recovery_rate')} FROM fact")
    q["yoy_change"] = _w(FACT, f"SELECT route_number, {I('calendar_year')}, {I('prior_calendar_year')}, "
                               f"{D('yoy_ridership_change_pct')} FROM fact")
    q["severity_tier"] = _w(FACT, f"SELECT route_number, {I('calendar_year')}, {D('pct_trips_overcrowded')}, "
                                  "overcrowding_severity FROM fact")
    q["persistent_topk"] = _w(RANKING, f"SELECT {RANKING_OUT} FROM ranking")
    q["rank_within_year"] = _w(RANKING, f"SELECT route_number, {I('calendar_year')}, {D('pct_trips_overcrowded')}, "
                                        f"{I('overcrowding_rank')} FROM ranking")
    q["composite_score"] = _w(SCORED, f"SELECT {SCORED_OUT} FROM scored")
    q["gap_rollup"] = _w(SCORED, f"SELECT {GAPROLL_OUT} FROM by_region")
    q["report_gap_by_region"] = q["gap_rollup"]
    known = "subregion IS NOT NULL"
    q["gap_with_rollup"] = _w(
        SCORED, f"SELECT {SCORED_OUT}, {D(f'CASE WHEN {known} THEN here_avg END', 'subregion_avg_gap_score')}, "
        f"{I(f'CASE WHEN {known} THEN here_routes END', 'subregion_route_count')} FROM scored")
    q["multi_index"] = _w(RECOVERY, f"SELECT {INDEXED_OUT} FROM indexed")
    q["recovery_rollup"] = _w(RECOVERY, f"SELECT {RECROLL_OUT} FROM by_region")
    q["report_recovery"] = q["recovery_rollup"]
    q["recovery_with_rollup"] = _w(
        RECOVERY, f"SELECT {INDEXED_OUT}, {D(f'CASE WHEN {known} THEN here_index END', 'subregion_boardings_index')}, "
        f"{I(f'CASE WHEN {known} THEN here_total END', 'subregion_total_routes')} FROM indexed")
    q["ordered_ranking"], q["ordered_gap"], q["ordered_recovery"] = q["persistent_topk"], q["gap_with_rollup"], q["recovery_with_rollup"]
    # data quality
    q["dq_summary"] = _dq_summary()
    q["dq_summary_marts"] = _dq_summary_marts()
    q["dq_not_null"] = _w(PERF, f"SELECT route_number, {I('calendar_year')} FROM perf WHERE pct_trips_overcrowded IS NULL")
    q["dq_unique"] = _w(_hard(PERF), f"SELECT route_number, {I('calendar_year')}, CAST(count(*) AS BIGINT) AS n_records "
                                     "FROM perf WHERE route_number IS NOT NULL AND perf.calendar_year IS NOT NULL "
                                     "GROUP BY route_number, perf.calendar_year HAVING count(*) > 1")
    regions = ", ".join(f"'{r}'" for r in P.subregions)
    q["dq_accepted_values"] = _w(LINE, f"SELECT route_number, {I('snapshot_year')}, subregion FROM line "
                                       f"WHERE subregion IS NOT NULL AND subregion NOT IN ({regions})")
    q["dq_range"] = _w(PERF, f"SELECT route_number, {I('calendar_year')}, {D('on_time_performance_pct')} FROM perf "
                             "WHERE on_time_performance_pct IS NOT NULL AND (on_time_performance_pct < 0 "
                             "OR on_time_performance_pct > 50)")
    q["dq_non_negative"] = _w(_hard(PERF), f"SELECT route_number, {I('calendar_year')}, {D('annual_boardings')} FROM perf "
                                    "WHERE annual_boardings IS NOT NULL AND annual_boardings < 0")
    q["dq_year_domain"] = _w(PERF, f"SELECT route_number, {I('calendar_year')} FROM perf WHERE calendar_year IS NULL "
                                   "OR calendar_year NOT IN (1995, 1996, 1997, 1998)")
    # reports
    years = list(P.valid_years)
    q["report_heatmap"] = _w(
        RANKING, f"SELECT route_number, {I('years_in_top20')}, "
        + ", ".join(f"CAST(max(pct_trips_overcrowded) FILTER (WHERE calendar_year = {y}) AS DOUBLE) AS pct_{y}"
                    for y in years)
        + " FROM ranking WHERE is_persistent_overcrowded GROUP BY route_number, years_in_top20")
    last, prev = years[-1], years[-2]
    q["report_efficiency"] = _w(
        FACT, f"SELECT route_number, subregion, {I('calendar_year')}, {D('boardings_per_service_hour')}, "
        f"{D('pct_trips_overcrowded')}, overcrowding_severity FROM fact WHERE calendar_year = {last} "
        "AND boardings_per_service_hour IS NOT NULL AND pct_trips_overcrowded IS NOT NULL")
    q["report_before_after"] = _w(
        RANKING, "SELECT t.route_number, CAST(t.overcrowding_rank AS BIGINT) AS rank_before, "
        "CAST(t.pct_trips_overcrowded AS DOUBLE) AS pct_before, CAST(f.pct_trips_overcrowded AS DOUBLE) AS pct_after, "
        "CAST(f.pct_trips_overcrowded - t.pct_trips_overcrowded AS DOUBLE) AS change_points, "
        f"CAST({prev} AS BIGINT) AS year_before, CAST({last} AS BIGINT) AS year_after "
        f"FROM (SELECT * FROM ranking WHERE calendar_year = {prev} AND is_top20) t "
        f"LEFT JOIN (SELECT * FROM fact WHERE calendar_year = {last}) f ON t.route_number = f.route_number")
    q["report_reliability"] = _w(
        FACT, f"SELECT subregion, {I('calendar_year')}, CAST(count(route_number) AS BIGINT) AS routes, "
        f"CAST({mean('on_time_performance_pct', 2)} AS DOUBLE) AS avg_on_time_pct, "
        f"CAST({mean('avg_speed_km_per_hr', 2)} AS DOUBLE) AS avg_speed_km_per_hr "
        "FROM fact WHERE subregion IS NOT NULL GROUP BY subregion, calendar_year")
    q["report_every_year"] = _w(
        RANKING, "SELECT route_number, CAST(count(*) AS BIGINT) AS years_in_top20, "
        "CAST(min(overcrowding_rank) AS BIGINT) AS best_rank FROM ranking WHERE is_top20 "
        f"GROUP BY route_number HAVING count(*) >= {len(years)}")
    q["report_system_recovery"] = _w(
        FACT, f"SELECT {I('calendar_year')}, CAST(count(route_number) AS BIGINT) AS routes, "
        "CAST(count(*) FILTER (WHERE has_2019_baseline) AS BIGINT) AS routes_with_baseline, "
        "CAST(sum(annual_boardings) FILTER (WHERE has_2019_baseline) AS DOUBLE) AS total_boardings, "
        "CAST(sum(boardings_2019) FILTER (WHERE has_2019_baseline) AS DOUBLE) AS total_boardings_base, "
        "CAST(CASE WHEN sum(boardings_2019) FILTER (WHERE has_2019_baseline) > 0 THEN "
        + rdiv("sum(annual_boardings) FILTER (WHERE has_2019_baseline)",
                   "sum(boardings_2019) FILTER (WHERE has_2019_baseline)", 100, 1)
        + " END AS DOUBLE) AS system_boardings_index FROM fact GROUP BY calendar_year")
    return q


ORACLE = build()
