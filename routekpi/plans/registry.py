"""Registered queries over the driver's tables: one per operator / model / report.

Each entry is ``f(spark, sf_dir) -> DataFrame`` and runs the engine's own
operators on inputs that Spark derives from the whole tables
(`routekpi.sources.testdata`).  `comparable` gives the column types used
when results are compared with the DuckDB oracle: decimals as DOUBLE and
integers as BIGINT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as K
from ..operators import quality as Q
from ..schemas import BUS_LINE_COLUMNS, BUS_LINE_MEASURES, STOPS_COLUMNS, YEARLINE_COLUMNS, YEARLINE_MEASURES
from ..session import materialize, shared_folder
from ..sources import testdata as TD
from ..sources.csv_raw import read_raw_csv, seed_frame
from . import marts, reports, staging
from .checks import mart_checks, staging_checks
from .pipeline import PipelineInputs, check_inputs, layer_summary, load_raw
from .storage import read_table

P = TD.DRIVER_PARAMS


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ----------------------------------------------------------------- building blocks

def raw_reports(spark, d):
    """Both reports, labelled (derived in one pass; `q_union_reports` runs U1 itself)."""
    return TD.report_rows(spark, d)


def raw_snapshots(spark, d):
    """All snapshots, labelled (one pass; `q_union_snapshots` runs U2 itself)."""
    return TD.snapshot_rows(spark, d)


def stg_perf(spark, d):
    return staging.model_performance(raw_reports(spark, d), P)


def stg_line(spark, d):
    return staging.model_line(raw_snapshots(spark, d), P)


def dim_routes(spark, d):
    return marts.dim_routes(stg_line(spark, d))


def dim_sub(spark, d):
    return marts.dim_subregions(TD.subregion_seed(spark, d))


def fact(spark, d):
    return marts.fact_route_performance(stg_perf(spark, d), dim_routes(spark, d), dim_sub(spark, d), P)


def base_fact(spark, d):
    """The fact as the pipeline writes it, with the base-year values of all indexed metrics."""
    return marts.fact_route_performance(stg_perf(spark, d), dim_routes(spark, d), dim_sub(spark, d), P, with_base=True)


def ranking(spark, d):
    return marts.overcrowding_ranking(fact(spark, d), P)


# ----------------------------------------------------------------- sources / loads

def _exported(spark: SparkSession, d: str, *only: str) -> PipelineInputs:
    """Raw inputs (all, or those of some sources) written as CSV files, tokens as text, in the shared folder."""
    return PipelineInputs(**TD.write_raw_csvs(spark, d, shared_folder(spark, "csv"), *([only] if only else [])))


def q_raw_csv_load(spark: SparkSession, d: str) -> DataFrame:
    """S1/S2/S4: the reports read from CSV files."""
    return read_raw_csv(spark, _exported(spark, d, "yearline").yearline_glob, YEARLINE_COLUMNS, source_col="report_source")


def q_raw_csv_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """S5: the snapshots read from CSV files."""
    return read_raw_csv(spark, _exported(spark, d, "bus_line").bus_line_glob, BUS_LINE_COLUMNS, source_col="snapshot_year")


def q_raw_csv_stops(spark: SparkSession, d: str) -> DataFrame:
    """S6: the stops read from CSV files."""
    return read_raw_csv(spark, _exported(spark, d, "stops").stops_path, STOPS_COLUMNS)


def q_raw_csv_seed(spark: SparkSession, d: str) -> DataFrame:
    """S10: the seed read from its CSV file."""
    return seed_frame(spark, _exported(spark, d, "seed").seed_path)


def q_source_year_from_path(spark, d):
    """S4: the report label each CSV row gets from its file path, counted."""
    return q_raw_csv_load(spark, d).groupBy("report_source").agg(F.count(F.lit(1)).alias("rows_loaded"))


def q_load_audit(spark, d):
    """S3/S8: the raw layer loaded from CSV files, and the rows that its tables hold per label."""
    inputs = _exported(spark, d)
    warehouse = inputs.seed_path.rsplit("/", 1)[0] + "/warehouse"
    load_raw(spark, inputs, warehouse, check_inputs(spark, inputs))
    out = None
    for name, table, label in (("raw_yearline", "yearline", "report_source"), ("raw_bus_line", "bus_line", "snapshot_year"),
                               ("raw_stops", "stops", None), ("subregion_population", "subregion_population", None)):
        rows = read_table(spark, warehouse, "raw", table)
        rows = rows.select(F.lit(name).alias("loaded"), (F.col(label) if label else F.lit(None).cast("string")).alias("label"))
        rows = rows.groupBy("loaded", "label").agg(F.count(F.lit(1)).alias("rows_loaded"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_raw_two_loads(spark, d):
    """S4/S5: both reports loaded, then the newer one again, shortened and alone: the older one stays as it was."""
    land, again = shared_folder(spark, "csv"), shared_folder(spark, "csv")
    warehouse = land.rsplit("/", 1)[0] + "/warehouse"
    TD.write_reports(spark, d, land)
    TD.write_reports(spark, d, again, newer_until=1999, older=False)
    for folder in (land, again):
        inputs = PipelineInputs(yearline_glob=f"{folder}/tspr_bus_yearline_*.csv")
        load_raw(spark, inputs, warehouse, check_inputs(spark, inputs, ("yearline",)), ("yearline",))
    return read_table(spark, warehouse, "raw", "yearline").select("report_source", *YEARLINE_COLUMNS)


def q_load_log(spark, d):
    """S1/S8: rows and ragged rows of every report, counted while its files are loaded.

    The newer report comes with one more folder part whose lines end after ten
    fields: its rows of 1997 once more.
    """
    land = shared_folder(spark, "csv")
    TD.write_reports(spark, d, land)
    path = f"{land}/tspr_bus_yearline_{TD.NEWER_REPORT[0]}.csv"
    some = TD.render_report(TD.supplier_years(spark, d).filter(F.col("year") == 1997), "all", loaded=False)
    some.select(*YEARLINE_COLUMNS[:10]).write.mode("append").options(**TD.CSV_OPTIONS).csv(path)
    inputs = PipelineInputs(yearline_glob=f"{land}/tspr_bus_yearline_*.csv")
    warehouse = land.rsplit("/", 1)[0] + "/warehouse"
    load_raw(spark, inputs, warehouse, check_inputs(spark, inputs, ("yearline",)), ("yearline",))
    log = read_table(spark, warehouse, "raw", "load_log")
    return log.groupBy("loaded", "report").agg(F.sum("rows").alias("rows_loaded"), F.sum("ragged_rows").alias("ragged_rows"))


def q_null_tokens(spark, d):
    """S2: every column of the newer report before and after the null tokens are read as NULL."""
    raw = TD.render_report(TD.supplier_years(spark, d).filter(TD._newer_rows()), "all", loaded=False)
    return raw.select("*", *[K.null_tokens(c).alias(f"{c}_loaded") for c in YEARLINE_COLUMNS])


def q_union_reports(spark, d):
    """U1: UNION ALL of the two report frames, each tagged with its label."""
    return staging.union_reports(TD.yearline_reports(spark, d))


def q_union_snapshots(spark, d):
    """U2: UNION ALL of the four snapshot frames, each tagged with its year."""
    return staging.union_snapshots(TD.bus_line_snapshots(spark, d))


def q_seed_dim(spark, d):
    return TD.subregion_seed(spark, d)


# ----------------------------------------------------------------- expressions

def q_try_integer(spark, d):
    p = TD.part_codes(spark, d)
    return p.select("p_partkey", "route_raw", K.try_integer("route_raw").alias("as_integer"),
                    K.try_integer(F.split_part("route_raw", F.lit("/"), F.lit(1))).alias("first_part"))


def q_try_decimal(spark, d):
    r = raw_reports(spark, d)
    return r.select("report_source", "CalendarYear", "Lineno_renamed",
                    *[K.try_decimal(src, p, s).alias(dst) for src, dst, p, s in YEARLINE_MEASURES])


def q_try_double(spark, d):
    s = TD.raw_stops(spark, d)
    return s.select("stop_id", K.try_double("stop_lat").alias("lat"), K.try_double("stop_lon").alias("lon"))


def q_strip_units(spark, d):
    r = raw_snapshots(spark, d)
    return r.select("snapshot_year", "Line", K.strip_units("Population").alias("population_str"),
                    *[K.parse_with_units(src, p, s).alias(dst) for src, dst, p, s in BUS_LINE_MEASURES])


def q_canonical_route(spark, d):
    p = TD.part_codes(spark, d)
    return p.select("p_partkey", "route_raw", K.canonical_route("route_raw").alias("route_number"),
                    K.combined_flag("route_raw").alias("is_combined_route"))


def q_combined_flag(spark, d):
    return stg_perf(spark, d).groupBy("is_combined_route").agg(F.count(F.lit(1)).alias("rows"))


def q_keyword_classify(spark, d):
    p = TD.part_codes(spark, d)
    return p.select("p_partkey", "p_name", K.keyword_classify("p_name", TD.PART_RULES).alias("category"))


def q_blank_default(spark, d):
    r = dim_routes(spark, d)
    return r.select("route_number", "route_name", "vehicle_type", "service_type")


def q_density(spark, d):
    return dim_sub(spark, d).select("subregion_name", "population_density_per_km2")


def q_severity_tier(spark, d):
    return fact(spark, d).select("route_number", "calendar_year", "pct_trips_overcrowded", "overcrowding_severity")


def q_year_flag(spark, d):
    return stg_perf(spark, d).select("route_number", "calendar_year", "is_covid_year",
                                     K.year_flag("calendar_year", P.base_year).alias("is_base_year"))


def q_boardings_per_hour(spark, d):
    return stg_perf(spark, d).select("route_number", "calendar_year", "boardings_per_service_hour")


# ----------------------------------------------------------------- models

def q_dedupe_latest(spark, d):
    from ..operators.dedupe import latest_per_key

    r = raw_reports(spark, d)
    return latest_per_key(r, ["CalendarYear", "Lineno_renamed"], ["report_source"],
                          tiebreak=[c for c in YEARLINE_COLUMNS[2:]]).select(
        "CalendarYear", "Lineno_renamed", "report_source", "AnnualBoardings")


def q_model_performance(spark, d):
    return stg_perf(spark, d)


def q_model_line(spark, d):
    return stg_line(spark, d)


def q_exclude_list(spark, d):
    r = raw_snapshots(spark, d)
    return r.filter(K.excluded("Line", P.excluded_services)).groupBy("snapshot_year").agg(
        F.count(F.lit(1)).alias("excluded_rows"))


def q_model_stops(spark, d):
    return staging.model_stops(TD.raw_stops(spark, d), P)


def q_latest_snapshot(spark, d):
    """W5 + F3: each route's newest snapshot row."""
    from ..operators.dedupe import latest_per_key

    line = stg_line(spark, d).filter(F.col("route_number").isNotNull())
    return latest_per_key(line, ["route_number"], ["snapshot_year"], tiebreak=["line_raw"]).select(
        "route_number", "snapshot_year", "line_raw", "subregion")


def q_bbox_filter(spark, d):
    """typed stops with coordinates inside the inclusive box (any location type)."""
    from ..operators.audit import bbox_filter

    s = TD.raw_stops(spark, d).select("stop_id", K.try_double("stop_lat").alias("stop_lat"),
                                      K.try_double("stop_lon").alias("stop_lon"))
    return bbox_filter(s, "stop_lat", "stop_lon", P.lat_range, P.lon_range)


def q_model_dim_routes(spark, d):
    return dim_routes(spark, d)


def q_model_dim_subregions(spark, d):
    return dim_sub(spark, d)


def q_revision_audit(spark, d):
    """J9/Q8 over three reports, with keys that a report repeats."""
    return staging.report_revisions(TD.audit_rows(spark, d), P)


def q_fact_build(spark, d):
    return fact(spark, d)


def hard_perf(spark, d):
    return staging.model_performance(TD.hard_rows(spark, d), P)


def q_fact_hard_keys(spark, d):
    """The fact over rows without a route, several codes of one route, and negative boardings."""
    return marts.fact_route_performance(hard_perf(spark, d), dim_routes(spark, d), dim_sub(spark, d), P)


def q_baseline_index(spark, d):
    return fact(spark, d).select("route_number", "calendar_year", "boardings_2019", "has_2019_baseline",
                                 "recovery_rate")


def q_yoy_change(spark, d):
    return fact(spark, d).select("route_number", "calendar_year", "prior_calendar_year",
                                 "yoy_ridership_change_pct")


def q_rank_within_year(spark, d):
    return ranking(spark, d).select("route_number", "calendar_year", "pct_trips_overcrowded", "overcrowding_rank")


def q_persistent_topk(spark, d):
    return ranking(spark, d)


def q_ordered_ranking(spark, d):
    """O1: the ranking by year and rank."""
    return marts.in_order(ranking(spark, d), "fct_overcrowding_ranking")


def q_ordered_gap(spark, d):
    """O2: the service gap by year, largest score first."""
    return marts.in_order(marts.service_gap(fact(spark, d), P), "fct_service_gap")


def q_ordered_recovery(spark, d):
    """O3: the recovery trends by sub-region, route and year."""
    return marts.in_order(marts.recovery_trends(base_fact(spark, d), P), "fct_recovery_trends")


def q_composite_score(spark, d):
    return marts.service_gap_scored(fact(spark, d), P)


def q_gap_rollup(spark, d):
    return marts.gap_rollup(marts.service_gap_scored(fact(spark, d), P))


def q_gap_with_rollup(spark, d):
    return marts.service_gap(fact(spark, d), P)


def q_multi_index(spark, d):
    return marts.recovery_indexed(base_fact(spark, d), P)


def q_recovery_rollup(spark, d):
    return marts.recovery_rollup(marts.recovery_indexed(base_fact(spark, d), P))


def q_recovery_with_rollup(spark, d):
    return marts.recovery_trends(base_fact(spark, d), P)


# ----------------------------------------------------------------- data quality

def _stg_checks():
    return staging_checks(P)


def q_dq_summary(spark, d):
    """The staging layer's checks, as the pipeline's gate runs them: each table is evaluated once."""
    tables = {"stg_bus_performance": stg_perf(spark, d), "stg_bus_line": stg_line(spark, d),
              "stg_stops": staging.model_stops(TD.raw_stops(spark, d), P)}
    return layer_summary(tables, _stg_checks())


def q_dq_summary_marts(spark, d):
    """The mart layer's checks, the warn one included."""
    routes, regions = materialize(dim_routes(spark, d), "dim_routes"), materialize(dim_sub(spark, d), "dim_subregions")
    f = materialize(marts.fact_route_performance(stg_perf(spark, d), routes, regions, P, with_base=True), "fact")
    built = {"fct_overcrowding_ranking": marts.overcrowding_ranking(f, P), "fct_service_gap": marts.service_gap(f, P),
             "fct_recovery_trends": marts.recovery_trends(f, P)}
    return layer_summary({"dim_routes": routes, "dim_subregions": regions, "fact_route_performance": f, **built}, mart_checks(P))


def _violations(spark, d, table, check):
    src = {"stg_bus_performance": stg_perf, "stg_bus_line": stg_line}[table](spark, d)
    return Q.violations(src, check)


def q_dq_not_null(spark, d):
    return _violations(spark, d, "stg_bus_performance", Q.not_null("pct_trips_overcrowded")).select(
        "route_number", "calendar_year")


def q_dq_unique(spark, d):
    """Routes that several raw codes name in one year."""
    return Q.violations(hard_perf(spark, d), Q.unique("route_number", "calendar_year"))


def q_dq_accepted_values(spark, d):
    return _violations(spark, d, "stg_bus_line", Q.accepted_values("subregion", P.subregions)).select(
        "route_number", "snapshot_year", "subregion")


def q_dq_range(spark, d):
    return _violations(spark, d, "stg_bus_performance", Q.in_range("on_time_performance_pct", 0, 50)).select(
        "route_number", "calendar_year", "on_time_performance_pct")


def q_dq_non_negative(spark, d):
    return Q.violations(hard_perf(spark, d), Q.non_negative("annual_boardings")).select(
        "route_number", "calendar_year", "annual_boardings")


def q_dq_year_domain(spark, d):
    return _violations(spark, d, "stg_bus_performance", Q.domain("calendar_year", (1995, 1996, 1997, 1998))).select(
        "route_number", "calendar_year")


# ----------------------------------------------------------------- reports

def q_report_heatmap(spark, d):
    return reports.report_heatmap(fact(spark, d), P)


def q_report_gap_by_region(spark, d):
    return reports.report_gap_by_region(fact(spark, d), P)


def q_report_recovery(spark, d):
    return reports.report_recovery(base_fact(spark, d), P)


def q_report_efficiency(spark, d):
    return reports.report_efficiency(fact(spark, d), P)


def q_report_before_after(spark, d):
    return reports.report_before_after(fact(spark, d), P)


def q_report_reliability(spark, d):
    return reports.report_reliability(fact(spark, d))


def q_report_every_year(spark, d):
    return reports.report_every_year(fact(spark, d), P)


def q_report_system_recovery(spark, d):
    return reports.report_system_recovery(fact(spark, d))


QUERIES = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def registered(name: str):
    fn = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(spark, sf_dir))

    run.__name__ = name
    run.__doc__ = fn.__doc__
    return run
