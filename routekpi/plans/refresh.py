"""Rebuild only the years that newly landed files revise.

The staging tables before and after the load are compared by key.  A changed
row (route, year) touches its own year and the route's next available year
(the change against the prior one); if it is the base year's, or the route's
dimension changed, all years of the route.  The ranking also changes for the
years of routes whose number of years in the top k did.  Only those year
partitions are written; the others keep their files.
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.audit import among, changed_keys
from ..operators.quality import enforce
from ..schemas import KpiParams
from ..session import materialize
from . import marts
from .checks import mart_checks, staging_checks
from .pipeline import ALL_LAYERS, ALL_SOURCES, PipelineInputs, RunSummary, _write, build_staging, by_year, check_inputs, in_files, layer_summary, load_raw, run_pipeline
from .storage import has_table, layer_path, read_table, recover, replace

log = logging.getLogger("routekpi.refresh")


def _years(df: DataFrame) -> set:
    """The distinct calendar years of a frame (a handful)."""
    return {r[0] for r in df.select("calendar_year").distinct().collect()}


def revised_years(old: DataFrame, new: DataFrame, routes: DataFrame, base_year: int) -> set:
    """Years whose fact rows differ between two staging tables; `routes` have a changed dimension."""
    keys = ("route_number", "calendar_year")
    changed = changed_keys(old, new, keys)
    every = old.select(*keys).union(new.select(*keys)).where("route_number IS NOT NULL").distinct()
    following = every.withColumn("next_year", F.lead("calendar_year").over(Window.partitionBy("route_number").orderBy("calendar_year")))
    follows = changed.join(following, list(keys)).select(F.col("next_year").alias("calendar_year")).where("calendar_year IS NOT NULL")
    whole = routes.select("route_number").union(changed.where(F.col("calendar_year") == base_year).select("route_number")).distinct()
    return _years(changed.select("calendar_year").union(follows).union(every.join(whole, "route_number").select("calendar_year")))


def refresh_revised(spark: SparkSession, inputs: PipelineInputs, warehouse: str, params: KpiParams = KpiParams(),
                    sources=ALL_SOURCES, schemas: dict | None = None) -> RunSummary:
    """Load the files of `inputs`, then bring staging and marts up to date, year by revised year.

    Gives the tables that a full run over all loaded reports would give.  A
    warehouse without marts gets a full run.  `summary.years` names the year
    partitions written of each table.
    """
    t0 = time.time()
    recover(spark, warehouse, schemas)
    _, stg_path, a = (layer_path(warehouse, x, schemas) for x in ALL_LAYERS)
    if not has_table(spark, f"{a}/fct_recovery_trends"):
        return run_pipeline(spark, inputs, warehouse, params, sources=sources, schemas=schemas)
    out = RunSummary()
    out.tables.update(load_raw(spark, inputs, warehouse, check_inputs(spark, inputs, sources), sources, schemas))

    # staging and dimensions anew, beside the written ones.  Those are replaced last: what is lost
    # on the way is found to differ again, and done again, by the next refresh
    stg = {n: materialize(df, n) for n, df in build_staging(spark, warehouse, params, schemas).items()}
    out.checks.extend(enforce(layer_summary(stg, staging_checks(params))))
    read = lambda layer, name: read_table(spark, warehouse, layer, name, schemas)
    dims = {"dim_routes": marts.dim_routes(stg["stg_bus_line"]), "dim_subregions": marts.dim_subregions(read("raw", "subregion_population"))}
    dims = {n: materialize(df, n) for n, df in dims.items()}
    regions = changed_keys(read("marts", "dim_subregions"), dims["dim_subregions"], ("subregion_name",))
    moved = changed_keys(read("marts", "dim_routes"), dims["dim_routes"], ("route_number",))
    inside = dims["dim_routes"].join(regions, F.col("subregion") == F.col("subregion_name")).select("route_number")
    perf = stg["stg_bus_performance"]
    years = revised_years(read("staging", "stg_bus_performance"), perf, moved.union(inside), params.base_year)
    log.info("revised years: %s", sorted(years, key=str))

    def write(name: str, df: DataFrame, touched: set) -> None:
        rows = df.where(among("calendar_year", touched))
        files = by_year(rows) if name == "fact_route_performance" else in_files(rows, name)
        out.tables[name] = replace(spark, f"{a}/{name}", [(files, {})], "calendar_year", keep_others=True, drop=tuple(touched))[0]["rows"]
        out.years[name] = sorted(touched, key=str)

    if years:
        write("fact_route_performance", marts.fact_route_performance(perf, dims["dim_routes"], dims["dim_subregions"], params, with_base=True), years)
        fact = read("marts", "fact_route_performance")
        before = read("marts", "fct_overcrowding_ranking").where("years_in_top20 > 0").select("route_number", "years_in_top20").distinct()
        other = changed_keys(before, marts.topk_years(fact, params), ("route_number",))
        ranked = years | _years(fact.join(other, "route_number").select("calendar_year"))
        write("fct_overcrowding_ranking", marts.overcrowding_ranking_of(fact, ranked, params), ranked)
        write("fct_service_gap", marts.service_gap(fact.where(among("calendar_year", years)), params), years)
        write("fct_recovery_trends", marts.recovery_trends(fact.where(among("calendar_year", years)), params), years)
    for name, df in dims.items():
        out.tables[name] = _write(df, f"{a}/{name}")
    for name, df in stg.items():
        out.tables[name] = _write(df, f"{stg_path}/{name}")
    names = ["dim_routes", "dim_subregions", "fact_route_performance", "fct_overcrowding_ranking", "fct_service_gap", "fct_recovery_trends"]
    out.checks.extend(enforce(layer_summary({n: read("marts", n) for n in names}, mart_checks(params))))
    out.seconds = time.time() - t0
    return out

