"""Report queries over the marts (the dashboard panels and the headline findings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import top_k
from ..operators.rollup import mean, weighted_index
from ..schemas import KpiParams
from .marts import gap_rollup, recovery_indexed, recovery_rollup, service_gap_scored, to_rank
from .storage import read_table


def top_routes(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """The top k rows of each year with their rank.

    A WindowGroupLimit keeps k rows per year in every map task, so reports on
    the top never compute the whole ranking.
    """
    perf, order = to_rank(fact)
    return top_k(perf, "calendar_year", order, params.top_k, rank_col="overcrowding_rank")


def report_heatmap(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """Persistent routes x years, cell = overcrowding pct (explicit pivot values: no extra job)."""
    years = list(params.valid_years)
    often = top_routes(fact, params).groupBy(F.col("route_number").alias("_often")).agg(F.count(F.lit(1)).alias("years_in_top20"))
    often = often.filter(F.col("years_in_top20") >= params.persistent_min_years)
    cells = to_rank(fact)[0].select("route_number", "calendar_year", "pct_trips_overcrowded").join(often, F.col("route_number") == F.col("_often"))
    return _heatmap(cells, years)


def _heatmap(cells: DataFrame, years: list) -> DataFrame:
    return (
        cells.groupBy("route_number", "years_in_top20")
        .pivot("calendar_year", years)
        .agg(F.max("pct_trips_overcrowded"))
        .withColumnsRenamed({str(y): f"pct_{y}" for y in years})
        .orderBy(F.col("years_in_top20").desc(), "route_number")
    )


def report_gap_by_region(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """Gap rollup per sub-region and year, with the most strained route (worst first)."""
    return gap_rollup(service_gap_scored(fact, params)).orderBy(
        "calendar_year", F.col("avg_gap_score").desc_nulls_last(), "subregion")


def report_recovery(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """Recovery rollup per sub-region and year (base year = 100)."""
    return recovery_rollup(recovery_indexed(fact, params)).orderBy("subregion", "calendar_year")


def report_efficiency(fact: DataFrame, params: KpiParams = KpiParams(), year: int | None = None) -> DataFrame:
    """Efficiency vs overcrowding points for one year (default: the last accepted year)."""
    year = year if year is not None else max(params.valid_years)
    return fact.filter(
        (F.col("calendar_year") == year)
        & F.col("boardings_per_service_hour").isNotNull()
        & F.col("pct_trips_overcrowded").isNotNull()
    ).select("route_number", "subregion", "calendar_year", "boardings_per_service_hour",
             "pct_trips_overcrowded", "overcrowding_severity")


def report_before_after(fact: DataFrame, params: KpiParams = KpiParams(),
                        before: int | None = None, after: int | None = None) -> DataFrame:
    """Top-k routes of the `before` year and their overcrowding in `after` (change in points)."""
    years = sorted(params.valid_years)
    before = before if before is not None else years[-2]
    after = after if after is not None else years[-1]
    return _before_after(top_routes(fact.filter(F.col("calendar_year") == before), params), fact, before, after)


def _before_after(top: DataFrame, fact: DataFrame, before: int, after: int) -> DataFrame:
    top = top.select(
        "route_number", F.col("overcrowding_rank").alias("rank_before"),
        F.col("pct_trips_overcrowded").alias("pct_before"),
    )
    later = fact.filter(F.col("calendar_year") == after).select(
        "route_number", F.col("pct_trips_overcrowded").alias("pct_after")
    )
    return (
        top.join(later, "route_number", "left")
        .withColumn("change_points", F.col("pct_after") - F.col("pct_before"))
        .withColumn("year_before", F.lit(before))
        .withColumn("year_after", F.lit(after))
        .orderBy("rank_before")
    )


def report_reliability(fact: DataFrame) -> DataFrame:
    """On-time performance and speed per sub-region and year."""
    return (
        fact.filter(F.col("subregion").isNotNull())
        .groupBy("subregion", "calendar_year")
        .agg(
            F.count("route_number").alias("routes"),
            mean("on_time_performance_pct", 2).alias("avg_on_time_pct"),
            mean("avg_speed_km_per_hr", 2).alias("avg_speed_km_per_hr"),
        )
        .orderBy("subregion", "calendar_year")
    )


def report_every_year(fact: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """Routes in the top k in every accepted year."""
    n = len(params.valid_years)
    return (
        top_routes(fact, params)
        .groupBy("route_number")
        .agg(F.count(F.lit(1)).alias("years_in_top20"), F.min("overcrowding_rank").alias("best_rank"))
        .filter(F.col("years_in_top20") >= n)
        .orderBy("best_rank", "route_number")
    )


def report_system_recovery(fact: DataFrame) -> DataFrame:
    """System-wide boardings vs the base year, per year (routes with a baseline)."""
    has = F.col("has_2019_baseline")
    return fact.groupBy("calendar_year").agg(
        F.count("route_number").alias("routes"),
        F.count_if(has).alias("routes_with_baseline"),
        F.sum(F.when(has, F.col("annual_boardings"))).alias("total_boardings"),
        F.sum(F.when(has, F.col("boardings_2019"))).alias("total_boardings_base"),
        weighted_index(F.when(has, F.col("annual_boardings")), F.when(has, F.col("boardings_2019"))).alias(
            "system_boardings_index"
        ),
    ).orderBy("calendar_year")


def written_report(spark: SparkSession, warehouse: str, name: str, params: KpiParams = KpiParams(), schemas: dict | None = None) -> DataFrame:
    """A panel's rows from the written marts, as a dashboard reads them.

    Ranks, persistence, scores and indices are those that the marts hold; nothing
    is ranked or indexed again, and a panel on some years reads their partitions
    only.  The rows are those of the function of the same name over the fact
    (`params` must be the marts' own).
    """
    mart = lambda table: read_table(spark, warehouse, "marts", table, schemas)
    years = sorted(params.valid_years)
    if name == "report_heatmap":
        return _heatmap(mart("fct_overcrowding_ranking").filter("is_persistent_overcrowded"), list(params.valid_years))
    if name == "report_every_year":
        top = mart("fct_overcrowding_ranking").filter(F.col("is_top20") & (F.col("years_in_top20") >= len(years)))
        return top.groupBy("route_number", "years_in_top20").agg(F.min("overcrowding_rank").alias("best_rank")).orderBy("best_rank", "route_number")
    if name == "report_before_after":
        ranking = mart("fct_overcrowding_ranking")
        top = ranking.filter((F.col("calendar_year") == years[-2]) & F.col("is_top20"))
        return _before_after(top, mart("fact_route_performance"), years[-2], years[-1])
    if name == "report_gap_by_region":
        return gap_rollup(mart("fct_service_gap")).orderBy("calendar_year", F.col("avg_gap_score").desc_nulls_last(), "subregion")
    if name == "report_recovery":
        return recovery_rollup(mart("fct_recovery_trends")).orderBy("subregion", "calendar_year")
    fact = mart("fact_route_performance")
    return {"report_efficiency": lambda: report_efficiency(fact, params), "report_reliability": lambda: report_reliability(fact),
            "report_system_recovery": lambda: report_system_recovery(fact)}[name]()


PANELS = ("report_heatmap", "report_gap_by_region", "report_recovery", "report_efficiency", "report_before_after", "report_reliability",
          "report_every_year", "report_system_recovery")
