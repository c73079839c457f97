"""Mini end-to-end golden (FIXTURES §3) through the CSV pipeline, and the gate."""

import os
import tempfile
from decimal import Decimal

import pytest

from routekpi.operators.quality import QualityGateError
from routekpi.plans.pipeline import PipelineInputs, run_pipeline, summary_frame
from tests.fixtures_kpi import write_inputs


def inputs_for(root):
    return PipelineInputs(
        yearline_glob=f"{root}/tspr_bus_yearline_*.csv",
        bus_line_glob=f"{root}/TSPR_OpenData_Archive_*.csv",
        stops_path=f"{root}/gtfs/stops.csv",
    )


@pytest.fixture(scope="module")
def built(spark):
    base = tempfile.mkdtemp(prefix="routekpi-e2e-", dir=os.environ.get("ROUTEKPI_SCRATCH", "/tmp"))
    raw = write_inputs(f"{base}/in")
    wh = f"{base}/wh"
    summary = run_pipeline(spark, inputs_for(raw), wh)
    read = lambda layer, name: spark.read.parquet(f"{wh}/{layer}/{name}")
    return {"summary": summary, "read": read, "wh": wh, "raw": raw}


def by_key(rows, *keys):
    return {tuple(getattr(r, k) for k in keys): r for r in rows}


def s(v):
    return None if v is None else str(v)


FACT = {
    # route, year: baseline?, recovery, prior year, change, severity, board/svc h (4 dp)
    ("5", 2019): (True, "100.0", None, None, "Low", "8.3333"),
    ("5", 2022): (True, "70.5", 2019, "-29.50", "High", "6.4091"),
    ("5", 2023): (True, "80.5", 2022, "14.18", "High", "7.0000"),
    ("5", 2024): (True, "90.5", 2023, "12.42", "Critical", "7.6695"),
    ("R4", 2023): (False, None, None, None, "Medium", "6.6667"),
    ("R4", 2024): (False, None, 2023, "25.00", "Medium", "7.1429"),
    ("10", 2019): (True, None, None, None, "Low", None),
    ("10", 2022): (True, None, 2019, None, "Low", "2.0000"),
    ("49", 2019): (True, "100.0", None, None, "Unknown", "6.0000"),
    ("99", 2019): (True, "100.0", None, None, "Medium", "8.0000"),
    ("99", 2024): (True, "125.0", 2019, "25.00", "Medium", "9.2593"),
}


def test_fact(built):
    rows = built["read"]("analytics", "fact_route_performance").collect()
    got = by_key(rows, "route_number", "calendar_year")
    assert set(got) == set(FACT)
    for k, (base, rec, prior, chg, sev, bph) in FACT.items():
        r = got[k]
        bph_got = None if r.boardings_per_service_hour is None else str(round(r.boardings_per_service_hour, 4))
        assert (r.has_2019_baseline, s(r.recovery_rate), r.prior_calendar_year, s(r.yoy_ridership_change_pct),
                r.overcrowding_severity, bph_got) == (base, rec, prior, chg, sev, bph), k
    assert got[("5", 2022)].report_source == "2024" and got[("5", 2019)].report_source == "2023"
    assert got[("5", 2022)].is_combined_route and not got[("R4", 2023)].is_combined_route
    assert got[("5", 2019)].subregion == "Vancouver/UBC" and got[("10", 2019)].subregion == "North Shore"
    assert got[("99", 2019)].subregion is None and got[("5", 2019)].subregion_code == "VAN"
    assert got[("49", 2019)].route_name == "49"  # blank name falls back to the route number


RECOVERY = {
    ("5", 2019): ("100.0", "100.0", "100.0", "100.0"),
    ("5", 2022): ("70.5", "90.0", "97.5", "306.1"),
    ("5", 2023): ("80.5", "95.0", "102.5", "408.2"),
    ("5", 2024): ("90.5", "98.0", "105.0", "612.2"),
    ("R4", 2023): (None, None, None, None),
    ("10", 2019): (None, "100.0", "100.0", None),
    ("10", 2022): (None, "120.0", "101.1", None),
    ("49", 2019): ("100.0", "100.0", "100.0", None),
    ("99", 2024): ("125.0", "110.0", "97.7", "124.9"),
}


def test_recovery_indices(built):
    got = by_key(built["read"]("analytics", "fct_recovery_trends").collect(), "route_number", "calendar_year")
    for k, exp in RECOVERY.items():
        r = got[k]
        assert tuple(s(x) for x in (r.boardings_index, r.revenue_hours_index, r.on_time_index,
                                    r.overcrowding_index)) == exp, k
    assert s(got[("5", 2019)].subregion_boardings_index) == "100.0"
    assert got[("5", 2023)].subregion_total_routes == 2
    assert got[("99", 2024)].subregion_boardings_index is None


GAP = {
    ("5", 2019): ("4.90", "60.00", "50.00", "30.45"),
    ("5", 2022): ("15.00", "66.67", "55.00", "38.50"),
    ("5", 2023): ("20.00", "80.00", "60.00", "46.00"),
    ("5", 2024): ("30.00", "100.00", "70.00", "59.00"),
    ("R4", 2023): ("5.00", "73.33", "80.00", "40.50"),
    ("R4", 2024): ("11.20", "86.67", "90.00", "49.60"),
    ("10", 2019): ("0.00", "6.67", "5.00", "3.00"),
    ("10", 2022): ("1.00", "13.33", "10.00", "6.50"),
    ("99", 2019): ("12.00", "53.33", "45.00", "31.00"),
    ("99", 2024): ("14.99", "60.00", "120.00", "49.50"),
}


def test_service_gap(built):
    got = by_key(built["read"]("analytics", "fct_service_gap").collect(), "route_number", "calendar_year")
    assert set(got) == set(GAP)  # route 49 has NULL inputs: absent
    for k, exp in GAP.items():
        r = got[k]
        assert tuple(s(x) for x in (r.component_overcrowding_freq, r.component_peak_load,
                                    r.component_capacity_util, r.gap_score)) == exp, k
    assert s(got[("5", 2023)].subregion_avg_gap_score) == "43.25"
    assert got[("99", 2019)].subregion_avg_gap_score is None


def test_ranking_and_persistence(built):
    rows = built["read"]("analytics", "fct_overcrowding_ranking").collect()
    order = {}
    for r in sorted(rows, key=lambda r: (r.calendar_year, r.overcrowding_rank)):
        order.setdefault(r.calendar_year, []).append(r.route_number)
    assert order == {2019: ["99", "5", "10"], 2022: ["5", "10"], 2023: ["5", "R4"], 2024: ["5", "99", "R4"]}
    years = {r.route_number: (r.years_in_top20, r.is_persistent_overcrowded) for r in rows}
    assert years == {"5": (4, True), "10": (2, False), "R4": (2, False), "99": (2, False)}
    assert all(r.is_top20 for r in rows)


def test_persistence_with_small_k(spark, built):
    from routekpi.plans.marts import overcrowding_ranking
    from routekpi.schemas import KpiParams

    fact = built["read"]("analytics", "fact_route_performance")
    for method in ("range", "window"):
        rows = overcrowding_ranking(fact, KpiParams(top_k=1, persistent_min_years=3), method=method).collect()
        got = {r.route_number: (r.years_in_top20, r.is_persistent_overcrowded) for r in rows}
        assert got["5"] == (3, True) and got["99"] == (1, False) and got["R4"] == (0, False)


ROLLUPS = {
    # (subregion, year): routes, with baseline, boardings, base, index, rev idx, on-time idx, pct idx
    ("Vancouver/UBC", 2019): (2, 2, "1600.000", "1600.000", "100.0", "100.0", "100.0", "100.0"),
    ("Vancouver/UBC", 2022): (1, 1, "705.000", "1000.000", "70.5", "90.0", "97.5", "306.1"),
    ("Vancouver/UBC", 2023): (2, 1, "805.000", "1000.000", "80.5", "95.0", "102.5", "408.2"),
    ("Vancouver/UBC", 2024): (2, 1, "905.000", "1000.000", "90.5", "98.0", "105.0", "612.2"),
    ("North Shore", 2019): (1, 1, "0.000", "0.000", None, "100.0", "100.0", None),
    ("North Shore", 2022): (1, 1, "30.000", "0.000", None, "120.0", "101.1", None),
}
GAP_ROLLUPS = {
    ("Vancouver/UBC", 2019): (1, "30.45", "30.45", "5"),
    ("Vancouver/UBC", 2022): (1, "38.50", "38.50", "5"),
    ("Vancouver/UBC", 2023): (2, "43.25", "46.00", "5"),
    ("Vancouver/UBC", 2024): (2, "54.30", "59.00", "5"),
    ("North Shore", 2019): (1, "3.00", "3.00", "10"),
    ("North Shore", 2022): (1, "6.50", "6.50", "10"),
}


def test_rollups(spark, built):
    from routekpi.plans import marts

    fact = built["read"]("analytics", "fact_route_performance")
    rec = by_key(marts.recovery_rollup(marts.recovery_indexed(fact)).collect(), "subregion", "calendar_year")
    assert set(rec) == set(ROLLUPS)
    for k, exp in ROLLUPS.items():
        r = rec[k]
        assert (r.total_routes, r.routes_with_baseline, s(r.total_boardings), s(r.total_boardings_2019),
                s(r.subregion_boardings_index), s(r.avg_revenue_hours_index), s(r.avg_on_time_index),
                s(r.avg_overcrowding_index)) == exp, k
    gap = by_key(marts.gap_rollup(marts.service_gap_scored(fact)).collect(), "subregion", "calendar_year")
    assert set(gap) == set(GAP_ROLLUPS)
    for k, (n, avg, mx, top) in GAP_ROLLUPS.items():
        r = gap[k]
        assert (r.route_count, s(r.avg_gap_score), s(r.max_gap_score), r.most_strained_route) == (n, avg, mx, top), k


def test_revision_audit(spark, built):
    from routekpi.plans.staging import report_revisions
    from routekpi.schemas import YEARLINE_COLUMNS
    from routekpi.sources.csv_raw import read_raw_csv

    raw = built["raw"]
    reports = {y: read_raw_csv(spark, f"{raw}/tspr_bus_yearline_{y}.csv", YEARLINE_COLUMNS) for y in ("2023", "2024")}
    from routekpi.sources.csv_raw import union_sources

    rows = report_revisions(union_sources(reports, "report_source")).collect()
    got = sorted((r.calendar_year_raw, r.route_number_raw, int(r.value_older), int(r.value_newer), s(r.revision_pct)) for r in rows)
    assert got == [("2022", "005/006", 700, 705, "0.7143"), ("2023", "005/006", 800, 805, "0.6250")]


def test_staging_and_stops(built):
    perf = built["read"]("staging", "stg_bus_performance").collect()
    assert len(perf) == 11
    r49 = [r for r in perf if r.route_number == "49"][0]
    assert r49.pct_trips_overcrowded is None and r49.avg_peak_load_factor is None
    line = built["read"]("staging", "stg_bus_line").collect()
    assert sorted(r.route_number for r in line) == ["10", "49", "5", "R4"]  # SeaBus excluded
    assert {r.route_number: r.corridor_population for r in line}["5"] == Decimal("1234")
    stops = built["read"]("staging", "stg_stops").collect()
    assert sorted(r.stop_id for r in stops) == ["S1", "S4"]


def test_summary_and_checks(spark, built):
    summary = built["summary"]
    assert summary.tables["raw_yearline"] == 13 and summary.tables["fact_route_performance"] == 11
    assert all(c["status"] in ("pass", "warn") for c in summary.checks)
    assert len([c for c in summary.checks if c["table"].startswith("stg_")]) == 25
    df = summary_frame(spark, summary)
    assert df.filter("checks_failed > 0").count() == 0


def test_rerun_is_idempotent(spark, built):
    before = sorted(map(tuple, built["read"]("analytics", "fct_service_gap").collect()), key=str)
    run_pipeline(spark, inputs_for(built["raw"]), built["wh"])
    after = sorted(map(tuple, built["read"]("analytics", "fct_service_gap").collect()), key=str)
    assert before == after


def test_gate_blocks_marts(spark, scratch):
    bad = [
        ("077", 2022, "", "1", "1", "1", "1", "1", "1"),          # NULL boardings
        ("078", 2022, "10", "1", "1", "1", "1", "-0.1", "1"),     # pct below range
        ("079", 2022, "10", "1", "1", "1", "1", "100.1", "1"),    # pct above range
        ("080", 2022, "-1", "1", "1", "1", "1", "1", "1"),        # negative boardings
        ("081", 2025, "10", "1", "1", "1", "1", "1", "1"),        # year outside domain
        ("005", 2024, "10", "1", "1", "1", "1", "1", "1"),        # '5' twice in 2024
    ]
    raw = write_inputs(f"{scratch}/in", extra_yearline=bad)
    with pytest.raises(QualityGateError) as err:
        run_pipeline(spark, inputs_for(raw), f"{scratch}/wh")
    failing = {f["check"] for f in err.value.failures}
    assert {"not_null_annual_boardings", "range_pct_trips_overcrowded", "non_negative_annual_boardings",
            "domain_calendar_year", "accepted_values_calendar_year", "unique_route_number_calendar_year"} <= failing
    assert not os.path.exists(f"{scratch}/wh/analytics")


def test_warn_severity_does_not_block(spark, scratch):
    from routekpi.schemas import SUBREGIONS, KpiParams

    lines = [("005", "Main St", "Atlantis", "Diesel", "Local", "1")]
    raw = write_inputs(f"{scratch}/in", lines=lines)
    # the unmatched sub-region is an error on the staging table unless accepted there
    params = KpiParams(subregions=SUBREGIONS + ("Atlantis",))
    summary = run_pipeline(spark, inputs_for(raw), f"{scratch}/wh", params)
    assert os.path.exists(f"{scratch}/wh/analytics/fct_service_gap")
    assert summary.tables["dim_routes"] == 1


def test_missing_inputs(spark, scratch):
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, inputs_for(f"{scratch}/nothing"), f"{scratch}/wh")


def test_stops_are_optional(spark, scratch, caplog):
    raw = write_inputs(f"{scratch}/in", stops=None)
    summary = run_pipeline(spark, inputs_for(raw), f"{scratch}/wh")
    assert "raw_stops" not in summary.tables and summary.tables["stg_stops"] == 0
    assert "no stops file" in caplog.text


def test_missing_stops_keep_the_loaded_table(spark, scratch):
    run_pipeline(spark, inputs_for(write_inputs(f"{scratch}/in")), f"{scratch}/wh")
    before = spark.read.parquet(f"{scratch}/wh/raw/stops").count()
    summary = run_pipeline(spark, inputs_for(write_inputs(f"{scratch}/in2", stops=None)), f"{scratch}/wh")
    assert before > 0 and spark.read.parquet(f"{scratch}/wh/raw/stops").count() == before
    assert summary.tables["stg_stops"] == 2


def test_source_scoped_load_needs_only_its_files(spark, scratch):
    from routekpi.plans.pipeline import PipelineInputs

    raw = write_inputs(f"{scratch}/in")
    only = PipelineInputs(stops_path=f"{raw}/gtfs/stops.csv")
    summary = run_pipeline(spark, only, f"{scratch}/wh", layers=("raw",), sources=("stops",))
    assert set(summary.tables) == {"raw_stops", "subregion_population"}
    with pytest.raises(FileNotFoundError, match="bus_line"):
        run_pipeline(spark, only, f"{scratch}/wh", layers=("raw",), sources=("bus_line",))


def test_unknown_layers_are_refused(spark, scratch):
    from routekpi.__main__ import parse_args

    with pytest.raises(ValueError, match="staing"):
        run_pipeline(spark, inputs_for(scratch), f"{scratch}/wh", layers=("staing",))
    with pytest.raises(SystemExit):
        parse_args(["--warehouse", "w", "--layers", "staing"])


def test_layer_schemas_with_fallback(spark, scratch):
    from routekpi.plans.pipeline import layer_path

    assert layer_path("w", "marts", {"marts": " kpi "}) == "w/kpi" and layer_path("w", "marts", {"marts": " "}) == "w/analytics"
    run_pipeline(spark, inputs_for(write_inputs(f"{scratch}/in")), f"{scratch}/wh", schemas={"staging": "clean", "marts": "kpi"})
    assert spark.read.parquet(f"{scratch}/wh/kpi/fct_service_gap").count() > 0
    assert spark.read.parquet(f"{scratch}/wh/clean/stg_stops").count() == 2


def test_mart_writes_few_files_per_year(spark, scratch):
    from routekpi.plans.pipeline import _write, by_year

    df = spark.range(0, 50_000, 1, 32).selectExpr("id", "cast(2000 + id % 4 as int) as calendar_year")
    _write(by_year(df), f"{scratch}/t", "calendar_year")
    import glob

    assert all(len(glob.glob(f"{scratch}/t/calendar_year={y}/*.parquet")) <= 2 for y in range(2000, 2004))


def test_partial_runs_by_layer_and_source(spark, built):
    # marts only, on the staging tables already written
    summary = run_pipeline(spark, inputs_for(built["raw"]), built["wh"], layers=("marts",))
    assert summary.tables["fact_route_performance"] == 11 and "raw_yearline" not in summary.tables
    summary = run_pipeline(spark, inputs_for(built["raw"]), built["wh"], layers=("raw",), sources=("yearline",))
    assert "raw_yearline" in summary.tables and "raw_bus_line" not in summary.tables


def test_mart_files_in_report_order(built):
    from pyspark.sql import functions as F

    df = built["read"]("analytics", "fct_overcrowding_ranking").withColumn("f", F.input_file_name())
    per_file = {}
    for r in df.collect():  # a file is read back in one split, in written order
        per_file.setdefault(r.f, []).append(r.overcrowding_rank)
    assert per_file and all(v == sorted(v) for v in per_file.values())


def test_written_reports_equal_those_over_the_fact(spark, built):
    from routekpi.plans import reports
    from routekpi.schemas import KpiParams

    fact = built["read"]("analytics", "fact_route_performance")
    for name in reports.PANELS:
        fn = getattr(reports, name)
        want = fn(fact) if name in ("report_reliability", "report_system_recovery") else fn(fact, KpiParams())
        got = reports.written_report(spark, built["wh"], name)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
        assert not any(op in got._jdf.queryExecution().executedPlan().toString() for op in ("WindowGroupLimit", "Window ["))


def test_marts_read_in_presentation_order(spark, built):
    from routekpi.plans.pipeline import read_mart

    ranks = [(r.calendar_year, r.overcrowding_rank) for r in read_mart(spark, built["wh"], "fct_overcrowding_ranking").collect()]
    assert ranks == sorted(ranks)
    gaps = [(r.calendar_year, -r.gap_score, r.route_number) for r in read_mart(spark, built["wh"], "fct_service_gap").collect()]
    assert gaps == sorted(gaps)
    trend = [(r.subregion is None, r.subregion, r.route_number, r.calendar_year) for r in read_mart(spark, built["wh"], "fct_recovery_trends").collect()]
    assert trend == sorted(trend)


def test_sql_over_registered_views(spark, built):
    from routekpi.functions.sql import register_views

    register_views(spark, built["wh"])
    rows = spark.sql("SELECT calendar_year, count(*) AS n FROM fct_overcrowding_ranking "
                     "WHERE is_top20 GROUP BY calendar_year ORDER BY calendar_year").collect()
    assert [(r.calendar_year, r.n) for r in rows] == [(2019, 3), (2022, 2), (2023, 2), (2024, 3)]


def test_command_line(spark, scratch, capsys):
    from routekpi.__main__ import main

    raw = write_inputs(f"{scratch}/in")
    args = ["--yearline", f"{raw}/tspr_bus_yearline_*.csv", "--bus-line", f"{raw}/TSPR_OpenData_Archive_*.csv",
            "--stops", f"{raw}/gtfs/stops.csv", "--warehouse", f"{scratch}/wh"]
    assert main(args, spark=spark) == 0
    out = capsys.readouterr().out
    assert "fact_route_performance\trows=11" in out
    bad = write_inputs(f"{scratch}/bad", extra_yearline=[("005", 2024, "-1", "1", "1", "1", "1", "1", "1")])
    args_bad = ["--yearline", f"{bad}/tspr_bus_yearline_*.csv", "--bus-line", f"{bad}/TSPR_OpenData_Archive_*.csv",
                "--warehouse", f"{scratch}/wh2"]
    assert main(args_bad, spark=spark) == 2
    assert main(["--yearline", f"{scratch}/none/*.csv", "--bus-line", f"{scratch}/none/*.csv",
                 "--warehouse", f"{scratch}/wh3"], spark=spark) == 1


def test_year_filter_prunes_fact_partitions(spark, built):
    from routekpi.plans.reports import report_efficiency

    df = report_efficiency(built["read"]("analytics", "fact_route_performance"), year=2024)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(calendar_year" in plan and "= 2024)" in plan
    assert "ReadSchema: struct<route_number:string,subregion:string,boardings_per_service_hour" in plan
    assert {r.route_number for r in df.collect()} == {"5", "R4", "99"}
