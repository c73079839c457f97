"""Tables replaced by report and by year, failed writes, loads at the same time, schemas and refresh."""

import os
import time

import pytest
from pyspark.sql import functions as F

from routekpi.functions.sql import register_tables, register_views
from routekpi.plans import storage
from routekpi.plans.jobs import run_together
from routekpi.plans.pipeline import PipelineInputs, run_pipeline
from routekpi.plans.refresh import refresh_revised
from tests.fixtures_kpi import PERF_2023, PERF_2024, _write, write_inputs, yearline_row
from tests.test_pipeline import inputs_for
from routekpi.schemas import YEARLINE_COLUMNS




def bag(df):
    return sorted((str(r.asDict()) for r in df.select(sorted(df.columns)).collect()))


def raw_rows(spark, wh):
    return {r.report_source: r.n for r in storage.read_table(spark, wh, "raw", "yearline").groupBy("report_source").agg(F.count("*").alias("n")).collect()}


def test_a_landing_replaces_its_own_report_only(spark, scratch):
    wh = f"{scratch}/wh"
    load = lambda raw: run_pipeline(spark, PipelineInputs(yearline_glob=f"{raw}/tspr_bus_yearline_*.csv"), wh, layers=("raw",), sources=("yearline",))
    load(write_inputs(f"{scratch}/in"))
    assert raw_rows(spark, wh) == {"2023": 6, "2024": 7}
    _write(f"{scratch}/in2/tspr_bus_yearline_2024.csv", YEARLINE_COLUMNS, [yearline_row(*r) for r in PERF_2024[:4]])
    with open(f"{scratch}/in2/tspr_bus_yearline_2024.csv", "a") as f:
        f.write("2024,too,short\n")
        f.write(",".join("x" * (len(YEARLINE_COLUMNS) + 2)) + "\n")
    summary = load(f"{scratch}/in2")
    assert raw_rows(spark, wh) == {"2023": 6, "2024": 6} and summary.tables["raw_yearline"] == 6
    got = {(r.report, r.file.rsplit("/", 1)[1]): (r.rows, r.ragged_rows) for r in storage.read_table(spark, wh, "raw", "load_log").collect()}
    assert got == {("2023", "tspr_bus_yearline_2023.csv"): (6, 0), ("2024", "tspr_bus_yearline_2024.csv"): (6, 2)}
    ragged = storage.read_table(spark, wh, "raw", "yearline").where("ragged_line is not null")
    assert {(r.CalendarYear, r.AnnualBoardings) for r in ragged.collect()} == {("2024", "short"), ("x", "x")}


def test_a_failed_write_keeps_the_old_rows(spark, scratch):
    path = f"{scratch}/wh/analytics/t"
    good = spark.range(5).withColumn("calendar_year", F.lit(2020))
    storage.replace(spark, path, [(good, {})], "calendar_year")
    files = sorted(os.listdir(f"{path}/calendar_year=2020"))
    for keep in (False, True):
        with pytest.raises(Exception, match="planted"):
            storage.replace(spark, path, [(good, {}), (spark.range(10, numPartitions=4).selectExpr("if(id = 7, cast(raise_error('planted') as bigint), id) as id").withColumn("calendar_year", F.lit(2020)), {})], "calendar_year", keep_others=keep)
        assert spark.read.parquet(path).count() == 5 and sorted(os.listdir(f"{path}/calendar_year=2020")) == files
    assert os.listdir(f"{scratch}/wh/analytics") == ["t"]


@pytest.mark.parametrize("keep", [False, True])
def test_a_lost_driver_leaves_a_table_that_recovers(spark, scratch, monkeypatch, keep):
    path = f"{scratch}/wh/analytics/t"
    year = lambda y, n: spark.range(n).withColumn("calendar_year", F.lit(y))
    storage.replace(spark, path, [(year(2020, 5).union(year(2021, 6)), {})], "calendar_year")
    calls, swap = [], storage._swap

    def lost(fs, new, current, old):
        calls.append(current)
        fs.move(current, old)  # the old rows are aside, the new ones not yet in place
        raise KeyboardInterrupt

    monkeypatch.setattr(storage, "_swap", lost)
    with pytest.raises(KeyboardInterrupt):
        storage.replace(spark, path, [(year(2021, 9), {})], "calendar_year", keep_others=keep)
    monkeypatch.setattr(storage, "_swap", swap)
    assert calls and storage.recover(spark, f"{scratch}/wh") == 1
    got = {r.calendar_year: r.n for r in spark.read.parquet(path).groupBy("calendar_year").agg(F.count("*").alias("n")).collect()}
    assert got == ({2020: 5, 2021: 9} if keep else {2021: 9})
    assert storage.recover(spark, f"{scratch}/wh") == 0 and os.listdir(f"{scratch}/wh/analytics") == ["t"]


def test_partitions_without_new_rows_can_be_dropped(spark, scratch):
    path = f"{scratch}/wh/analytics/t"
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, None), (4, 2022)], "id int, calendar_year int")
    storage.replace(spark, path, [(df, {})], "calendar_year")
    storage.replace(spark, path, [(df.where("id = 1").withColumn("id", F.lit(9)), {})], "calendar_year", keep_others=True, drop=(2020, 2021, None, 1999))
    assert sorted((r.id, r.calendar_year) for r in spark.read.parquet(path).collect()) == [(4, 2022), (9, 2020)]


def test_jobs_overlap_and_stop_together(spark):
    slow = F.udf(lambda i, s: time.sleep(s) or i, "long")

    def job(seconds):
        def run():
            begin = time.time()
            spark.range(1, numPartitions=1).select(slow("id", F.lit(seconds))).collect()
            return begin, time.time()
        return run

    job(0)()  # a Python worker is up
    done = run_together(spark, {"a": job(2), "b": job(2)})
    assert max(b for b, _ in done.values()) < min(e for _, e in done.values())

    def fails():
        time.sleep(1)
        raise ValueError("planted")

    begin = time.time()
    with pytest.raises(ValueError, match="planted"):
        run_together(spark, {"slow": job(60), "fails": fails, "later": job(60)}, at_once=2)
    assert time.time() - begin < 30


def test_schemas_reach_views_and_catalog(spark, scratch):
    from routekpi.__main__ import parse_args

    args = parse_args(["--warehouse", "w", "--schema", "marts=kpi", "--schema", "raw= landing "])
    schemas = dict(args.schema)
    assert schemas == {"marts": "kpi", "raw": "landing"}
    with pytest.raises(SystemExit):
        parse_args(["--warehouse", "w", "--schema", "mart=kpi"])
    wh = f"{scratch}/wh"
    run_pipeline(spark, inputs_for(write_inputs(f"{scratch}/in")), wh, schemas=schemas)
    assert {"landing", "staging", "kpi"} == set(os.listdir(wh))
    names = register_views(spark, wh, layers=("raw", "staging", "marts"), schemas=schemas)
    assert spark.sql("select count(*) from fct_service_gap").first()[0] == 10 and "raw_yearline" in names
    tables = register_tables(spark, wh, layers=("raw", "staging", "marts"), schemas=schemas)
    assert "kpi.fct_service_gap" in tables and "landing.yearline" in tables
    assert spark.sql("select count(*) from kpi.fct_service_gap where calendar_year = 2024").first()[0] == 3
    plan = spark.sql("select route_number from kpi.fct_service_gap where calendar_year = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(calendar_year" in plan
    # registered again, a table has the partitions written since
    storage.replace(spark, f"{wh}/kpi/fct_service_gap", [(spark.table("kpi.fct_service_gap").where("calendar_year = 2024").withColumn("calendar_year", F.lit(2025)), {})],
                    "calendar_year", keep_others=True)
    register_tables(spark, wh, schemas=schemas)
    assert spark.sql("select count(*) from kpi.fct_service_gap").first()[0] == 13
    for name in tables:
        spark.sql(f"drop table {name}")


MARTS = ("dim_routes", "dim_subregions", "fact_route_performance", "fct_overcrowding_ranking", "fct_service_gap", "fct_recovery_trends")


def year_files(wh, table):
    root = f"{wh}/analytics/{table}"
    return {d: sorted(f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")) for d in os.listdir(root) if "=" in d}


def test_refresh_equals_a_full_rebuild(spark, scratch):
    from routekpi.schemas import KpiParams

    params, wh = KpiParams(top_k=1), f"{scratch}/wh"
    first = refresh_revised(spark, inputs_for(write_inputs(f"{scratch}/in")), wh, params)  # nothing there yet: a full run
    assert first.tables["fact_route_performance"] == 11 and not first.years

    def land(folder, rows_2023, rows_2024, lines=None):
        raw = write_inputs(f"{scratch}/{folder}", **({"lines": lines} if lines else {}))
        _write(f"{raw}/tspr_bus_yearline_2023.csv", YEARLINE_COLUMNS, [yearline_row(*r) for r in rows_2023])
        _write(f"{raw}/tspr_bus_yearline_2024.csv", YEARLINE_COLUMNS, [yearline_row(*r) for r in rows_2024])
        before = {t: year_files(wh, t) for t in MARTS[2:]}
        summary = refresh_revised(spark, inputs_for(raw), wh, params)
        run_pipeline(spark, inputs_for(raw), f"{scratch}/{folder}-full", params)
        for t in MARTS:
            assert bag(spark.read.parquet(f"{wh}/analytics/{t}")) == bag(spark.read.parquet(f"{scratch}/{folder}-full/analytics/{t}")), t
        for t, years in before.items():  # what isn't named has its files
            touched = {f"calendar_year={y}" for y in summary.years.get(t, ())}
            after = year_files(wh, t)
            assert {d: f for d, f in after.items() if d not in touched} == {d: f for d, f in years.items() if d not in touched}
            assert all(after.get(d) != years.get(d) for d in touched if d in years)
        return summary.years

    assert land("same", PERF_2023, PERF_2024) == {}
    late = [(*r[:2], "999", *r[3:]) if r[:2] == ("R4", 2024) else r for r in PERF_2024]
    # the top of 2023 changes from route 5 to R4: route 5's persistence in its other years, too
    top = [(*r[:7], "90", *r[8:]) if r[:2] == ("R4", 2023) else r for r in late]
    years = land("top", PERF_2023, top)
    assert years["fct_service_gap"] == [2023, 2024] and years["fact_route_performance"] == [2023, 2024] and years["fct_overcrowding_ranking"] == [2019, 2022, 2023, 2024]
    base = [(*r[:2], "1100", *r[3:]) if r[:2] == ("005/006", 2019) else r for r in PERF_2023]
    assert land("base", base, top)["fct_recovery_trends"] == [2019, 2022, 2023, 2024]
    gone = [r for r in top if r[1] != 2022]
    assert "calendar_year=2022" in year_files(wh, "fct_service_gap")
    land("gone", [r for r in base if r[1] != 2022], gone)
    assert "calendar_year=2022" not in year_files(wh, "fct_service_gap")
