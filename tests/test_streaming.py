"""Incremental ingest: each landed file is loaded once, across runs."""

import os

from routekpi.schemas import YEARLINE_COLUMNS
from routekpi.streaming import ingest_new_files
from tests.fixtures_kpi import PERF_2023, PERF_2024, _write, yearline_row


def test_ingest_appends_only_new_files(spark, scratch):
    landing, table, ckpt = f"{scratch}/landing", f"{scratch}/raw_yearline", f"{scratch}/ckpt"
    os.makedirs(landing)
    _write(f"{landing}/tspr_bus_yearline_2023.csv", YEARLINE_COLUMNS, [yearline_row(*r) for r in PERF_2023])
    assert ingest_new_files(spark, landing, table, YEARLINE_COLUMNS, ckpt, "report_source") == len(PERF_2023)
    _write(f"{landing}/tspr_bus_yearline_2024.csv", YEARLINE_COLUMNS, [yearline_row(*r) for r in PERF_2024])
    assert ingest_new_files(spark, landing, table, YEARLINE_COLUMNS, ckpt, "report_source") == len(PERF_2024)
    assert ingest_new_files(spark, landing, table, YEARLINE_COLUMNS, ckpt, "report_source") == 0
    raw = spark.read.parquet(table)
    counts = {r.report_source: r["count"] for r in raw.groupBy("report_source").count().collect()}
    assert counts == {"2023": len(PERF_2023), "2024": len(PERF_2024)}
    # null tokens are applied on the way in
    assert raw.filter("Lineno_renamed = '049'").select("Perc_Trips_w_Overcrowding").first()[0] is None


def test_every_micro_batch_is_counted(spark, scratch):
    """More micro-batches than Spark keeps progress reports of."""
    landing = f"{scratch}/landing"
    os.makedirs(landing)
    files = 8
    for i in range(files):
        _write(f"{landing}/tspr_bus_yearline_20{10 + i}.csv", YEARLINE_COLUMNS, [yearline_row(*r) for r in PERF_2023])
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        n = ingest_new_files(spark, landing, f"{scratch}/t", YEARLINE_COLUMNS, f"{scratch}/c", "report_source", max_files_per_trigger=1)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert n == files * len(PERF_2023) == spark.read.parquet(f"{scratch}/t").count()
