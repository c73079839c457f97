"""End-to-end batch job: input check -> raw load -> seed -> staging -> gate -> marts -> checks.

Every layer is written as Parquet under `warehouse` (raw/, staging/,
analytics/) in the place of the earlier tables (see `storage`), so a re-run
gives the same tables and each layer reads the previous one from storage:
lineage is cut at every layer and a lost executor only recomputes work inside
one layer.  Independent tables are built at the same time.
"""

from __future__ import annotations

import logging
import re
import time
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import QualityGateError, enforce, run_checks
from ..schemas import BUS_LINE_COLUMNS, STOPS_COLUMNS, YEARLINE_COLUMNS, KpiParams
from ..sources.csv_raw import RAGGED_LINE, SOURCE_FILE, YEAR_FROM_FILE, empty_raw, read_raw_csv, seed_frame
from . import marts, staging
from .checks import mart_checks, staging_checks
from .jobs import run_together
from .storage import LABEL, LAYER_SCHEMAS, has_table, layer_path, recover, replace

log = logging.getLogger("routekpi.pipeline")


@dataclass
class PipelineInputs:
    """Input locations (any Hadoop-compatible URI).  Globs select the report
    and snapshot files; the year in each file name labels its rows."""

    yearline_glob: str | None = None
    bus_line_glob: str | None = None
    stops_path: str | None = None
    seed_path: str | None = None
    # Set True for exports with newlines inside quoted fields: each file is
    # then read by one task, so Spark can't split large ones.
    multiline: bool = False


@dataclass
class RunSummary:
    tables: dict = field(default_factory=dict)
    checks: list = field(default_factory=list)
    years: dict = field(default_factory=dict)  # of a refresh: the year partitions written of each table
    seconds: float = 0.0


def has_files(spark: SparkSession, glob: str) -> bool:
    """True when `glob` matches at least one path on its file system (any that Spark reads)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def check_inputs(spark: SparkSession, inputs: PipelineInputs, sources=None) -> dict:
    """The glob to read per selected source.  Report and snapshot files are required
    when their source is selected; missing stops are warned about and skipped (None)."""
    sources = ALL_SOURCES if sources is None else sources
    paths = {"yearline": inputs.yearline_glob, "bus_line": inputs.bus_line_glob, "stops": inputs.stops_path}
    found = {k: p if k in sources and p and has_files(spark, p) else None for k, p in paths.items()}
    missing = [k for k in ("yearline", "bus_line") if k in sources and not found[k]]
    if missing:
        raise FileNotFoundError("missing required raw files: " + ", ".join(missing))
    if "stops" in sources and not found["stops"]:
        log.warning("no stops file (%s): the stops table stays as it is", inputs.stops_path)
    return found


def _write(df: DataFrame, path: str, partition_by=None) -> int:
    """Replace a table and return its row count (counted while writing)."""
    return int(replace(df.sparkSession, path, [(df, {})], partition_by)[0]["rows"])


ALL_SOURCES = ("yearline", "bus_line", "stops")
ALL_LAYERS = tuple(LAYER_SCHEMAS)
#: Files that one load job reads and counts one by one.
FILES_PER_JOB = 64
SOURCES = {"yearline": (YEARLINE_COLUMNS, "report_source"), "bus_line": (BUS_LINE_COLUMNS, "snapshot_year"), "stops": (STOPS_COLUMNS, None)}
LOG_SCHEMA = "loaded string, report string, file string, rows long, ragged_rows long"


def source_files(spark: SparkSession, glob: str) -> list:
    """The files that a glob stands for; a folder that it matches stands for the data files in it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    hidden = lambda p: p.getName().startswith(("_", "."))
    out = []
    for status in fs.globStatus(path) or []:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        out += [s.getPath() for s in inside if s.isFile() and not hidden(s.getPath())]
    return sorted(out, key=lambda p: p.toString())


def _load_files(spark: SparkSession, kind: str, files: list, report: str | None, path: str, multiline: bool) -> list:
    """Load the files of one report (or of a source without reports) in place of its earlier rows.

    Returns one (loaded, report, file, rows, ragged rows) per file, counted while loading.
    """
    columns, label = SOURCES[kind]
    frames, log_rows = [], []
    for at in range(0, len(files), FILES_PER_JOB):
        some = files[at : at + FILES_PER_JOB]
        df = read_raw_csv(spark, [p.toString() for p in some], columns, source_col=label, multiline=multiline, track=True)
        metrics = {}
        for i, p in enumerate(some):
            mine = F.col(SOURCE_FILE).endswith(p.toUri().getRawPath())
            metrics[f"rows_{i}"] = F.count_if(mine)
            metrics[f"ragged_{i}"] = F.count_if(mine & F.col(RAGGED_LINE).isNotNull())
        frames.append((df.withColumn(LABEL, F.col(label)) if label else df, metrics))
    counted = replace(spark, path, frames, LABEL if label else None, keep_others=label is not None)
    for i, p in enumerate(files):
        held, k = counted[i // FILES_PER_JOB], i % FILES_PER_JOB
        log_rows.append((f"raw_{kind}", report, p.toString(), int(held[f"rows_{k}"]), int(held[f"ragged_{k}"])))
    return log_rows


def load_raw(spark: SparkSession, inputs: PipelineInputs, warehouse: str, found: dict,
             sources=ALL_SOURCES, schemas: dict | None = None) -> dict:
    """Raw layer: all-text tables, one per selected source kind, with the file's year label.

    Every report or snapshot is a partition of its own: those found take the place
    of their earlier rows, those without a file keep theirs.  A source without files
    keeps its table.  All are loaded at the same time, and `load_log` holds the
    rows and ragged rows of every loaded file.
    """
    raw = layer_path(warehouse, "raw", schemas)
    tasks, seed = {}, f"{raw}/subregion_population"
    for kind, (_, label) in SOURCES.items():
        if kind in sources and found[kind]:
            reports: dict = {}
            for p in source_files(spark, found[kind]):
                m = re.search(YEAR_FROM_FILE, p.toString()) if label else None
                reports.setdefault(m.group(1) if m else None, []).append(p)
            for report, files in reports.items():
                name = f"raw_{kind}" + (f"_{report}" if label else "")
                tasks[name] = partial(_load_files, spark, kind, files, report, f"{raw}/{kind}", inputs.multiline)
    tasks["subregion_population"] = lambda: _write(seed_frame(spark, inputs.seed_path), seed)
    done = run_together(spark, tasks, pool="load")
    counts = {}
    rows = [r for name, held in done.items() if name != "subregion_population" for r in held]
    for loaded, _, _, n, _ in rows:
        counts[loaded] = counts.get(loaded, 0) + n
    counts["subregion_population"] = done["subregion_population"]
    if rows:  # one row a file; a report's earlier rows go with its earlier files
        entries = spark.createDataFrame(rows, LOG_SCHEMA).withColumn(LABEL, F.concat_ws("-", "loaded", "report"))
        replace(spark, f"{raw}/load_log", [(entries, {})], LABEL, keep_others=True)
    return counts


def build_staging(spark: SparkSession, warehouse: str, params: KpiParams, schemas: dict | None = None) -> dict:
    path = layer_path(warehouse, "raw", schemas)
    raw = lambda name: spark.read.parquet(f"{path}/{name}")
    stops = raw("stops") if has_table(spark, f"{path}/stops") else empty_raw(spark, STOPS_COLUMNS)  # never loaded yet
    return {
        "stg_bus_performance": staging.model_performance(raw("yearline"), params),
        "stg_bus_line": staging.model_line(raw("bus_line"), params),
        "stg_stops": staging.model_stops(stops, params),
    }


def layer_summary(tables: dict, suites: dict) -> DataFrame:
    """One summary frame for every check of every table of a layer (one job)."""
    parts = [run_checks(tables[name], checks, name) for name, checks in suites.items() if name in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_pipeline(spark: SparkSession, inputs: PipelineInputs, warehouse: str,
                 params: KpiParams = KpiParams(), layers=ALL_LAYERS,
                 sources=ALL_SOURCES, schemas: dict | None = None) -> RunSummary:
    """Run the job; `layers` selects a partial run (e.g. only "marts" on existing
    staging), `sources` the raw sources to (re)load and `schemas` other names for layers."""
    if unknown := [x for x in layers if x not in ALL_LAYERS] or not layers:
        raise ValueError(f"unknown layers {unknown}; there are {', '.join(ALL_LAYERS)}")
    t0 = time.time()
    out = RunSummary()
    recover(spark, warehouse, schemas)
    raw, stg_path, a = (layer_path(warehouse, x, schemas) for x in ALL_LAYERS)
    if "raw" in layers:
        found = check_inputs(spark, inputs, sources)
        out.tables.update(load_raw(spark, inputs, warehouse, found, sources, schemas))

    if "staging" in layers:
        stg = build_staging(spark, warehouse, params, schemas)
        out.tables.update(run_together(spark, {n: partial(_write, df, f"{stg_path}/{n}") for n, df in stg.items()}, pool="staging"))
        written = {n: spark.read.parquet(f"{stg_path}/{n}") for n in stg}
        gate = layer_summary(written, staging_checks(params))
        out.checks.extend(enforce(gate))  # raises QualityGateError: no mart is written
        log.info("staging gate passed (%d checks)", len(out.checks))

    if "marts" in layers:
        s = lambda n: spark.read.parquet(f"{stg_path}/{n}")
        seed = spark.read.parquet(f"{raw}/subregion_population")
        dims = {"dim_routes": marts.dim_routes(s("stg_bus_line")), "dim_subregions": marts.dim_subregions(seed)}
        out.tables.update(run_together(spark, {n: partial(_write, df, f"{a}/{n}") for n, df in dims.items()}, pool="marts"))
        fact = marts.fact_route_performance(
            s("stg_bus_performance"), spark.read.parquet(f"{a}/dim_routes"),
            spark.read.parquet(f"{a}/dim_subregions"), params, with_base=True,
        )
        out.tables["fact_route_performance"] = _write(by_year(fact), f"{a}/fact_route_performance", "calendar_year")
        fact = spark.read.parquet(f"{a}/fact_route_performance")
        builds = {
            "fct_overcrowding_ranking": marts.overcrowding_ranking(fact, params),
            "fct_service_gap": marts.service_gap(fact, params),
            "fct_recovery_trends": marts.recovery_trends(fact, params),
        }
        writes = {n: partial(_write, in_files(df, n), f"{a}/{n}", "calendar_year") for n, df in builds.items()}
        out.tables.update(run_together(spark, writes, pool="marts"))
        names = ["dim_routes", "dim_subregions", "fact_route_performance", *builds]
        written = {n: spark.read.parquet(f"{a}/{n}") for n in names}
        rows = [r.asDict() for r in layer_summary(written, mart_checks(params)).collect()]
        out.checks.extend(rows)
        failing = [r for r in rows if r["status"] == "fail"]
        if failing:
            raise QualityGateError(failing)
        ranks = out.tables["fct_overcrowding_ranking"]
        scored = fact.filter(F.col("pct_trips_overcrowded").isNotNull()).count()
        if ranks != scored:
            raise RuntimeError(f"fct_overcrowding_ranking has {ranks} rows for {scored} rows to rank")
    out.seconds = time.time() - t0
    return out


def by_year(df: DataFrame) -> DataFrame:
    """Rows dealt by year before a write partitioned by it: a few files of the advisory
    partition size per year (large years are split), not one per task and year."""
    return df.hint("rebalance", "calendar_year")


def in_files(mart: DataFrame, name: str) -> DataFrame:
    """A KPI mart's rows as its files hold them: by year, in presentation order."""
    return by_year(mart).sortWithinPartitions("calendar_year", *marts.mart_order(name))


def read_mart(spark: SparkSession, warehouse: str, name: str, schemas: dict | None = None) -> DataFrame:
    """A written KPI mart in its presentation order."""
    return marts.in_order(spark.read.parquet(f"{layer_path(warehouse, 'marts', schemas)}/{name}"), name)


def summary_frame(spark: SparkSession, summary: RunSummary) -> DataFrame:
    """Completion summary: one row per table with its row count and check results."""
    rows = []
    for table, n in summary.tables.items():
        checks = [c for c in summary.checks if c["table"] == table]
        rows.append((table, int(n), sum(c["status"] == "pass" for c in checks),
                     sum(c["status"] == "fail" for c in checks), sum(c["status"] == "warn" for c in checks)))
    return spark.createDataFrame(rows, "table string, rows long, checks_passed long, checks_failed long, checks_warned long")
