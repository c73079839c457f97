"""Command line: run the pipeline (for spark-submit or python -m routekpi).

    spark-submit --py-files routekpi.zip -m routekpi \\
        --yearline 's3://bucket/raw/tspr_bus_yearline_*.csv' \\
        --bus-line 's3://bucket/raw/TSPR_OpenData_Archive_*.csv' \\
        --stops s3://bucket/raw/gtfs/stops.csv \\
        --warehouse s3://bucket/warehouse --source all --layers raw,staging,marts

Exit code 0 on success, 2 when the quality gate stops the run, 1 on a
missing input.  The completion summary is printed one line per table.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from .operators.quality import QualityGateError
from .plans.pipeline import ALL_LAYERS, PipelineInputs, run_pipeline
from .plans.refresh import refresh_revised
from .schemas import SOURCE_CHOICES
from .session import apply_engine_conf, ensure_checkpoint_dir


def layer_list(text: str) -> tuple:
    layers = tuple(x.strip() for x in text.split(",") if x.strip())
    if not layers or set(layers) - set(ALL_LAYERS):
        raise argparse.ArgumentTypeError(f"layers are {', '.join(ALL_LAYERS)}")
    return layers


def schema_name(text: str) -> tuple:
    layer, sep, name = text.partition("=")
    if layer not in ALL_LAYERS or not sep or not name.strip():
        raise argparse.ArgumentTypeError(f"LAYER=NAME with a layer of {', '.join(ALL_LAYERS)}")
    return layer, name.strip()


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="routekpi", description="Route KPI pipeline on Spark")
    p.add_argument("--yearline", default=None, help="glob of the yearline report CSV files")
    p.add_argument("--bus-line", default=None, help="glob of the bus line snapshot CSV files")
    p.add_argument("--stops", default=None, help="stops CSV (optional)")
    p.add_argument("--seed", default=None, help="sub-region seed CSV (default: built-in)")
    p.add_argument("--warehouse", required=True, help="output root for raw/, staging/, analytics/")
    p.add_argument("--source", choices=sorted(SOURCE_CHOICES), default="all", help="raw sources to (re)load")
    p.add_argument("--layers", type=layer_list, default=ALL_LAYERS, help="comma list of layers to run")
    p.add_argument("--schema", type=schema_name, action="append", default=[], metavar="LAYER=NAME",
                   help="schema (folder) of a layer; may be given once per layer")
    p.add_argument("--refresh", action="store_true", help="load the files, then rebuild only the years that they revise")
    p.add_argument("--multiline", action="store_true", help="CSV fields hold newlines: one task per file")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> int:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = spark or SparkSession.builder.appName("routekpi").getOrCreate()
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)
    inputs = PipelineInputs(args.yearline, args.bus_line, args.stops, args.seed, multiline=args.multiline)
    try:
        how = {"sources": SOURCE_CHOICES[args.source], "schemas": dict(args.schema)}
        if args.refresh:
            summary = refresh_revised(spark, inputs, args.warehouse, **how)
        else:
            summary = run_pipeline(spark, inputs, args.warehouse, layers=args.layers, **how)
    except QualityGateError as err:
        print(err, file=sys.stderr)
        return 2
    except FileNotFoundError as err:
        print(err, file=sys.stderr)
        return 1
    for table, rows in summary.tables.items():
        checks = [c for c in summary.checks if c["table"] == table]
        passed = sum(c["status"] == "pass" for c in checks)
        warned = sum(c["status"] == "warn" for c in checks)
        print(f"{table}\trows={rows}\tchecks_passed={passed}\tchecks_warned={warned}")
    print(f"done in {summary.seconds:.1f}s")
    return 0


if __name__ == "__main__":
    sys.exit(main())
