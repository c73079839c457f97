"""Benchmark: headline queries on the driver's tables.

Runs each headline query of the registry on $BENCH_SF_DIR (default
/root/testdata/sf0.1) with local[$BENCH_CPUS], warm ($BENCH_WARMUP untimed
runs first, default 2: the JVM keeps speeding up over the first runs), and
reports the median of $BENCH_REPEATS timed runs.  A timed run builds the
DataFrame and executes it to the end (rows are counted into a no-op sink, so
the whole result is computed and nothing is collected to the driver).

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "model_performance",
    "model_line",
    "revision_audit",
    "fact_build",
    "persistent_topk",
    "gap_with_rollup",
    "recovery_with_rollup",
    "report_gap_by_region",
    "report_heatmap",
    "dq_summary",
]


def bench_pipeline(spark, sf_dir: str, repeats: int) -> float:
    """CSV pipeline end to end (load, staging, gate, marts, mart checks) on
    CSV exports derived from the driver's tables (written once, untimed)."""
    import dataclasses
    import uuid

    from routekpi.plans.pipeline import PipelineInputs, run_pipeline
    from routekpi.session import ensure_checkpoint_dir
    from routekpi.sources import testdata as TD

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}"
    inputs = PipelineInputs(**TD.write_raw_csvs(spark, sf_dir, f"{base}/in"))
    params = dataclasses.replace(TD.DRIVER_PARAMS, subregions=TD.DRIVER_PIPELINE_SUBREGIONS)

    def once():
        t = time.perf_counter()
        run_pipeline(spark, inputs, f"{base}/warehouse", params)
        return time.perf_counter() - t

    once()
    return round(statistics.median(once() for _ in range(repeats)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from routekpi.plans.registry import registered
    from routekpi.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    names = [q for q in only if q != "pipeline_csv"] if only else HEADLINE
    times = {}
    for name in names:
        run = registered(name)

        def once():
            t = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t

        for _ in range(warmup):  # JIT, file listing, first plans
            once()
        times[name] = round(statistics.median(once() for _ in range(repeats)), 3)

    if not only or "pipeline_csv" in only:
        times["pipeline_csv"] = bench_pipeline(spark, sf_dir, repeats)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(v for k, v in times.items() if k != "pipeline_csv"), 3)
    print(json.dumps({
        "metric": "headline_queries_total_median_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "note": "value = sum of the headline queries; pipeline_csv reported separately",
        "cpus": int(cpus),
        "repeats": repeats,
        "warmup": warmup,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
