"""Physical-plan properties that matter at scale.

Plans are taken with automatic broadcasts off and AQE off, i.e. as if every
table were too large to broadcast: what remains broadcast is what the code
hints on a proven bound.
"""

import os
import re

import pytest

from routekpi.plans import registry as R

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture()
def static_plan(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    def plan(df):
        return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())

    yield plan
    for k, v in old.items():
        spark.conf.set(k, v)


def test_fact_reads_lineitem_once_and_shares_route_exchange(spark, static_plan):
    p = static_plan(R.fact(spark, SF))
    assert len(re.findall(r"FileScan parquet \[l_", p)) == 1
    # lineitem scan reads only the six columns used
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", p[p.index("FileScan parquet [l_"):]).group(1)
    assert len(scan.split(",")) == 6
    # partial aggregation before the shuffle
    assert "partial_sum" in p and "partial_count" in p
    # dedup: WindowGroupLimit partial below the exchange, final above it
    assert "WindowGroupLimit [CalendarYear, Lineno_renamed]" in p and ", Partial" in p and ", Final" in p
    # one hash exchange on the route key serves the windows and the join with the dimension
    assert len(re.findall(r"Exchange hashpartitioning\(_key, \d+\)", p)) <= 2
    assert "SortMergeJoin [_key]" in p
    assert "BroadcastExchange" not in p  # nothing is hinted for broadcast


def test_ranking_never_puts_a_year_in_one_task(spark, static_plan):
    p = static_plan(R.ranking(spark, SF))
    # the placement is written once; what reads it has no range exchange of its own
    assert "rangepartitioning" not in p and len(re.findall(r"FileScan parquet .*_place", p)) >= 2
    # the only exchange keyed by the year alone carries the counts per slice
    for m in re.finditer(r"Exchange hashpartitioning\((?:calendar_year|_in), \d+\)", p):
        assert "_of" in p[max(0, m.start() - 400):m.start() + 400]


def test_top_reports_never_rank_everything(spark, static_plan):
    for name in ("report_heatmap", "report_every_year", "report_before_after"):
        p = static_plan(R.QUERIES[name](spark, SF))
        assert "WindowGroupLimit [calendar_year" in p and "_place" not in p


def test_rollups_aggregate_partially_and_hint_nothing(spark, static_plan):
    p = static_plan(R.QUERIES["gap_with_rollup"](spark, SF))
    assert re.search(r"HashAggregate\(keys=\[subregion, subregion_code, calendar_year\], functions=\[partial_", p)
    assert "BroadcastHashJoin" not in p
    # distinct sub-region texts without bound are joined back by a shuffle
    wide = spark.range(0, 1000).selectExpr("concat('s', id) as subregion", "'c' as subregion_code", "2000 as calendar_year", "id")
    assert "BroadcastHashJoin" not in static_plan(wide.join(wide.groupBy("subregion").count(), "subregion", "left"))


def test_gap_rollup_numbers_are_hash_aggregated(spark, static_plan):
    p = static_plan(R.QUERIES["gap_rollup"](spark, SF))
    # only the rows that reach their group's maximum are aggregated as text
    assert re.search(r"HashAggregate\(keys=\[subregion, subregion_code, calendar_year\], functions=\[(?:partial_)?count", p)
    assert "min_by" not in p


def test_quality_summary_is_one_scan_per_table(spark, static_plan):
    p = static_plan(R.QUERIES["dq_summary"](spark, SF))
    # the stops table is scanned once for its row checks and once for its uniqueness check
    assert len(re.findall(r"FileScan parquet \[c_", p)) <= 2


def test_checks_of_a_table_share_one_scan_and_one_exchange(spark, static_plan, scratch):
    from routekpi.operators import quality as Q

    spark.range(100).selectExpr("id", "id % 7 as a", "cast(id as string) as b").write.parquet(f"{scratch}/t")
    checks = [Q.not_null("a"), Q.in_range("id", 0, 50), Q.unique("id"), Q.unique("a", "b"), Q.unique("a"), Q.accepted_values("a", [1, 2], severity=Q.WARN)]
    df = Q.run_checks(spark.read.parquet(f"{scratch}/t"), checks, "t")
    p = static_plan(df)
    assert p.count("FileScan") == 1 and len(re.findall(r"Exchange hashpartitioning", p)) == 1 and p.count("Exchange") == 2  # the other: one row of totals
    assert "functions=[partial_count" in p
    got = {r.check: (r.failures, r.status) for r in df.collect()}
    assert got == {"not_null_a": (0, "pass"), "range_id": (49, "fail"), "unique_id": (0, "pass"), "unique_a_b": (0, "pass"), "unique_a": (7, "fail"), "accepted_values_a": (71, "warn")}


def test_recovery_of_the_written_fact_needs_no_route_exchange(spark, static_plan, scratch):
    from routekpi.plans import marts

    R.base_fact(spark, SF).write.parquet(f"{scratch}/fact")
    p = static_plan(marts.recovery_trends(spark.read.parquet(f"{scratch}/fact"), R.P))
    assert "Window" not in p and "route" not in "".join(re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p))


def test_rows_without_a_route_share_no_window_key(spark, static_plan):
    from pyspark.sql import functions as F

    from routekpi.operators.windows import spread_key
    from routekpi.plans import marts

    rows = spark.range(200_000).selectExpr("cast(null as string) as route_number", "cast(2000 + id % 4 as int) as calendar_year", "'2024' as report_source",
                                           "false as is_combined_route", "cast(id as decimal(18,3)) as annual_boardings", "cast(id % 977 as decimal(18,4)) as annual_service_hours")
    keys = rows.select(spread_key("route_number", ["calendar_year", *marts.PRIOR_TIEBREAK]).alias("k")).groupBy("k").count()
    assert keys.count() == 1024 and keys.agg(F.max("count")).first()[0] < 400
    # the recovery mart's own window, for a fact without base values, uses the same key
    p = static_plan(marts.recovery_indexed(R.fact(spark, SF), R.P))
    assert len(re.findall(r"xxhash64\(calendar_year, report_source", p)) >= 1
