"""Operators against brute force: ranks, dedup, windows, quality checks."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from routekpi.operators import quality as Q
from routekpi.operators.dedupe import latest_per_key
from routekpi.operators.ranking import rank_within, top_k
from routekpi.operators.windows import with_baseline, with_prior


def brute_rank(rows):
    """rows: (period, score, entity) -> {(period, entity): rank} by score desc, entity asc."""
    out = {}
    for p in {r[0] for r in rows}:
        grp = sorted([r for r in rows if r[0] == p], key=lambda r: (-r[1] if r[1] is not None else float("inf"), r[2]))
        # NULL scores sort first on DESC NULLS FIRST
        nulls = [r for r in grp if r[1] is None]
        rest = [r for r in grp if r[1] is not None]
        for i, r in enumerate(nulls + rest):
            out[(p, r[2])] = i + 1
    return out


def order():
    return [F.col("score").desc_nulls_first(), F.col("entity").asc_nulls_last()]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([2019, 2022, 2023, None]), st.one_of(st.none(), st.integers(0, 5)),
                          st.integers(0, 10_000)), min_size=1, max_size=80,
                unique_by=lambda t: (t[0], t[2])),
       st.integers(1, 7))
def test_rank_within_matches_brute_force(spark, rows, parts):
    df = spark.createDataFrame([(p, s, f"e{e:05d}") for p, s, e in rows], "period int, score int, entity string")
    got = {(r.period, r.entity): r.rank for r in rank_within(df, "period", order(), num_partitions=parts).collect()}
    assert got == brute_rank([(p, s, f"e{e:05d}") for p, s, e in rows])


def test_rank_within_on_skewed_period(spark):
    rnd = random.Random(7)
    # one period holds most rows (a hot key); ranks must stay a permutation 1..n
    rows = [(2024 if rnd.random() < 0.8 else 2019, rnd.randint(0, 50), f"r{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "period int, score int, entity string")
    out = rank_within(df, "period", order(), num_partitions=8)
    win = rank_within(df, "period", order(), method="window")
    a = {(r.period, r.entity): r.rank for r in out.collect()}
    b = {(r.period, r.entity): r.rank for r in win.collect()}
    assert a == b
    for p in (2019, 2024):
        ranks = sorted(v for (q, _), v in a.items() if q == p)
        assert ranks == list(range(1, len(ranks) + 1))


def test_top_k_is_prefix_of_rank(spark):
    rows = [(2024, i % 13, f"r{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "period int, score int, entity string")
    top = {r.entity for r in top_k(df, "period", order(), 20).collect()}
    ranked = {r.entity for r in rank_within(df, "period", order()).filter("rank <= 20").collect()}
    assert top == ranked and len(top) == 20


def test_latest_per_key_and_shuffled_input(spark):
    rows = [("2022", "005", "2023", "700"), ("2022", "005", "2024", "705"), ("2019", "005", "2023", "1000"),
            ("2022", None, "2024", "1"), ("2023", "010", "2024", "b"), ("2023", "010", "2024", "a")]
    schema = "y string, r string, src string, v string"
    for seed in range(3):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, schema).repartition(3)
        got = sorted(tuple(r) for r in latest_per_key(df, ["y", "r"], ["src"], tiebreak=["v"]).collect())
        assert got == [("2019", "005", "2023", "1000"), ("2022", "005", "2024", "705"), ("2023", "010", "2024", "a")]


def test_prior_and_baseline_windows_match_self_joins(spark):
    rows = [("5", 2019, 1000), ("5", 2022, 705), ("5", 2024, 905), ("R4", 2023, 400), ("R4", 2024, 500),
            (None, 2019, 7), (None, 2022, 8)]
    df = spark.createDataFrame(rows, "route string, year int, v int")
    out = with_baseline(with_prior(df, "route", "year", {"prior_v": "v"}, prior_time="prior_year"),
                        "route", "year", 2019, {"base_v": "v"})
    got = {(r.route, r.year): (r.prior_v, r.prior_year, r.base_v) for r in out.collect()}
    assert got[("5", 2022)] == (1000, 2019, 1000)
    assert got[("5", 2024)] == (705, 2022, 1000)
    assert got[("R4", 2023)] == (None, None, None)
    assert got[("R4", 2024)] == (400, 2023, None)
    assert got[(None, 2022)] == (None, None, None)  # NULL entity: no match, as in a self-join


def test_checks_one_pass_and_violations(spark):
    rows = [("a", 1, 5), ("b", None, -1), ("b", 2025, 101), (None, 2019, 50)]
    df = spark.createDataFrame(rows, "k string, year int, pct int")
    checks = [Q.not_null("year"), Q.accepted_values("year", [2019, 2022]), Q.domain("year", [2019]),
              Q.in_range("pct", 0, 100), Q.non_negative("pct"), Q.unique("k"),
              Q.accepted_values("k", ["a"], severity=Q.WARN)]
    summary = {r.check: (r.failures, r.status) for r in Q.run_checks(df, checks, "t").collect()}
    assert summary == {
        "not_null_year": (1, "fail"), "accepted_values_year": (2, "fail"), "domain_year": (3, "fail"),
        "range_pct": (2, "fail"), "non_negative_pct": (1, "fail"), "unique_k": (1, "fail"),
        "accepted_values_k": (2, "warn"),
    }
    assert Q.violations(df, Q.unique("k")).collect()[0].n_records == 2
    try:
        Q.enforce(Q.run_checks(df, checks, "t"))
        raise AssertionError("gate did not raise")
    except Q.QualityGateError as e:
        assert len(e.failures) == 6


def test_window_rank_plan_has_group_limit(spark):
    df = spark.createDataFrame([(2019, i, f"r{i}") for i in range(50)], "period int, score int, entity string")
    w = Window.partitionBy("period").orderBy(*order())
    plan = df.withColumn("rn", F.row_number().over(w)).filter("rn <= 3")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def audited(spark, rows):
    from routekpi.operators.audit import revision_audit

    df = spark.createDataFrame(rows, "s string, y string, r string, v int").repartition(3)
    out = revision_audit(df, ["y", "r"], "s", F.col("v")).collect()
    return {(r.r, r.older_report, r.newer_report): (r.value_older, r.value_newer, r.max_older, r.max_newer, r.rows_older, r.rows_newer) for r in out}


def test_revision_audit_never_pairs_repeated_keys(spark):
    rows = [("a", "2022", "005", 700 + i % 50) for i in range(3000)] + [("a", "2022", "010", 9)]
    rows += [("b", "2022", "005", 800 + i % 40) for i in range(2000)] + [("b", "2022", "010", 9)]
    assert audited(spark, rows) == {("005", "a", "b"): (700, 800, 749, 839, 3000, 2000)}


def test_revision_audit_shows_any_change_over_any_number_of_reports(spark):
    rows = [("a", "y", "max", 10), ("a", "y", "max", 20), ("b", "y", "max", 10), ("b", "y", "max", 30)]
    rows += [("a", "y", "middle", v) for v in (1, 5, 9)] + [("b", "y", "middle", v) for v in (1, 6, 9)]
    rows += [("a", "y", "text", 9), ("b", "y", "text", 10)]
    rows += [("a", "y", "third", 1), ("b", "y", "third", 1), ("c", "y", "third", 2)]
    rows += [("a", "y", "gap", 1), ("c", "y", "gap", 3)]
    rows += [("a", "y", "null", None), ("b", "y", "null", 4), ("c", "y", "null", None)]
    rows += [("a", "y", "order", 3), ("a", "y", "order", 4), ("b", "y", "order", 4), ("b", "y", "order", 3)]
    rows += [("a", "y", "alone", 1), ("a", "y", None, 1), ("b", "y", None, 2), ("c", "y", None, 3)]
    got = audited(spark, rows)
    assert got == {
        ("max", "a", "b"): (10, 10, 20, 30, 2, 2), ("middle", "a", "b"): (1, 1, 9, 9, 3, 3), ("text", "a", "b"): (9, 10, 9, 10, 1, 1),
        ("third", "b", "c"): (1, 2, 1, 2, 1, 1), ("gap", "a", "c"): (1, 3, 1, 3, 1, 1),
        ("null", "a", "b"): (None, 4, None, 4, 1, 1), ("null", "b", "c"): (4, None, 4, None, 1, 1),
    }


def test_rank_within_where_sampling_is_not_exhaustive(spark):
    """A million rows with payload columns and one sampled key per partition: ranks equal the window's."""
    old = spark.conf.get("spark.sql.execution.rangeExchange.sampleSizePerPartition")
    spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", "1")
    try:
        df = spark.range(0, 1_000_000, 1, 16).selectExpr(
            "case when id % 3 = 0 then 2019 else 2024 end as period", "cast(xxhash64(id) % 1000 as int) as score",
            "concat('e', id) as entity", "id * 7 as payload", "repeat('x', 20) as more")
        out = rank_within(df, "period", order(), num_partitions=13)
        both = out.join(rank_within(df, "period", order(), method="window").select("entity", F.col("rank").alias("want")), "entity")
        assert out.count() == 1_000_000
        assert both.where("rank <> want").count() == 0 and both.count() == 1_000_000
        assert out.columns == [*df.columns, "rank"]
    finally:
        spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", old)


def test_windows_spread_rows_without_entity_and_order_ties(spark):
    from routekpi.operators.windows import prior_columns, spread_key

    rows = [(None, 2000 + i % 7, i) for i in range(5000)] + [("5", 2001, 3), ("5", 2001, 1), ("5", 2002, 9)]
    df = spark.createDataFrame(rows, "e string, t int, v int").repartition(5)
    keyed = df.withColumn("k", spread_key("e", ["t", "v"]))
    biggest = keyed.where("e is null").groupBy("k").count().agg({"count": "max"}).first()[0]
    assert biggest < 50  # nowhere near all of them
    out = keyed.withColumns(prior_columns("e", "t", {"was": "v"}, prior_time="when", tiebreak=("v",), key="k"))
    assert {(r.t, r.v): (r.was, r.when) for r in out.where("e = '5'").collect()} == {(2001, 1): (None, None), (2001, 3): (1, 2001), (2002, 9): (3, 2001)}
    assert out.where("e is null and (was is not null or when is not null)").count() == 0


def test_top_of_group_with_ties_and_null_keys(spark):
    from routekpi.operators.rollup import with_top

    rows = [("a", None, 3, "r2"), ("a", None, 3, "r1"), ("a", None, 1, "r0"), ("b", "x", 2, "r9")]
    df = spark.createDataFrame(rows, "g string, c string, s int, r string")
    out = with_top(df.groupBy("g", "c").agg(F.max("s").alias("m")), df, ["g", "c"], "s", "m", "r", "top")
    assert {(r.g, r.c, r.m, r.top) for r in out.collect()} == {("a", None, 3, "r1"), ("b", "x", 2, "r9")}
