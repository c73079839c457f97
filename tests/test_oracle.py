"""Registered queries vs their DuckDB SQL on the driver's smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from routekpi.plans.oracle_sql import ORACLE  # noqa: E402
from routekpi.plans.registry import QUERIES, registered  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SUBSET = ["seed_dim", "model_performance", "model_line", "model_stops", "fact_build", "persistent_topk",
          "gap_with_rollup", "recovery_with_rollup", "revision_audit", "dq_summary", "canonical_route",
          "report_before_after", "raw_csv_load", "raw_csv_snapshots", "load_audit", "fact_hard_keys", "dq_summary_marts", "dq_unique"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def canon_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return repr(float(v)) if isinstance(v, float) else str(v)

    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def test_registry_and_oracle_cover_each_other():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    df = registered(name)(spark, SF)
    s_cols, s_rows = canon_rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_cols, d_rows = canon_rows(d_cols, res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
    kinds = {"LongType()": "BIGINT", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN"}
    s_types = {f.name: kinds.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
    rel = con.sql(ORACLE[name])
    assert s_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
