"""The column functions as Spark SQL functions, and the layers as views.

For users who write SQL (as the source project's models are written),
`register_sql_functions` creates temporary SQL-bodied functions; Spark
inlines their bodies into the plan, so they stay JVM-side and codegen'd like
the Column functions in this package (no Python runs per row).
`register_views` exposes the written tables of the layers as temporary views and
`register_tables` as tables of the catalog, in the databases that the layers'
schemas name.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .codes import ROUTE_PREFIXES, ROUTE_SEPARATOR
from ..plans.storage import LAYER_TABLES, layer_path, layer_schema, read_table
from ..schemas import NULL_TOKENS, SEVERITY_BANDS, SEVERITY_LOW, SEVERITY_UNKNOWN, SUBREGION_RULES, UNIT_STRIP_PATTERN


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_function_bodies(subregion_rules=SUBREGION_RULES, severity_bands=SEVERITY_BANDS) -> dict:
    """name -> (signature, return type, body)."""
    tokens = ", ".join(_quote(t) for t in NULL_TOKENS)
    classify = " ".join(
        "WHEN " + " OR ".join(f"upper(c) LIKE {_quote(p)}" for p in pats) + f" THEN {_quote(cat)}"
        for cat, pats in subregion_rules
    )
    tiers = " ".join(f"WHEN pct >= {b} THEN {_quote(t)}" for b, t in severity_bands)
    kept = " OR ".join(f"startswith(upper(c), {_quote(p)})" for p in ROUTE_PREFIXES)
    number = f"try_cast(split_part(c, {_quote(ROUTE_SEPARATOR)}, 1) AS DECIMAL(38,0))"
    return {
        "rk_null_token": ("c STRING", "STRING", f"CASE WHEN c IN ({tokens}) THEN NULL ELSE c END"),
        "rk_try_integer": ("c STRING", "DECIMAL(38,0)", "try_cast(c AS DECIMAL(38,0))"),
        "rk_strip_units": ("c STRING", "STRING", f"regexp_replace(c, {_quote(UNIT_STRIP_PATTERN)}, '')"),
        "rk_canonical_route": ("c STRING", "STRING", f"CASE WHEN {kept} THEN trim(c) ELSE CAST({number} AS STRING) END"),
        "rk_combined_flag": ("c STRING", "BOOLEAN", f"coalesce(contains(c, {_quote(ROUTE_SEPARATOR)}), false)"),
        "rk_subregion": ("c STRING", "STRING", f"CASE {classify} ELSE c END"),
        "rk_severity_tier": (
            "pct DECIMAL(10,4)", "STRING",
            f"CASE WHEN pct IS NULL THEN {_quote(SEVERITY_UNKNOWN)} {tiers} ELSE {_quote(SEVERITY_LOW)} END",
        ),
    }


def register_sql_functions(spark: SparkSession, **rules) -> list:
    names = []
    for name, (args, ret, body) in sql_function_bodies(**rules).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
        names.append(name)
    return names


def _written(spark: SparkSession, warehouse: str, layers, schemas: dict | None):
    """(layer, table, path) of the tables of these layers; each must have been written."""
    for layer in layers:
        layer = "marts" if layer == "analytics" else layer
        for table in LAYER_TABLES[layer]:
            yield layer, table, f"{layer_path(warehouse, layer, schemas)}/{table}"


def register_views(spark: SparkSession, warehouse: str, layers=("staging", "marts"), schemas: dict | None = None) -> list:
    """Temporary views over the tables that `run_pipeline` wrote under `warehouse`
    with these `schemas`; raw tables' names begin with raw_."""
    names = []
    for layer, table, _ in _written(spark, warehouse, layers, schemas):
        view = table if layer != "raw" else f"raw_{table}"
        read_table(spark, warehouse, layer, table, schemas).createOrReplaceTempView(view)
        names.append(view)
    return names


def register_tables(spark: SparkSession, warehouse: str, layers=("staging", "marts"), schemas: dict | None = None) -> list:
    """Catalog tables `<schema>.<table>` over the written tables, one database per layer's schema.

    They are external tables of the session's own catalog: dropping one leaves the
    files.  Registering again takes in what has been written since, new and
    dropped partitions too.
    """
    names = []
    for layer, table, path in _written(spark, warehouse, layers, schemas):
        name = f"`{layer_schema(layer, schemas)}`.`{table}`"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer_schema(layer, schemas)}`")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=path, source="parquet")
        if spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Partition Provider'").count():
            spark.catalog.recoverPartitions(name)
        names.append(name.replace("`", ""))
    return names
