"""Layer tables in folders: replaced whole or by partition, old rows kept until new ones are complete.

A write goes to a folder of its own beside the table.  Only when Spark has
committed all of it is it marked ready and put in the table's place by
renames, so a write that fails leaves the table as it was and readers never
see part of one.  A driver lost between the renames leaves a ready folder that
`recover` finishes (the pipeline calls it first).
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("routekpi.storage")

#: Folder (schema) of each layer unless `schemas` names another.
LAYER_SCHEMAS = {"raw": "raw", "staging": "staging", "marts": "analytics"}
LAYER_TABLES = {
    "raw": ("yearline", "bus_line", "stops", "subregion_population", "load_log"),
    "staging": ("stg_bus_performance", "stg_bus_line", "stg_stops"),
    "marts": ("dim_routes", "dim_subregions", "fact_route_performance", "fct_overcrowding_ranking",
              "fct_service_gap", "fct_recovery_trends"),
}
#: Partition column of the raw tables that hold one report or snapshot per partition.
LABEL = "label"
#: How Spark names the partition of NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def layer_schema(layer: str, schemas: dict | None = None) -> str:
    """The schema named for a layer, trimmed, else the default one."""
    return ((schemas or {}).get(layer) or "").strip() or LAYER_SCHEMAS[layer]


def layer_path(warehouse: str, layer: str, schemas: dict | None = None) -> str:
    """Where a layer's tables lie."""
    return f"{warehouse}/{layer_schema(layer, schemas)}"


class _Folders:
    """A file system that Spark reads, by path text."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))] if self.exists(path) else []

    def move(self, old: str, new: str) -> None:
        self._fs.mkdirs(self._path(new).getParent())
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def replace(spark: SparkSession, path: str, frames, partition_by: str | None = None, keep_others: bool = False,
            drop: tuple = ()) -> list:
    """Put the rows of `frames` in the place of the table at `path`; one dict of metrics per frame.

    `frames` is a list of (DataFrame, {name: aggregate Column}); the number of
    rows is counted as "rows" with the other metrics while writing.  With
    `keep_others` only the partitions that the new rows lie in are replaced, and
    those of the values in `drop` that no new row has removed; the others keep
    their files.
    """
    parent, name = path.rstrip("/").rsplit("/", 1)
    token, fs = uuid.uuid4().hex, _Folders(spark, path)
    staged = f"{parent}/_next-{token}"
    counted = []
    try:
        for df, metrics in frames:
            obs = Observation()
            aggregates: list[Column] = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]]
            w = df.observe(obs, *aggregates).write.mode("append")
            if partition_by:
                w = w.partitionBy(partition_by)
            w.parquet(f"{staged}/{name}")
            counted.append(obs.get)
        held = set(fs.names(f"{staged}/{name}"))
        for part in {f"{partition_by}={NO_VALUE if v is None else v}" for v in drop} - held:
            fs.touch(f"{staged}/_drop/{part}")
    except BaseException:
        fs.delete(staged)
        raise
    fs.touch(f"{staged}/{'_parts' if keep_others else '_whole'}-{name}")
    _settle(fs, parent, token)
    log.info("wrote %s (%s rows)", path, sum(c["rows"] for c in counted))
    return counted


def _swap(fs: _Folders, new: str, current: str, old: str) -> None:
    if fs.exists(current):
        fs.move(current, old)
    if fs.exists(new):
        fs.move(new, current)


def _settle(fs: _Folders, parent: str, token: str) -> None:
    """Put a complete write in place.  Done again after an interruption it goes on where it stopped."""
    staged, old = f"{parent}/_next-{token}", f"{parent}/_old-{token}"
    for mark in fs.names(staged):
        if mark.startswith("_whole-"):
            name = mark.removeprefix("_whole-")
            if fs.exists(f"{staged}/{name}"):
                _swap(fs, f"{staged}/{name}", f"{parent}/{name}", f"{old}/{name}")
        elif mark.startswith("_parts-"):
            name = mark.removeprefix("_parts-")
            for part in fs.names(f"{staged}/{name}"):
                if "=" in part:
                    _swap(fs, f"{staged}/{name}/{part}", f"{parent}/{name}/{part}", f"{old}/{name}/{part}")
            for part in fs.names(f"{staged}/_drop"):
                if fs.exists(f"{parent}/{name}/{part}"):
                    fs.move(f"{parent}/{name}/{part}", f"{old}/{name}/{part}")
    fs.delete(staged)
    fs.delete(old)


def recover(spark: SparkSession, warehouse: str, schemas: dict | None = None) -> int:
    """Finish the writes that were complete but not yet in place when a driver was lost; their number."""
    done = 0
    for layer in LAYER_SCHEMAS:
        parent = layer_path(warehouse, layer, schemas)
        fs = _Folders(spark, parent)
        for folder in fs.names(parent):
            if folder.startswith("_next-") and any(n.startswith(("_whole-", "_parts-")) for n in fs.names(f"{parent}/{folder}")):
                _settle(fs, parent, folder.removeprefix("_next-"))
                done += 1
    return done


def has_table(spark: SparkSession, path: str) -> bool:
    return _Folders(spark, path).exists(path)


def read_table(spark: SparkSession, warehouse: str, layer: str, name: str, schemas: dict | None = None) -> DataFrame:
    """A written table.  The raw tables' partition column repeats the row's own label and is left out."""
    df = spark.read.parquet(f"{layer_path(warehouse, layer, schemas)}/{name}")
    return df.drop(LABEL) if layer == "raw" and name != "load_log" else df
