"""Session helpers: one place for the settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume.  ANSI stays on (parse only with try_cast,
# divide only under a guard); AQE re-plans joins and shuffle partitions at run
# time; the session time zone is fixed so year() is the same everywhere.
ENGINE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "routekpi") -> SparkSession:
    """Local session for tests and benchmarks (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.scheduler.mode", "FAIR")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session.

    The operators rely on them, so a setting that can't be changed and differs
    is an error.
    """
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it the operators can't run.  Only a local master (tests) gets
    a scratch folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="routekpi-ckpt-", dir=os.environ.get("ROUTEKPI_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; it goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/routekpi-{uuid.uuid4().hex}/{name}"
    parent = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
    fs = parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(parent)
    fs.deleteOnExit(parent)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    What is read twice is then the same rows both times, whatever is recomputed.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
