"""Tables that an operator reads more than once, in the shared folder.

The folder is the one that ``spark.checkpoint.dir`` names, so every executor
and the driver see the files and a lost executor costs no recomputation of
what is written.  Files go when the application ends.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from routekpi.session import ensure_checkpoint_dir


def folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    jvm = spark.sparkContext._jvm
    parent = jvm.org.apache.hadoop.fs.Path(path).getParent()
    fs = parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(parent)
    fs.deleteOnExit(parent)
    return path


#: Most bytes of an Arrow batch between Spark and a Python worker; texts are long.
BATCH_BYTES = 8 << 20
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once for each application, and bound Arrow batches.

    Called first by every operator: a Python function knows the files that were
    added before it was made.  A smaller bound that the session has stays.
    """
    sc = spark.sparkContext
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)\s*([bkmg]?)b?", spark.conf.get(limit).lower()).groups()
    if int(number) << {"k": 10, "m": 20, "g": 30}.get(unit, 0) > BATCH_BYTES:
        spark.conf.set(limit, str(BATCH_BYTES))
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    fd, path = tempfile.mkstemp(prefix="routekpi-", suffix=".zip")
    with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w") as z:
        for top, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name based on ``stem`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
