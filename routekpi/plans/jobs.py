"""Independent Spark jobs at the same time, stopped together when one fails."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark.sql import SparkSession

#: Jobs that are started at once; each is parallel in itself.
AT_ONCE = 8


def run_together(spark: SparkSession, tasks: dict[str, Callable], pool: str = "routekpi", at_once: int = AT_ONCE) -> dict:
    """Run the functions, each of which starts Spark jobs, and return {name: result}.

    Each has a scheduler pool of its own, so with spark.scheduler.mode=FAIR they
    share the cluster evenly and a small load doesn't wait for a large one.  The
    first failure cancels the running jobs of the others, keeps those that wait
    from starting, and is raised once all have ended.
    """
    if not tasks:
        return {}
    sc, tag, stopped = spark.sparkContext, f"routekpi-{uuid.uuid4().hex}", threading.Event()

    def call(name: str, task: Callable):
        if stopped.is_set():
            return None
        sc.setLocalProperty("spark.scheduler.pool", f"{pool}-{name}")
        sc.setJobDescription(name)
        sc.addJobTag(tag)
        sc.setInterruptOnCancel(True)
        try:
            return task()
        except BaseException:
            first = not stopped.is_set()
            stopped.set()
            if first:
                sc.cancelJobsWithTag(tag)
                raise
            return None  # stopped by another's failure
        finally:
            sc.removeJobTag(tag)

    with ThreadPoolExecutor(min(at_once, len(tasks))) as threads:
        running = {name: threads.submit(call, name, task) for name, task in tasks.items()}
        wait(running.values(), return_when=FIRST_EXCEPTION)
    return {name: future.result() for name, future in running.items()}
