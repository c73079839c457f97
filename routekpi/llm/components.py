"""Connected components of a graph given as a table of links.

Alternating large-star and small-star steps: every step points a node's
neighbours at the smallest node near it, until each component is a star around
its smallest node.  Links stay in tables; the driver sees three sums per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from routekpi.llm.scratch import save


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    out = both.where("b > a").join(least, F.col("a") == F.col("n"))
    return out.select(F.col("b").alias("a"), F.least("m", "n").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    pulled = e.join(least, F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return pulled.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def _sums(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b long) but the roots themselves.

    ``root`` is the smallest node that links reach.  Self links and repeated
    links do no harm; nulls aren't allowed.
    """
    e = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = save(e, "links")
    was = _sums(e)
    while was[0]:
        e = save(_small_star(_large_star(e)), "star")
        now = _sums(e)
        if now == was:
            break
        was = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
