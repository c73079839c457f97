"""Ranks within a period, top-k membership and persistence.

The period key (a year) has only a handful of values, so
``row_number() over (partition by year ...)`` would put every entity of a
year into one task.  `rank_within` computes the same row numbers without
that: rows are range-partitioned on (period, order keys) once, so each slice
holds a contiguous run of the global order, and are written to the shared
folder with their slice and place.  The counts per (slice, period) -- at most
slices + periods rows -- and the ranks are both read from those files, so they
can't disagree about which row lies in which slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _unused(df: DataFrame, stem: str) -> str:
    while stem in df.columns:
        stem += "_"
    return stem


def rank_within(df: DataFrame, period: str, order, rank_col: str = "rank",
                num_partitions: int | None = None, method: str = "range") -> DataFrame:
    """1-based row number within `period` following `order` (a list of sort Columns).

    `order` must be a total order inside a period (end it with the entity key)
    so the numbering is repeatable.  ``method="window"`` gives the plain
    window form for comparison.
    """
    order = list(order)
    if method == "window":
        w = Window.partitionBy(period).orderBy(*order)
        return df.withColumn(rank_col, F.row_number().over(w))

    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(period).asc_nulls_last(), *order]
    part, place = _unused(df, "_slice"), _unused(df, "_place")
    placed = materialize(
        df.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().alias(place)),
        "placed",
    )
    counts = placed.groupBy(F.col(part).alias("_of"), F.col(period).alias("_in")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first")
    )
    before = Window.partitionBy("_in").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_of", "_in", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    same = (F.col(part) == F.col("_of")) & F.col(period).eqNullSafe(F.col("_in"))
    rank = (F.col("_offset") + F.col(place) - F.col("_first") + 1).cast("int")
    # every row has its slice's offset; a missing one is an error, not a lost row
    rank = F.when(F.col("_of").isNull(), F.raise_error(F.lit("rank_within: a row without its slice")).cast("int")).otherwise(rank)
    return placed.join(offsets, same, "left").select(*[F.col(f"`{c}`") for c in df.columns], rank.alias(rank_col))


def top_k(df: DataFrame, period: str, order, k: int, rank_col: str = "rank") -> DataFrame:
    """The first k rows of each period.  Planned as a WindowGroupLimit: every
    map task keeps its own top k per period before the shuffle.  Meant for a
    small k (a report's); for ranks of all rows use `rank_within`."""
    w = Window.partitionBy(period).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def with_topk_persistence(ranked: DataFrame, entity: str, rank_col: str, k: int, min_periods: int,
                          count_col: str = "years_in_top20", flag_col: str = "is_top20",
                          persistent_col: str = "is_persistent_overcrowded", counts: DataFrame | None = None) -> DataFrame:
    """Add top-k flag, number of periods in the top k, and the persistence flag.

    The per-entity counts come from the top-k rows (k per period) or, where
    `ranked` has some periods only, from `counts` (entity, count_col); AQE
    broadcasts them when their measured size allows it.
    """
    if counts is None:
        counts = ranked.filter(F.col(rank_col) <= k).groupBy(entity).agg(F.count(F.lit(1)).alias(count_col))
    counts = counts.select(F.col(entity).alias("_who"), count_col)
    n = F.coalesce(F.col(count_col), F.lit(0)).cast("long")
    return ranked.join(counts, F.col(entity) == F.col("_who"), "left").select(
        *[F.col(f"`{c}`") for c in ranked.columns],
        (F.col(rank_col) <= k).alias(flag_col),
        n.alias(count_col),
        (n >= min_periods).alias(persistent_col),
    )
