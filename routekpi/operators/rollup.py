"""Group rollups: simple means, volume-weighted indices, arg-max.

All are hash aggregates with a map-side partial step, so a group holding a
large share of the rows (a big sub-region in a busy year) is pre-combined in
every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean(c, scale: int) -> Column:
    """round(avg(c), scale); NULLs ignored (decimal avg stays decimal)."""
    return F.round(F.avg(c), scale)


def weighted_index(value, base, scale: int = 1) -> Column:
    """round(sum(value) / sum(base) * 100, scale) when sum(base) > 0."""
    num, den = F.sum(value), F.sum(base)
    return F.when(den > 0, F.round(num / den * 100, scale))


def with_top(rolled: DataFrame, rows: DataFrame, keys, score: str, best: str, entity: str, name: str) -> DataFrame:
    """Adds to a rollup the entity with the group's largest score (`best`); ties go to the smallest entity.

    The rollup itself stays a hash aggregate of numbers; only the rows that
    reach their group's maximum meet it again.
    """
    keys = list(keys)
    most = rolled.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(best).alias("_best"))
    same = F.col(score) == F.col("_best")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    top = rows.join(most, same, "inner").groupBy(*[f"_{k}" for k in keys]).agg(F.min(entity).alias(name))
    back = F.lit(True)
    for k in keys:
        back = back & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rolled.join(top, back, "left").drop(*[f"_{k}" for k in keys])
