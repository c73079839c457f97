"""Per-entity time windows: prior available period and base-period values.

Both are window expressions over one ``partitionBy(key).orderBy(time, ...)``
spec, so Spark plans a single Exchange and a single Sort for all of them.  The
key is the entity, except that rows without one are dealt over many keys by
their hash: they share no window by definition, and would else all sort in one
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys over which the rows without an entity are dealt.
NULL_KEYS = 1024


def spread_key(entity: str, by) -> Column:
    """The entity as text, or one of NULL_KEYS other texts where it is NULL."""
    return F.coalesce(F.col(entity).cast("string"), F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*by), F.lit(NULL_KEYS)).cast("string")))


def entity_window(entity: str, time: str, tiebreak=(), key: str | None = None):
    """Rows of an entity by time; `tiebreak` columns make the order total.  `key` names a `spread_key` column."""
    part = F.col(key) if key else spread_key(entity, [time, *tiebreak])
    return Window.partitionBy(part).orderBy(F.col(time).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak])


def prior_columns(entity: str, time: str, columns: dict, prior_time: str | None = None, tiebreak=(), key: str | None = None) -> dict:
    """Columns holding the previous *available* period's values (gap-blind lag).

    `columns` maps output name -> source column.  Values are NULL for a NULL
    entity or time, as a self-join on (entity, time) would give.
    """
    w = entity_window(entity, time, tiebreak, key)
    valid = F.col(entity).isNotNull() & F.col(time).isNotNull()
    out = {name: F.when(valid, F.lag(src).over(w)) for name, src in columns.items()}
    if prior_time:
        out[prior_time] = F.when(valid, F.lag(time).over(w))
    return out


def baseline_columns(entity: str, time: str, base_period, columns: dict, tiebreak=(), key: str | None = None) -> dict:
    """Columns holding the entity's (largest) value in `base_period`, NULL if it has no such row."""
    w = entity_window(entity, time, tiebreak, key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    valid = F.col(entity).isNotNull()
    return {
        name: F.when(valid, F.max(F.when(F.col(time) == F.lit(base_period), F.col(src))).over(w))
        for name, src in columns.items()
    }


def with_prior(df: DataFrame, entity: str, time: str, columns: dict, prior_time: str | None = None) -> DataFrame:
    return df.withColumns(prior_columns(entity, time, columns, prior_time))


def with_baseline(df: DataFrame, entity: str, time: str, base_period, columns: dict) -> DataFrame:
    return df.withColumns(baseline_columns(entity, time, base_period, columns))
