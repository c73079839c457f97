"""Keep-the-newest-row operators (report dedup, latest snapshot)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_first()


def _asc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def latest_per_key(df: DataFrame, keys, newest_first, tiebreak=(), drop_null_keys: bool = True,
                   rank_col: str = "_row_num") -> DataFrame:
    """One row per key: the row with the largest `newest_first` value(s).

    Same result as ``row_number() over (partition by keys order by newest_first desc) = 1``
    with the NULL ordering of the source warehouse (NULL sorts as largest).
    `tiebreak` columns make the choice repeatable when the order columns tie:
    one is sorted ascending, several by one 64-bit hash of them all, so the
    sort never compares every column of a wide row.  Rows with a NULL key are dropped *before* the window: they
    are discarded by the caller's filter anyway, and dropping them first keeps
    a mass of NULL keys from landing in one task.

    Spark plans the ``= 1`` filter as a WindowGroupLimit, so each map task
    keeps one row per key before the shuffle -- a key with millions of copies
    ships at most one row per input partition.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newest_first = [newest_first] if isinstance(newest_first, str) else list(newest_first)
    if drop_null_keys and keys:
        df = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    ties = [F.xxhash64(*tiebreak)] if len(tiebreak) > 1 else list(tiebreak)
    w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in newest_first], *[_asc(c) for c in ties])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)
