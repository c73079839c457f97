"""Revision audit between overlapping reports, and the bounding-box filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def revision_audit(reports: DataFrame, keys, report: str, value: Column) -> DataFrame:
    """Keys whose values changed from one report to the next that holds the key.

    `reports` is the union of any number of reports, labelled by `report`, whose
    labels order them.  `value` is a numeric expression.  One aggregation reduces
    each (key, report) to the smallest and largest value, the number of rows and
    an order-free sum over the values' hashes; ``lag`` over a key's reports then
    compares each report with the one before.  A key is reported if any of the
    four differs, so a value that a report repeats can hide nothing, and repeated
    keys never multiply into pairs.

    Returns the keys, older/newer report, value_older/value_newer (the smallest),
    max_older/max_newer and rows_older/rows_newer.
    """
    keys = list(keys)
    seen = (
        reports.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
        .select(*keys, F.col(report).alias("newer_report"), value.alias("_v"))
        .groupBy(*keys, "newer_report")
        .agg(F.min("_v").alias("value_newer"), F.max("_v").alias("max_newer"), F.count(F.lit(1)).alias("rows_newer"),
             F.sum(F.xxhash64("_v").cast("decimal(38,0)")).alias("_sum_newer"))
    )
    w = Window.partitionBy(*keys).orderBy("newer_report")
    names = ("value", "max", "rows", "_sum")
    seen = seen.withColumns({"older_report": F.lag("newer_report").over(w)} | {f"{n}_older": F.lag(f"{n}_newer").over(w) for n in names})
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"{n}_newer").eqNullSafe(F.col(f"{n}_older"))
    return seen.where(F.col("older_report").isNotNull() & ~same).drop("_sum_newer", "_sum_older")


def bbox_filter(df: DataFrame, lat: str, lon: str, lat_range, lon_range) -> DataFrame:
    """Non-null coordinates inside an inclusive box (pushed to the scan as ranges)."""
    return df.filter(
        F.col(lat).isNotNull()
        & F.col(lon).isNotNull()
        & F.col(lat).between(lat_range[0], lat_range[1])
        & F.col(lon).between(lon_range[0], lon_range[1])
    )


def changed_keys(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """The keys whose rows differ between two tables of the same columns, or that one of them lacks.

    Each side is reduced to a count and an order-free hash sum per key (NULL keys
    count as a key), so rows that repeat a key are compared as a bag.
    """
    def reduced(df: DataFrame, side: int) -> DataFrame:
        digest = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(new.columns)]).cast("decimal(38,0)")
        return df.groupBy(*keys).agg(F.sum(digest).alias("digest"), F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))

    both = reduced(old, 0).unionByName(reduced(new, 1)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sides"), F.min("digest").alias("d0"), F.max("digest").alias("d1"), F.min("n").alias("n0"), F.max("n").alias("n1"))
    return both.where("sides = 1 OR d0 != d1 OR n0 != n1").select(*keys)


def among(column: str, values) -> Column:
    """True where the column has one of the values; None stands for NULL."""
    some = F.col(column).isin(sorted(v for v in values if v is not None))
    return some | F.col(column).isNull() if None in values else some
