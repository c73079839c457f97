"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id's digits, modulo 4, is 2; a null id isn't."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: Column, rows: int, id_col: str = "doc_id", text_col: str = "text",
           label_id: str | None = None, exclude_held_out: bool = True) -> DataFrame:
    """(id, text, y) of at most ``rows`` labelled documents, chosen by a hash of the id.

    ``label`` is an expression over ``labels``; null labels, null ids and
    (by default) held-out ids are left out, and of an id's several labels the
    largest counts.  Of rows that repeat an id the one with the least hash of its
    text (then the first text) is taken, so there are ``rows`` at most whatever the
    table holds.  Only the ids and labels are broadcast.
    """
    y = labels.select(F.col(label_id or id_col).alias("y_id"), label.cast("int").alias("y")).where("y IS NOT NULL AND y_id IS NOT NULL")
    if exclude_held_out:
        y = y.where(~held_out(F.col("y_id")))
    y = y.groupBy("y_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("y_id"), "y_id").limit(rows)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = narrow.join(F.broadcast(y), F.col("id") == F.col("y_id")).select("id", "text", "y")
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("text"), "text"))  # a group limit: one row of an id and task
    return found.withColumn("place_", first).where("place_ = 1").drop("place_")
