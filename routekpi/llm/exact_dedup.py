"""Exact deduplication by two passes of Bloom filtering.

Pass one hashes every normalised text and builds a bounded counting filter of
the hashes; pass two tests every row against it.  Only rows whose hash may
occur twice shuffle, by the whole SHA-256; the rest pass straight through.

Two texts are equal when identical after replacing each run of the bytes 0x20
and 0x09-0x0D by one space.  Null texts count as empty, so all of them and the
empty texts form one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from routekpi.llm import bloom
from routekpi.llm.scratch import fresh, save, ship


def text_sha256(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text in UTF-8."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.sha2(plain.cast("binary"), 256)


def _key(sha: Column) -> Column:
    """64 bits of the SHA-256, as the filter's key."""
    return F.xxhash64(sha)


def _filter(hashed: DataFrame, key: str, max_filter_bytes: int):
    return bloom.build(hashed, key, hashed.count(), max_filter_bytes)


def mark_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the smallest id of the rows with an equal text and ``kept``
    says whether the row has it.  Rows that repeat id and text are the same
    document: they share their flags (``drop_exact`` returns one of them).  A
    null id is kept only in a group without any other id.  Other columns of
    ``docs`` don't matter; no rows give no rows.
    """
    ship(docs.sparkSession)
    hashed = save(
        docs.select(F.col(id_col).alias("id"), text_sha256(F.col(text_col)).alias("sha")).withColumn("key", _key(F.col("sha"))),
        "hashes",
    )
    tested = hashed.withColumn("again", bloom.may_hold(_filter(hashed, "key", max_filter_bytes), F.col("key")))
    tested = save(tested.select("id", "sha", "again"), "tested")
    alone = tested.where(~F.col("again")).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    suspects = tested.where("again")
    # written first, so that a hot group's rows can be split in the join
    groups = save(suspects.groupBy("sha").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    met = suspects.join(groups, "sha").select("id", "keep_id", "group_size", "sha")
    return alone.unionByName(met).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """The rows of ``docs``, one for each normalised text: that with the smallest id.

    All columns stay as they are.  Rows of equal id and text differ at most in
    other columns; one of them stays, chosen by a hash of the row.  Suspected
    rows are reduced in the map tasks first, so a group of copies of any size
    shuffles one row per task.
    """
    ship(docs.sparkSession)
    sha, key = fresh(docs, "sha_"), fresh(docs, "key_")
    hashed = save(docs.select(_key(text_sha256(F.col(text_col))).alias(key)), "keys")
    filt = _filter(hashed, key, max_filter_bytes)
    named = docs.withColumn(sha, text_sha256(F.col(text_col)))
    flag = fresh(docs, "again_")
    tested = named.withColumn(flag, bloom.may_hold(filt, _key(F.col(sha))))
    alone = tested.where(~F.col(flag)).select(docs.columns)
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.xxhash64(*[F.col(c).cast("string") if t.startswith("map") else F.col(c) for c, t in docs.dtypes]))
    best = tested.where(flag).groupBy(sha).agg(F.min_by(F.struct(*docs.columns), order).alias("row"))
    return alone.unionByName(best.select("row.*"))
