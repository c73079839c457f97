"""Mixing sources to target weights as a time-varying curriculum.

Each source is given a share of all words by its weight, at most ``max_epochs``
times its own size; the excess is shared again by weight until no target is
above its bound.  A source's documents lie one after another on its word axis,
in an order fixed by a hash of id and text, and the axis repeats for every epoch.
Its weight schedule (a rate over training time 0 to 1) is integrated, and the
inverse of that integral turns a place on the axis into a training position.

Running totals never gather a source in one task: a source's documents are
dealt to buckets by ranges of the hash, summed per bucket, and the buckets'
totals shift the running totals within.  Rows equal in id, source and text are
counted first, so they are one row there, however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from routekpi.llm import words as W
from routekpi.llm.scratch import fresh, save, ship

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: A source's target is at most so many times its size.
MAX_EPOCHS = 3
#: Rates over training time, by weight: knots of (time, rate), linear between.
SCHEDULES = {
    1: ((0.0, 1.5), (1.0, 0.5)),  # the light sources early
    2: ((0.0, 1.0), (1.0, 1.0)),
    3: ((0.0, 0.5), (1.0, 1.5)),  # the heavy sources late
}
#: About so many documents are summed in one bucket.
BUCKET_ROWS = 4096


def with_sizes(docs: DataFrame, text_col: str, size_col: str, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and the number of words of each whole text (null: 0)."""
    keep = list(keep)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, text_col):
                b = W.texts(part.column(part.schema.get_field_index(text_col)))
                sizes = np.diff(W.runs(~W.is_space(b.data), b.offsets)[2])
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], [*keep, size_col])

    fields = docs.select(*keep).withColumn(size_col, F.lit(0).cast("long")).schema
    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(count, fields)


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds weight, target (double) and demand (whole words) to (source, n, source_size).

    Sharing the excess again until none is above its bound settles where
    ``sum(min(bound, level * weight))`` meets the total: sources in the order
    of bound / weight reach their bound one after another.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    t = totals.withColumn("nth", F.row_number().over(by_name) - 1).withColumn("weight", pick)
    t = t.withColumn("bound", F.col("source_size") * max_epochs)
    by_fill = Window.orderBy(F.col("bound") / F.col("weight"), "nth")
    below = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    t = t.withColumn("total", F.sum("source_size").over(everything))
    level = (F.col("total") - F.coalesce(F.sum("bound").over(below), F.lit(0))) / F.sum("weight").over(onward)
    t = t.withColumn("level", level)
    # the first source, in that order, that the level leaves below its bound sets it for all after it
    open_ = F.col("level") * F.col("weight") < F.col("bound")
    t = t.withColumn("level", F.min(F.when(open_, F.struct(F.col("bound") / F.col("weight"), "nth", "level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull() | (F.col("level") * F.col("weight") >= F.col("bound")), F.col("bound").cast("double")).otherwise(F.col("level") * F.col("weight"))
    t = t.withColumn("target", target)
    return t.withColumn("demand", F.floor(F.col("target") + 0.5)).select("source", "n", "source_size", "weight", "target", "demand")


def position(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of the rate reaches ``share`` of the whole."""
    pieces = [(t0, r0, (r1 - r0) / (t1 - t0), (r0 + r1) / 2 * (t1 - t0)) for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
    need, done, out = share * F.lit(float(sum(p[3] for p in pieces))), 0.0, None
    for t0, rate, slope, area in pieces:
        left = F.greatest(need - F.lit(done), F.lit(0.0))
        # the root of rate * t + slope * t**2 / 2 = left, in the form without cancellation
        root = F.lit(rate) + F.sqrt(F.greatest(F.lit(rate * rate) + F.lit(2 * slope) * left, F.lit(0.0)))
        here = F.lit(t0) + F.when(root > 0, F.lit(2.0) * left / root).otherwise(F.lit(0.0))
        out = here if out is None else F.when(need >= F.lit(done), here).otherwise(out)
        done += area
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, schedules: dict[int, Sequence[tuple[float, float]]] | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: id, size, source, source_size, target, taken, position.

    ``taken`` is the number of words that the mix takes, repeats counted: whole
    epochs of the source's axis and what of the last epoch's words, in hash
    order, still lies below the demand; the one document at that border may be
    taken in part.  So the words taken from a source are its target, rounded.
    ``position`` (0 to 1) is where the document comes first, null if it isn't
    taken.  Rows come range-sorted by position, those not taken last.

    A null source is a source of its own, last in order.  Empty texts have size
    0 and are never taken.  Repeated rows count as rows, one after another on the
    axis.  The order key is the MD5 of the id's digits (none for a null id), a
    colon and the text's MD5.  Other columns don't matter; no rows give no rows.
    """
    ship(docs.sparkSession)
    schedules = schedules or SCHEDULES
    placed = save(taken_of(place(docs, id_col, text_col, source_col, weights, max_epochs, bucket_rows)), "placed")
    share = F.col("start") / F.greatest(F.col("demand"), F.lit(1))
    at = F.lit(None).cast("double")
    for weight, knots in schedules.items():
        at = F.when(F.col("weight") == weight, position(share, knots)).otherwise(at)
    out = placed.withColumn("position", F.when(F.col("taken") > 0, at))
    return out.orderBy(F.col("position").asc_nulls_last(), "id").select(
        F.col("id").alias(id_col), "size", "source", "source_size", "target", "taken", "position")


def order_key(id_col: str, text_col: str) -> Column:
    """A row's place among its source's rows: equal for rows of equal id and text only."""
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))


def place(docs, id_col, text_col, source_col, weights, max_epochs, bucket_rows) -> DataFrame:
    """(id, source, order, size, copies, source_size, weight, target, demand, start) of each different row; start is the first copy's."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), order_key(id_col, text_col).alias("order"), F.col(text_col).alias("text"))
    sized = with_sizes(narrow, "text", "size", ["id", "source", "order"])
    sized = save(sized.groupBy("id", "source", "order", "size").agg(F.count(F.lit(1)).alias("copies")), "sizes")
    totals = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    plan = save(targets(totals, weights, max_epochs), "targets").withColumnRenamed("source", "of")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # the first 12 hex digits of the order key as a fraction of the source's buckets
    part = F.conv(F.substring("order", 1, 12), 16, 10).cast("double") / float(1 << 48)
    rows = save(rows.withColumn("bucket", F.floor(part * F.ceil(F.col("n") / bucket_rows))), "bucketed")
    # sums of the buckets before each; a few rows for every bucket_rows documents
    words = F.sum(F.col("size") * F.col("copies"))
    before = Window.partitionBy("of").orderBy("in").rowsBetween(Window.unboundedPreceding, -1)
    shift = rows.groupBy(F.col("source").alias("of"), F.col("bucket").alias("in")).agg(words.alias("words"))
    shift = shift.withColumn("shift", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    within = Window.partitionBy("source", "bucket").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(words.over(within), F.lit(0)))
    rows = rows.join(shift, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in"))).drop("of", "in")
    return rows.select("id", "source", "order", "size", "copies", "source_size", "weight", "target", "demand", (F.col("start") + F.col("shift")).alias("start"))


def taken_of(placed: DataFrame) -> DataFrame:
    """A row per copy, with its own ``start`` and the words ``taken`` of it."""
    rows = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rows = rows.withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    size, whole = F.greatest(F.col("source_size"), F.lit(1)), F.col("demand")
    epochs = F.floor(whole / size)
    rest = whole - epochs * size
    last = F.least(F.greatest(rest - F.col("start"), F.lit(0)), F.col("size"))
    return rows.withColumn("taken", (epochs * F.col("size") + last).cast("long"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
         max_epochs: int = MAX_EPOCHS, schedules: dict[int, Sequence[tuple[float, float]]] | None = None) -> DataFrame:
    """The mixed documents themselves, with the columns of ``docs``, in training order.

    A document comes once for every whole time that it is taken; of the one at
    a source's border, the words taken come as one more row, joined by one space.
    So the words returned of a source are its target, rounded.  Rows equal in id,
    source and text are copies of one row: where they differ in other columns, of
    the one with the least hash of them all.  Null sources, empty texts, clashing
    names and empty tables are as for ``mix``.
    """
    ship(docs.sparkSession)
    schedules = schedules or SCHEDULES
    placed = save(place(docs, id_col, text_col, source_col, weights, max_epochs, BUCKET_ROWS), "placed")
    at, part, size, key, k_key, k_source = (fresh(docs, x) for x in ("position_", "words_", "size_", "key_", "k_key", "k_source"))
    plan = taken_of(placed).where("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("taken") / F.col("size")) - 1).cast("int"))))
    words = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))
    share = (F.col("start") + F.col("epoch") * F.col("source_size")) / F.greatest(F.col("demand"), F.lit(1))
    when = F.lit(None).cast("double")
    for weight, knots in schedules.items():
        when = F.when(F.col("weight") == weight, position(share, knots)).otherwise(when)
    plan = plan.select(F.col("order").alias(k_key), F.col("source").alias(k_source), F.col("copies"), F.col("size").alias(size), words.alias(part), when.alias(at))
    same = lambda df: F.col(key).eqNullSafe(F.col(k_key)) & df[source_col].eqNullSafe(F.col(k_source))
    rows = docs.withColumn(key, order_key(id_col, text_col))
    out = rows.join(plan.where("copies = 1").drop("copies"), same(rows))
    many = save(placed.where("copies > 1").select(F.col("order").alias(k_key), F.col("source").alias(k_source)), "many")
    if many.limit(1).count():
        # equal rows: each map task ships one of them
        digest = F.xxhash64(*[F.col(c).cast("string") if t.startswith("map") else F.col(c) for c, t in docs.dtypes])
        held = rows.join(many, same(rows), "left_semi").groupBy(key, source_col).agg(F.min_by(F.struct(*docs.columns), digest).alias("row"))
        held = held.select("row.*", key)
        out = out.unionByName(held.join(plan.where("copies > 1").drop("copies"), same(held)))
    cut = F.array_join(F.slice(F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != ""), 1, F.col(part).cast("int")), " ")
    out = out.withColumn(text_col, F.when(F.col(part) < F.col(size), cut).otherwise(F.col(text_col)))
    return out.orderBy(at, id_col).select(docs.columns)
