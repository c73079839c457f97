"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A document's set of word shingles has a signature of 32 symbols of 16 bits.
Signatures are cut into 8 chunks of 4 symbols.  Two signatures that differ in at
most 15 symbols have, by the pigeonhole principle, a chunk with at most one
differing symbol; so each chunk is indexed four times, each time without one
symbol (all ways to have that error), and such two signatures share a key.  The
three symbols left, the chunk and the place left out make a 64-bit key without
any hashing.  Documents of Jaccard similarity s miss every key with probability
``(1 - s**4 - 4 * s**3 * (1 - s))**8``: 1e-6 at 0.8.

Every pair that meets on a key is confirmed or ruled out on full shingle sets.  Documents with equal sets are one
class from the start.  Within a key's bucket the members are compared first with
one hub, the member that agrees most with the others; buckets are cut into parts
of bounded size for that choice.  What the hubs' links leave in different
components is then compared pair by pair, so no link between different sets that
could join two components is left out, and a large group of copies costs a
comparison per member and key, not one per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from routekpi.llm import bloom
from routekpi.llm import words as W
from routekpi.llm.components import components
from routekpi.llm.scratch import fresh, save, ship

#: Words of a shingle and least Jaccard similarity in percent.
SHINGLE_WORDS = 5
MIN_PERCENT = 80
#: Signature: CHUNKS chunks of 4 symbols of 16 bits; one error per chunk is enumerated.
CHUNKS, WIDTH = 8, 4
SYMBOLS = CHUNKS * WIDTH
#: Pairs of at most this many differing symbols share a key for certain: 2 * CHUNKS - 1.
MAX_DISTANCE = 2 * CHUNKS - 1
#: Members of a bucket that are compared in one piece.
PART = 512
#: Bits of a parity map.
MAP_BITS = 1024

_rng = np.random.default_rng(20)
_MULTIPLIERS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


def shingle_sets(b: W.Bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit shingle hashes of each text, sorted, and where each text's begin.

    Words are lower-cased (A-Z).  A text of fewer than k words has its whole
    sequence as one shingle; one without words has none.
    """
    words, _, _, first = W.word_hashes(b.lower_ascii())
    grams, at = W.gram_hashes(words, first, k)
    counts = np.diff(at)
    lengths = np.diff(first)
    short = np.flatnonzero((lengths > 0) & (lengths < k))
    whole = np.zeros(len(short), np.uint64)
    for i in range(k - 1):
        has = lengths[short] > i
        whole[has] = whole[has] * np.uint64(0xC2B2AE3D27D4EB4F) + words[first[short[has]] + i]
    whole = W.mix64(whole + lengths[short].astype(np.uint64))
    owner = np.concatenate([np.repeat(np.arange(len(b)), counts), short]).astype(np.uint64)
    keys = (owner << np.uint64(48)) | (np.concatenate([grams, whole]) >> np.uint64(16))
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    begin = np.searchsorted(keys, np.arange(len(b) + 1, dtype=np.uint64) << np.uint64(48))
    return keys & np.uint64((1 << 48) - 1), begin


def signatures(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """MinHash symbols, a row of SYMBOLS 16-bit integers for each non-empty set."""
    full = begin[:-1][np.diff(begin) > 0]
    out = np.zeros((len(full), SYMBOLS), np.uint16)
    for j in range(SYMBOLS):
        values = ((sets * _MULTIPLIERS[j] + _SHIFTS[j]) >> np.uint64(32)).astype(np.uint32)
        least = np.minimum.reduceat(values, full) if len(full) else values[:0]
        out[:, j] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def fingerprints(sets: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set that don't depend on order (0 for an empty set)."""
    sums = []
    for salt in (0x51ED270B1, 0x2545F4914F6CDD1D):
        total = np.zeros(len(sets) + 1, np.uint64)
        np.cumsum(W.mix64(sets ^ np.uint64(salt)), out=total[1:])
        sums.append((total[begin[1:]] - total[begin[:-1]]).view(np.int64))
    return sums[0], sums[1]


def _sketches(narrow: DataFrame, k: int) -> DataFrame:
    kind = narrow.schema["id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in W.chunks(batch, "text"):
                sets, begin = shingle_sets(W.texts(part.column(1)), k)
                n = np.diff(begin)
                signature = np.zeros(len(n), object)
                signature[:] = None
                signature[n > 0] = [x.tobytes() for x in signatures(sets, begin)]
                f1, f2 = fingerprints(sets, begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(n))), part.column(0), pa.array(n), pa.array(f1), pa.array(f2), pa.array(signature, pa.binary())],
                    ["row", "id", "n", "f1", "f2", "sig"])
                row += len(n)

    return narrow.mapInArrow(sketch, f"row long, id {kind}, n long, f1 long, f2 long, sig binary")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            rep = np.asarray(part.column(0))
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
            keys = []
            for c in range(CHUNKS):
                for out in range(WIDTH):
                    x, y, z = (sig[:, c, j] for j in range(WIDTH) if j != out)
                    keys.append((np.uint64(c * WIDTH + out) << np.uint64(48)) | (x << np.uint64(32)) | (y << np.uint64(16)) | z)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(rep, SYMBOLS))], ["key", "rep"])


def grouped(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows that come sorted by ``columns``, with the groups' starts.

    Rows are held back until their group is complete; groups are of bounded size.
    """

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for c in columns:
            v = np.asarray(t[c])
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        at = starts(table)
        if len(at) > 1:
            yield table.slice(0, int(at[-1])).combine_chunks(), at[:-1]
        held = table.slice(int(at[-1])).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, starts(table)


def _symbols(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each (key, part), the member whose symbols most others share."""
    for table, at in grouped(batches, ["key", "part"]):
        sig = _symbols(table["sig"])
        group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(sig)))).astype(np.uint64)
        score = np.zeros(len(sig), np.int64)
        for j in range(SYMBOLS):
            _, inverse, counts = np.unique((group << np.uint64(16)) | sig[:, j], return_inverse=True, return_counts=True)
            score += counts[inverse]
        rep = np.asarray(table["rep"])
        order = np.lexsort((rep, -score, group))
        best = order[at]
        yield table.take(pa.array(best)).combine_chunks().to_batches()[0]


def _pairs(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Different (smaller, larger) pairs, each once."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = low != high
    new[1:] &= (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    yield pa.RecordBatch.from_arrays([pa.array(low[new]), pa.array(high[new])], ["a", "b"])


def parity_maps(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """MAP_BITS bits per set, each the parity of the shingles that fall on it.

    Common shingles cancel between two sets, so their maps differ in at most as
    many bits as the sets differ in shingles.
    """
    n = len(begin) - 1
    spot = np.repeat(np.arange(n), np.diff(begin)) * MAP_BITS + (W.mix64(sets + np.uint64(11)) % np.uint64(MAP_BITS)).astype(np.int64)
    odd = (np.bincount(spot, minlength=n * MAP_BITS) & 1).astype(bool)
    return np.packbits(odd).reshape(n, MAP_BITS // 8)


def _bounds(sets: DataFrame, some: DataFrame) -> DataFrame:
    """(rep, n, shared, map): sizes of the sets of ``some``, how many shingles each shares with any other of them, parity maps.

    Two sets can't have more in common than the smaller of their ``shared``, and
    differ in at least as many shingles as their maps in bits.  That rules out
    nearly all pairs of copies that each were changed on their own.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data = part["set"].to_pylist()
                n = np.array([len(x) // 8 for x in data])
                maps = parity_maps(np.frombuffer(b"".join(data), np.uint64), np.concatenate([[0], np.cumsum(n)]))
                yield pa.RecordBatch.from_arrays([part["rep"], pa.array(n), pa.array([m.tobytes() for m in maps], pa.binary())], ["rep", "n", "map"])

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data = part["set"].to_pylist()
                rep = np.repeat(np.asarray(part["rep"]), [len(x) // 8 for x in data])
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(np.frombuffer(b"".join(data), np.int64))], ["rep", "shingle"])

    few = sets.join(some, "rep", "left_semi").select("rep", "set")
    sizes = few.mapInArrow(measured, "rep long, n long, map binary")
    lone = few.mapInArrow(shingles, "rep long, shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"), F.min("rep").alias("rep"))
    lone = lone.where("holders = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("lone"))
    return save(sizes.join(lone, "rep", "left").select("rep", "n", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("shared"), "map"), "bounds")


def _cross_pairs(min_percent: int):
    """Pairs of each (key, part, stray) in different components that may be similar enough."""

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in grouped(batches, ["key", "part", "stray"]):
            maps = np.frombuffer(b"".join(table["map"].to_pylist()), np.uint64).reshape(table.num_rows, -1)
            rep, root, left, n, shared = (np.asarray(table[c]) for c in ("rep", "root", "left", "n", "shared"))
            for begin, end in zip(at, np.append(at[1:], len(rep))):
                x = begin + np.flatnonzero(left[begin:end])
                y = begin + np.flatnonzero(~left[begin:end])
                for i in range(0, len(x), 64):
                    rows = x[i : i + 64]
                    most = np.minimum(shared[rows][:, None], shared[y][None, :])
                    may = 100 * most >= min_percent * (n[rows][:, None] + n[y][None, :] - most)
                    p, q = np.nonzero(may & (root[rows][:, None] != root[y][None, :]))
                    p, q = rows[p], y[q]
                    differing = np.bitwise_count(maps[p] ^ maps[q]).sum(axis=1, dtype=np.int64)
                    near = 100 * (n[p] + n[q] - differing) >= min_percent * (n[p] + n[q] + differing)
                    if near.any():
                        yield from _pairs(rep[p[near]], rep[q[near]])

    return cross


def _verified(pairs: DataFrame, sets: DataFrame, min_percent: int) -> DataFrame:
    """The pairs whose sets are similar enough."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch["set_a"], batch["set_b"])):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) >= min_percent * max(len(x), len(y)):
                    small, large = (x, y) if len(x) < len(y) else (y, x)
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[at] == small).sum())
                    keep[i] = 100 * both >= min_percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    a, b = (sets.select(F.col("rep").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b").mapInArrow(similar, "a long, b long")


def _full_sets(narrow: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, set) of the wanted classes (rep, id, f1, f2), computed again from the texts.

    A bounded filter of the wanted ids lets most other documents go unread
    beyond their id; the fingerprints then match exactly.
    """
    filt = bloom.build(wanted.select(F.xxhash64("id").alias("h")), "h", wanted.count(), plane="seen")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                sets, begin = shingle_sets(W.texts(part.column(1)), k)
                f1, f2 = fingerprints(sets, begin)
                data = [sets[i:j].tobytes() for i, j in zip(begin, begin[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(f1), pa.array(f2), pa.array(data, pa.binary())], ["id", "f1", "f2", "set"])

    kind = narrow.schema["id"].dataType.simpleString()
    some = narrow.where(bloom.may_hold(filt, F.xxhash64("id"))).mapInArrow(compute, f"id {kind}, f1 long, f2 long, set binary")
    w = wanted.select("rep", F.col("id").alias("w_id"), F.col("f1").alias("w1"), F.col("f2").alias("w2"))
    met = some.join(w, (F.col("f1") == F.col("w1")) & (F.col("f2") == F.col("w2")) & F.col("id").eqNullSafe(F.col("w_id")))
    # rows that repeat id and text compute the same set
    return met.select("rep", "set").dropDuplicates(["rep"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                    min_percent: int = MIN_PERCENT, part: int = PART) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Documents link when 100 * intersection >= min_percent * union of their
    shingle sets; ``component_id`` is the smallest id that links reach, and
    ``kept`` says whether it is the row's own.  Null, empty and blank texts have
    no shingles and link with nothing, not even each other.  Rows that repeat an
    id with an equal set share their flags; a null id is kept only where its
    component has no other id.
    """
    return _near_rows(docs, id_col, text_col, shingle_words, min_percent, part).drop("f1", "f2")


def _near_rows(docs: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS, min_percent: int = MIN_PERCENT, part: int = PART) -> DataFrame:
    """``near_duplicates`` with the fingerprint (f1, f2) of each row's set."""
    ship(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = save(_sketches(narrow, shingle_words), "sketches")
    classes = save(rows.where("n > 0").groupBy("f1", "f2").agg(F.min("row").alias("rep")), "firsts")
    classes = save(rows.where("n > 0").select("f1", "f2", "row", "id", "n").join(classes, ["f1", "f2"]), "classes")
    reps = rows.join(classes.where("row = rep").select("row"), "row", "left_semi").select(F.col("row").alias("rep"), "id", "f1", "f2", "sig")
    reps = save(reps, "reps")

    keys = reps.select("rep", "sig").mapInArrow(_keys, "key long, rep long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = keys.join(shared, "key").withColumn("parts", F.ceil(F.col("size") / part))
    members = members.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts"))).join(reps.select("rep", "sig"), "rep")
    members = save(members.select("key", "part", "parts", "rep", "sig"), "members")

    def choose(m: DataFrame) -> DataFrame:
        dealt = m.select("key", "part", "parts", "rep", "sig").repartition("key", "part").sortWithinPartitions("key", "part")
        return save(dealt.mapInArrow(_hubs, "key long, part long, parts long, rep long, sig binary"), "hubs")

    hubs = choose(members)
    done = hubs.where("parts = 1")
    while rest := hubs.where("parts > 1").count():  # the parts' hubs play again, PART of them at a time
        again = hubs.where("parts > 1").withColumn("parts", F.ceil(F.col("parts") / part))
        hubs = choose(again.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts"))))
        done = done.unionByName(hubs.where("parts = 1"))
    hub = done.select("key", F.col("rep").alias("hub"))
    tried = members.select("key", "rep").join(hub, "key").where("rep <> hub")
    tried = save(tried.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct(), "tried")

    wanted = save(reps.select("rep", "id", "f1", "f2").join(members.select("rep").distinct(), "rep"), "wanted")
    sets = save(_full_sets(narrow, wanted, shingle_words), "sets")
    links = save(_verified(tried, sets, min_percent), "verified")
    roots = components(links)

    # what the hubs left apart: members outside their bucket's largest component against all of it
    placed = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    apart = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    placed = save(placed.join(apart, "key"), "apart")
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    placed = placed.join(main, "key").join(_bounds(sets, placed.select("rep").distinct()), "rep")
    stray = placed.where("root <> main")
    stray_parts = stray.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / part).alias("strays"))
    right = placed.join(stray_parts, "key").withColumn("stray", F.explode(F.sequence(F.lit(0).cast("long"), F.col("strays") - 1)))
    left = stray.join(stray_parts, "key").withColumn("stray", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("strays")))
    left = left.drop("part").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    columns = ["key", "part", "stray", "rep", "root", "n", "shared", "map"]
    blocks = left.select(*columns, F.lit(True).alias("left")).unionByName(right.select(*columns, F.lit(False).alias("left")))
    blocks = blocks.repartition("key", "part", "stray").sortWithinPartitions("key", "part", "stray")
    more = blocks.mapInArrow(_cross_pairs(min_percent), "a long, b long").distinct().join(tried, ["a", "b"], "left_anti")
    more = save(more, "more")
    found = save(_verified(more, sets, min_percent), "verified")
    if found.count():
        roots = components(links.unionByName(found))

    named = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    firsts = save(named.groupBy("root").agg(F.min("id").alias("component_id")), "smallest")
    linked = named.join(firsts, "root").select("id", F.col("n").alias("n_shingles"), "component_id", "f1", "f2")
    empty = rows.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), "f1", "f2")
    out = linked.unionByName(empty)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "f1", "f2")


def _prints(k: int):
    """The fingerprint (f1, f2) of a text's set, as one string."""

    @F.pandas_udf("string")
    def prints(texts: pd.Series) -> pd.Series:
        out = []
        for part in W.chunks(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), "text"):
            f1, f2 = fingerprints(*shingle_sets(W.texts(part.column(0)), k))
            out += [f"{x} {y}" for x, y in zip(f1.tolist(), f2.tolist())]
        return pd.Series(out, dtype=object)

    return prints


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps.

    A row is known by its id and its set's fingerprint, so rows that share the
    id of a dropped one, or have none as it, stay unless their set is the same.
    Only rows whose id may be a dropped one's are read for their fingerprint.
    """
    gone, mark, held = fresh(docs, "gone"), fresh(docs, "mark"), fresh(docs, "print")
    marks = _near_rows(docs, id_col, text_col, shingle_words, **options).where(~F.col("kept"))
    marks = save(marks.select(F.col(id_col).alias(gone), F.concat_ws(" ", "f1", "f2").alias(mark)).distinct(), "gone")
    filt = bloom.build(marks.select(F.xxhash64(gone).alias("h")).distinct(), "h", marks.count(), plane="seen")
    may = bloom.may_hold(filt, F.xxhash64(id_col))
    suspects = docs.where(may).withColumn(held, _prints(shingle_words)(F.col(text_col)))
    left = suspects.join(marks, F.col(id_col).eqNullSafe(F.col(gone)) & (F.col(held) == F.col(mark)), "left_anti")
    return docs.where(~may).unionByName(left.select(docs.columns))
