"""Line dedup by an exact set-similarity join.

A line is the set of its words.  Lines of equal sets are one class, represented
by its first line in the order (id, line number).  Two classes of Jaccard
similarity ``min_percent`` or more share a word among the first
``n - ceil(t * n) + 1`` words of each when all sets are ordered alike; words are
ordered by rarity, so few classes meet.  The order uses counts from a sketch of
bounded size over all lines (a pure function of the word, so the filter stays
exact), and words that the sketch proves unique can't be shared and are left out.
Entries meet in one shuffle, sorted by word and length, within a sliding window
of the length filter; frequent words are split by length.

A meeting pair passes the length filter, the positional filter (words left after
the shared one) and a bound from 192-bit parity maps of the sets before its full sets
are compared.  As a line needs one earlier match, not all, an entry with many partners
proposes its earliest and most alike one; only classes that stay open meet all of theirs.
So a large group of alike lines costs a few comparisons per line, not one per pair.  A line goes if its class has an earlier line, or if a similar class
starts earlier; both are judged on the input.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from routekpi.llm import bloom
from routekpi.llm import words as W
from routekpi.llm.scratch import save, ship

MIN_PERCENT = 80
#: Counters of the sketch of word counts (16 bits each), and of one segment of it.
COUNTERS = 1 << 22
SEGMENT = 1 << 16
#: 64-bit integers of a parity map.
MAPS = 3
#: Stands for a null id in the order of places.
LAST_ID = (1 << 63) - 1
#: Words of more lines than this meet by length class.
COMMON = 4096
#: Entries of a key that each entry is met with at least; beyond, those with ENOUGH earlier partners rest.
#: An entry with fewer proposes them all.
CLOSE, ENOUGH = 64, 9
#: Bits of a word's hash that are kept.
WORD_BITS = 44
#: Bits of a line's length beside a key of WORD_BITS; longer lines count as the longest there.
LENGTH_BITS = 64 - WORD_BITS
#: An entry of a block: what ``_meet`` reads of it.
ENTRY = np.dtype([("at", "<u8"), ("f", "<i8"), ("meta", "<i8"), ("id", "<i8"), ("number", "<i4"), ("maps", "<i8", (MAPS,))])
#: Entries that a task packs into blocks at once, that a bucket of keys has about, and that are met at once.
PACKED, BUCKET, MET = 1 << 18, 1 << 17, 1 << 15
#: Added to a key that has blocks of its own, as its count in the sketch is without bound.
OWN = 1 << 62
#: Pairs that are compared at once, and that are held until the best of an entry's many are chosen.
BLOCK, PAIRS = 1 << 16, 1 << 20


#: Of eight bytes read at once, the bits of a word that has so many bytes.
_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], "<u8")


def word_keys(b: W.Bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each white-space separated word, and its start.

    Words are read by eight bytes, so that the work goes by words and not by bytes.
    """
    inside = np.zeros(len(b.data) + 2, bool)
    np.logical_not(W.is_space(b.data), out=inside[1:-1])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    borders = np.unique(b.offsets)
    borders = borders[inside[borders] & inside[borders + 1]]  # a word ends where its text does
    if len(borders):
        starts, ends = (np.insert(x, np.searchsorted(x, borders), borders) for x in (starts, ends))
    eights = np.ndarray(len(b.data) + 1, "<u8", np.concatenate([b.data, np.zeros(8, np.uint8)]), strides=(1,))
    left = ends - starts
    key = W.mix64((eights[starts] & _BYTES.take(left, mode="clip")) + left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    more = np.flatnonzero(left > 8)
    at, left = starts[more] + 8, left[more] - 8
    while len(more):
        key[more] = W.mix64(key[more] * np.uint64(0xC2B2AE3D27D4EB4F) + (eights[at] & _BYTES.take(left, mode="clip")))
        some = left > 8
        more, at, left = more[some], at[some] + 8, left[some] - 8
    return key, starts


def line_starts(b: W.Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, bytes (its end included), document and number of each line that has any."""
    ends = np.flatnonzero(b.data == 10) + 1
    starts = np.sort(np.concatenate([b.offsets[:-1], ends]))  # a line end that closes a text starts an empty line
    size = np.diff(np.append(starts, len(b.data)))
    starts, size = starts[size > 0], size[size > 0]
    doc = np.searchsorted(b.offsets, starts, side="right") - 1
    number = np.searchsorted(ends, starts, side="right") - np.searchsorted(ends, b.offsets, side="right")[doc]
    return starts, size, doc, number


def line_sets(b: W.Bytes, counters: np.ndarray | None = None, whole: bool = False) -> dict[str, np.ndarray]:
    """Lines with words: ``doc`` and ``number`` of each, and its distinct words ``set[at[i]:at[i+1]]``, sorted.

    A word is 44 bits of its hash, so that line and word sort as one integer.
    With ``counters``, true for some counters of the sketch, only lines with a word of those.
    With ``whole``, each text is one line, of number 0.
    """
    words, spots = word_keys(b)
    if whole:
        starts, doc, number = b.offsets[:-1], np.arange(len(b)), np.zeros(len(b), np.int64)
    else:
        starts, _, doc, number = line_starts(b)
    count = np.diff(np.append(np.searchsorted(spots, starts), len(spots)))
    doc, number, count = (x[count > 0] for x in (doc, number, count))
    line = np.repeat(np.arange(len(count)), count)
    words = words >> np.uint64(64 - WORD_BITS)
    if counters is not None:
        some = np.zeros(len(count), bool)
        some[line[counters[(words & np.uint64(COUNTERS - 1)).view(np.int64)]]] = True
        words, doc, number, count = words[some[line]], doc[some], number[some], count[some]
        line = np.repeat(np.arange(len(count)), count)
    if len(count) >> (64 - WORD_BITS):  # more lines than fit beside a word: one very long text
        words = words[np.lexsort((words, line))]
    else:
        words = np.sort((line.astype(np.uint64) << np.uint64(WORD_BITS)) | words) & np.uint64((1 << WORD_BITS) - 1)
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
    at = np.searchsorted(line[new], np.arange(len(count) + 1))
    return {"doc": doc, "number": number, "set": words[new], "at": at}


def some_lines(b: W.Bytes, ids: np.ndarray, places: Broadcast) -> tuple[W.Bytes, np.ndarray, np.ndarray]:
    """The lines whose places the filter may hold, each as one text, with their ids and numbers.

    The words of the other lines are never hashed.
    """
    starts, size, doc, number = line_starts(b)
    keep = bloom.holds(places.value, _place_keys(ids[doc], number))
    inside = np.repeat(keep, size)
    return W.Bytes(b.data[inside], np.concatenate([[0], np.cumsum(size[keep])])), ids[doc[keep]], number[keep]


def class_keys(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit sum over each set, its class."""
    total = np.zeros(len(sets) + 1, np.uint64)
    np.cumsum(W.mix64(sets ^ np.uint64(0x8CB92BA72F3D8DD7)), out=total[1:])
    return (total[at[1:]] - total[at[:-1]]).view(np.int64)


def _line_count(b: W.Bytes) -> np.ndarray:
    """Lines of each text: one more than its line ends, none for an empty text."""
    return np.diff(np.searchsorted(np.flatnonzero(b.data == 10), b.offsets)) + (np.diff(b.offsets) > 0)


def _profile(narrow: DataFrame) -> DataFrame:
    """Per text: id, key (hash of id and text), n_lines, sha, and class keys and numbers of its lines with words.

    Each task adds its part of the sketch of word counts as rows with a segment.
    """
    kind = narrow.schema["id"].dataType.simpleString()
    schema = f"id {kind}, key long, n_lines long, sha string, f array<long>, number array<int>, segment int, counts binary"

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(COUNTERS, np.uint32)
        names = ["id", "key", "n_lines", "sha", "f", "number", "segment", "counts"]
        ids = None
        for batch in batches:
            for part in W.chunks(batch, "text"):
                b = W.texts(part.column(1))
                lines = line_sets(b)
                np.add.at(sketch, (lines["set"] & np.uint64(COUNTERS - 1)).astype(np.int64), np.uint32(1))
                f = class_keys(lines["set"], lines["at"])
                at = pa.array(np.searchsorted(lines["doc"], np.arange(len(b) + 1)), pa.int32())
                raw = b.data.tobytes()
                sha = [hashlib.sha256(raw[i:j]) for i, j in zip(b.offsets, b.offsets[1:])]
                lists = [pa.ListArray.from_arrays(at, pa.array(v)) for v in (f, lines["number"].astype(np.int32))]
                ids = part.column(0)
                key = [int.from_bytes(s.digest()[:8], "little", signed=True) for s in sha]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(key, pa.int64()), pa.array(_line_count(b)), pa.array([s.hexdigest() for s in sha]), *lists,
                     pa.nulls(len(b), pa.int32()), pa.nulls(len(b), pa.binary())], names)
        for k in range(0, COUNTERS, SEGMENT) if ids is not None else ():
            if (some := np.minimum(sketch[k : k + SEGMENT], 65535).astype(np.uint16)).any():
                none = [pa.nulls(1, t) for t in (ids.type, pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*none, pa.array([k // SEGMENT], pa.int32()), pa.array([zlib.compress(some.tobytes(), 1)], pa.binary())], names)

    return narrow.mapInArrow(profile, schema)


def _sketch(profile: DataFrame) -> Broadcast:
    """The merged counts: 2 * COUNTERS bytes, whatever the input."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(SEGMENT, np.int64)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"segment": pa.array([at], pa.int32()), "counts": pa.array([zlib.compress(np.minimum(total, 65535).astype(np.uint16).tobytes(), 1)], pa.binary())})

        for batch in batches:  # sorted by segment; one sum is held at a time
            for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                if segment != at:
                    if at is not None:
                        yield done()
                    at, total = segment, np.zeros(SEGMENT, np.int64)
                total += np.frombuffer(zlib.decompress(counts.as_buffer()), np.uint16)
        if at is not None:
            yield done()

    parts = profile.where("segment IS NOT NULL").select("segment", "counts").repartition("segment").sortWithinPartitions("segment")
    out = np.zeros(COUNTERS, np.uint16)
    for row in parts.mapInArrow(merge, "segment int, counts binary").collect():
        out[row.segment * SEGMENT : (row.segment + 1) * SEGMENT] = np.frombuffer(zlib.decompress(row.counts), np.uint16)
    return profile.sparkSession.sparkContext.broadcast(out)


def word_ranks(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A word is ranked and known by its count (16 bits) and 28 bits of its hash."""
    count = counts[(sets & np.uint64(COUNTERS - 1)).view(np.int64)].astype(np.uint64)
    return (count << np.uint64(28)) | (sets >> np.uint64(WORD_BITS - 28))


def prefix_words(sets: np.ndarray, at: np.ndarray, counts: np.ndarray, min_percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the prefix words of all lines, rarest first, and where each line's begin.

    Words that the sketch proves unique are 0, which keeps the others' positions.
    """
    n = np.diff(at)
    line = np.repeat(np.arange(len(n)), n)
    rank = word_ranks(sets, counts)
    if len(n) >> (64 - WORD_BITS):
        rank = rank[np.lexsort((rank, line))]
    else:
        rank = np.sort((line.astype(np.uint64) << np.uint64(WORD_BITS)) | rank) & np.uint64((1 << WORD_BITS) - 1)
    length = n - -(-n * min_percent // 100) + 1
    rank[rank >> np.uint64(28) <= 1] = 0
    keep = np.arange(len(sets)) - np.repeat(at[:-1], n) < np.repeat(length, n)
    return rank[keep], np.concatenate([[0], np.cumsum(length)])


def prefix_keys(words: np.ndarray, at: np.ndarray, n: np.ndarray, min_percent: int) -> tuple[np.ndarray, ...]:
    """(line, key, pos, low, own) of each entry of lines of ``n`` words with these prefix words.

    Words of more than COMMON lines are split by length class: an entry goes to
    its own class and, as ``low``, to the next one.  ``own`` says that the sketch gives no bound for the key.
    """
    line = np.repeat(np.arange(len(n)), np.diff(at))
    keep = np.flatnonzero(words)
    line, key, pos = line[keep], words[keep], keep - at[line[keep]]
    low, own = np.zeros(len(keep), bool), key >> np.uint64(28) == 65535
    common = np.flatnonzero(key >> np.uint64(28) > COMMON)
    if len(common):
        size = _length_class(n[line[common]], min_percent).astype(np.uint64)
        split = [W.mix64((key[common] << np.uint64(LENGTH_BITS)) | (size + np.uint64(up))) >> np.uint64(LENGTH_BITS) for up in (0, 1)]
        key[common] = split[0]
        key, line, pos = np.concatenate([key, split[1]]), np.concatenate([line, line[common]]), np.concatenate([pos, pos[common]])
        low, own = np.concatenate([low, np.ones(len(common), bool)]), np.concatenate([own, own[common]])
    return line, key, pos, low, own


def parity_maps(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MAPS 64-bit integers per set; a bit is the parity of the words that fall on it.

    Common words cancel between two sets, so their maps differ in at most as many
    bits as the sets differ in words.
    """
    lines, bits = len(at) - 1, 64 * MAPS
    spot = np.repeat(np.arange(lines), np.diff(at)) * bits + (W.mix64(sets + np.uint64(17)) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(spot, minlength=lines * bits) & 1).astype(bool)
    return np.packbits(odd).view(np.uint64).reshape(lines, MAPS)


def _place_keys(ids: np.ndarray, number: np.ndarray) -> np.ndarray:
    """64-bit hashes of places."""
    return W.mix64(W.mix64(ids.view(np.uint64)) + number.astype(np.int64).view(np.uint64)).view(np.int64)


def first_places(classes: DataFrame) -> Broadcast:
    """A filter of the first places of classes: it lets each first place pass and few others."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place_keys(np.asarray(batch.column(0).fill_null(LAST_ID)), np.asarray(batch.column(1))))], ["place"])

    places = classes.select("first.id", "first.number").mapInArrow(keys, "place long")
    return bloom.build(places, "place", classes.count(), plane="seen", repeats=False)


def _length_class(n: np.ndarray, min_percent: int) -> np.ndarray:
    """Similar sets have lengths of one class or of two neighbouring ones."""
    return np.floor(np.log(n) / np.log(100 / min_percent) + 1e-9).astype(np.int64)


def _entries(narrow: DataFrame, counts: Broadcast, firsts: Broadcast, min_percent: int, buckets: int, wanted: Broadcast | None = None) -> DataFrame:
    """An entry (at, f, meta, id, number, maps) per prefix word of each class, from its first place.

    Lines that the filter of first places rules out are left out; copies that it
    lets pass only cost work.  ``at`` packs the key and the length, so that one integer
    sorts the entries; ``meta`` packs the whole length, the
    word's position and ``low``, in that order.  ``wanted`` tells the entries to make, as ``_wanted`` returns it.

    Entries come as blocks (part, n, entries): of one of ``buckets`` of keys, a power of
    two, or of one key and length where the sketch gives no bound for the key.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        counters = None if wanted is None else np.unpackbits(wanted.value[1], bitorder="little").astype(bool)
        for batch in batches:
            for part in W.chunks(batch, "text"):
                kept, ids, number = some_lines(W.texts(part.column(1)), np.asarray(part.column(0).fill_null(LAST_ID)), firsts)
                lines = line_sets(kept, counters, whole=True)
                sets, ends = lines["set"], lines["at"]
                f, n, ids, number = class_keys(sets, ends), np.diff(ends), ids[lines["doc"]], number[lines["doc"]]
                words, at = prefix_words(sets, ends, counts.value, min_percent)
                line, key, pos, low, own = prefix_keys(words, at, n, min_percent)
                if wanted is not None:
                    some = np.flatnonzero(bloom.holds(wanted.value[0], key))
                    key, line, pos, low, own = key[some], line[some], pos[some], low[some], own[some]
                some = np.zeros(len(n), bool)
                some[line] = True
                maps = parity_maps(sets[np.repeat(some, n)], np.concatenate([[0], np.cumsum(n[some])]))[(np.cumsum(some) - 1)[line]].view(np.int64)
                meta = (n[line] << 32) | (pos << 1) | low
                key = (key << np.uint64(LENGTH_BITS)) | np.minimum(n[line], (1 << LENGTH_BITS) - 1).astype(np.uint64)
                rows = np.empty(len(key), ENTRY)
                for name, column in zip(ENTRY.names, (key, f[line], meta, ids[line], number[line], maps)):
                    rows[name] = column
                yield rows, own

    def emit_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for some in emit(batches):
            held.append(some)
            size += len(some[0])
            if size >= PACKED:
                yield _blocks(*(np.concatenate(v) for v in zip(*held)), buckets)
                held, size = [], 0
        if size:
            yield _blocks(*(np.concatenate(v) for v in zip(*held)), buckets)

    blocks = narrow.select("id", "text").mapInArrow(emit_blocks, "part long, n int, entries binary")
    return blocks.repartition("part").sortWithinPartitions("part", "n")


def _wanted(sets: DataFrame, counts: Broadcast, min_percent: int) -> Broadcast:
    """The entries that meet those of ``sets``: a filter of keys, and a bit for each counter of the sketch that has a prefix word."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.asarray(pc.binary_length(batch["set"])).astype(np.int64) // 8
            if not len(n):
                continue
            at = np.concatenate([[0], np.cumsum(n)])
            words = np.frombuffer(b"".join(batch["set"].to_pylist()), np.uint64)
            ranks, begin = prefix_words(words, at, counts.value, min_percent)
            key = pa.array(prefix_keys(ranks, begin, n, min_percent)[1].view(np.int64))
            rank = word_ranks(words, counts.value)  # the prefix words are those up to the last one's rank
            some = words[(rank >> np.uint64(28) > 1) & (rank <= np.repeat(ranks[begin[1:] - 1], n))]
            counter = pa.array((some & np.uint64(COUNTERS - 1)).view(np.int64))
            yield pa.RecordBatch.from_arrays([key, pa.nulls(len(key), pa.int64())], ["key", "counter"])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(counter), pa.int64()), counter], ["key", "counter"])

    found = save(sets.select("set").mapInArrow(keys, "key long, counter long").distinct(), "keys")
    known = found.where("key IS NOT NULL")
    filt = bloom.build(known, "key", known.count(), plane="seen", repeats=False)
    bits = np.zeros(COUNTERS >> 6, np.int64)
    for row in found.where("counter IS NOT NULL").groupBy((F.col("counter") / 64).cast("int").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(counter % 64 AS int)))").alias("bits")).collect():  # at most COUNTERS / 64 rows
        bits[row["at"]] = row.bits
    return sets.sparkSession.sparkContext.broadcast((filt.value, bits.view(np.uint8)))


def bucket_count(classes: int, partitions: int) -> int:
    """A power of two of buckets of about BUCKET entries, if a class has ten, and enough for all partitions."""
    return 1 << (max(16 * partitions, classes * 10 // BUCKET) - 1).bit_length()


def _blocks(rows: np.ndarray, own: np.ndarray, buckets: int) -> pa.RecordBatch:
    """(part, n, entries) of entries: a block for each bucket, and for each key and length of the keys with blocks of their ``own``."""
    key = rows["at"] >> np.uint64(LENGTH_BITS)
    part = np.where(own, key + np.uint64(OWN), W.mix64(key) & np.uint64(buckets - 1))
    n = np.where(own, rows["at"] & np.uint64((1 << LENGTH_BITS) - 1), np.uint64(0))
    if own.any():
        order = np.lexsort((n, part))
    else:  # numbers of 16 bits sort by radix
        order = np.argsort(part.astype(np.uint16) if buckets <= 1 << 16 else part, kind="stable")
    part, n = part[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (n[1:] != n[:-1])]))
    ends = (np.append(new, len(rows)) * ENTRY.itemsize).astype(np.int32)
    body = pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer(ends), pa.py_buffer(rows.take(order).view(np.uint8))])
    return pa.RecordBatch.from_arrays([pa.array(part[new].view(np.int64)), pa.array(n[new].astype(np.int32)), body], ["part", "n", "entries"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by (part, n) to entries sorted by (key, length).

    One bucket, whose keys the sketch bounds, is held at a time; a key with
    blocks of its own passes as it comes.
    """

    def sorted_rows(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = rows.take(np.argsort(rows["at"]))
        for i in range(0, len(rows), MET):
            some = rows[i : i + MET]
            yield pa.RecordBatch.from_pydict(
                {c: pa.array(some[c].view(f"<i{some[c].itemsize}").copy()) for c in ENTRY.names[:-1]} | {f"m{k}": pa.array(some["maps"][:, k].copy()) for k in range(MAPS)})

    held, bucket = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = np.asarray(batch["part"])
        entries = batch["entries"]
        ends = np.frombuffer(entries.buffers()[1], np.int32)[entries.offset : entries.offset + len(part) + 1]
        rows = np.frombuffer(entries.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(ENTRY)
        at = np.concatenate([[0], np.cumsum(np.diff(ends) // ENTRY.itemsize)])
        borders = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        for i, j in zip(borders, np.append(borders[1:], len(part))):
            if part[i] != bucket:
                if held:
                    yield from sorted_rows(np.concatenate(held))
                held, bucket = [], part[i]
            some = rows[at[i] : at[j]]
            if part[i] >= OWN:
                yield from sorted_rows(some)
            else:
                held.append(some)
    if held:
        yield from sorted_rows(np.concatenate(held))


class _Best:
    """For each row the partner of the least rank seen so far."""

    def __init__(self, rows: int):
        self.rank = np.full((rows, 2), np.iinfo(np.int64).max)
        self.partner = np.full(rows, -1)

    def offer(self, row: np.ndarray, rank: np.ndarray, partner: np.ndarray) -> None:
        order = np.lexsort((rank[:, 1], rank[:, 0], row))
        order = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])] if len(order) else order
        row, rank, partner = row[order], rank[order], partner[order]
        old = self.rank[row]
        less = (rank[:, 0] < old[:, 0]) | ((rank[:, 0] == old[:, 0]) & (rank[:, 1] < old[:, 1]))
        self.rank[row[less]], self.partner[row[less]] = rank[less], partner[less]


def _meet(min_percent: int, wanted: Broadcast | None = None):
    """Entries sorted by (key, length) to (a, b, more): class b starts earlier and passes the filters against a.

    A row of a key gives all its partners if they are fewer than ENOUGH, else its
    earliest and its most alike one; ``more`` says that it has, or may have, others.
    With ``wanted``, a filter of classes, those get them all.
    An entry that has ENOUGH earlier partners meets no others beyond the CLOSE
    nearest of its key but those that still lack them; ``more`` is true for it.
    A copy of a class from a later place only costs work: the order of a pair is
    that of first places, which is looked up when its sets are compared.
    Only entries of one key within the length filter are held at a time.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = {c: np.asarray(batch[c]) for c in ("f", "id", "number")}
            at = np.asarray(batch["at"]).view(np.uint64)
            now |= {"key": at >> np.uint64(LENGTH_BITS), "m": (at & np.uint64((1 << LENGTH_BITS) - 1)).astype(np.int64)}
            meta = np.asarray(batch["meta"])
            now |= {"n": meta >> 32, "pos": (meta & 0xFFFFFFFF) >> 1, "low": meta & 1}
            now["done"] = np.zeros(len(meta), bool)  # ENOUGH partners in an earlier batch, which said so
            now["maps"] = np.stack([np.asarray(batch[f"m{k}"]).view(np.uint64) for k in range(MAPS)], axis=1)
            first = 0
            if held is not None:
                first = len(held["f"])
                now = {c: np.concatenate([held[c], v]) for c, v in now.items()}
            key, f, pos, low, ids, number = (now[c] for c in ("key", "f", "pos", "low", "id", "number"))
            n, m = now["n"], now["m"]
            asked = None if wanted is None else bloom.holds(wanted.value, f)
            early, alike, partners, found = _Best(len(f)), _Best(len(f)), np.zeros(len(f), np.int64), []
            done = now["done"]
            group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) << LENGTH_BITS
            # entries of j's key within the length filter begin at reach[j]
            reach = np.searchsorted(group | m, group | -(-m * min_percent // 100))
            # the longest set that can share enough words with one that has none before this entry's
            fits = (100 + min_percent) * (n - pos) // min_percent - n

            def settle() -> None:
                """Of rows with many partners only the best are kept."""
                a, b, differing = (np.concatenate(v) for v in zip(*found))
                big = partners[a] >= ENOUGH
                x, y, bits = a[big], b[big], differing[big]
                early.offer(x, np.stack([ids[y], number[y].astype(np.int64)], axis=1), y)
                alike.offer(x, np.stack([bits, ids[y]], axis=1), y)
                found[:] = [(a[~big], b[~big], differing[~big])]

            def compare(i: np.ndarray, j: np.ndarray) -> None:
                ok = np.flatnonzero((n[i] <= fits[j]) & (n[j] <= fits[i]))
                x, y = i[ok], j[ok]
                differing = np.bitwise_count(now["maps"][x] ^ now["maps"][y]).sum(axis=1, dtype=np.int64)
                need = -(-(n[x] + n[y]) * min_percent // (100 + min_percent))  # words that must be shared
                ok = np.flatnonzero((n[x] + n[y] - differing >= 2 * need) & (f[x] != f[y]) & ((low[x] & low[y]) == 0))
                x, y, differing = x[ok], y[ok], differing[ok]
                before = (ids[x] < ids[y]) | ((ids[x] == ids[y]) & (number[x] < number[y]))
                after = (ids[x] > ids[y]) | ((ids[x] == ids[y]) & (number[x] > number[y]))
                for later, earlier, some in ((y, x, before), (x, y, after)):
                    a, b, bits = later[some], earlier[some], differing[some]
                    if asked is not None:
                        a, b, bits = a[asked[a]], b[asked[a]], bits[asked[a]]
                    if len(a):
                        found.append((a, b, bits))
                        np.add.at(partners, a, 1)
                if asked is None and sum(len(a) for a, _, _ in found) > max(PAIRS, 2 * ENOUGH * len(f)):
                    settle()

            # each entry and the CLOSE before it, but for those too long for its position
            j = np.arange(first, len(f))
            low_end = np.maximum(reach[first:], j - CLOSE)
            high_end = np.where(n[first:] > m[first:], j, np.minimum(j, np.searchsorted(group | m, group[first:] | np.clip(fits[first:], 0, (1 << LENGTH_BITS) - 1), side="right")))
            count = np.maximum(high_end - low_end, 0)
            total = np.concatenate([[0], np.cumsum(count)])
            at = 0
            while total[at] < total[-1]:
                to = max(at + 1, int(np.searchsorted(total, total[at] + BLOCK, side="right")) - 1)
                back = np.repeat(low_end[at:to] - total[at:to], count[at:to])
                compare(back + np.arange(total[at], total[to]), np.repeat(j[at:to], count[at:to]))
                at = to
            step = CLOSE + 1
            j = j[j - reach[first:] >= step]
            wanting = asked if asked is not None else ~done & (partners < ENOUGH)
            below, above = (j[wanting[j]], np.flatnonzero(wanting)) if len(j) else (j, j)
            while len(below) or len(above):
                above = above[above + step < len(f)]
                below, above = below[below - step >= reach[below]], above[above >= reach[above + step]]
                if not len(below) and not len(above):
                    break
                width = max(1, BLOCK // (len(below) + len(above)))
                steps = np.arange(step, step + min(width, len(f)))
                down, back = np.repeat(below, len(steps)), np.tile(steps, len(below))
                up, on = np.repeat(above, len(steps)), np.tile(steps, len(above))
                some, more = down >= back, up + on < len(f)
                down, back, up, on = down[some], back[some], up[more], on[more]
                more = (up + on >= first) & ~wanting[up + on]  # other pairs are met from the other end
                i, j = np.concatenate([down - back, up[more]]), np.concatenate([down, (up + on)[more]])
                some = i >= reach[j]
                compare(i[some], j[some])
                step += len(steps)
                if asked is None:
                    wanting = ~done & (partners < ENOUGH)
                    below, above = below[wanting[below]], above[wanting[above]]
            if not found:
                a, b, more = f[:0], f[:0], np.zeros(0, bool)
            elif asked is not None:
                a, b, _ = (np.concatenate(v) for v in zip(*found))
                a, b, more = f[a], f[b], np.zeros(len(a), bool)
            else:
                settle()
                many = partners >= ENOUGH
                done |= many
                some = np.flatnonzero(many)
                x, y, _ = found[0]
                x, y = np.concatenate([x, some, some]), np.concatenate([y, early.partner[some], alike.partner[some]])
                a, b, more = f[x], f[y], many[x]
            if len(a):
                order = np.lexsort((~more, b, a))
                a, b, more = a[order], b[order], more[order]
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new]), pa.array(more[new])], ["a", "b", "more"])
            rest = (key == key[-1]) & (100 * m >= min_percent * m[-1])
            held = {c: v[rest] for c, v in now.items()}

    return meet


def _sets_of(narrow: DataFrame, places: Broadcast) -> DataFrame:
    """(f, set) of the lines that may be at ``places``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                lines = line_sets(some_lines(W.texts(part.column(1)), np.asarray(part.column(0).fill_null(LAST_ID)), places)[0], whole=True)
                f = class_keys(lines["set"], lines["at"])
                data = [lines["set"][i:j].tobytes() for i, j in zip(lines["at"], lines["at"][1:])]
                yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(data, pa.binary())], ["f", "set"])

    return narrow.select("id", "text").mapInArrow(emit, "f long, set binary")


def _similar(min_percent: int):
    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                n_a, n_b = (np.asarray(pc.binary_length(part[c])).astype(np.int64) // 8 for c in ("set_a", "set_b"))
                words = np.frombuffer(b"".join([*part["set_a"].to_pylist(), *part["set_b"].to_pylist()]), np.uint64)
                pair = np.repeat(np.tile(np.arange(part.num_rows, dtype=np.uint64), 2), np.concatenate([n_a, n_b]))
                words = np.sort((pair << np.uint64(WORD_BITS)) | words)  # shared words lie side by side
                both = np.bincount((words[1:][words[1:] == words[:-1]] >> np.uint64(WORD_BITS)).astype(np.int64), minlength=part.num_rows)
                yield part.select(["a", "b"]).filter(pa.array(100 * both >= min_percent * (n_a + n_b - both)))

    return similar


def _verified(narrow: DataFrame, classes: DataFrame, pairs: DataFrame, min_percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) whose full sets are similar enough, class b starting before class a, and (f, set, place) of all their classes."""
    wanted = pairs.select(F.col("a").alias("f")).unionByName(pairs.select(F.col("b").alias("f"))).distinct()
    wanted = save(wanted.join(classes.select("f", "first", F.col("first.id").alias("id")), "f"), "wanted")
    size = wanted.count()
    holders = bloom.build(wanted.select(F.xxhash64("id").alias("h")).distinct(), "h", size, plane="seen", repeats=False)
    some = narrow.where(bloom.may_hold(holders, F.xxhash64("id")))  # the documents of the classes' first lines
    place = F.struct("first.last", "first.id", "first.number").alias("place")
    sets = _sets_of(some, first_places(wanted)).join(wanted.select("f", place), "f")
    sets = save(sets.dropDuplicates(["f"]), "sets")
    left, right = (sets.select(F.col("f").alias(x), F.col("set").alias(f"set_{x}"), F.col("place").alias(f"place_{x}")) for x in "ab")
    return save(pairs.select("a", "b").join(left, "a").join(right, "b").where("place_b < place_a").select("a", "b", "set_a", "set_b").mapInArrow(_similar(min_percent), "a long, b long"), "similar"), sets


def later_classes(narrow: DataFrame, classes: DataFrame, counts: Broadcast, min_percent: int) -> DataFrame:
    """(l_f): the classes for which a similar class starts earlier.

    Each class is first checked against its candidates of each prefix word, of many
    the earliest and most alike, which settles nearly all; a class that fails and
    had other candidates is then checked against every one.
    """
    firsts = first_places(classes)
    buckets = bucket_count(classes.count(), int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    meet = _meet(min_percent)
    tried = save(_entries(narrow, counts, firsts, min_percent, buckets).mapInArrow(lambda blocks: meet(_unpacked(blocks)), "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more")), "tried")
    similar, sets = _verified(narrow, classes, tried, min_percent)
    found = save(similar.select(F.col("a").alias("l_f")).distinct(), "later")
    open_ = tried.where("more").select(F.col("a").alias("f")).distinct().join(found, F.col("f") == F.col("l_f"), "left_anti")
    open_ = save(open_, "open")
    size = open_.count()
    if not size:
        return found
    asked = bloom.build(open_, "f", size, plane="seen", repeats=False)
    wanted = _wanted(sets.join(open_, "f", "left_semi"), counts, min_percent)
    again = _entries(narrow, counts, firsts, min_percent, buckets, wanted)
    meet_all = _meet(min_percent, asked)
    pairs = again.mapInArrow(lambda blocks: meet_all(_unpacked(blocks)), "a long, b long, more boolean").select("a", "b").distinct()
    pairs = save(pairs.join(open_.select(F.col("f").alias("a")), "a", "left_semi").join(tried.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    more = _verified(narrow, classes, pairs, min_percent)[0].select(F.col("a").alias("l_f"))
    return found.unionByName(more).distinct()


def _cut(texts: DataFrame, with_text: bool) -> DataFrame:
    """(key, id, n_removed, sha, kept) of the texts without the line numbers in ``gone``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch.column(2)
            ends, keys, lines = (np.asarray(x) for x in (lists.offsets, lists.values.field("key"), lists.values.field("number")))
            for text, i, j in zip(batch.column(1).cast(pa.binary()).to_pylist(), ends, ends[1:]):
                data = text or b""
                key = int.from_bytes(hashlib.sha256(data).digest()[:8], "little", signed=True)
                numbers = set(lines[i:j][keys[i:j] == key].tolist())
                kept = b"\n".join([x for i, x in enumerate(data.split(b"\n")) if i not in numbers])
                out.append((key, len(numbers), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            columns = [pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["c_id", "c_key", "n_removed", "c_sha", "kept"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(cut, f"c_id {kind}, c_key long, n_removed long, c_sha string, kept string")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_percent: int = MIN_PERCENT, with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_lines, n_removed, kept_sha256 (and kept_text).

    Lines end at newlines.  A line with words goes if an earlier line, in the
    order (id, number), has word sets of Jaccard similarity ``min_percent``
    percent or more; lines without words stay.  Null and empty texts have no
    lines.  Rows that repeat id and text share the first's result, lines at one
    place of rows that share an id don't remove each other, and null ids come last.  ``kept_sha256`` is of the lines left, joined by newlines.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    profile = save(_profile(narrow), "profile")
    rows = profile.where("segment IS NULL")
    lines = rows.select("id", "key", F.explode(F.arrays_zip("f", "number")).alias("x")).select("id", "key", F.col("x.f").alias("f"), F.col("x.number").alias("number"))
    place = F.struct(F.col("id").isNull().alias("last"), "id", "number", "key")
    classes = save(lines.groupBy("f").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "line_classes")

    later = save(later_classes(narrow, classes, _sketch(profile), min_percent), "doomed_classes")
    doomed = classes.join(later, F.col("f") == F.col("l_f"), "left").where("n > 1 OR l_f IS NOT NULL")
    doomed = save(doomed.select(F.col("f").alias("d_f"), "first", F.col("l_f").isNotNull().alias("all")), "doomed")
    gone = lines.join(doomed, F.col("f") == F.col("d_f")).where(F.col("all") | (place != F.col("first")))
    # the first line of a class stays in every row that repeats its id and text
    gone = save(gone.select("id", "key", "number").distinct(), "gone")

    filt = bloom.build(gone.select(F.xxhash64("id").alias("h")).distinct(), "h", gone.count(), plane="seen", repeats=False)
    lists = gone.groupBy(F.col("id").alias("g_id")).agg(F.collect_list(F.struct("key", "number")).alias("gone"))
    texts = narrow.where(bloom.may_hold(filt, F.xxhash64("id"))).join(lists, F.col("id").eqNullSafe(F.col("g_id"))).select("id", "text", "gone")
    cut = save(_cut(texts, with_text).where("n_removed > 0"), "cut")
    cut = (cut if with_text else cut.drop("kept")).dropDuplicates(["c_id", "c_key"])
    out = rows.select("id", "key", "n_lines", "sha").join(cut, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("key") == F.col("c_key")), "left")
    columns = [F.col("id").alias(id_col), "n_lines", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("c_sha", "sha").alias("kept_sha256")]
    if with_text:
        whole = narrow.select(F.col("id").alias("t_id"), F.coalesce("text", F.lit("")).alias("t_text")).withColumn("t_sha", F.sha2(F.col("t_text").cast("binary"), 256))
        out = out.join(whole.dropDuplicates(["t_id", "t_sha"]), F.col("id").eqNullSafe(F.col("t_id")) & (F.col("sha") == F.col("t_sha")))
        columns.append(F.coalesce("kept", "t_text").alias("kept_text"))
    return out.select(columns)
