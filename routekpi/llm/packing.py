"""Best-fit packing of documents into sequences by bin completion.

Documents become token ids (tokenizer ids, then an end id) and are cut only if
longer than a sequence, into full pieces after a first one that may be shorter.
Full pieces are sequences already.  The rest is packed in blocks of some
thousand pieces, each by branch and bound over completions of the sequence
around its largest remaining piece; blocks are dealt by a unique row number, so
no document, source or group of copies makes a block large.  What a block leaves
in poorly filled sequences is packed again together with that of other blocks.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from routekpi.llm import words as W
from routekpi.llm.scratch import save, ship

END_ID = 2
MAX_TOKENS = 1024
#: Pieces packed together at first.
BLOCK_PIECES = 2048
#: Blocks whose poorly filled sequences are packed again together.
BLOCKS_AGAIN = 256
#: A sequence less full than this is packed again.
FULL_ENOUGH = 0.98
#: Search steps of a block beyond the first descent; the best packing found so far stays.
SEARCH_STEPS = 4000
#: Waste at which a single piece is taken to fill a room in the first descents.
SLACKS = (4, 8, 16)
#: Pieces of the fillings that are tested for dominance.
TESTED = 6


#: What an exhausted search of fillings gives.
END = object()


class Encoder:
    """Ids of texts as little-endian 32-bit integers, by a ``tokenizers`` file of byte-level BPE.

    The vocabulary, special tokens and byte alphabet come from the file; the
    merging itself is done by tiktoken, whose ids for one vocabulary are the same
    (in byte-level BPE an id is also its merge's rank) in a third of the time.
    The tests compare both on whole texts.
    """

    #: How the file's ByteLevel pre-tokenizer cuts texts (fixed values of that format).
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        # the byte alphabet: printable bytes stand for themselves, the others for characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in tokenizer.get_vocab(with_added_tokens=False).items() if token not in special}
        self.coder = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens=special)
        self.special = set(special)

    def encode(self, text: str) -> bytes:
        ids = array("I", self.coder.encode(text, allowed_special=self.special, disallowed_special=()) if any(s in text for s in self.special) else self.coder.encode_ordinary(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenize(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, max_tokens: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row per piece: row (unique), id, piece, start, length, ids_crc32 (and ids)."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in W.chunks(batch, "text"):
                at, number, start, length, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    data = (encode(text) if text else b"") + end
                    n = len(data) // 4
                    cuts = [0, *range(n % max_tokens or max_tokens, n + 1, max_tokens)] if n > max_tokens else [0, n]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        piece = data[4 * a : 4 * b]
                        at.append(i), number.append(k), start.append(a), length.append(b - a), crc.append(zlib.crc32(piece))
                        if with_ids:
                            ids.append(piece)
                columns = [pa.array(range(row, row + len(at)), pa.int64()), part.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["row", "id", "piece", "start", "length", "ids_crc32"]
                row += len(at)
                yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    return narrow.mapInArrow(cut, schema)


# ---- packing of one block: lengths 1..capacity, as a histogram ----


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Best-fit decreasing: each length into the fullest sequence that it fits."""
    rooms: list[int] = []  # sorted free rooms that occur
    by_room: dict[int, list[list[int]]] = {}
    out: list[list[int]] = []
    for length in range(capacity, 0, -1):
        for _ in range(int(counts[length])):
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                held = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(i)
            else:
                room, held = capacity, []
                out.append(held)
            held.append(length)
            room -= length
            if room:
                if room not in by_room:
                    insort(rooms, room)
                    by_room[room] = []
                by_room[room].append(held)
    return [tuple(x) for x in out]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Martello and Toth's bound: large pieces that can't share, and what is left over."""
    sizes = np.arange(capacity + 1)
    mass = counts * sizes
    best = -(-int(mass.sum()) // capacity)
    ends, total = np.cumsum(counts), np.cumsum(mass)
    for small in np.flatnonzero(counts[: capacity // 2 + 1]):
        huge = ends[-1] - ends[capacity - small]
        large = ends[capacity - small] - ends[capacity // 2]
        room = large * capacity - (total[capacity - small] - total[capacity // 2])
        rest = total[capacity // 2] - (total[small - 1] if small else 0)
        best = max(best, int(huge + large + max(0, -(-(rest - room) // capacity))))
    return best


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the pieces of ``b`` can be grouped so that each group fits a piece of ``a`` of its own."""

    def place(i: int, rooms: tuple[int, ...]) -> bool:
        return i == len(b) or any(
            room >= b[i] and place(i + 1, rooms[:k] + (room - b[i],) + rooms[k + 1 :]) for k, room in enumerate(rooms))

    return place(0, a)


def fillings(counts: np.ndarray, room: int) -> Iterator[tuple[int, ...]]:
    """Every filling of ``room`` by pieces at hand, least waste first, made one at a time; () if nothing fits.

    Which sums the shorter pieces reach is worked out first, as bits of a number
    per length, so no step leads nowhere.  Of equal waste, larger pieces come first.
    """
    have = np.flatnonzero(counts[: room + 1]).tolist()
    number = counts[have].tolist()
    reach, mask = [1], (1 << (room + 1)) - 1
    for length, n in zip(have, number):
        bits, n, copies = reach[-1], min(n, room // length), 1
        while n > 0:
            copies = min(copies, n)
            bits |= (bits << (length * copies)) & mask
            n -= copies
            copies *= 2
        reach.append(bits)

    def exactly(k: int, total: int) -> Iterator[tuple[int, ...]]:
        if not total:
            yield ()
            return
        for i in range(min(k, bisect_right(have, total)) - 1, -1, -1):
            if not reach[i + 1] >> total & 1:
                return
            length = have[i]
            for n in range(min(number[i], total // length), 0, -1):
                if reach[i] >> (total - n * length) & 1:
                    for rest in exactly(i, total - n * length):
                        yield (length,) * n + rest

    def every() -> Iterator[tuple[int, ...]]:
        sums = reach[-1]
        while sums:
            total = sums.bit_length() - 1
            yield from exactly(len(have), total)
            sums ^= 1 << total

    return every()


def completions(counts: np.ndarray, room: int) -> Iterator[tuple[int, ...] | None]:
    """The undominated fillings of ``room``, least waste first; None stands for a dominated one.

    Only fillings of TESTED pieces at most are tested, as the test takes time
    exponential in them; others are kept, which costs the search steps.
    """
    made = fillings(counts, room)
    seen: list[tuple[int, ...]] = []

    def undominated() -> Iterator[tuple[int, ...] | None]:
        for filling in made:
            short = len(filling) <= TESTED
            if short and any(dominates(x, filling) for x in seen):
                yield None
                continue
            if short:
                seen.append(filling)
            yield filling
            if filling == (room,):
                return  # it dominates every other

    return undominated()


def descend(counts: np.ndarray, capacity: int, slack: int) -> list[tuple[int, ...]]:
    """One descent: the largest piece left with the filling of least waste, or with one piece that wastes ``slack`` at most.

    Accepting a little waste early keeps the small pieces for the middling ones,
    which fit each other badly at the end.
    """
    counts, out, top, left = counts.copy(), [], capacity, int(counts.sum())
    while left:
        while not counts[top]:
            top -= 1
        counts[top] -= 1
        room = capacity - top
        have = np.flatnonzero(counts[: room + 1])
        filling = (int(have[-1]),) if len(have) and room - have[-1] <= slack else next(fillings(counts, room))
        for piece in filling:
            counts[piece] -= 1
        out.append((top, *filling))
        left -= len(out[-1])
    return out


def bin_completion(counts: np.ndarray, capacity: int, steps: int = SEARCH_STEPS) -> list[tuple[int, ...]]:
    """Sequences, as tuples of lengths, that hold all pieces of the histogram.

    Depth-first: the largest piece left is completed in each undominated way,
    least waste first; a branch ends when its waste so far leaves no packing better
    than the best known.  Best fit and descents that accept a little waste give the
    first of those.  The search stops at the lower bound, or after ``steps`` fillings
    beyond the length of one descent: that is its only cut.
    """
    counts = counts.astype(np.int64).copy()
    best = best_fit(counts, capacity)
    least = lower_bound(counts, capacity)
    for slack in SLACKS:
        if len(best) > least:
            best = min(best, descend(counts, capacity, slack), key=len)
    total = int((counts * np.arange(capacity + 1)).sum())
    path: list[tuple[int, ...]] = []
    todo: list[tuple[int, Iterator]] = []
    waste, budget = 0, len(best) + steps

    def options() -> tuple[int, Iterator]:
        have = np.flatnonzero(counts)
        if not len(have):
            return 0, iter(())
        top = int(have[-1])
        counts[top] -= 1
        found = completions(counts, capacity - top)
        counts[top] += 1
        return top, found

    todo.append(options())
    while todo and len(best) > least and budget > 0:
        budget -= 1
        top, more = todo[-1]
        filling = next(more, END)
        if filling is None:
            continue  # dominated
        step = () if filling is END else (top, *filling)
        # fillings come by waste: past what a better packing may still waste, none of the rest is of use
        if filling is END or capacity - sum(step) > (len(best) - 1) * capacity - total - waste:
            todo.pop()
            if path:
                gone = path.pop()
                np.add.at(counts, list(gone), 1)
                waste -= capacity - sum(gone)
            continue
        path.append(step)
        np.subtract.at(counts, list(step), 1)
        waste += capacity - sum(step)
        if not counts.any() and len(path) < len(best):
            best = list(path)
        todo.append(options())
    if len(best) > least and path and counts.any():
        closed = path + best_fit(counts, capacity)
        best = min(best, closed, key=len)
    return best


def pack_block(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence number, offset and fill of its sequence, for each piece."""
    bins = bin_completion(np.bincount(lengths, minlength=capacity + 1), capacity)
    order = np.argsort(lengths, kind="stable")
    used = np.searchsorted(lengths[order], np.arange(capacity + 1))
    sequence, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
    for k, held in enumerate(bins):
        at, total = 0, sum(held)
        for length in held:
            i = order[used[length]]
            used[length] += 1
            sequence[i], offset[i], fill[i] = k, at, total
            at += length
    return sequence, offset, fill


def pack_pieces(pieces: DataFrame, max_tokens: int, group: str) -> DataFrame:
    """Adds sequence_id, offset and fill to pieces of one ``group`` each."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long, fill long"

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        k, offset, fill = pack_block(rows["length"].to_numpy(), max_tokens)
        return rows.assign(sequence_id=rows["row"].to_numpy()[np.unique(k, return_index=True)[1]][k], offset=offset, fill=fill)

    return pieces.groupBy(group).applyInPandas(block, schema)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
         block_pieces: int = BLOCK_PIECES, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null and empty texts are one piece of the end id alone.  Repeated rows are
    packed as rows of their own (``row`` in the result tells them apart).  A
    sequence's id is the ``row`` of one of its pieces; offsets run from 0
    without gaps.  ``ids`` are little-endian unsigned 32-bit integers.
    """
    ship(docs.sparkSession)
    pieces = save(tokenize(docs, tokenizer, id_col, text_col, max_tokens, end_id, with_ids), "pieces")
    full = pieces.where(F.col("length") == max_tokens).withColumn("sequence_id", F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    part = pieces.where(F.col("length") < max_tokens)
    blocks = max(1, -(-part.count() // block_pieces))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    once = save(pack_pieces(part.withColumn("block", block), max_tokens, "block"), "packed")
    good = F.col("fill") >= FULL_ENOUGH * max_tokens
    again = once.where(~good).drop("sequence_id", "offset", "fill").withColumn("block", F.floor(F.col("block") / BLOCKS_AGAIN).cast("int"))
    again = pack_pieces(again, max_tokens, "block")
    columns = [F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "row", *["ids"] * with_ids]
    return full.select(columns).unionByName(once.where(good).select(columns)).unionByName(again.select(columns))
