"""Periodic runs of words, by longest common extensions in suffix trees.

A run is a stretch of words with smallest period q (words q apart are identical),
of at least max(least, 3 q) words, that no neighbouring word extends with that
period.  They are found in three steps:

1. Any run's grams of K words (K = 9 for at least 24 words) each occur twice in
   its document or more: the run repeats them q words on.  So only stretches of
   words with such grams are looked at; the others hold no run and no part of one.
   This loses nothing: a run lies whole within one stretch, and extends no further
   in the document than there.
2. Ukkonen's suffix trees are built of the stretches' words and of their reversal.
   An Euler tour of a tree and the least depth over a stretch of it (in constant
   time: a table over blocks, with the parts of blocks) give the depth of the lowest
   common ancestor of two leaves, which is how far two places agree.
3. A run has a Lyndon word of its period, under the order of words or its reverse,
   which is the longest Lyndon word from its first place; so the candidates are
   two per place: the distance to the next smaller suffix in either order (which the
   tree's leaves in order give).  Each is extended by the agreement of its two
   places to the right and, in the reversal, to the left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from routekpi.llm import words as W
from routekpi.llm.scratch import fresh, ship

LEAST = 24
#: A run has this many periods at least.
TIMES = 3
#: Words of stretches that share a tree, about (one longer stretch has its own).
TREE_WORDS = 1 << 13
_NONE = np.zeros((0, 3), np.int64)


# ----------------------------------------------------------------- suffix tree

class SuffixTree:
    """Ukkonen's suffix tree of a list of ints below ``ends``; ``ends`` is added as its last symbol."""

    def __init__(self, text: list[int], ends: int):
        text = [*text, ends]
        self.size = n = len(text)
        width = ends + 1
        # nodes: where their edge begins and ends in the text (a leaf's end: n), suffix link
        start, stop, link = [0], [0], [0]
        child: dict[int, int] = {}  # parent * width + first symbol -> node
        node = edge = length = left = 0
        for i, symbol in enumerate(text):
            left += 1
            last = 0
            while left:
                if not length:
                    edge = i
                at = node * width + text[edge]
                nxt = child.get(at)
                if nxt is None:
                    child[at] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    begin = start[nxt]
                    held = stop[nxt]
                    held = (held if held <= i else i + 1) - begin
                    if length >= held:  # walk down
                        edge += held
                        length -= held
                        node = nxt
                        continue
                    if text[begin + length] == symbol:
                        if last:
                            link[last] = node
                        length += 1
                        break
                    inner = len(start)
                    start += (begin, i)
                    stop += (begin + length, n)
                    link += (0, 0)
                    child[at] = inner
                    child[inner * width + symbol] = inner + 1
                    start[nxt] = begin + length
                    child[inner * width + text[begin + length]] = nxt
                    if last:
                        link[last] = inner
                    last = inner
                left -= 1
                if not node:
                    if length:
                        length -= 1
                        edge = i - left + 1
                else:
                    node = link[node]
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)  # by parent, then first symbol
        self.parents, self.children = keys[order] // width, nodes[order]
        self.lengths = np.array(stop, np.int64) - np.array(start, np.int64)
        self.lengths[0] = 0
        self._tour()

    def _tour(self) -> None:
        """Euler tour: depths in letters along it, the place of each leaf on it, and the leaves in order."""
        count, n = len(self.lengths), self.size
        first = np.searchsorted(self.parents, np.arange(count + 1)).tolist()
        children, lengths = self.children.tolist(), self.lengths.tolist()
        tour, leaves, places = [0], [], [0] * n
        stack = [(0, first[0], first[1])]  # depth, next child, end of the children
        while stack:
            depth, at, end = stack[-1]
            if at == end:
                stack.pop()
                if stack:
                    tour.append(stack[-1][0])
                continue
            stack[-1] = (depth, at + 1, end)
            node = children[at]
            down = depth + lengths[node]
            low, high = first[node], first[node + 1]
            if low == high:
                suffix = n - down
                places[suffix] = len(tour)
                leaves.append(suffix)
                tour += (down, depth)
            else:
                tour.append(down)
                stack.append((down, low, high))
        self.leaves = np.array(leaves, np.int64)
        self.places = np.array(places, np.int64)
        self.least = RangeLeast(np.array(tour, np.int64))

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at i and at j (other than i) have in common."""
        a, b = self.places[i], self.places[j]
        return self.least(np.minimum(a, b), np.maximum(a, b))


class RangeLeast:
    """Least value of any stretch in constant time, in memory of the values' order."""

    BLOCK = 16

    def __init__(self, values: np.ndarray):
        size = self.BLOCK
        blocks = -(-len(values) // size)
        padded = np.full(blocks * size, np.iinfo(np.int64).max)
        padded[: len(values)] = values
        self.grid = padded.reshape(blocks, size)
        self.head = np.minimum.accumulate(self.grid, axis=1).ravel()
        self.tail = np.minimum.accumulate(self.grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.values = padded
        self.levels = [self.grid.min(axis=1)]
        step = 1
        while 2 * step <= blocks:
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-step], below[step:]))
            step *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For a <= b, the least of values a to b, both included."""
        size = self.BLOCK
        x, y = a // size, b // size
        out = np.minimum(self.tail[a], self.head[b])
        inner = y - x - 1
        for level in range(len(self.levels)):
            at = np.flatnonzero((inner >> level == 1) & (inner > 0))  # 2**level <= inner < 2**(level + 1)
            table = self.levels[level]
            out[at] = np.minimum(out[at], np.minimum(table[x[at] + 1], table[y[at] - (1 << level)]))
        same = np.flatnonzero(x == y)
        if len(same):
            low, high = a[same], b[same]
            best = self.values[low]
            for k in range(1, size):
                best = np.where(low + k <= high, np.minimum(best, self.values[np.minimum(low + k, high)]), best)
            out[same] = best
        return out


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of smaller rank (the end, if there is none)."""
    n = len(rank)
    out = [n] * n
    stack: list[int] = []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(text: list[int], least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """All runs (start, length, period) of a list of ints from 0, by start and period."""
    n = len(text)
    if n < least:
        return _NONE
    ends = max(text) + 1
    forward, backward = SuffixTree(text, ends), SuffixTree(text[::-1], ends)
    # suffixes by the order of symbols, the end largest, and by its reverse, the end smallest.  Where the word
    # after a run is smaller, under one of them, than the word a period before, the run's Lyndon word reaches
    # from its place to the next smaller suffix; what is no Lyndon word's place only gives a run again, or none
    rank = np.empty(n + 1, np.int64)
    rank[forward.leaves] = np.arange(n + 1)
    a = np.tile(np.arange(n), 2)
    b = np.concatenate([next_smaller(order.tolist()) for order in (rank[:n], -rank[:n])])
    a, b = a[b < n], b[b < n]
    period = b - a
    right = forward.agree(a, b)
    left = np.zeros(len(a), np.int64)
    inner = np.flatnonzero(a > 0)
    left[inner] = backward.agree(n - a[inner], n - b[inner])  # of words a - 1 and b - 1, to the left
    start, length = a - left, left + period + right
    keep = length >= np.maximum(least, times * period)
    found = np.stack([start[keep], length[keep], period[keep]], axis=1)
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


# ----------------------------------------------------------------- stretches

def gram_words(least: int, times: int) -> int:
    """The longest gram that every place of every run has twice: a run of n words and period q has n - 2 q + 1 at most."""
    return max(1, min(max(least, times * q) - 2 * q + 1 for q in range(1, least + 2)))


def stretches(hashes: np.ndarray, first: np.ndarray, k: int, least: int) -> list[tuple[int, int, int]]:
    """(document, begin, end) of the words whose grams of k words all occur again in their document."""
    grams = W.sliding_hashes(hashes, k)
    if not len(grams):
        return []
    own = W.owners(first)[: len(grams)]
    inside = np.arange(len(grams)) + k <= first[own + 1]
    key = W.mix64(grams ^ (own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    held = key[order]
    again = np.zeros(len(held), bool)
    same = held[1:] == held[:-1]
    again[1:] |= same
    again[:-1] |= same
    flag = np.zeros(len(held), bool)
    flag[order] = again
    flag &= inside
    place = np.flatnonzero(flag)
    new = np.flatnonzero((np.diff(place) > 1) | (np.diff(own[place]) > 0))
    begins, stops = place[np.append(0, new + 1)] if len(place) else place, place[np.append(new, len(place) - 1)] if len(place) else place
    out = []
    for s, e in zip(begins.tolist(), (stops + 1).tolist()):
        if e - s + k - 1 >= least:
            out.append((int(own[s]), s, e + k - 1))
    return out


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per input row: id, n_words, runs, collapsed.

    ``runs`` is an array of (start, length, period), by start and then period, in
    words of the document from 0; ``collapsed`` the words, joined by one space,
    that no run contains after its first period.  Words are ``[^\\x20\\x09-\\x0D]+``.
    Null and empty texts have no words, no runs and an empty text.  Rows are
    independent of each other (repeated ids and texts get a result each), other
    columns don't matter, and no rows give no rows.  A text is held whole, and
    trees are as large as its longest stretch of repeated grams.
    """
    if least < 2 or times < 2:
        raise ValueError("a run has two words and two periods at least")
    ship(docs.sparkSession)
    gram = gram_words(least, times)
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def batch_runs(batch: pa.RecordBatch, tokens: list[list[bytes]]) -> list[list[np.ndarray]]:
        """Runs of each document of a batch."""
        hashes, _, _, first = W.word_hashes(W.texts(batch.column(1)))
        out: list[list[np.ndarray]] = [[] for _ in tokens]
        waiting: list[tuple[int, int, int]] = []

        def solve() -> None:
            # one list of ints, with symbols of their own between the stretches
            ids: dict[bytes, int] = {}
            text, at = [], []
            for doc, s, e in waiting:
                at.append(len(text))
                own = tokens[doc]
                base = int(first[doc])
                text += [ids.setdefault(w, len(ids)) for w in own[s - base : e - base]]
                text.append(-1)
            symbol = len(ids)
            for k, x in enumerate(text):
                if x < 0:
                    text[k] = symbol
                    symbol += 1
            found = runs_of(text, least, times)
            which = np.searchsorted(at, found[:, 0], side="right") - 1
            for k, (doc, s, _) in enumerate(waiting):
                mine = found[which == k]
                if len(mine):
                    out[doc].append(mine + [s - at[k] - int(first[doc]), 0, 0])

        size = 0
        for part in stretches(hashes, first, gram, least):
            if waiting and size + part[2] - part[1] > TREE_WORDS:
                solve()
                waiting, size = [], 0
            waiting.append(part)
            size += part[2] - part[1]
        if waiting:
            solve()
        return out

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.chunks(whole, "text"):
                tokens = [(t.as_buffer().to_pybytes() if t.is_valid else b"").split() for t in batch.column(1)]
                runs, texts = [], []
                for own, held in zip(tokens, batch_runs(batch, tokens)):
                    mine = np.concatenate(held) if held else _NONE
                    mine = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in mine.tolist()])
                    if len(mine):
                        gone = np.zeros(len(own) + 1, np.int64)
                        np.add.at(gone, mine[:, 0] + mine[:, 2], 1)
                        np.add.at(gone, mine[:, 0] + mine[:, 1], -1)
                        kept = np.cumsum(gone)[:-1] == 0
                        own = [w for w, k in zip(own, kept.tolist()) if k]
                    texts.append(b" ".join(own).decode())
                columns = [batch.column(0), pa.array([len(t) for t in tokens], pa.int64()), pa.array(runs, run), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "runs", "collapsed"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = narrow.mapInArrow(find, "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)


# ----------------------------------------------------------------- the query's documents and columns

def plant_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, some of them made periodic from some word on.

    With h = crc32(id), g = h / 10 and n words: where 10 divides h and n > 0, each
    word i >= a becomes word a + (i - a) % p, for a = g % n and
    p = 1 + (n - a) / (3 + g % 8).  Documents with a null id stay as they are.
    """
    h, g, n, a, p, w = (fresh(docs, c) for c in ("h_", "g_", "n_", "a_", "p_", "w_"))
    text = F.col(text_col)
    chosen = F.coalesce(F.col(h) % 10 == 0, F.lit(False)) & F.col(n).isNotNull() & (F.col(n) > 0)
    out = docs.withColumn(h, F.crc32(F.col(id_col).cast("string").cast("binary")))
    out = out.withColumn(w, F.when(F.col(h) % 10 == 0, F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
    out = out.withColumn(g, F.expr(f"{h} div 10")).withColumn(n, F.size(w).cast("long"))
    out = out.withColumn(a, F.when(chosen, F.col(g) % F.col(n))).withColumn(p, F.expr(f"1 + ({n} - {a}) div (3 + {g} % 8)"))
    place = f"CASE WHEN i < {a} THEN i ELSE {a} + (i - {a}) % {p} END"
    made = F.expr(f"array_join(transform(sequence(0L, {n} - 1), i -> {w}[int({place})]), ' ')")
    return out.select(*[F.when(chosen, made).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_runs, the run of most periods, and digests, of ``find_runs``.

    That run has the greatest exact length / period (ties: smallest start, then
    period); its four columns are null without runs.
    """
    # a comes before b where a.length / a.period is larger, and so on: the products are exact
    more = "b.length * a.period - a.length * b.period"
    better = f"CASE WHEN {more} != 0 THEN {more} WHEN a.start != b.start THEN a.start - b.start ELSE a.period - b.period END"
    best = F.expr(f"aggregate(runs, runs[0], (a, b) -> IF({better} > 0, b, a))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    out = found.select(id_col, F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("top"),
                       F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return out.select(id_col, "n_runs", F.col("top.start").alias("start"), F.col("top.length").alias("length"), F.col("top.period").alias("period"),
                      F.expr("(1000 * top.length) div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
