"""Groups of spelling variants: words one edit apart, by sorted-list dynamic programming.

The vocabulary is counted with partial sums in the tasks.  Then pairs of words
that differ by one inserted, deleted or replaced code point are found so:

* Two such words, the shorter of n code points, agree everywhere but in one
  place.  Cutting [0, n) in two leaves that place in one half, so the words agree
  in the other: words of n and n + 1 code points meet under the key (n, half, text of
  the other half).  A key of more than GROUP_WORDS words is cut in two again, and so
  on; when one place is left, a key holds at most the words that differ there, which
  the alphabet bounds.  So no task ever holds an unbounded group and nothing is left
  out.
* A task holds some keys' words as one sorted list.  Each word scans its key's
  stretch of the list in order with a banded edit matrix (three cells a row).  The
  rows of the prefix that a word shares with the one before it (the LCP) are used
  again; when a row's cells all exceed one edit, every word that shares that prefix
  is skipped.  All scans of a task advance together, one row a step, in numpy.

A pair counts in the one part that holds its first difference, so every pair is
found once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from routekpi.llm.scratch import save, ship

#: Letters of words: ASCII and Latin-1 (its two signs among them, too).
LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form has this many times its variant's occurrences.
RATIO = 5
#: Words under one key that are scanned as one list; more are cut by another key.
GROUP_WORDS = 4096
#: Words and code points that a task scans at once.
BATCH_WORDS = 1 << 16
BATCH_POINTS = 1 << 20
#: Distinct words that a task holds before it hands counts on.
HELD_WORDS = 1 << 19


# ----------------------------------------------------------------- vocabulary

def every_199th(seed: int, runs: list[str]) -> None:
    """Delete one code point of the runs whose crc32, after ``<doc_id>:``, 199 divides (in place)."""
    hashes = np.array([zlib.crc32(r.encode(), seed) for r in runs], np.int64)
    for k in np.flatnonzero(hashes % 199 == 0):
        run = runs[k]
        at = int(hashes[k]) % len(run)
        runs[k] = run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                alter: Callable[[int, list[str]], None] | None = None) -> DataFrame:
    """(word, n) of the letter runs of whole texts, lower-cased in A-Z only, with that length and number.

    ``alter`` may change a document's list of runs of ``min_length`` or more code
    points; it gets the crc32 of ``<id>:`` (a null id is empty) with it.  Null texts have none.
    """
    ship(docs.sparkSession)
    find = re.compile(f"[{LETTERS}]{{{min_length},}}").findall

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1)):
                if not text.is_valid:
                    continue
                runs = find(text.as_buffer().to_pybytes().lower().decode())  # bytes: A-Z only
                if alter and runs:
                    alter(zlib.crc32(f"{doc.as_py() if doc.is_valid else ''}:".encode()), runs)
                counts.update(runs)
                if len(counts) >= HELD_WORDS:
                    yield batch(counts)
                    counts.clear()
        if counts:
            yield batch(counts)

    parts = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(count, "word string, n long")
    return parts.where(F.char_length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ----------------------------------------------------------------- the scan

def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, a row each, ended by zeros; and their lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    data = np.array(words, dtype=f"<U{lengths.max() + 2}")
    return data.view(np.uint32).reshape(len(words), -1).astype(np.int32), lengths


def scan(words: list[str], begin: np.ndarray, end: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of places in the list with one edit from word a to word b.

    The list is sorted by key and word; begin and end give the stretch of each
    word's key.  Word a asks (``asks``) for words of its own length after it and
    for words longer by one.
    """
    points, length = _matrix(words)
    count, width = points.shape
    # code points that a word shares with the one before it, in the same key
    lcp = np.zeros(count, np.int64)
    if count > 1:
        differ = points[1:] != points[:-1]
        lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), length[1:])
        lcp[1:][begin[1:] != begin[:-1]] = 0
    # the next place at which the shared prefix is shorter than d: where a scan goes on after a skip at depth d
    after = np.full((width, count + 1), count, np.int32)
    after[:, :count] = np.where(lcp < np.arange(width)[:, None], np.arange(count), count)
    after = np.minimum.accumulate(after[:, ::-1], axis=1)[:, ::-1]
    # rows of the band: cell k of row d is the distance of word[:d] to query[:d - 1 + k], 2 for more than one
    query = np.flatnonzero(asks)
    rows = np.full((len(query), width + 1, 3), 2, np.int8)
    rows[:, 0, 1], rows[:, 0, 2] = 0, 1
    place = begin[query].copy()
    depth = np.zeros(len(query), np.int64)
    active = np.arange(len(query))
    found_a, found_b = [], []
    while len(active):
        q, i, d = query[active], place[active], depth[active]
        # one more row: the word's code point d against the query's d - 1, d and d + 1
        point = points[i, d]
        before = rows[active, d]
        cell = []
        for k in (0, 1, 2):
            j = d + k  # the cell stands for query[:j]
            match = points[q, j - 1] == point  # (j = 0 is set below)
            best = np.where(match, before[:, k], before[:, k] + 1)
            if k < 2:
                best = np.minimum(best, before[:, k + 1] + 1)
            if k:
                best = np.minimum(best, cell[k - 1] + 1)
            best = np.where(j <= length[q], best, 2)
            if not k:
                best = np.where(d == 0, 1, best)
            cell.append(np.minimum(best, 2).astype(np.int8))
        rows[active, d + 1] = np.stack(cell, axis=1)
        low = np.minimum(np.minimum(cell[0], cell[1]), cell[2])
        d1 = d + 1
        ended = (low < 2) & (d1 == length[i])
        if ended.any():
            # the whole word: the cell of the whole query
            k = length[q] - d1 + 1
            value = np.where(k == 0, cell[0], np.where(k == 1, cell[1], np.where(k == 2, cell[2], 2)))
            hit = ended & (value == 1) & ((length[i] > length[q]) | ((length[i] == length[q]) & (i > q)))
            found_a.append(q[hit])
            found_b.append(i[hit])
        skipped = low >= 2
        going = ~skipped & ~ended
        # past the words that share the prefix, or the next word, whose shared rows are kept
        step = np.where(skipped, after[d1, np.minimum(i + 1, count)], i + 1)
        there = np.where(going, i, step)
        shared = lcp[np.minimum(there, count - 1)]
        place[active] = there
        depth[active] = np.where(going, d1, np.minimum(shared, d1))
        active = active[there < end[q]]
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _neighbours(low: np.ndarray, high: np.ndarray, words: list[str], begin: np.ndarray, end: np.ndarray, n: np.ndarray, short: np.ndarray):
    """Per word with near ones: place, their number, and the place of the most frequent, first in order."""
    length = np.array([len(w) for w in words])
    a, b = scan(words, begin, end, length == short)
    # a pair counts where its first difference lies
    points, _ = _matrix(words)
    first = (points[a] != points[b]).argmax(axis=1)
    here = (first >= low[a]) & ((first < high[a]) | (high[a] == short[a]))
    a, b = a[here], b[here]
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    if not len(one):
        return one, one, one
    order = np.lexsort((other, -n[other], one))
    one, other = one[order], other[order]
    head = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]]))
    return one[head], np.diff(np.append(head, len(one))), other[head]


_KEYED = "word string, n long, short int, low int, high int, key string"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and word -> (word, near, best_n, best) of the words with near ones."""
    held: list[tuple] = []
    points = 0

    def flush(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        words, ns, short, low, high, keys = (list(c) for c in zip(*rows))
        new = np.concatenate([[True], np.array([x != y for x, y in zip(keys[1:], keys)], bool)])
        group = np.cumsum(new) - 1
        starts = np.append(np.flatnonzero(new), len(rows))
        n = np.array(ns, np.int64)
        one, count, best = _neighbours(np.array(low), np.array(high), words, starts[group], starts[group + 1], n, np.array(short))
        if len(one):
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[i] for i in one], pa.string()), pa.array(count, pa.int64()), pa.array(n[best], pa.int64()), pa.array([words[i] for i in best], pa.string())],
                names=["word", "near", "best_n", "best"])

    for batch in batches:
        for row in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("word", "n", "short", "low", "high", "key")]):
            if (len(held) >= BATCH_WORDS or points >= BATCH_POINTS) and row[5] != held[-1][5]:
                yield from flush(held)
                held, points = [], 0
            if held and len(row[0]) > 2 * len(held[-1][0]) + 16 and row[5] != held[-1][5]:  # a much longer word widens every row
                yield from flush(held)
                held, points = [], 0
            held.append(row)
            points += len(row[0])
    if held:
        yield from flush(held)


def _with_key(parts: DataFrame) -> DataFrame:
    """The key of (short, low, high): the texts before low and after high (a longer word's: one further)."""
    head, tail = F.expr("substring(word, 1, low)"), F.expr("substring(word, high + 1 + char_length(word) - short)")
    return parts.withColumn("key", F.concat_ws("\u0000", F.col("short").cast("string"), F.col("low").cast("string"), F.col("high").cast("string"), head, tail))


def near_words(vocabulary: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, form_n, best): how many words are one edit away, and the most frequent of them.

    ``vocabulary`` has (word, n), each word once.  Words without near ones have no
    row.  Ties go to the first word in code-point order.
    """
    ship(vocabulary.sparkSession)
    length = F.char_length("word")
    shorts = vocabulary.select("word", "n", F.explode(F.array(length, length - 1)).alias("short")).where("short > 0")
    half = (F.col("short") / 2).cast("int")
    parts = shorts.withColumn("cut", F.explode(F.array(F.struct(F.lit(0).alias("low"), half.alias("high")), F.struct(half.alias("low"), F.col("short").alias("high")))))
    parts = _with_key(parts.select("word", "n", "short", "cut.low", "cut.high"))
    found = []
    while True:
        parts = save(parts, "parts")
        # a key is of use if a word asks there: one of its own length, and another
        sizes = parts.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max(length == F.col("short")).alias("asks")).where("size > 1 AND asks")
        large = F.col("size") > group_words
        splits = F.col("high") - F.col("low") > 1
        met = save(parts.join(sizes.select(F.col("key").alias("of"), "size"), F.col("key") == F.col("of")).drop("of"), "met")
        ready = met.where(~(large & splits)).select("word", "n", "short", "low", "high", "key")
        found.append(ready.repartition("key").sortWithinPartitions("short", "key", "word").mapInArrow(_solve, "word string, near long, best_n long, best string"))
        rest = met.where(large & splits)
        if not rest.limit(1).count():
            break
        mid = ((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(F.struct("low", mid.alias("high")), F.struct(mid.alias("low"), "high"))
        parts = _with_key(rest.select("word", "n", "short", F.explode(halves).alias("cut")).select("word", "n", "short", "cut.low", "cut.high"))
    near = found[0]
    for part in found[1:]:
        near = near.unionByName(part)
    first = F.min_by(F.struct("best_n", "best"), F.struct(-F.col("best_n"), F.col("best")))
    return near.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("first")).select("word", "n_near", F.col("first.best_n").alias("best_n"), F.col("first.best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by pointer doubling.

    A form has more occurrences than its word, so chains have no cycle and a
    length of at most the logarithm of the largest number.
    """
    out = save(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = out.select(F.col("word").alias("via"), F.col("root").alias("next"))
        out = save(out.join(further, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not out.where("moved").limit(1).count():
            return out.select("word", "root")


def group_variants(vocabulary: DataFrame, ratio: int = RATIO, group_words: int = GROUP_WORDS) -> DataFrame:
    """One row per word of (word, n): word, form, root, n, n_near, form_n.

    A word's form is the most frequent word one edit away (ties: first in
    code-point order) if it has ``ratio`` times the word's occurrences or more;
    its root is reached by following forms.  Without a form, form and form_n are
    null and the root is the word.  Rows that repeat a word are added up; rows
    with a null word or number are left out; no rows give no rows.
    """
    ship(vocabulary.sparkSession)
    once = vocabulary.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    once = save(once, "vocabulary")
    near = near_words(once, group_words).select(F.col("word").alias("w"), "n_near", "best_n", "best")
    rows = once.join(near, F.col("word") == F.col("w"), "left")
    has = F.col("best_n") >= ratio * F.col("n")
    rows = save(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "forms")
    last = roots(rows.where("form IS NOT NULL")).select(F.col("word").alias("of"), "root")
    out = rows.join(last, F.col("word") == F.col("of"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **counting) -> DataFrame:
    """``group_variants`` of the words of whole texts (``count_words``).

    Null and empty texts have no words, rows that repeat a document count again,
    other columns don't matter, and a table without words gives no rows.  A task
    holds one text and its counts at a time.
    """
    return group_variants(count_words(docs, id_col, text_col, **counting))
