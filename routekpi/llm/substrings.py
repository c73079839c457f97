"""Removal of passages that repeat across documents, by suffix automata.

A window is WINDOW consecutive words of one document.  A word goes when a
window that covers it also starts in a document with a smaller id.

Automata of all texts against all texts would cost their product, so the
references are first narrowed to what repeats at all, and every document meets
only the automata that hold its own repeats:

1. Winnowing: of the word k-grams of every window the least hash is its anchor.
   Equal windows have equal anchors, so a window whose anchor no other document
   has (by a bounded counting filter) needs no further look.
2. The 64-bit hashes of the windows left are grouped for the smallest id that has
   each, its owner.  Runs of windows with one owner become spans: a reference if
   the document is the owner, else a query.
3. References are dealt to shards by owner.  A shard's task builds one suffix
   automaton over its references' words and streams the queries of its owners
   through it for matching statistics; matched stretches of WINDOW words or more
   are removed.  An owner with many queries has its references sent to several
   copies of the shard, each with part of the queries.

Documents of equal words are one text from the start: all but the first are
covered whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from routekpi.llm import bloom
from routekpi.llm import words as W
from routekpi.llm.scratch import save, ship

WINDOW = 50
#: Queries of one owner in one copy of a shard.
QUERIES = 256
#: Words of references in a shard, about; and least number of shards.
SHARD_WORDS = 50_000
LEAST_SHARDS = 512


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over values[i:i+width] for each i, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


def anchors(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the anchor hash of each, and each one's document."""
    k = window // 2 + 1
    counts = np.maximum(np.diff(first) - window + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = W.sliding_hashes(words, k)
    least = _sliding(grams, window - k + 1, np.minimum)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.concatenate([[0], np.cumsum(counts)])
    starts = np.repeat(first[:-1] - at[:-1], counts) + np.arange(total)
    return starts, least[starts], owner


def _fingerprints(words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each whole word sequence."""
    out = []
    for salt in (0x2127599BF4325C37, 0x9FB21C651E98DF25):
        spots = np.arange(len(words), dtype=np.uint64) - np.repeat(first[:-1], np.diff(first)).astype(np.uint64)
        total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(W.mix64((words ^ np.uint64(salt)) + spots * np.uint64(0xD1342543DE82EF95)), out=total[1:])
        out.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return out


def _key(ids: pa.Array, f1: np.ndarray) -> np.ndarray:
    """A 64-bit key of a row's id and words."""
    ids = np.asarray(ids.cast(pa.int64()).fill_null(-1)).view(np.uint64)
    return W.mix64(ids * np.uint64(0x9E3779B97F4A7C15) ^ f1.view(np.uint64)).view(np.int64)


def _profile(narrow: DataFrame, window: int) -> DataFrame:
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                b = W.texts(part.column(1))
                words, _, _, first = W.word_hashes(b)
                f1, f2 = _fingerprints(words, first)
                _, anchor, owner = anchors(words, first, window)
                order = np.lexsort((anchor, owner))
                anchor, owner = anchor[order], owner[order]
                new = np.ones(len(anchor), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
                at = np.searchsorted(owner[new], np.arange(len(b) + 1))
                found = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(anchor[new].view(np.int64)))
                raw = b.data.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[i:j].split())).hexdigest() for i, j in zip(b.offsets, b.offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(_key(part.column(0), f1)), pa.array(f1), pa.array(f2), pa.array(np.diff(first)), pa.array(sha), found],
                    ["id", "key", "f1", "f2", "n", "sha", "anchors"])

    return narrow.mapInArrow(profile, "id long, key long, f1 long, f2 long, n long, sha string, anchors array<long>")


def _windows(narrow: DataFrame, filt, window: int) -> DataFrame:
    """(w, id, key, pos, len): hashes of windows whose anchor may repeat; len equal ones in a row."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                words, _, _, first = W.word_hashes(W.texts(part.column(1)))
                starts, anchor, owner = anchors(words, first, window)
                again = bloom.holds(filt.value, anchor)
                starts, owner = starts[again], owner[again]
                if not len(starts):
                    continue
                hashes = W.sliding_hashes(words, window)[starts]
                new = np.ones(len(starts), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
                at = np.flatnonzero(new)
                f1, _ = _fingerprints(words, first)
                doc = owner[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[at].view(np.int64)), part.column(0).cast(pa.int64()).take(pa.array(doc)), pa.array(_key(part.column(0), f1)[doc]),
                     pa.array((starts[at] - first[doc]).astype(np.int32)), pa.array(np.diff(np.append(at, len(starts))).astype(np.int32))],
                    ["w", "id", "key", "pos", "len"])

    return narrow.mapInArrow(emit, "w long, id long, key long, pos int, len int")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (id, key, pos) to runs (id, key, owner, begin, last) of adjacent windows of one owner."""
    for batch in batches:
        if not batch.num_rows:
            continue
        v = {c: np.asarray(batch[c]) for c in ("id", "key", "owner", "pos", "len")}
        end = v["pos"] + v["len"]
        new = np.ones(batch.num_rows, bool)
        new[1:] = v["pos"][1:] != end[:-1]
        for c in ("id", "key", "owner"):
            new[1:] |= v[c][1:] != v[c][:-1]
        at = np.flatnonzero(new)
        stop = np.append(at[1:], len(new)) - 1
        yield pa.RecordBatch.from_arrays([pa.array(v[c][at]) for c in ("id", "key", "owner", "pos")] + [pa.array(end[stop])], ["id", "key", "owner", "begin", "stop"])


class Automaton:
    """Suffix automaton over integer symbols, extended text by text."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]

    def add(self, text: list[int]) -> None:
        """Insert a text; matches never run from one text into the next."""
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for c in text:
            p = last
            if c in nxt[p]:  # the state exists already from an earlier text
                q = nxt[p][c]
                last = q if size[q] == size[p] + 1 else self._split(p, q, c)
                continue
            cur = len(nxt)
            nxt.append({}), link.append(0), size.append(size[p] + 1)
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                link[cur] = q if size[q] == size[p] + 1 else self._split(p, q, c)
            last = cur

    def _split(self, p: int, q: int, c: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        clone = len(nxt)
        nxt.append(dict(nxt[q])), link.append(link[q]), size.append(size[p] + 1)
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        link[q] = clone
        return clone

    def matched(self, text: list[int], least: int) -> list[tuple[int, int]]:
        """Maximal stretches of ``text`` covered by matches of ``least`` symbols or more."""
        nxt, link, size = self.next, self.link, self.size
        state, length, out = 0, 0, []
        for i, c in enumerate(text):
            while state and c not in nxt[state]:
                state = link[state]
                length = size[state]
            if c in nxt[state]:
                state = nxt[state][c]
                length += 1
            if length >= least:
                begin = i + 1 - length
                if out and begin <= out[-1][1]:
                    out[-1] = (min(out[-1][0], begin), i + 1)
                else:
                    out.append((begin, i + 1))
        return out


def _texts_of(narrow: DataFrame, runs: DataFrame) -> DataFrame:
    """Texts of the documents in ``runs`` (id, ...) with their runs; a bounded filter spares the others the shuffle."""
    filt = bloom.build(runs.select(F.xxhash64("id").alias("h")).distinct(), "h", runs.count(), plane="seen")
    lists = runs.groupBy(F.col("id").alias("r_id")).agg(F.collect_list(F.struct(*[c for c in runs.columns if c != "id"])).alias("runs"))
    return narrow.where(bloom.may_hold(filt, F.xxhash64("id"))).join(lists, F.col("id") == F.col("r_id")).select("id", "text", "runs")


def _spans(texts: DataFrame, window: int) -> DataFrame:
    """(id, key, owner, begin, words): the words, as 64-bit hashes, of each run."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                words, _, _, first = W.word_hashes(W.texts(part.column(1)))
                keys = _key(part.column(0), _fingerprints(words, first)[0])
                out = []
                for i, runs in enumerate(part.column(2).to_pylist()):
                    for r in runs:
                        if r["key"] == keys[i]:
                            at = first[i] + r["begin"]
                            data = words[at : first[i] + r["stop"] + window - 1]
                            out.append((part.column(0)[i].as_py(), r["key"], r["owner"], r["begin"], data.tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                        ["id", "key", "owner", "begin", "words"])

    return texts.mapInArrow(cut, "id long, key long, owner long, begin int, words binary")


def _match(window: int):
    def match(rows: pd.DataFrame) -> pd.DataFrame:
        automaton = Automaton()
        for words in rows.loc[rows["id"] == rows["owner"], "words"].drop_duplicates():
            automaton.add(np.frombuffer(words, np.uint64).tolist())
        out = []
        asked = rows[rows["id"] != rows["owner"]]
        for i, key, begin, words in zip(asked["id"], asked["key"], asked["begin"], asked["words"]):
            for a, b in automaton.matched(np.frombuffer(words, np.uint64).tolist(), window):
                out.append((i, key, begin + a, begin + b))
        return pd.DataFrame(out, columns=["id", "key", "begin", "stop"])

    return match


def _remove(texts: DataFrame, with_text: bool) -> DataFrame:
    """(id, key, n_removed, sha, kept) of documents with stretches to remove."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                b = W.texts(part.column(1))
                words, _, _, first = W.word_hashes(b)
                keys = _key(part.column(0), _fingerprints(words, first)[0])
                raw = b.data.tobytes()
                out = []
                for i, runs in enumerate(part.column(2).to_pylist()):
                    runs = [r for r in runs if r["key"] == keys[i]]
                    if runs:
                        text = raw[b.offsets[i] : b.offsets[i + 1]].split()
                        gone = np.zeros(len(text), bool)
                        for r in runs:
                            gone[r["begin"] : r["stop"]] = True
                        kept = b" ".join([w for w, g in zip(text, gone.tolist()) if not g])
                        out.append((part.column(0)[i].as_py(), keys[i], int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                        ["id", "key", "n_removed", "sha", "kept"])

    return texts.mapInArrow(remove, "id long, key long, n_removed long, sha string, kept string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 (and kept_text).

    Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged; null texts
    have none.  ``kept_sha256`` is of the words kept, joined by one space, and
    ``kept_text`` is that text.  Documents of fewer than ``window`` words lose
    nothing.  Rows that repeat an id don't count as smaller than each other; rows
    with a null id lose nothing and are no reference.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = save(_profile(narrow, window), "profiles")
    long = rows.where(f"n >= {window} AND id IS NOT NULL")
    first = save(long.groupBy("f1", "f2").agg(F.min("id").alias("first")), "texts")
    long = save(long.select("id", "key", "f1", "f2").join(first, ["f1", "f2"]), "firsts")
    # ids all of whose rows copy an earlier document need no windows of their own
    copies = long.groupBy("id").agg(F.min(F.col("id") > F.col("first")).alias("copy"), F.count(F.lit(1)).alias("n"))
    copies = save(copies.where("copy").select("id", "n"), "copies")
    seen = bloom.build(copies.select(F.xxhash64("id").alias("h")), "h", copies.count(), plane="seen")
    named = narrow.where("id IS NOT NULL")
    maybe = bloom.may_hold(seen, F.xxhash64("id"))
    lone = named.where(~maybe).unionByName(named.where(maybe).join(copies.select(F.col("id").alias("c_id")), F.col("id") == F.col("c_id"), "left_anti"))

    keys = rows.join(copies.select(F.col("id").alias("c_id")), F.col("id") == F.col("c_id"), "left_anti").select(F.explode("anchors").alias("anchor"))
    count = rows.agg(F.coalesce(F.sum(F.size("anchors")), F.lit(0))).first()[0]
    windows = save(_windows(lone, bloom.build(keys, "anchor", count), window), "windows")
    owners = windows.groupBy("w").agg(F.min("id").alias("owner"), F.max("id").alias("high")).where("owner < high").select("w", "owner")
    met = windows.join(save(owners, "owners"), "w").select("id", "key", "owner", "pos", "len")
    runs = met.repartition("id").sortWithinPartitions("id", "key", "pos").mapInArrow(_runs, "id long, key long, owner long, begin int, stop int")
    runs = save(runs, "runs")

    spans = save(_spans(_texts_of(narrow, runs), window), "spans")
    asked = spans.groupBy("owner").agg(F.count(F.when(F.col("id") != F.col("owner"), 1)).alias("queries"))
    held = spans.where("id = owner").agg(F.sum(F.length("words") / 8)).first()[0] or 0
    shards = max(LEAST_SHARDS, int(held / SHARD_WORDS))
    dealt = spans.join(save(asked.withColumn("copies", F.greatest(F.ceil(F.col("queries") / QUERIES), F.lit(1))), "asked"), "owner")
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)
    one = F.array(F.pmod(F.xxhash64("id", "key", "begin"), F.col("copies")))
    dealt = dealt.withColumn("copy", F.explode(F.when(F.col("id") == F.col("owner"), everywhere).otherwise(one)))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(shards)))
    gone = dealt.select("shard", "copy", "id", "key", "owner", "begin", "words").groupBy("shard", "copy").applyInPandas(
        _match(window), "id long, key long, begin int, stop int")
    gone = save(gone, "matched")

    cut = save(_remove(_texts_of(narrow, gone), with_text), "removed")
    cut = (cut if with_text else cut.drop("kept")).dropDuplicates(["id", "key"])
    whole = long.where("id > first").select(F.col("id").alias("w_id"), F.col("key").alias("w_key")).distinct()
    cut = cut.select(F.col("id").alias("x_id"), F.col("key").alias("x_key"), "n_removed", F.col("sha").alias("x_sha"), *["kept"] * with_text)
    out = rows.drop("anchors").join(cut, (F.col("id") == F.col("x_id")) & (F.col("key") == F.col("x_key")), "left")
    out = out.join(whole, (F.col("id") == F.col("w_id")) & (F.col("key") == F.col("w_key")), "left")
    copied = F.col("w_id").isNotNull()
    removed = F.when(copied, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0)))
    sha = F.when(copied, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("x_sha", "sha"))
    columns = [F.col("id").alias(id_col), F.col("n").alias("n_words"), removed.cast("long").alias("n_removed"), sha.alias("kept_sha256")]
    if with_text:
        texts = narrow.select(F.col("id").alias("t_id"), F.col("text"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("t"))
        texts = texts.dropDuplicates(["t_id", "t"]).drop("t")
        plain = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
        texts = texts.withColumn("plain", plain).withColumn("p_sha", F.sha2(F.col("plain").cast("binary"), 256)).dropDuplicates(["t_id", "p_sha"])
        out = out.join(texts, F.col("id").eqNullSafe(F.col("t_id")) & (F.col("sha") == F.col("p_sha")), "left")
        columns.append(F.when(copied, F.lit("")).otherwise(F.coalesce("kept", "plain")).alias("kept_text"))
    return out.select(columns)
