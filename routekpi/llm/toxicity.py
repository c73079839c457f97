"""Toxicity by nearest labelled examples under TF-IDF cosine.

Terms are all words (runs of letters, A-Z lower-cased) of the labelled examples,
and those 4 to 6 byte beginnings of words that go with toxicity.  Document
frequencies are counted over all documents.  A term that the examples associate
with toxicity (G-test) has BOOST times its TF-IDF weight; no other term is left
out, so a copy of an example is its nearest neighbour, at cosine 1, whatever its
words.  Examples and documents are unit vectors of these weights.

A block-max inverted index over the examples gives, per term and block of
examples, the largest weight: a document's blocks are visited in the order of
their bounds until no other block can hold a nearer example, so the neighbours
are exact.  Blocks hold examples of the same strongest terms.

Votes of the neighbours, weighted by squared cosine, are shrunk towards the rate
among examples without any toxic term, which also scores documents without terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from routekpi.llm import labelled
from routekpi.llm import words as W
from routekpi.llm.scratch import save, ship

#: At most so many labelled documents are examples, each of at most so many bytes.
SAMPLE = 4096
EXAMPLE_BYTES = 1 << 16
#: Least G statistic and count among toxic examples of a term that goes with toxicity, and its weight.
MIN_G, MIN_COUNT, BOOST = 30.0, 5, 8.0
PREFIXES = (4, 5, 6)
NEIGHBOURS = 15
BLOCK = 512
#: A term of more than one in so many examples is frequent; and texts that are scored at once.
FREQUENT = 16
TEXTS = 64
#: Weight of the background rate against one neighbour of cosine 1, and that rate if nothing is known.
BACKGROUND = 0.05
UNKNOWN_RATE = 0.1
THRESHOLD = 0.3


SIEVE_BITS = 22
_sieves: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _sieve(wanted: np.ndarray) -> np.ndarray:
    """Which beginnings of hashes occur among the wanted ones; kept for the last arrays asked for."""
    if id(wanted) not in _sieves:
        if len(_sieves) > 1:
            _sieves.clear()
        held = np.zeros(1 << SIEVE_BITS, bool)
        held[wanted >> np.uint64(64 - SIEVE_BITS)] = True
        _sieves[id(wanted)] = wanted, held
    return _sieves[id(wanted)][1]


def terms(b: W.Bytes, wanted: np.ndarray | None = None, beginnings: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts, and each one's text; only words in ``wanted`` and parts in ``beginnings`` (both sorted) if given."""
    b = b.lower_ascii()
    starts, ends, first = W.runs(W.is_letter(b.data), b.offsets)
    prefix, doc = b.prefix_hashes(), W.owners(first)
    found, owner = [], []
    for width in (0, *PREFIXES):
        some = slice(None) if not width else np.flatnonzero(ends - starts > width)
        s = starts[some]
        h = W.span_hashes(prefix, s, s + width if width else ends) ^ np.uint64(width)
        d = doc[some]
        known = beginnings if width else wanted
        if known is not None:
            keep = np.flatnonzero(_sieve(known)[h >> np.uint64(64 - SIEVE_BITS)])
            h, d = h[keep], d[keep]
            if len(h):
                keep = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
                h, d = h[keep], d[keep]
        found.append(h)
        owner.append(d)
    return np.concatenate(found), np.concatenate(owner)


def _distinct(h: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs in order, with their counts."""
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return d[at], h[at], np.diff(np.append(at, len(h)))


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.chunks(batch, "text"):
            y = np.asarray(part.column(1)).astype(np.int64)
            b = W.texts(part.column(0))
            whole = np.unique(W.span_hashes(b.lower_ascii().prefix_hashes(), *W.runs(W.is_letter(b.data), b.offsets)[:2]))
            d, h, _ = _distinct(*terms(b))
            unique, at = np.unique(h, return_inverse=True)
            bad = np.bincount(at, y[d], len(unique)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(unique.view(np.int64)), pa.array(np.bincount(at, minlength=len(unique)).astype(np.int64)), pa.array(bad), pa.array(np.isin(unique, whole))],
                ["term", "n", "bad", "word"])


def vocabulary(examples: DataFrame) -> Vocabulary:
    """The examples' words, and the beginnings of words that go with toxicity; empty without examples of both kinds."""
    n, bad = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not bad or bad == n:
        return Vocabulary(np.zeros(0, np.uint64), np.zeros(0))
    counts = examples.select("text", "y").mapInArrow(_label_counts, "term long, n long, bad long, word boolean")
    counts = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.max("word").alias("word"))
    rate = bad / n
    expected = F.col("n") * rate
    good = F.col("n") - F.col("bad")
    g = 2 * (F.col("bad") * F.log(F.col("bad") / expected) + F.when(good > 0, good * F.log(good / (F.col("n") * (1 - rate)))).otherwise(0.0))
    toxic = F.coalesce((F.col("bad") >= MIN_COUNT) & (F.col("bad") > expected) & (g >= MIN_G), F.lit(False))
    rows = counts.withColumn("toxic", F.when(F.col("bad") > 0, toxic).otherwise(False)).where("word OR toxic").select("term", "toxic").toPandas()
    term = rows["term"].to_numpy(np.int64).view(np.uint64)  # at most SAMPLE * EXAMPLE_BYTES bytes of words
    order = np.argsort(term)
    return Vocabulary(term[order], np.where(rows["toxic"].to_numpy(bool)[order], BOOST, 1.0))


class Vocabulary:
    """Sorted term hashes, which of them go with toxicity, and the weight of each (inverse document frequency and boost)."""

    def __init__(self, term: np.ndarray, boost: np.ndarray):
        self.term, self.boost = term, boost
        self.toxic = term[boost > 1]
        self.weight = boost

    def __len__(self) -> int:
        return len(self.term)

    def counts(self, b: W.Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term number and count of the terms of each text, in order."""
        h, d = terms(b, self.term, self.toxic)
        size = max(len(self), 1)
        key = np.sort(d * size + np.searchsorted(self.term, h))
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[at] // size, key[at] % size, np.diff(np.append(at, len(key)))

    def vectors(self, b: W.Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term number and weight of each non-zero entry of the unit TF-IDF vectors, in order."""
        d, at, tf = self.counts(b)
        w = (1 + np.log(tf)) * self.weight[at]
        norm = np.sqrt(np.bincount(d, w * w, len(b)))
        return d, at, w / norm[d]


def inverse_frequencies(docs: DataFrame, vocab: Vocabulary, text_col: str) -> np.ndarray:
    """Inverse document frequencies of the vocabulary over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(vocab), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for part in W.chunks(batch, text_col):
                total += np.bincount(vocab.counts(W.texts(part.column(0)))[1], minlength=len(vocab))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["term", "n"])

    rows = docs.select(text_col).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()  # a row per term
    df = np.zeros(len(vocab) + 1, np.int64)
    df[rows["term"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)  # (-1: the documents)
    return np.log((df[-1] + 1) / (df[:-1] + 1)) + 1


class BlockMaxIndex:
    """Inverted lists of the examples' vectors, block by block, with each block's largest weight per term.

    The list of a term that more than one in FREQUENT examples have is an array
    over all examples; so documents meet these lists by one matrix product.
    """

    def __init__(self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, ids: np.ndarray, y: np.ndarray, terms_: int):
        # examples of the same strongest term lie together, which makes bounds tight
        strongest = np.zeros(len(ids), np.int64)
        order = np.lexsort((weight, example))
        strongest[example[order]] = term[order]
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((ids, strongest))] = np.arange(len(ids))
        self.ids, self.y = np.empty_like(ids), np.empty_like(y)
        self.ids[rank], self.y[rank] = ids, y
        example = rank[example]
        self.block = BLOCK
        self.terms, self.blocks = terms_, -(-len(ids) // BLOCK)
        many = np.flatnonzero(np.bincount(term, minlength=terms_) * FREQUENT > len(ids))
        self.row = np.full(terms_, -1)
        self.row[many] = np.arange(len(many))
        often = self.row[term] >= 0
        self.dense = np.zeros((len(many), self.blocks * BLOCK))
        self.dense[self.row[term[often]], example[often]] = weight[often]
        example, term, weight = example[~often], term[~often], weight[~often]
        block = example // BLOCK
        order = np.lexsort((example, term, block))
        self.place, self.weight = (example[order] % BLOCK).astype(np.int32), weight[order]
        key = block[order] * terms_ + term[order]
        self.begin = np.searchsorted(key, np.arange(self.blocks * terms_ + 1)).astype(np.int32)
        self.most = np.zeros((terms_, self.blocks), np.float32)
        np.maximum.at(self.most, (term, block), np.nextafter(weight, 2).astype(np.float32) * np.float32(1 + 1e-6))

    def partial(self, texts: int, d: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Per text and example the part of their cosine that is due to frequent terms."""
        row = self.row[term]
        often = row >= 0
        own = np.zeros((texts, len(self.dense)))
        own[d[often], row[often]] = weight[often]
        return own @ self.dense

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS, partial: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples and their cosines; ties to the earlier example."""
        if partial is None:
            partial = self.partial(1, np.zeros(len(term), np.int64), term, weight)[0]
        rare = self.row[term] < 0
        term, weight = term[rare], weight[rare]
        partial = partial.reshape(self.blocks, self.block)
        bound = partial.max(axis=1) + (weight @ self.most[term]) * (1 + 1e-6) + 1e-9
        best, score = np.zeros(0, np.int64), np.zeros(0)
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] <= 1e-9 or (len(best) == k and bound[block] < score[-1]):
                break
            at = block * self.terms + term
            first = self.begin[at]
            size = self.begin[at + 1] - first
            ends = np.cumsum(size)
            found = partial[block]
            if len(ends) and ends[-1]:
                spot = np.repeat(first - (ends - size), size) + np.arange(ends[-1])
                found = found + np.bincount(self.place[spot], self.weight[spot] * np.repeat(weight, size), self.block)
            some = np.flatnonzero(found > (score[-1] * (1 - 1e-12) if len(best) == k else 0))
            best, score = np.concatenate([best, some + block * self.block]), np.concatenate([score, found[some]])
            keep = np.lexsort((best, -score))[:k]
            best, score = best[keep], score[keep]
        return best, score


def score_toxicity(docs: DataFrame, labels: DataFrame, label: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                   rows: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted, evidence (nearest examples' ids).

    Held-out documents and labelled ones above EXAMPLE_BYTES are never examples.
    Null and empty texts, and texts without any example's word, have the rate among
    examples without a toxic term and no evidence.  Without labels of both kinds
    that rate is UNKNOWN_RATE for every text.  Of several labels of an id the
    largest counts and of rows that repeat an id one is an example; rows to score
    are independent of each other.  No rows give no rows; very long texts are read
    whole, one at a time; other columns don't matter.
    """
    ship(docs.sparkSession)
    label = F.col("toxic") if label is None else label
    fits = docs.where(F.octet_length(text_col) <= EXAMPLE_BYTES)
    examples = save(labelled.sample(fits, labels, label, rows, id_col, text_col), "examples")
    vocab = vocabulary(examples)
    index, base = None, UNKNOWN_RATE
    if len(vocab):
        vocab.weight = inverse_frequencies(docs, vocab, text_col) * vocab.boost
        held = examples.orderBy("id").toArrow().combine_chunks().to_batches()[0]  # at most ``rows`` rows of EXAMPLE_BYTES
        y, parts, done = np.asarray(held["y"]).astype(np.int64), [], 0
        for part in W.chunks(held, "text"):
            d, t, w = vocab.vectors(W.texts(part["text"]))
            parts.append((d + done, t, w))
            done += part.num_rows
        example, term, weight = (np.concatenate(c) for c in zip(*parts))
        plain = np.ones(len(y), bool)
        plain[example[vocab.boost[term] > 1]] = False
        base = float((y[plain].sum() + 0.1) / (plain.sum() + 1))
        index = BlockMaxIndex(example, term, weight, np.asarray(held["id"]), y, len(vocab))
    kind = examples.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((vocab, index, base))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, index, base = shared.value
        for batch in batches:
            for part in W.chunks(batch, "text"):
                out, evidence = np.full(part.num_rows, base), [[] for _ in range(part.num_rows)]
                if index is not None:
                    d, t, w = vocab.vectors(W.texts(part.column(1)))
                    at = np.searchsorted(d, np.arange(part.num_rows + 1))
                    for low in range(0, part.num_rows, TEXTS):
                        high = min(low + TEXTS, part.num_rows)
                        some = slice(at[low], at[high])
                        partial = index.partial(high - low, d[some] - low, t[some], w[some])
                        for i in low + np.flatnonzero(np.diff(at[low : high + 1])):
                            near, cosine = index.nearest(t[at[i] : at[i + 1]], w[at[i] : at[i + 1]], partial=partial[i - low])
                            vote = cosine * cosine
                            out[i] = (vote @ index.y[near] + BACKGROUND * base) / (vote.sum() + BACKGROUND)
                            evidence[i] = index.ids[near].tolist()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out), pa.array(evidence, pa.list_(pa.int64()))], ["id", "score", "evidence"])

    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(score, f"id {kind}, score double, evidence array<long>")
    return scored.select(F.col("id").alias(id_col), labelled.held_out(F.col("id")).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "evidence")
