"""Language identification of words by a linear-chain conditional random field.

Every word (a run of letters, A-Z lower-cased; of a longer run, as in scripts
without spaces, each piece of some 48 bytes) of a line is labelled with a
language.  Features of a word: its first and last 1 to 4 bytes (affixes), its
byte trigrams, and the word itself (a lexicon learned from the labelled texts),
all hashed.  Transitions between the languages of neighbouring words are
learned too, from chains that join stretches of different documents, so
code-switched lines are labelled word by word.  Forward-backward gives each
word's marginals; a document's language is the one with the largest mean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from routekpi.llm import labelled
from routekpi.llm import words as W
from routekpi.llm.scratch import save, ship

BITS = 18
AFFIXES = (1, 2, 3, 4)
#: Longest word in bytes.
PIECE = 48
#: The model is fitted on at most so many labelled documents; of one of more bytes, on slices of so many characters spread over it.
SAMPLE, SAMPLE_BYTES = 1200, 50_000
SLICES, SLICE = 10, 1000
#: Words of one stretch in a training chain at most, stretches of a chain, and chains of a step.
STRETCH, STRETCHES, CHAINS = 12, 2, 128
PASSES, RATE, SHRINK = 4, 0.2, 1e-6
UNKNOWN = "und"


def letter_runs(b: W.Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the index of each text's first; long runs are cut between characters."""
    starts, ends, first = W.runs(W.is_letter(b.data), b.offsets)
    more = np.maximum(ends - starts - 1, 0) // PIECE
    if not more.any():
        return starts, ends, first
    before = np.concatenate([[0], np.cumsum(more)])
    nth = np.arange(before[-1]) - np.repeat(before[:-1], more) + 1
    cuts = np.repeat(starts, more) + PIECE * nth
    for _ in range(3):
        cuts -= (b.data[cuts] & 0xC0) == 0x80
    begin = np.sort(np.concatenate([starts, cuts]))
    end = np.append(begin[1:], 0)
    end[np.arange(len(starts)) + before[1:]] = ends
    return begin, end, first + before[first]


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (W.mix64(h + np.uint64(kind * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(64 - BITS)).astype(np.int64)


def word_features(b: W.Bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashed affixes and lexicon entry of each word, a row per word; bucket 0 where a word is too short."""
    prefix = b.prefix_hashes()
    out = np.zeros((len(starts), 2 * len(AFFIXES) + 1), np.int64)
    for k, width in enumerate(AFFIXES):
        long = np.flatnonzero(ends - starts >= width)
        out[long, 2 * k] = _bucket(W.span_hashes(prefix, starts[long], starts[long] + width), 2 * k + 1)
        out[long, 2 * k + 1] = _bucket(W.span_hashes(prefix, ends[long] - width, ends[long]), 2 * k + 2)
    out[:, -1] = _bucket(W.span_hashes(prefix, starts, ends), 99)
    return out


def trigrams(b: W.Bytes) -> np.ndarray:
    """The bucket of the three bytes at each place (short at the end)."""
    data = b.data.astype(np.uint64)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    return _bucket((data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:], 77)


class Chain:
    """Weights (buckets x labels), transitions and their use."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        self.weights = np.zeros((1 << BITS, len(labels)), np.float32)
        self.switch = np.zeros((len(labels), len(labels)))

    def emissions(self, b: W.Bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Scores of each word for each label, relative to the word's best."""
        scores = np.zeros((len(starts), len(self.labels)))
        feats = word_features(b, starts, ends)
        for column in feats.T:
            scores += self.weights[column]
        three = trigrams(b)
        if len(three):
            total = np.zeros((len(three) + 1, len(self.labels)))
            np.cumsum(self.weights[three], axis=0, out=total[1:])
            long = np.flatnonzero(ends - starts >= 3)
            scores[long] += total[ends[long] - 2] - total[starts[long]]
        return scores - scores.max(axis=1, keepdims=True) if len(scores) else scores

    def marginals(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(label) of each word by forward-backward; ``first`` holds the chains' first words."""
        lengths = np.diff(first)
        order = np.argsort(-lengths, kind="stable")
        begin, lengths = first[:-1][order], lengths[order]
        local, move = np.exp(np.maximum(scores, -60)), np.exp(self.switch)
        alpha, beta = np.empty_like(local), np.empty_like(local)
        longest = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(longest + 1), side="left")  # chains longer than t
        for t in range(longest):
            at = begin[: active[t]] + t
            a = local[at] if t == 0 else (alpha[at - 1] @ move) * local[at]
            alpha[at] = a / a.sum(axis=1, keepdims=True)
        for t in range(longest - 1, -1, -1):
            at = begin[: active[t]] + t
            z = np.ones((len(at), len(self.labels)))
            more = active[t + 1]
            if more:
                after = at[:more] + 1
                z[:more] = (beta[after] * local[after]) @ move.T
            beta[at] = z / z.sum(axis=1, keepdims=True)
        out = alpha * beta
        return out / out.sum(axis=1, keepdims=True)

    def pair_marginals(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Expected transitions between neighbours, summed: alpha of the first, beta times local score of the second."""
        joint = left[:, :, None] * np.exp(self.switch)[None] * right[:, None, :]
        return (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def _fit(chain: Chain, texts: list[bytes], y: np.ndarray, seed: int = 5) -> Chain:
    """Adagrad on the conditional likelihood of chains that join stretches of documents."""
    b = W.Bytes(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])).lower_ascii()
    starts, ends, first = letter_runs(b)
    feats, three = word_features(b, starts, ends), trigrams(b)
    owner = y[W.owners(first)]
    # stretches of words of one document, the last one shorter, in an order fixed by the seed
    cuts = np.concatenate([np.arange(i, j, STRETCH) for i, j in zip(first, first[1:])] or [np.zeros(0, int)]).astype(np.int64)
    sizes = np.minimum(STRETCH, first[W.owners(first)[cuts] + 1] - cuts) if len(cuts) else cuts
    rng, k, n_labels = np.random.default_rng(seed), STRETCH * STRETCHES, len(chain.labels)
    w_squares, s_squares = np.full(chain.weights.shape, 1e-6, np.float32), np.full(chain.switch.shape, 1e-6)
    for _ in range(PASSES):
        order = rng.permutation(len(cuts))
        for i in range(0, len(order), STRETCHES * CHAINS):
            # a chain's words come first in its row, places that it doesn't fill last
            some = order[i : i + STRETCHES * CHAINS]
            chains = -(-len(some) // STRETCHES)
            held = np.zeros(chains * STRETCHES, np.int64)
            held[: len(some)] = sizes[some]
            nth = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
            words = np.repeat(cuts[some], sizes[some]) + nth
            length = held.reshape(chains, STRETCHES).sum(axis=1)
            full = np.arange(k)[None, :] < length[:, None]
            gold = np.zeros((chains, k), np.int64)
            gold[full] = owner[words]
            grams = np.maximum(ends[words] - starts[words] - 2, 0)
            spot = np.repeat(starts[words] - np.concatenate([[0], np.cumsum(grams)[:-1]]), grams) + np.arange(grams.sum())
            word_of = np.concatenate([np.repeat(np.arange(len(words)), feats.shape[1]), np.repeat(np.arange(len(words)), grams)])
            ids = np.concatenate([feats[words].ravel(), three[spot]])
            scores = np.zeros((len(words), n_labels))
            for label in range(n_labels):
                scores[:, label] = np.bincount(word_of, chain.weights[ids, label], len(words))
            local = np.ones((chains, k, n_labels))
            local[full] = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60))
            move = np.exp(chain.switch)
            alpha, beta = np.empty_like(local), np.ones_like(local)
            for t in range(k):
                a = local[:, 0] if t == 0 else (alpha[:, t - 1] @ move) * local[:, t]
                alpha[:, t] = a / a.sum(axis=1, keepdims=True)
            for t in range(k - 2, -1, -1):
                z = (beta[:, t + 1] * local[:, t + 1]) @ move.T
                beta[:, t] = np.where(full[:, t + 1, None], z / z.sum(axis=1, keepdims=True), 1.0)
            p = (alpha * beta)[full]
            slope = -p / p.sum(axis=1, keepdims=True)
            slope[np.arange(len(words)), gold[full]] += 1
            used, where = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(where, slope[word_of, label], len(used)) for label in range(n_labels)], axis=1) / chains
            grad -= SHRINK * chain.weights[used]
            w_squares[used] += grad * grad
            chain.weights[used] += RATE * grad / np.sqrt(w_squares[used])
            seen = np.zeros_like(chain.switch)
            np.add.at(seen, (gold[:, :-1][full[:, 1:]], gold[:, 1:][full[:, 1:]]), 1)
            hoped = chain.pair_marginals(alpha[:, :-1][full[:, 1:]], (beta[:, 1:] * local[:, 1:])[full[:, 1:]])
            grad = (seen - hoped) / chains
            s_squares += grad * grad
            chain.switch += RATE * grad / np.sqrt(s_squares)
    return chain


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE) -> Chain:
    """Fit on a bounded sample of labelled documents, in equal parts per language where there are enough.

    Every language is learned; with more languages than ``rows``, the ``rows`` most frequent.
    """
    langs = docs.where(F.col(lang_col).isNotNull() & ~labelled.held_out(F.col(id_col))).where(F.length(text_col) > 0)
    # the texts are read here and for the documents chosen, whatever the number of languages
    langs = save(langs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")), "labelled")
    names = [r.lang for r in langs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).select("lang").collect()]
    names.sort()
    if not names:
        return Chain([])
    each = max(1, rows // len(names))
    # planned as a group limit: a map task keeps so many rows of each language
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    learned = langs.sparkSession.createDataFrame([(x,) for x in names], "l_lang string")
    picked = langs.withColumn("place", place).where(F.col("place") <= each).drop("place").join(F.broadcast(learned), F.col("lang") == F.col("l_lang"), "left_semi")
    picked = picked.select(F.col("id").alias("p_id"), "lang").distinct()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("own")).join(
        F.broadcast(picked), (F.col("id") == F.col("p_id")) & (F.col("own") == F.col("lang")))
    size = F.length("text")
    slices = F.concat_ws("\n", *(F.substring("text", F.floor(size * i / SLICES).cast("int") + 1, F.lit(SLICE)) for i in range(SLICES)))
    found = found.withColumn("text", F.when(F.octet_length("text") > SAMPLE_BYTES, slices).otherwise(F.col("text")))
    held = found.orderBy("id", "text").limit(rows).select("text", "lang").collect()
    y = np.array([names.index(r.lang) for r in held])
    return _fit(Chain(names), [r.text.encode() for r in held], y)


def label_words(b: W.Bytes, chain: Chain) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every word of the texts, and the index of each text's first word."""
    b = b.lower_ascii()
    starts, ends, first = letter_runs(b)
    if not len(starts):
        return np.zeros((0, len(chain.labels))), first
    # a chain is a line of a document
    border = np.zeros(len(b.data) + 1, bool)
    border[b.offsets] = True
    border[np.flatnonzero(b.data == 10)] = True
    line = np.cumsum(border)[starts]
    chains = np.concatenate([np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])), [len(starts)]])
    return chain.marginals(chain.emissions(b, starts, ends), chains), first


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score (mean marginal), word_share (per language).

    Null texts and texts without a letter are ``und`` with score 0; so is every
    text if no document has a language to learn from.  Held-out documents are
    never learned from, and a prediction sees the text alone.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col, lang_col, rows))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            for part in W.chunks(batch, "text"):
                b = W.texts(part.column(1))
                langs, score = np.full(len(b), UNKNOWN, object), np.zeros(len(b))
                share = np.zeros((len(b), len(chain.labels)))
                if chain.labels:
                    p, first = label_words(b, chain)
                    total = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)])
                    n = np.diff(first)
                    share = (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)[:, None]
                    ascii_letter = np.concatenate([[0], np.cumsum(W.is_letter(b.data) & (b.data < 128))])
                    lettered = ascii_letter[b.offsets[1:]] > ascii_letter[b.offsets[:-1]]
                    for i in np.flatnonzero((n > 0) & ~lettered):  # letters, or other non-ASCII characters only?
                        lettered[i] = any(c.isalpha() for c in part.column(1)[int(i)].as_py())
                    share[~lettered] = 0
                    best = share.argmax(axis=1)
                    langs[lettered] = np.array(chain.labels, object)[best[lettered]]
                    score = np.clip(share[np.arange(len(b)), best], 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(share.tolist(), pa.list_(pa.float64()))],
                    ["id", "lang_pred", "score", "word_share"])

    kind = narrow.schema["id"].dataType.simpleString()
    out = narrow.mapInArrow(predict, f"id {kind}, lang_pred string, score double, word_share array<double>")
    return out.select(F.col("id").alias(id_col), labelled.held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "word_share")
