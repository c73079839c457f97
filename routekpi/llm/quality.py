"""Quality classifier: ordinal cumulative-link regression on hashed text.

Grades are ordered 0..K-1.  All thresholds share one weight vector over hashed
features of the text: P(grade >= k) = sigmoid(score - threshold[k-1]).  A text's
score is the mean weight of its features, so whole texts of any length cost one
look-up per feature.  Features of a word: its bytes, its shape (the classes of
its first, last and middle bytes and its length), its last two bytes, and
whether it repeats one of the two words before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from routekpi.llm import labelled
from routekpi.llm import words as W
from routekpi.llm.scratch import fresh, save, ship

BITS = 18
#: The model is fitted on at most so many labelled documents (whole texts).
SAMPLE = 8192
PASSES, RATE, SHRINK, BATCH = 12, 0.5, 1e-6, 64
#: Least probability of at least this grade for a document to be selected.
MIN_GRADE, MIN_PROBABILITY = 1, 0.5


def _classes(data: np.ndarray) -> np.ndarray:
    """0 lower case or non-ASCII, 1 upper case, 2 digit, 3 and more: symbols by their bits."""
    table = np.zeros(256, np.uint64)
    table[:128] = 3 + np.arange(128) % 13
    table[97:123] = table[128:] = 0
    table[65:91], table[48:58] = 1, 2
    return table[data]


def features(b: W.Bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words and where each text's begin."""
    words, starts, ends, first = W.word_hashes(b)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(len(b) + 1, np.int64)
    kind = _classes(b.data)
    length = np.minimum(ends - starts, 15).astype(np.uint64)
    middle = kind[(starts + ends - 1) // 2]
    shape = ((kind[starts] * np.uint64(17) + kind[ends - 1]) * np.uint64(17) + middle) * np.uint64(16) + length
    tail = b.data[ends - 1].astype(np.uint64) * np.uint64(256) + b.data[np.maximum(ends - 2, starts)]
    doc = W.owners(first)
    again = np.zeros(len(words), np.uint64)
    for back in (2, 1):
        same = np.zeros(len(words), bool)
        same[back:] = (words[back:] == words[:-back]) & (doc[back:] == doc[:-back])
        again[same] = back
    out = np.empty((len(words), 4), np.uint64)
    for k, value in enumerate((words, shape, tail, again)):
        out[:, k] = W.mix64(value + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(64 - BITS)
    return out.ravel().astype(np.int64), first * 4


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[at[i]:at[i+1]]."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


class OrdinalModel:
    """Shared weights and ordered thresholds."""

    def __init__(self, grades: int):
        self.weights = np.zeros(1 << BITS)
        self.thresholds = np.linspace(-0.5, 0.5, grades - 1) if grades > 1 else np.zeros(0)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, a row for each score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))

    def fit(self, index: list[np.ndarray], share: list[np.ndarray], y: np.ndarray, seed: int = 3) -> OrdinalModel:
        """Adagrad on the likelihood of the grades, mini-batches in a fixed order."""
        rng = np.random.default_rng(seed)
        squares, t_squares = np.full(len(self.weights), 1e-8), np.full(len(self.thresholds), 1e-8)
        for _ in range(PASSES):
            order = rng.permutation(len(y))
            for i in range(0, len(y), BATCH):
                rows = order[i : i + BATCH]
                at = np.concatenate([[0], np.cumsum([len(index[r]) for r in rows])])
                ids, x = np.concatenate([index[r] for r in rows]), np.concatenate([share[r] for r in rows])
                score = _sums(self.weights[ids] * x, at)
                # bounds of the grade's slice of the logistic distribution
                edge = np.concatenate([[-np.inf], self.thresholds, [np.inf]])
                low, high = edge[y[rows]] - score, edge[y[rows] + 1] - score
                a, c = 1 / (1 + np.exp(-np.clip(low, -500, 500))), 1 / (1 + np.exp(-np.clip(high, -500, 500)))
                a[y[rows] == 0], c[y[rows] == len(self.thresholds)] = 0, 1
                p = np.maximum(c - a, 1e-12)
                d_low, d_high = a * (1 - a) / p, c * (1 - c) / p  # of log p, by -low and by high
                slope = d_low - d_high  # of log p by the score
                grad = np.bincount(ids, np.repeat(slope, np.diff(at)) * x, minlength=0) / len(rows)
                used = np.unique(ids)
                step = grad[used] - SHRINK * self.weights[used]
                squares[used] += step * step
                self.weights[used] += RATE * step / np.sqrt(squares[used])
                t = np.zeros(len(self.thresholds) + 2)
                np.add.at(t, y[rows], -d_low)
                np.add.at(t, y[rows] + 1, d_high)
                t = t[1:-1] / len(rows)
                t_squares += t * t
                self.thresholds = np.sort(self.thresholds + RATE * t / np.sqrt(t_squares))
        return self


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(y, index, share): each text's distinct features and their shares of all."""
    for batch in batches:
        for part in W.chunks(batch, "text"):
            ids, at = features(W.texts(part.column(0)))
            out = [np.unique(ids[i:j], return_counts=True) for i, j in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.array([o[0].astype(np.int32).tobytes() for o in out], pa.binary()),
                 pa.array([(o[1] / max(1, o[1].sum())).astype(np.float32).tobytes() for o in out], pa.binary())],
                ["y", "index", "share"])


def train(graded: DataFrame, grades: int) -> OrdinalModel:
    """Fit on (id, text, y), a bounded sample; texts are reduced to features by tasks."""
    rows = graded.select("text", "y").mapInArrow(_counted, "y int, index binary, share binary").toPandas()
    rows = rows[rows["index"].map(len) > 0].sort_values(["y", "index"], ignore_index=True)  # a fixed order
    model = OrdinalModel(grades)
    if len(rows):
        index = [np.frombuffer(x, np.int32) for x in rows["index"]]
        model.fit(index, [np.frombuffer(x, np.float32).astype(float) for x in rows["share"]], rows["y"].to_numpy())
    return model


def grade(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (or the id), expected_grade, p_1 .. p_K-1 of every row.

    Texts without any word, null ones too, have grade 0 for certain.
    """
    ship(docs.sparkSession)
    keep = keep or [id_col]
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))
    own = docs.select(*keep)
    names = [fresh(own, "expected_grade"), *(fresh(own, f"p_{k + 1}") for k in range(len(model.thresholds)))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, thresholds = shared.value
        model = OrdinalModel(1)
        model.thresholds = thresholds
        for batch in batches:
            for part in W.chunks(batch, text_col):
                ids, at = features(W.texts(part.column(part.schema.get_field_index(text_col))))
                n = np.diff(at)
                tails = model.tails(_sums(weights[ids].astype(float), at) / np.maximum(n, 1)) * (n > 0)[:, None]
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(tails.sum(axis=1)), *(pa.array(t) for t in tails.T)], [*keep, *names])

    wanted = docs.select(*dict.fromkeys([*keep, text_col]))
    schema = own
    for name in names:
        schema = schema.withColumn(name, F.lit(0.0))
    return wanted.mapInArrow(score, schema.schema)


def grades_of(labels: DataFrame) -> F.Column:
    """The rating that the labels give: 0 junk, 1 good but toxic, 2 good."""
    return F.col("quality") * (2 - F.coalesce(F.col("toxic"), F.lit(0)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_grade: int = MIN_GRADE,
             min_probability: float = MIN_PROBABILITY, rows: int = SAMPLE) -> DataFrame:
    """One row per input row: id, expected_grade, p_good, selected, held_out.

    The grades are ``grades_of(labels)``; ``p_good`` is the probability of
    ``min_grade`` or more and ``selected`` says whether it is at least
    ``min_probability``.  Held-out documents are never learned from.  Texts
    without words are not selected; without labels every other text is.
    """
    ship(docs.sparkSession)
    model = train(save(labelled.sample(docs, labels, grades_of(labels), rows, id_col, text_col), "graded"), 3)
    out = grade(docs, model, id_col, text_col)
    p = F.col(f"p_{min_grade}")
    return out.select(id_col, "expected_grade", p.alias("p_good"), (p >= min_probability).alias("selected"), labelled.held_out(F.col(id_col)).alias("held_out"))


def select(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_grade: int = MIN_GRADE,
           min_probability: float = MIN_PROBABILITY, rows: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that ``classify`` selects, with their columns."""
    ship(docs.sparkSession)
    model = train(save(labelled.sample(docs, labels, grades_of(labels), rows, id_col, text_col), "graded"), 3)
    out = grade(docs, model, id_col, text_col, docs.columns)
    return out.where(F.col(fresh(docs, f"p_{min_grade}")) >= min_probability).select(docs.columns)
