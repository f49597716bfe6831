"""Graded quality by ordinal cumulative-link regression on hashed text.

``P(grade <= k) = sigmoid(threshold[k] - score)`` with one score per text, the sum of shared weights over its
hashed words and word shapes, and thresholds in ascending order. The expected grade and the probability of
reaching a grade follow. The model is fitted in numpy on a bounded sample of rated rows, the
``SAMPLE_ROWS`` with the smallest hash of doc_id; texts of any length are scored whole, in one pass
without an exchange. The model, 2^16 weights, goes out with the task.

Null and empty texts have no words and get the score 0, so the thresholds alone decide. Ratings without a
document, null ratings and further ratings of a row do not count (the smallest rating does). Without ratings
of two different grades all weights are 0. Repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import id_and_text, pieces
from scanlake.llm.features import Vocabulary, mixed, word_hashes

BUCKETS = 1 << 16
SAMPLE_ROWS = 3000
EPOCHS = 120
RATE = 0.05
RIDGE = 1e-5
PIECE_CHARS = 1_500_000
SCHEMA = "doc_id long, score double, expected_grade double, tail_probability double, grade int, kept boolean"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, np.float64)))


def hashed_text(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: bucket and weight of its words and of their shapes; rows are bounded by ``starts``.

    A word counts by the logarithm of its number in the text, and a text's values have length one.
    """
    words = Vocabulary([t.split() for t in texts])
    codes, starts = words.bytes()
    own = word_hashes(codes, starts) % np.uint64(BUCKETS)
    # The shape: its bytes' classes (lower, upper, digit, beyond ASCII, other), repeats folded.
    kind = np.full(256, 4, np.uint8)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 0, 1, 2, 3
    classes = kind[codes]
    first = np.ones(len(codes), bool)
    first[1:] = classes[1:] != classes[:-1]
    first[starts[:-1][np.diff(starts) > 0]] = True
    kept = np.concatenate(([0], np.cumsum(first)))
    shapes = mixed(word_hashes(classes[first] + np.uint8(200), kept[starts])) % np.uint64(BUCKETS)
    owner = np.repeat(np.arange(len(texts)), words.lengths)
    keys = np.concatenate((owner * BUCKETS + own[words.numbers].astype(np.int64),
                           owner * BUCKETS + shapes[words.numbers].astype(np.int64)))
    keys, counts = np.unique(keys, return_counts=True)
    rows, buckets = keys // BUCKETS, keys % BUCKETS
    values = np.log1p(counts)
    norms = np.sqrt(np.bincount(rows, values**2, len(texts)))
    return rows, buckets, values / norms[rows]


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        rows, buckets, values = hashed_text(texts)
        return np.bincount(rows, self.weights[buckets] * values, len(texts)).astype(np.float64)

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """Column k: probability of a grade above k."""
        return sigmoid(scores[:, None] - self.thresholds)


def fit(texts: list[str], grades: np.ndarray, top: int) -> OrdinalModel:
    """Likelihood by Adam over all sampled rows; thresholds are a first one and positive steps."""
    weights = np.zeros(BUCKETS)
    share = np.array([(grades > k).mean() if len(grades) else 0.5 for k in range(top)])
    share = np.clip(np.minimum.accumulate(share), 0.001, 0.999)
    first = np.log((1 - share) / share)
    if len(set(grades.tolist())) < 2:
        return OrdinalModel(weights, first)
    rows, buckets, values = hashed_text(texts)
    steps = np.log(np.expm1(np.maximum(np.diff(first), 0.05)))
    params = np.concatenate((weights, [first[0]], steps))
    m, v = np.zeros_like(params), np.zeros_like(params)
    n = len(texts)
    for epoch in range(1, EPOCHS + 1):
        w, head, gaps = params[:BUCKETS], params[BUCKETS], params[BUCKETS + 1 :]
        cuts = head + np.concatenate(([0], np.cumsum(np.logaddexp(0, gaps))))
        score = np.bincount(rows, w[buckets] * values, n)
        below = np.concatenate((np.zeros((n, 1)), sigmoid(cuts - score[:, None]), np.ones((n, 1))), 1)
        p = np.maximum(below[np.arange(n), grades + 1] - below[np.arange(n), grades], 1e-9)
        slope = below * (1 - below)
        upper, lower = slope[np.arange(n), grades + 1], slope[np.arange(n), grades]
        d_score = (upper - lower) / p / n
        d_cuts = np.zeros((n, top + 2))
        d_cuts[np.arange(n), grades + 1] -= upper / p / n
        d_cuts[np.arange(n), grades] += lower / p / n
        d_cut = d_cuts.sum(0)[1:-1]
        d_gaps = np.cumsum(d_cut[::-1])[::-1][1:] * sigmoid(gaps)
        d_w = np.bincount(buckets, d_score[rows] * values, BUCKETS) + RIDGE * w
        grad = np.concatenate((d_w, [d_cut.sum()], d_gaps))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params - RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-8)
    gaps = params[BUCKETS + 1 :]
    cuts = params[BUCKETS] + np.concatenate(([0], np.cumsum(np.logaddexp(0, gaps))))
    return OrdinalModel(params[:BUCKETS].astype(np.float32), cuts)


def rated_sample(docs: DataFrame, ratings: DataFrame, grade: Column, most: int = SAMPLE_ROWS) -> tuple[list, np.ndarray]:
    """Texts and grades of the rated rows with the smallest hash of doc_id."""
    rated = (
        ratings.select(F.col("doc_id").alias("rated"), grade.cast("int").alias("grade"))
        .where("rated is not null and grade is not null")
        .groupBy("rated").agg(F.min("grade").alias("grade"))
        # Ratings of other documents must not use up the sample.
        .join(docs.select(F.col("doc_id").cast("long").alias("rated")), "rated", "left_semi")
        .orderBy(F.xxhash64("rated"), "rated").limit(most)
    )
    rows = id_and_text(docs).join(F.broadcast(rated), F.col("doc_id") == F.col("rated")).select("text", "grade").collect()
    rows.sort()
    return [r[0] for r in rows], np.array([r[1] for r in rows], np.int64)


def graded(docs: DataFrame, ratings: DataFrame, grade: Column, top: int, least: int = 1, chance: float = 0.5) -> DataFrame:
    """Expected grade, probability of at least grade ``least``, likeliest grade, and kept by that probability."""
    model = fit(*rated_sample(docs, ratings, grade), top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in pieces(batches, PIECE_CHARS):
            scores = model.scores(texts)
            above = model.at_least(scores)
            share = np.concatenate((np.ones((len(texts), 1)), above), 1) - np.concatenate((above, np.zeros((len(texts), 1))), 1)
            tail = above[:, least - 1]
            yield pa.record_batch(
                [
                    pa.array(doc_ids, pa.int64()), pa.array(scores), pa.array(above.sum(1)), pa.array(tail),
                    pa.array(share.argmax(1), pa.int32()), pa.array(tail >= chance),
                ],
                names=["doc_id", "score", "expected_grade", "tail_probability", "grade", "kept"],
            )

    return id_and_text(docs).mapInArrow(run, SCHEMA)
