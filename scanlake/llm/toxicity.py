"""Toxicity of whole texts by a bidirectional gated recurrent network with attention pooling.

A text is cut into overlapping windows of ``WINDOW`` words, ``STRIDE`` apart; the last one ends with the text.
A word enters as its hashed embedding and the mean of its hashed character trigrams' embeddings. One network
reads a window forwards, one backwards; attention weighs the places; a linear layer gives the window's score.
A text's score is that of its highest window.

The network is trained in numpy on the driver with Adam, on a bounded sample: of each label the rows with the
smallest hash of doc_id, ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` of them, whole texts. As labels belong to
texts, each epoch learns from the window that scores highest so far. Rows whose crc32(doc_id as text) mod 5
is 0 are never learned from. Scoring is one pass over the table without an exchange; the weights (under 0.5
MB) go out with the tasks. Equal words of a batch are projected once.

Null and empty texts are one window without words: its score is the bias. Null labels and labels without a
document do not count; of several labels of a row the largest does. Without both labels in the sample every
score is the sample's share of toxic rows, 0 without any. A null doc_id is not held out. Repeated rows get
equal scores. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import id_and_text, pieces, slices
from scanlake.llm.features import Vocabulary, trigram_hashes, word_hashes

WINDOW = 64
STRIDE = 32
HIDDEN = 8
WORD_BUCKETS, WORD_SIZE = 1 << 13, 8
CHAR_BUCKETS, CHAR_SIZE = 1 << 12, 8
SAMPLE_TOXIC, SAMPLE_CLEAN = 600, 1200
EPOCHS = 12
#: A small sample is gone through more often.
LEAST_EXAMPLES = 20_000
BATCH = 64
RATE = 0.01
FOLDS = 5
PIECE_CHARS = 300_000
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
Params = dict[str, np.ndarray]


def new_params(seed: int = 7) -> Params:
    rng = np.random.default_rng(seed)

    def small(*shape: int, by: float = 0.3) -> np.ndarray:
        return (rng.standard_normal(shape) * by).astype(np.float32)

    size = WORD_SIZE + CHAR_SIZE
    params = {
        "words": small(WORD_BUCKETS, WORD_SIZE, by=0.1),
        "chars": small(CHAR_BUCKETS, CHAR_SIZE, by=0.1),
        "into": small(size, 6 * HIDDEN),
        "bias": np.zeros(6 * HIDDEN, np.float32),
        "attend": small(2 * HIDDEN, HIDDEN),
        "attend_bias": np.zeros(HIDDEN, np.float32),
        "weigh": small(HIDDEN),
        "out": small(2 * HIDDEN),
        "out_bias": np.zeros(1, np.float32),
    }
    for side in "fb":
        params[f"own_{side}"] = small(HIDDEN, 3 * HIDDEN)
    return params


class Words:
    """Distinct words of some texts with their buckets, and the windows of every text."""

    def __init__(self, texts: list[str]):
        vocabulary = Vocabulary([t.lower().split() for t in texts])
        codes, starts = vocabulary.bytes()
        self.count = len(vocabulary.words)
        self.bucket = (word_hashes(codes, starts) % np.uint64(WORD_BUCKETS)).astype(np.int64)
        trigrams, self.owner = trigram_hashes(codes, starts)
        self.trigram = (trigrams % np.uint64(CHAR_BUCKETS)).astype(np.int64)
        self.first = np.searchsorted(self.owner, np.arange(self.count + 1))
        self.numbers, self.lengths = vocabulary.numbers, vocabulary.lengths
        # A window: where its words begin among all, how many they are, and its text.
        begin = np.cumsum(self.lengths) - self.lengths
        many = np.maximum(0, -(-(self.lengths - WINDOW) // STRIDE)) + 1
        self.text = np.repeat(np.arange(len(texts)), many)
        step = np.arange(len(self.text)) - np.repeat(np.cumsum(many) - many, many)
        last = np.maximum(0, self.lengths[self.text] - WINDOW)
        self.begin = begin[self.text] + np.minimum(step * STRIDE, last)
        self.size = np.minimum(self.lengths[self.text], WINDOW)
        self.first_window = np.cumsum(many) - many

    def inputs(self, params: Params, some: np.ndarray | None = None) -> np.ndarray:
        """What enters for each distinct word: its embedding and the mean of its trigrams'."""
        if some is None:
            some = np.arange(self.count)
        n = self.first[some + 1] - self.first[some]
        at = np.repeat(self.first[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        if not len(some):
            return np.zeros((0, WORD_SIZE + CHAR_SIZE), np.float32)
        sums = np.add.reduceat(params["chars"][self.trigram[at]], np.cumsum(n) - n, axis=0)
        means = (sums / n[:, None]).astype(np.float32)
        return np.concatenate((params["words"][self.bucket[some]], means), 1)

    def windows(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of windows, time first, ``count`` where a window has ended; and where it has not."""
        places = np.arange(int(self.size[some].max(initial=0)))
        inside = places[:, None] < self.size[some]
        at = np.minimum(self.begin[some] + places[:, None], max(0, len(self.numbers) - 1))
        numbers = self.numbers[at] if len(self.numbers) else np.zeros(at.shape, np.int64)
        return np.where(inside, numbers, self.count), inside


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _read(entered: np.ndarray, own: np.ndarray, numbers: np.ndarray, mask: np.ndarray | None, back: bool, trace=None):
    """Hidden states of one direction: time, unit, window, so that every operation runs along the windows.

    ``entered`` holds the projected words in columns, the last one for no word.
    """
    time, many = numbers.shape
    states = np.empty((time, HIDDEN, many), np.float32)
    h = np.zeros((HIDDEN, many), np.float32)
    own = np.ascontiguousarray(own.T)
    for t in range(time - 1, -1, -1) if back else range(time):
        x = entered.take(numbers[t], axis=1)
        u = own @ h
        gates = _sigmoid(x[: 2 * HIDDEN] + u[: 2 * HIDDEN])
        z, r = gates[:HIDDEN], gates[HIDDEN:]
        n = np.tanh(x[2 * HIDDEN :] + r * u[2 * HIDDEN :])
        if trace is not None:
            trace[t] = (h, z, r, n, u[2 * HIDDEN :])
        h = n + z * (h - n)
        if mask is not None:
            h = h * mask[t]
        states[t] = h
    return states


def projected(params: Params, inputs: np.ndarray) -> np.ndarray:
    """Words in columns, and one of zeros for no word."""
    out = np.zeros((6 * HIDDEN, len(inputs) + 1), np.float32)
    out[:, :-1] = (inputs @ params["into"] + params["bias"]).T
    return out


def forward(params: Params, entered: np.ndarray, numbers: np.ndarray, inside: np.ndarray, traces=None):
    """Scores of windows before the logistic function, and what the way back needs."""
    whole = bool(inside.all())
    mask = None if whole else inside.astype(np.float32)
    trace = traces or [None, None]
    f = _read(entered[: 3 * HIDDEN], params["own_f"], numbers, mask, False, trace[0])
    b = _read(entered[3 * HIDDEN :], params["own_b"], numbers, mask, True, trace[1])
    states = np.concatenate((f, b), 1)
    hidden = np.tanh(np.matmul(params["attend"].T, states) + params["attend_bias"][:, None])
    score = np.matmul(params["weigh"][None, None, :], hidden)[:, 0]
    if not whole:
        score = np.where(inside, score, np.float32(-1e9))
    weight = np.exp(score - score.max(0, initial=-1e9))
    if not whole:
        weight = weight * mask
    weight /= np.maximum(weight.sum(0), np.float32(1e-9))
    pooled = (weight[:, None] * states).sum(0, dtype=np.float32)
    return params["out"] @ pooled + params["out_bias"][0], (states, hidden, weight, pooled, mask)


def scores(params: Params, words: Words) -> np.ndarray:
    """Of each window, before the logistic function."""
    entered = projected(params, words.inputs(params))
    out = np.empty(len(words.text), np.float32)
    whole = words.size == WINDOW
    for group in (np.flatnonzero(whole), np.flatnonzero(~whole)):
        for at in range(0, len(group), 2048):
            some = group[at : at + 2048]
            out[some] = forward(params, entered, *words.windows(some))[0]
    return out


def text_scores(params: Params, words: Words) -> np.ndarray:
    if not len(words.lengths):
        return np.zeros(0)
    return np.maximum.reduceat(scores(params, words), words.first_window)


def gradients(params: Params, words: Words, some: np.ndarray, labels: np.ndarray) -> Params:
    """Of the mean logistic loss over some windows."""
    numbers, inside = words.windows(some)
    used, local = np.unique(numbers, return_inverse=True)
    local = local.reshape(numbers.shape)
    real = used[used < words.count]
    x = words.inputs(params, real)
    entered = projected(params, x)
    traces: list[dict] = [{}, {}]
    logits, (states, hidden, weight, pooled, mask) = forward(params, entered, local, inside, traces)
    grad = {k: np.zeros_like(v) for k, v in params.items()}
    d = ((_sigmoid(logits) - labels) / len(some)).astype(np.float32)
    grad["out"], grad["out_bias"] = pooled @ d, d.sum(keepdims=True)
    d_pooled = params["out"][:, None] * d
    d_weight = (states * d_pooled).sum(1)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    grad["weigh"] = (hidden * d_score[:, None]).sum((0, 2))
    d_hidden = d_score[:, None] * params["weigh"][:, None] * (1 - hidden**2)
    grad["attend"] = np.matmul(states, d_hidden.transpose(0, 2, 1)).sum(0)
    grad["attend_bias"] = d_hidden.sum((0, 2))
    d_states = weight[:, None] * d_pooled + np.matmul(params["attend"], d_hidden)
    time = len(local)
    d_entered = np.zeros((6 * HIDDEN, len(real) + 1))
    for side, trace, first in (("f", traces[0], 0), ("b", traces[1], HIDDEN)):
        own = params[f"own_{side}"]
        d_inputs = np.zeros((time, 3 * HIDDEN, len(some)), np.float32)
        d_h = np.zeros((HIDDEN, len(some)), np.float32)
        for t in range(time) if side == "b" else range(time - 1, -1, -1):
            h, z, r, n, u = trace[t]
            d_h = d_h + d_states[t, first : first + HIDDEN]
            if mask is not None:
                d_h = d_h * mask[t]
            d_n = d_h * (1 - z) * (1 - n**2)
            d_z = d_h * (h - n) * z * (1 - z)
            d_r = d_n * u * r * (1 - r)
            d_inputs[t] = np.concatenate((d_z, d_r, d_n))
            d_u = np.concatenate((d_z, d_r, d_n * r))
            grad[f"own_{side}"] += h @ d_u.T
            d_h = d_h * z + own @ d_u
        flat = local.ravel()
        for k in range(3 * HIDDEN):
            d_entered[3 * first + k] = np.bincount(flat, d_inputs[:, k].ravel(), len(real) + 1)
    d_entered = d_entered[:, : len(real)].T
    grad["into"] = (x.T @ d_entered).astype(np.float32)
    grad["bias"] = d_entered.sum(0).astype(np.float32)
    d_x = d_entered @ params["into"].T
    np.add.at(grad["words"], words.bucket[real], d_x[:, :WORD_SIZE])
    n = words.first[real + 1] - words.first[real]
    at = np.repeat(words.first[real] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    np.add.at(grad["chars"], words.trigram[at], np.repeat(d_x[:, WORD_SIZE:] / n[:, None], n, 0))
    return grad


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Params:
    params = new_params(seed)
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1:
        for value in params.values():
            value[...] = 0
        params["out_bias"][0] = 30.0 if share else -30.0
        return params
    params["out_bias"][0] = np.log(share / (1 - share))
    words = Words(texts)
    rng = np.random.default_rng(seed)
    epochs = max(epochs, min(60, LEAST_EXAMPLES // len(texts)))
    many = np.diff(np.append(words.first_window, len(words.text)))
    m = {k: np.zeros_like(v) for k, v in params.items()}
    v = {k: np.zeros_like(x) for k, x in params.items()}
    step = 0
    for epoch in range(epochs):
        if epoch < 2:  # nothing is known yet: windows by chance
            chosen = words.first_window + (rng.random(len(texts)) * many).astype(np.int64)
        else:
            found = scores(params, words)
            order = np.lexsort((found, words.text))
            chosen = order[words.first_window + many - 1]
        mix = rng.permutation(len(texts))
        for at in range(0, len(mix), BATCH):
            own = mix[at : at + BATCH]
            grad = gradients(params, words, chosen[own], labels[own])
            step += 1
            rate = RATE * min(1.0, 2 * (1 - epoch / epochs))
            for k, g in grad.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                params[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return params


def fold():
    """crc32(doc_id as text) mod 5; 0 is held out."""
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    known = (
        labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic")).where(fold() != 0)
        # Labels of other documents must not use up the sample.
        .join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = (
        known.where("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC)
        .unionByName(known.where("toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN))
        .withColumnRenamed("doc_id", "labelled")
    )
    rows = (
        id_and_text(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .select("doc_id", "text", "toxic").collect()
    )
    rows.sort()
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.float32)


def learned(docs: DataFrame, labels: DataFrame) -> Params:
    return train(*labelled_sample(docs, labels))


def probabilities(params: Params, texts: list[str]) -> np.ndarray:
    return _sigmoid(text_scores(params, Words(texts)).astype(np.float64))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    params = learned(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in pieces(batches, PIECE_CHARS):
            p = probabilities(params, texts)
            yield pa.record_batch(
                [pa.array(doc_ids, pa.int64()), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    found = id_and_text(docs).mapInArrow(run, "doc_id long, score double, predicted int")
    return found.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the table, all columns, whose text scores below one half."""
    params = learned(docs, labels)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(place).to_pylist()]
            keep: list[bool] = []
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < PIECE_CHARS:
                    size += len(texts[end])
                    end += 1
                keep += (probabilities(params, texts[at:end]) < 0.5).tolist()
                at = end
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
