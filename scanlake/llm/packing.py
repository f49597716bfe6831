"""Packing documents into windows of at most 2048 ids, in order, cut where it costs least.

Each task takes the documents of its partition in order of doc_id as one stream of ids. It may cut after a
document (free), after a sentence (a small penalty, as the document is truncated) and, only in sentences longer
than a window, elsewhere (a larger one). Dynamic programming over these places minimises padding plus
penalties: the best cost up to a place is its own penalty plus the least ``cost + position`` among the places of
one window before it, which a monotone queue gives in constant time. A sequence whose length is a power of two is not
padded: places that lie exactly such a length (of at least ``SHORTEST``) before are tried beside the queue.
Sequences follow each other without gaps in the stream, so order is kept and every id lies in one piece.

The stream is solved in runs of about ``RUN_IDS``. All sequences of a run but the last are emitted, the last
begins the next run: only the end of a partition is padded because the stream ends. That one rest is cut into
powers of two, within a sentence if need be, where this costs less than its padding; these few cuts a partition
do not grow with the documents. No exchange; a task holds one run.

Null text is empty text: the end id alone. Repeated rows are packed each. Null doc_ids come first. An empty
table gives no rows. Other columns are ignored. sequence_id is the partition's number times 2^32 plus a count.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from scanlake.llm.common import id_and_text, pieces
from scanlake.llm.tokenizing import word_level

WINDOW = 2048
RUN_IDS = 400_000
SENTENCE_PENALTY = 4
OTHER_PENALTY = 12
#: Sentences longer than a window may also be cut at places this far apart.
INNER_STEP = 16
#: Shortest sequence that is cut for its power of two.
SHORTEST = 64
PIECE_CHARS = 600_000
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
SCHEMA = ", ".join(f"{c} long" for c in COLUMNS)


def cut_places(
    document_ends: np.ndarray, sentence_ends: np.ndarray, window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray]:
    """Places that may be cut, ascending, 0 first and the end last, and the penalty of each."""
    total = int(document_ends[-1])
    marks = np.unique(np.concatenate(([0], document_ends, sentence_ends)))
    gaps = np.diff(marks)
    long = np.flatnonzero(gaps > window)
    more = (gaps[long] - 1) // INNER_STEP
    extra = np.repeat(marks[long], more)
    step = np.arange(len(extra)) - np.repeat(np.cumsum(more) - more, more) + 1
    places = np.sort(np.concatenate((marks, extra + step * INNER_STEP)))
    penalty = np.full(len(places), OTHER_PENALTY)
    penalty[np.isin(places, sentence_ends)] = SENTENCE_PENALTY
    penalty[np.isin(places, document_ends)] = 0
    penalty[0] = 0
    return places[places <= total], penalty[places <= total]


def unpadded_before(places: np.ndarray, window: int) -> list[list[int]]:
    """Of each place the indexes of those before it by a power of two, from ``SHORTEST`` to under a window."""
    found = [[] for _ in places]
    size = SHORTEST
    while size < window:
        at = np.searchsorted(places, places - size)
        for j in np.flatnonzero(places[at] == places - size).tolist():
            found[j].append(int(at[j]))
        size *= 2
    return found


def best_cuts(places: list[int], penalties: list[int], window: int, unpadded=None, last_cost=None) -> list[int]:
    """Indexes of the chosen places, first and last included. No two neighbours are over a window apart.

    ``unpadded`` lists for each place those before it from which a sequence has no padding.
    ``last_cost`` gives the cost of a last sequence by its length, if that is not its padding.
    """
    cost = [0] * len(places)
    came = [0] * len(places)
    queue = deque([(places[0], places[0], 0)])  # cost + position (ascending), position, index
    for j in range(1, len(places)):
        place = places[j]
        while queue[0][1] < place - window:
            queue.popleft()
        least, _, came[j] = queue[0]
        best = least + window - place
        if unpadded:
            for i in unpadded[j]:
                if cost[i] < best:
                    best, came[j] = cost[i], i
        cost[j] = best + penalties[j]
        key = cost[j] + place
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, place, j))
    if last_cost and len(places) > 1:
        end = places[-1]
        came[-1] = min(
            (i for i in range(len(places) - 1) if places[i] >= end - window),
            key=lambda i: cost[i] + last_cost(end - places[i]),
        )
    cuts = [len(places) - 1]
    while cuts[-1]:
        cuts.append(came[cuts[-1]])
    return cuts[::-1]


def powers_of_two(length: int) -> list[int]:
    """Parts, each a power of two, that make up the length, largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


class Packer:
    """A stream of documents into windows; ``take`` adds documents and gives finished pieces."""

    def __init__(self, first_sequence: int, sentence_ids: np.ndarray, window: int = WINDOW):
        self.sequence, self.window = first_sequence, window
        self.is_sentence_end = sentence_ids
        self.ids = np.zeros(0, np.uint32)
        #: Of each document in the buffer: id, ids of it before the buffer, its ids in all, its end in the buffer.
        self.docs: list[tuple] = []

    def take(self, doc_ids: list, ids: np.ndarray, lengths: np.ndarray, last: bool = False) -> list[tuple]:
        ends = len(self.ids) + np.cumsum(lengths)
        self.docs += [(d, 0, int(n), int(e)) for d, n, e in zip(doc_ids, lengths, ends, strict=True)]
        self.ids = np.concatenate((self.ids, ids))
        if not len(self.ids) or not last and len(self.ids) < RUN_IDS:
            return []
        document_ends = np.array([e for *_, e in self.docs])
        known = self.is_sentence_end
        sentence_ends = np.flatnonzero(known[np.minimum(self.ids, len(known) - 1)]) + 1
        places, penalties = cut_places(document_ends, sentence_ends, self.window)
        unpadded = unpadded_before(places, self.window)
        places = places.tolist()
        # The last sequence begins the next run and costs nothing yet; at the end it may become powers of two.
        cost = self._rest_cost if last else lambda rest: 0
        cuts = [places[i] for i in best_cuts(places, penalties.tolist(), self.window, unpadded, cost)]
        rest = cuts[-1] - cuts[-2]
        if not last:
            cuts.pop()
        elif self._rest_cost(rest) < self.window - rest:
            cuts[-1:] = (cuts[-2] + np.cumsum(powers_of_two(rest))).tolist()
        return self._emit(cuts)

    def _rest_cost(self, rest: int) -> int:
        return min(self.window - rest, (rest.bit_count() - 1) * OTHER_PENALTY)

    def _emit(self, cuts: list[int]) -> list[tuple]:
        rows, at = [], 0
        starts = [0, *[e for *_, e in self.docs]]
        for begin, end in zip(cuts, cuts[1:]):
            while self.docs[at][3] <= begin:
                at += 1
            k = at
            while k < len(self.docs) and starts[k] < end:
                doc, before, total, doc_end = self.docs[k]
                a, b = max(begin, starts[k]), min(end, doc_end)
                rows.append(
                    (doc, before + a - starts[k], b - a, zlib.crc32(self.ids[a:b].tobytes()), total,
                     self.sequence, a - begin)
                )
                k += 1
            self.sequence += 1
        done = cuts[-1]
        left = []
        for k, (doc, before, total, end) in enumerate(self.docs):
            if end > done:
                left.append((doc, before + max(0, done - starts[k]), total, end - done))
        self.docs, self.ids = left, self.ids[done:].copy()
        return rows


def packed(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """One row per piece: where it comes from in its document and where it lies in its window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_level(tokenizer_path)
        vocabulary = encoder.library.get_vocab()
        sentence = np.zeros(max(max(vocabulary.values()), end_id) + 2, bool)
        for text, number in vocabulary.items():
            if text.removesuffix("</w>").endswith((".", "!", "?")):
                sentence[number] = True
        packer = Packer(TaskContext.get().partitionId() << 32, sentence, window)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=COLUMNS)

        for doc_ids, texts in pieces(batches, PIECE_CHARS):
            ids, lengths = encoder.encode(texts)
            if rows := packer.take(doc_ids, np.insert(ids, np.cumsum(lengths), end_id), lengths + 1):
                yield batch(rows)
        if rows := packer.take([], np.zeros(0, np.uint32), np.zeros(0, np.int64), last=True):
            yield batch(rows)

    return id_and_text(docs).sortWithinPartitions("doc_id").mapInArrow(run, SCHEMA)
