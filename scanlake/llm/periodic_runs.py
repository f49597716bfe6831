"""Stretches of words that repeat with a short period, found by seeding and extending on diagonals.

A run is a stretch of consecutive words whose smallest period is q, at least ``max(6, 4 q)`` words long, which
no neighbouring word extends keeping that period. On the diagonal of lag q it is a row of equal words that
overlaps itself by at least ``max(5, 3 q)`` words. So lags are taken in ranges: for lags from q on, the texts'
k-grams of that guaranteed overlap are indexed, and of each k-gram the pair of an occurrence and the next one in
the same document is a seed if its distance lies in the range. Within a run every k-gram that fits seeds exactly
its lag, as k reaches ``2 * lag - 1``: a nearer repeat would give the run a smaller period. Seeds next to each
other on a diagonal are one; too few of them cannot belong to a run. The rest are extended both ways, and a table
of the furthest place covered on each diagonal keeps a stretch from being extended twice.

K-grams are named exactly, by doubling: the name of a longer one comes from the names of two shorter ones that
cover it. Places whose k-gram occurs once in their document are left out of all longer ones, so ordinary text
costs a few passes, whatever its length. All documents of a batch take these passes together, in numpy.

One pass over the table without an exchange; a task holds about ``PIECE_CHARS`` of text, or one longer text.
Null text is empty text and has no runs. Texts of any length are taken whole. Repeated rows give repeated
results, a null doc_id stays null, an empty table gives no rows, other columns are ignored. Of runs of equal
length the one with the smallest start, then the smallest period, is the longest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scanlake.llm.common import id_and_text, pieces

SHORTEST, REPEATS = 6, 4
PIECE_CHARS = 1_000_000
#: What a document's words are before its runs are sought: (doc_id, words) to words.
Prepare = Callable[[int | None, list[bytes]], list[bytes]]
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, "
    "n_words long, n_dropped long"
)
NAMES = [
    "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs",
    "n_words", "n_dropped",
]
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Grams:
    """Places whose k-gram occurs twice or more in its document, ascending, and the k-grams' names."""

    def __init__(self, words: np.ndarray, owner: np.ndarray):
        self.k, self.total = 1, len(words)
        self.places, self.names = self._repeated(np.arange(len(words)), owner << 32 | words)

    def _repeated(self, places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
        often = counts[names] > 1
        return places[often], names[often]

    def grow(self, k: int) -> None:
        while self.k < k and len(self.places):
            step = min(self.k, k - self.k)
            # The longer gram at p is the gram at p and the one ``step`` later. Names carry their document.
            at = np.minimum(np.searchsorted(self.places, self.places + step), len(self.places) - 1)
            both = self.places[at] == self.places + step
            keys = self.names[both] << 32 | self.names[at[both]]
            self.places, self.names = self._repeated(self.places[both], keys)
            self.k += step

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and the distance to the next place with the same gram."""
        order = np.argsort(self.names, kind="stable")
        same = self.names[order[1:]] == self.names[order[:-1]]
        places = self.places[order]
        return places[:-1][same], (places[1:] - places[:-1])[same]


def _extended(words: np.ndarray, at: int, end: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The widest [at, end) around the given one in which words equal those ``lag`` later, inside [low, high)."""
    step = 16
    while at > low:
        a = max(low, at - step)
        differ = np.flatnonzero(words[a:at] != words[a + lag : at + lag])
        if len(differ):
            at = a + int(differ[-1]) + 1
            break
        at, step = a, step * 2
    step = 16
    while end + lag < high:
        b = min(high - lag, end + step)
        differ = np.flatnonzero(words[end:b] != words[end + lag : b + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = b, step * 2
    return at, end


def find_runs(words: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of every run, by document, start and period; ``words``: all documents' word numbers."""
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    grams = _Grams(words.astype(np.int64), owner)
    found: list[tuple[int, int, int, int]] = []
    least_lag = 1
    while len(grams.places):
        overlap = max(SHORTEST - 1, (REPEATS - 1) * least_lag)
        last_lag = (overlap + 1) // 2
        grams.grow(overlap)
        if not len(grams.places):
            break
        places, lags = grams.seeds()
        inside = (lags >= least_lag) & (lags <= last_lag)
        places, lags = places[inside], lags[inside]
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        new = np.ones(len(places), bool)
        new[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
        begin = np.flatnonzero(new)
        many = np.diff(np.append(begin, len(places)))
        lag = lags[begin]
        needed = np.maximum(SHORTEST, REPEATS * lag) - lag - overlap + 1
        covered: dict[int, int] = {}
        for k in np.flatnonzero(many >= needed).tolist():
            at, q = int(places[begin[k]]), int(lag[k])
            if at < covered.get(q, 0):
                continue
            doc = int(owner[at])
            low, high = int(ends[doc] - lengths[doc]), int(ends[doc])
            a, b = _extended(words, at, at + int(many[k]) - 1 + overlap, q, low, high)
            covered[q] = b
            if b - a + q >= max(SHORTEST, REPEATS * q):
                found.append((doc, a - low, b - a + q, q))
        least_lag = last_lag + 1
    return sorted(found, key=lambda r: (r[0], r[1], r[3]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _rows(batches: Iterator[pa.RecordBatch], prepare: Prepare | None) -> Iterator[pa.RecordBatch]:
    for doc_ids, texts in pieces(batches, PIECE_CHARS):
        # On bytes, split() knows the six white space characters only.
        lists = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        if prepare:
            lists = [prepare(d, w) for d, w in zip(doc_ids, lists, strict=True)]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        number = _Numbers().__getitem__
        words = np.fromiter((number(w) for own in lists for w in own), np.int64, int(lengths.sum()))
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for doc, *run in find_runs(words, lengths):
            runs.setdefault(doc, []).append(tuple(run))
        rows = []
        for n, (doc_id, own) in enumerate(zip(doc_ids, lists, strict=True)):
            of_doc = runs.get(n, [])
            start, length, period = min(of_doc, key=lambda r: (-r[1], r[0], r[2])) if of_doc else (None, None, None)
            kept = collapsed(own, of_doc) if of_doc else own
            told = "".join(f"{s},{m},{p}\n" for s, m, p in of_doc)
            rows.append((
                doc_id, len(of_doc), start, length, period, 1000 * length // period if of_doc else None,
                hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
                [{"start": s, "length": m, "period": p} for s, m, p in of_doc], len(own), len(own) - len(kept),
            ))
        types = [pa.int64()] * 6 + [pa.string()] * 2 + [_RUN] + [pa.int64()] * 2
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=NAMES)


def periodic_runs(docs: DataFrame, prepare: Prepare | None = None) -> DataFrame:
    """Of each document its runs, the longest one, and digests of the runs and of the text without repeats."""
    return id_and_text(docs).mapInArrow(lambda batches: _rows(batches, prepare), SCHEMA)


def collapse_words(text: str) -> str:
    """The words of a text joined by one space, without those that runs repeat."""
    words = text.encode("utf-8", "surrogatepass").split()
    number = _Numbers().__getitem__
    runs = find_runs(np.array([number(w) for w in words], np.int64), np.array([len(words)]))
    return b" ".join(collapsed(words, [r[1:] for r in runs])).decode("utf-8", "surrogatepass")
