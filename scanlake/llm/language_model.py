"""Log probabilities of texts from a log-frequency Bloom filter of quantised n-gram counts.

Texts are lower-cased (A-Z) and cut into words; every text ends with an end token. Chunks (``word_chunks``) hold
them as numbers.

1. *Words*. Each word's exact count in the training documents goes to the chunks that have it, and the sums N
   (tokens) and V (distinct tokens). These give the base probability ``(c + 0.5) / (N + 0.5 (V + 1))``.
2. *Filter*. Chunks send the n-grams of two to ``order`` words of their training documents with counts, equal
   ones combined, dealt out by hash into segments. A segment sums them exactly, then keeps of a count c only
   its level, ``1 + floor(log2 c)``, as that many entries (n-gram, 1), (n-gram, 2), ... of a Bloom filter of
   ``BITS_PER_ENTRY`` bits an entry. A segment's size follows its entries, so the whole filter grows with the
   corpus and its error does not.
3. *Probes*. The level of an n-gram is found by probing 1, 2, ... until a miss; the middle of the level's range
   is the estimated count, never more than its context's. A word's probability after a context is
   ``(count(context, word) + strength * shorter) / (count(context) + strength)``, ``shorter`` being the
   probability after the context without its first word, at last the base probability. The strength depends on
   the context's length. An unknown n-gram is taken for known with a chance of about 1 in 30 and counts as one.

A level is at most its count, so the tokens bound the filter's size before it is built. If that bound is at most
``broadcast_bytes`` the filter is broadcast and probed where the texts are. Beyond it no worker holds it whole:
chunks send the n-grams of all their documents, and the task that builds a segment probes it for them. Both ways
give equal results. N-grams are named by 40 bits within a segment, so the filter's own error is the one that
counts.

Null text is empty: the end token alone. Texts of any length are taken whole. Repeated rows count and are scored
each; a null doc_id stays null and belongs to the training documents if ``held_out`` says null. Without
training documents N and V are 0 and every token has probability 1. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import whole_text
from scanlake.llm.features import mixed, word_hashes
from scanlake.llm.word_chunks import (
    FEWEST_BUCKETS,
    Chunk,
    Numbers,
    answered,
    asked,
    bucket_number,
    by_bucket,
    chunk_rows,
    exchanged,
    packed,
    read_chunk,
    unpacked,
    with_answers,
    write_chunks,
)
from scanlake.session import written

ORDER = 3
#: By the words of the context: what the shorter context's probability weighs, in occurrences.
STRENGTHS = {1: 200.0, 2: 20.0}
#: Of the filter; 5 probes at 7.3 bits an entry find a missing entry by chance once in 32.
BITS_PER_ENTRY, PROBES = 7.3, 5
#: Every Python worker holds a copy of what is broadcast.
BROADCAST_BYTES = 32_000_000
NAME_BITS = 40
#: Scoring holds some twenty numbers for each token of a chunk.
CHUNK_TOKENS = 2_000_000
#: Tokens, for each size of n-gram, for which one segment is added.
SEGMENT_TOKENS = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = 0xD1B54A32D192ED03
_END, _BEGIN = np.uint64(0x632BE59BD9B4E019), np.uint64(0x8CB92BA72F3D8DD7)
SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _tokenise(texts: list[str], labels: list[str], numbers: Numbers) -> list[list[int]]:
    """Word numbers, the first token telling if the document is held out (1) or learned from (0)."""
    number = numbers.table().__getitem__
    # On bytes, lower() and split() know the letters A-Z and the six white space characters only.
    return [
        [int(label), *map(number, text.encode("utf-8", "surrogatepass").lower().split())]
        for text, label in zip(texts, labels, strict=True)
    ]


class _Tokens:
    """A chunk's tokens, end tokens included: the number of words stands for the end, one more for the start."""

    def __init__(self, chunk: Chunk):
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        self.held_out = chunk.tokens[starts].astype(bool)
        self.lengths = chunk.lengths
        self.end = len(chunk.words)
        # The place that said whether a document is held out becomes the end of the document before.
        self.tokens = np.append(chunk.tokens[1:], 0).astype(np.int64)
        self.ends = starts + chunk.lengths - 1
        self.starts = starts
        if len(self.ends):
            self.tokens[self.ends] = self.end
        self.learned = np.repeat(~self.held_out, self.lengths)
        offsets = np.frombuffer(chunk.words.buffers()[1], np.int64, self.end + 1, 8 * chunk.words.offset)
        data = np.frombuffer(chunk.words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.hashes = np.concatenate((word_hashes(data, offsets - offsets[0]), [_END, _BEGIN]))

    def before(self, back: int) -> np.ndarray:
        """The token so many places before each, the start token before a document's first."""
        out = np.concatenate((np.full(back, self.end + 1), self.tokens[:-back] if back < len(self.tokens) else []))
        out = out[: len(self.tokens)].astype(np.int64)
        for k in range(back):
            at = self.starts + k
            out[at[at <= self.ends]] = self.end + 1
        return out

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For two to ``order`` words: the distinct n-grams as hashes, and of each token the one that ends there."""
        local, keys = self.tokens, self.hashes
        for back in range(1, order):
            pairs, local = np.unique(self.before(back) << 32 | local, return_inverse=True)
            keys = mixed(keys[pairs & 0xFFFFFFFF] * _MIX + self.hashes[pairs >> 32])
            local = local.astype(np.int32)
            yield keys + np.uint64(back), local


def _send_words(buckets: int):
    def send(row: dict, chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        t = _Tokens(chunk)
        counts = np.bincount(t.tokens[t.learned], minlength=t.end + 1)
        order, parts = by_bucket((t.hashes[: t.end] % np.uint64(buckets)).astype(np.int64))
        for bucket, a, b in parts:
            own = order[a:b]
            yield bucket, packed(words=chunk.words.take(pa.array(own)), counts=counts[own])

    return send


def _count_words(bucket: int, blobs: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    parts = [unpacked(b) for b in blobs]
    coded = pa.chunked_array([p["words"] for p in parts]).combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy()
    total = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(total, codes, np.concatenate([p["counts"] for p in parts]))
    ends = np.cumsum([len(p["counts"]) for p in parts])[:-1]
    answers = [packed(counts=c) for c in np.split(total[codes], ends)]
    return answers, [packed(tokens=np.array([total.sum()]), distinct=np.array([np.count_nonzero(total)]))]


def _counts_of(row: dict, t: _Tokens, buckets: int, documents: int) -> np.ndarray:
    """Exact training counts of the chunk's words, then of the end token and the start."""
    order, parts = by_bucket((t.hashes[: t.end] % np.uint64(buckets)).astype(np.int64))
    answers = {a["bucket"]: unpacked(a["blob"])["counts"] for a in row["word_counts"] or []}
    counts = np.full(t.end + 2, documents, np.int64)
    for bucket, a, b in parts:
        counts[order[a:b]] = answers[bucket]
    return counts


def _dealt(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """An order by segment and name, the names in it, and of each segment its number and its part of the order."""
    segment = hashes % np.uint64(segments)
    names = mixed(hashes) >> np.uint64(64 - NAME_BITS)
    order = np.argsort(segment << np.uint64(NAME_BITS) | names)
    segment = segment[order].astype(np.int64)
    cuts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(segment) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(segment))
    return order, names[order], [(int(segment[a]), int(a), int(b)) for a, b in zip(cuts, ends)]


def _gaps(names: np.ndarray) -> np.ndarray:
    """Ascending names as the gaps between them, low bytes first, high bytes, mostly zero, last."""
    gaps = np.diff(names, prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, : NAME_BITS // 8].T).ravel()


def _ascending(gaps: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(gaps) * 8 // NAME_BITS, 8), np.uint8)
    wide[:, : NAME_BITS // 8] = gaps.reshape(NAME_BITS // 8, -1).T
    return np.cumsum(wide.view(np.uint64).ravel(), dtype=np.uint64)


def _send_grams(order: int, segments: int, learned_only: bool):
    """Distinct n-grams with their counts in training documents; the counts that are not one are listed."""

    def send(row: dict, chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        t = _Tokens(chunk)
        keys, counts = [], []
        for hashes, local in t.grams(order):
            many = np.bincount(local[t.learned], minlength=len(hashes))
            some = many > 0 if learned_only else np.ones(len(many), bool)
            keys.append(hashes[some])
            counts.append(many[some])
        at, names, parts = _dealt(np.concatenate(keys), segments)
        counts = np.concatenate(counts)[at]
        for segment, a, b in parts:
            other = np.flatnonzero(counts[a:b] != 1)
            yield segment, packed(
                gaps=_gaps(names[a:b]), other=other.astype(np.uint32), counts=counts[a:b][other].astype(np.uint64)
            )

    return send


def _places(names: np.ndarray, level: int, bits: int, probe: int) -> np.ndarray:
    h = mixed(names * _MIX + np.uint64(level * _LEVEL & 0xFFFFFFFFFFFFFFFF))
    return ((h + np.uint64(probe) * (mixed(h) | np.uint64(1))) >> np.uint64(11)) % np.uint64(bits)


def build_segment(names: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The filter's bytes for n-grams with counts: as many entries each as its count's level."""
    level = np.frexp(counts.astype(np.float64))[1]
    bits = 8 * max(1, -(-int(level.sum() * BITS_PER_ENTRY) // 8))
    found = np.zeros(bits, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        for probe in range(PROBES):
            found[_places(names[level >= j], j, bits, probe)] = True
    return np.packbits(found, bitorder="little")


def levels(segment: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Of each n-gram the level before the first miss."""
    out = np.zeros(len(names), np.uint8)
    rows = np.arange(len(names))
    bits = 8 * len(segment)
    level = 1
    while len(rows) and bits:
        alive = rows
        for probe in range(PROBES):
            place = _places(names[alive], level, bits, probe)
            hit = segment[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
            alive = alive[hit.astype(bool)]
        out[alive] = level
        rows, level = alive, level + 1
        if level > 64:
            break
    return out


def _build(probe: bool):
    """A segment from what the chunks sent: its bytes as a result, or the levels each chunk asks for."""

    def solve(segment: int, blobs: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        names, counts = [], []
        for p in map(unpacked, blobs):
            names.append(_ascending(p["gaps"]))
            counts.append(np.ones(len(names[-1]), np.int64))
            counts[-1][p["other"]] = p["counts"].astype(np.int64)
        ends = np.cumsum([len(n) for n in names])[:-1]
        names, counts = np.concatenate(names), np.concatenate(counts)
        distinct, back = np.unique(names, return_inverse=True)
        total = np.bincount(back, counts, len(distinct)).astype(np.int64)
        del names, counts
        data = build_segment(distinct[total > 0], total[total > 0])
        if not probe:
            return [], [data.tobytes()]
        found = levels(data, distinct)[back]
        return [packed(levels=x) for x in np.split(found, ends)], []

    return solve


def _estimate(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level."""
    top = np.exp2(level.astype(np.float64))
    return np.where(level > 0, (top / 2 + top - 1) / 2, 0.0)


def _score(order: int, segments: int, buckets: int, about: dict, spread_filter):
    """``spread_filter``: the broadcast segments, or None where the chunks got the levels from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chunk_rows(batches):
            chunk = read_chunk(row)
            t = _Tokens(chunk)
            counts = _counts_of(row, t, buckets, about["documents"])
            n_tokens, distinct = about["tokens"], about["distinct"]
            known = counts[t.tokens]
            base = (known + 0.5) / (n_tokens + 0.5 * (distinct + 1))
            grams = list(t.grams(order))
            at, names, parts = _dealt(np.concatenate([g[0] for g in grams]), segments)
            found = np.zeros(len(at), np.uint8)
            answers = {a["bucket"]: a["blob"] for a in (row.get("levels") or [])}
            for segment, a, b in parts:
                if spread_filter is None:
                    found[at[a:b]] = unpacked(answers[segment])["levels"]
                elif segment in spread_filter.value:
                    found[at[a:b]] = levels(np.frombuffer(spread_filter.value[segment], np.uint8), names[a:b])
            del at, names
            estimates = np.split(_estimate(found), np.cumsum([len(g[0]) for g in grams])[:-1])
            probability = base
            context = counts[t.before(1)].astype(np.float64)
            for size, (estimate, (_, local)) in enumerate(zip(estimates, grams), start=2):
                own = np.minimum(estimate[local], context)
                strength = STRENGTHS[size - 1]
                probability = (own + strength * probability) / (context + strength)
                # The context one longer is this n-gram one token earlier; a document begins with the start.
                context = np.append(0.0, own[:-1])
                context[t.starts] = about["documents"]
            yield pa.record_batch(
                [
                    pa.array(chunk.doc_ids, pa.int64()), pa.array(t.held_out), pa.array(t.lengths),
                    pa.array(_sums(known > 0, t.starts).astype(np.int64)),
                    pa.array(np.full(len(t.lengths), n_tokens), pa.int64()),
                    pa.array(_sums(np.log10(base), t.starts)), pa.array(_sums(np.log10(probability), t.starts)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values.astype(np.float64), starts) if len(starts) else np.zeros(0)


def scored(
    docs: DataFrame, held_out: Column, order: int = ORDER, broadcast_bytes: int = BROADCAST_BYTES,
    chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """Of each document its tokens, how many are known, and its base-10 log probability by words and by the model.

    ``held_out`` says which rows are scored without being learned from.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"),
        F.when(held_out, "1").otherwise("0").alias("label"),
    )
    chunks = write_chunks(rows, _tokenise, chunk_tokens)
    buckets = bucket_number(chunks)
    tokens = chunks.agg(F.sum("tokens")).first()[0] or 0
    segments = max(FEWEST_BUCKETS, tokens * (order - 1) // SEGMENT_TOKENS)
    with_counts, results = exchanged(chunks, _send_words(buckets), _count_words, "word_counts")
    about = _about(results, rows)
    shared = None
    if tokens * (order - 1) * BITS_PER_ENTRY / 8 + 8 * segments <= broadcast_bytes:
        built = written(answered(asked(chunks, _send_grams(order, segments, True)), _build(False)), "filter")
        shared = spark.sparkContext.broadcast({r["bucket"]: bytes(r["blob"]) for r in built.collect()})
    else:
        found = answered(asked(chunks, _send_grams(order, segments, False)), _build(True))
        with_counts = with_answers(with_counts, written(found, "levels"), "levels")
    return with_counts.mapInArrow(_score(order, segments, buckets, about, shared), SCHEMA)


def _about(results: DataFrame, rows: DataFrame) -> dict:
    """Training documents, tokens and distinct tokens, the end tokens among them."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chunk_rows(batches):
            found = unpacked(row["blob"])
            yield pa.record_batch([pa.array(found["tokens"]), pa.array(found["distinct"])], names=["tokens", "distinct"])

    found = results.mapInArrow(totals, "tokens long, distinct long").agg(F.sum("tokens"), F.sum("distinct")).first()
    documents = rows.where("label = '0'").count()
    return {"documents": documents, "tokens": (found[0] or 0) + documents, "distinct": (found[1] or 0) + (documents > 0)}
