"""Removal of 50-byte strings that also start in an earlier document, by merged Burrows-Wheeler transforms.

Every window of 50 bytes has one *anchor*: of the 24-byte strings in it, the one with the least hash, the
leftmost of equals. Equal windows have equal anchors at equal places, so the corpus can be dealt out by anchor
and each part solved by itself. Four passes, each bounded by the size of a chunk or a bucket:

1. *Chunks*. Tasks pack their documents into chunks of about ``CHUNK_BYTES``, compress them, and append them to
   one file per task in the shared folder; a longer document is a chunk of its own. The list of chunks is
   written by Spark and names only files of tasks that ended, so retries leave unnamed files at most.
2. *Shared anchors*. Each chunk sends its distinct anchor hashes (5 bytes each), dealt into buckets. A bucket
   returns to each chunk one bit per hash: seen in another chunk or not. An anchor of one document only cannot
   belong to a repeated window, so the rest of the work follows the repeated part of the corpus. Anchors that
   occur more than ``HOT`` times are told to the chunks as *hot*.
3. *Contexts*. The windows of one shared anchor cover at most 76 bytes, its context. A chunk sends its distinct
   contexts, each with its smallest doc_id, dealt out by anchor. In a bucket equal contexts become one class
   with one smallest doc_id. Anchors with one class are done: all their windows start in that document.
   The classes of the other anchors that agree with another one in 24 bytes beside the anchor, without which no
   window can be equal, are dealt into shards, each shard's transform is built, and the transforms are merged by interleave refinement (``suffix_merge``). Blocks of suffixes with 50 equal bytes
   are the repeated intervals; their smallest doc_id is compared with each context's own.
   A phrase of 24 to 49 bytes in many documents has another context in each, all under one anchor. So a hot
   anchor's context is cut into its windows, each a string of its own under an anchor of 50 bytes: a chunk sends
   its distinct ones with their bytes, dealt out by their hashes, so a bucket gets at most one of each per chunk.
4. *Removal*. Chunks get one bit per window back, mark covered bytes and report each document.

A hot passage costs one entry per chunk and anchor, however many documents hold it. Hashes of 64 bits deal the
work out and put equal strings side by side, but decide nothing: contexts and windows of hot anchors are one class
only if their bytes are equal, and different ones under one hash are told apart by the merge.

Null text is empty. Texts under 50 bytes keep everything. Rows that repeat a doc_id are one document. A null
doc_id counts as smaller than none: its windows never remove others', and any other document's remove its own.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import id_and_text
from scanlake.llm.features import mixed
from scanlake.llm.files import filesystem
from scanlake.llm.suffix_merge import Shard, merge, places_in_shards
from scanlake.session import new_folder, written

WINDOW, ANCHOR = 50, 24
SPAN = WINDOW - ANCHOR + 1
#: Windows of an anchor are told apart by so many different places of it.
PLACES = 3
CHUNK_BYTES = 2_000_000
#: Texts are searched in steps of so many windows; their arrays stay in a core's cache.
STEP = 1 << 14
PLACE_BITS = np.uint64(15)
BUCKET_BYTES = 12_000_000
FEWEST_BUCKETS = 64
#: An anchor with more occurrences is dealt out by its windows. Up to MANY in a chunk count as one.
HOT = 4096
MANY = 15
#: Pairs of neighbours whose bytes are compared at once.
COMPARED = 1 << 17
#: A chunk's messages are passed on when they have so many bytes.
SENT_BYTES = 1 << 25
#: Classes of a bucket that form one shard.
SHARD_STRINGS = 4096
LAST = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15
_M = 0xFFFFFFFFFFFFFFFF
_CODEC = "zstd"
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def string_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of all strings of ANCHOR (three times 8) bytes; ``words``: the eight bytes at every place."""
    h = mixed(words)
    return mixed(h[:-16] + h[8:-8] * _power(1) + h[16:] * _power(2))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows whose anchor differs from that of the window before, their anchors' places, and the hash at every
    place."""
    words = _words(data)
    hashes = np.empty(len(data) - ANCHOR + 1, np.uint64)
    low = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    numbers = np.arange(STEP + SPAN, dtype=np.uint64)
    windows = len(data) - WINDOW + 1
    begins, places, before = [], [], -1
    for at in range(0, windows, STEP):
        end = min(windows, at + STEP)
        hashes[at : end + SPAN - 1] = keys = string_hashes(words[at : end + SPAN + 15])
        keys &= ~low
        keys |= numbers[: len(keys)]
        size = 1
        while size * 2 <= SPAN:
            keys = np.minimum(keys[:-size], keys[size:])
            size *= 2
        place = (np.minimum(keys[: end - at], keys[SPAN - size : SPAN - size + end - at]) & low).astype(np.int64) + at
        new = np.ones(len(place), bool)
        new[0] = place[0] != before
        new[1:] = place[1:] != place[:-1]
        new = np.flatnonzero(new)
        begins.append(new + at)
        places.append(place[new])
        before = place[-1]
    return np.concatenate(begins), np.concatenate(places), hashes


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash; of greater hashes no smaller one."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class Chunk:
    """The anchors of some documents and the windows that belong to each."""

    def __init__(self, data: bytes, doc_ids: list, lengths: list[int]):
        self.data = np.frombuffer(data, np.uint8)
        self.lengths = np.array(lengths, np.int64)
        self.doc_ids = np.array([LAST if d is None else d for d in doc_ids], np.int64)
        n = len(self.data)
        empty = np.zeros(0, np.int64)
        self.anchor = self.first = self.last = self.owner = empty
        self.hash = np.zeros(0, np.uint64)
        if n < WINDOW:
            return
        begin, place, hashes = anchors(self.data)
        ends = np.cumsum(self.lengths)
        # Runs of windows with one anchor, cut where documents begin and end.
        starts = (ends - self.lengths)[self.lengths >= WINDOW]
        at = np.searchsorted(begin, starts)
        inner = begin[np.minimum(at, len(begin) - 1)] != starts
        begin, place = np.insert(begin, at[inner], starts[inner]), np.insert(place, at[inner], place[at[inner] - 1])
        owner = np.repeat(np.arange(len(ends)), np.diff(np.searchsorted(begin, ends), prepend=0))
        last = np.minimum(np.append(begin[1:], n - WINDOW + 1) - 1, ends[owner] - WINDOW)
        inside = begin <= last
        self.first, self.last, self.owner, self.anchor = begin[inside], last[inside], owner[inside], place[inside]
        # Anchors are those with the least hashes; mixed again they spread over the buckets.
        self.hash = mixed(hashes[self.anchor])
        self._hashes = hashes

    @cached_property
    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct anchor hashes in order, of each anchor its hash's number, and how often each occurs."""
        return np.unique(self.hash, return_inverse=True, return_counts=True)

    def sent(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes in the order they are sent, their buckets, if two documents here have them, and
        how often they occur."""
        distinct, back, counts = self.distinct
        low = np.full(len(distinct), LAST)
        high = np.full(len(distinct), -1)
        doc = np.unique(self.doc_ids, return_inverse=True)[1][self.owner]
        np.minimum.at(low, back, doc)
        np.maximum.at(high, back, doc)
        return distinct, _bucket(distinct, buckets), low < high, counts

    def contexts(self, shared: np.ndarray, buckets: int):
        """Occurrences of shared anchors by context: the entries in the order they are sent, and of each
        occurrence its entry. ``shared``: of each distinct hash if it is one."""
        at = np.flatnonzero(shared[self.distinct[1]])
        left = self.anchor[at] - self.first[at]
        size = self.last[at] - self.first[at] + WINDOW
        key = self.hash[at] ^ (left * 128 + size).astype(np.uint64) * np.uint64(_BASE)
        for place in (np.zeros(len(at), np.int64), np.full(len(at), ANCHOR), np.minimum(2 * ANCHOR, size - ANCHOR), size - ANCHOR):
            key = mixed(key * np.uint64(_BASE) + self._hashes[self.first[at] + place]) if len(at) else key
        order = np.lexsort((key, self.hash[at]))
        sorted_key, sorted_hash = key[order], self.hash[at][order]
        same = (sorted_key[1:] == sorted_key[:-1]) & (sorted_hash[1:] == sorted_hash[:-1])
        same &= left[order[1:]] == left[order[:-1]]
        entry, some = classes(order, same, self.data, self.first[at], size)
        least = np.full(len(some), LAST)
        np.minimum.at(least, entry, self.doc_ids[self.owner[at]])
        return at, entry, {
            "bucket": _bucket(self.hash[at][some], buckets), "hash": self.hash[at][some], "key": key[some],
            "left": left[some], "size": size[some], "first": self.first[at][some], "doc": least,
        }

    def windows(self, hot: np.ndarray, buckets: int):
        """Places and doc_ids of the windows of hot anchors, of each its entry, and the distinct windows as they
        are sent."""
        at = np.flatnonzero(hot[self.distinct[1]])
        own = self.last[at] - self.first[at] + 1
        place = np.repeat(self.first[at] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        docs = np.repeat(self.doc_ids[self.owner[at]], own)
        key = np.zeros(len(place), np.uint64)
        for shift in (0, ANCHOR, WINDOW - ANCHOR):
            key = mixed(key * np.uint64(_BASE) + self._hashes[place + shift]) if len(place) else key
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        entry, some = classes(order, same, self.data, place, np.full(len(place), WINDOW))
        least = np.full(len(some), LAST)
        np.minimum.at(least, entry, docs)
        return place, docs, entry, {"bucket": _bucket(key[some], buckets), "key": key[some], "first": place[some], "doc": least}


def classes(
    order: np.ndarray, same: np.ndarray, data: np.ndarray, first: np.ndarray, size: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of each string the number of its class, and of each class one string.

    ``same`` tells of every two neighbours in ``order`` if their hashes are equal; only neighbours whose bytes are
    equal too share a class. Different strings under one hash may part equal ones into several classes.
    """
    new = np.ones(len(order), bool)
    new[1:] = ~same
    pairs = np.flatnonzero(same)
    # Eight bytes at a time; the last eight of a string overlap those before.
    words = _words(data)
    for at in range(0, len(pairs), COMPARED):
        now = pairs[at : at + COMPARED]
        a, b = order[now], order[now + 1]
        differs = size[a] != size[b]
        last = np.minimum(size[a], size[b]) - 8
        a, b = first[a], first[b]
        for step in range(0, int(last.max()) + 8, 8):
            place = np.minimum(last, step)
            differs |= words[a + place] != words[b + place]
        new[now[differs] + 1] = True
    of_class = np.empty(len(order), np.int64)
    of_class[order] = np.cumsum(new) - 1
    return of_class, order[new]


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every place, as one number each, without a copy."""
    return np.ndarray(max(0, len(data) - 7), "<u8", np.ascontiguousarray(data), strides=(1,))


def _slices(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return data[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def _pack(*arrays: np.ndarray) -> bytes:
    """The arrays in one blob, compressed together: many messages are short."""
    sizes = np.array([a.nbytes for a in arrays], "<i8")
    return bytes([len(arrays)]) + sizes.tobytes() + pa.compress(b"".join(a.tobytes() for a in arrays), _CODEC, asbytes=True)


def _unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, "<i8", blob[0], 1)
    ends = np.cumsum(sizes).tolist()
    data = pa.decompress(memoryview(blob)[1 + sizes.nbytes :], ends[-1], _CODEC, asbytes=True)
    blobs = [data[end - size : end] for end, size in zip(ends, sizes.tolist())]
    return [np.frombuffer(b, t) for b, t in zip(blobs + [b""] * (len(types) - len(blobs)), types, strict=True)]


def _write_chunks(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at = None, 0
        path = f"{folder}/chunks-{uuid.uuid4().hex}"
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal out, at, number, ids, texts, size
            if out is None:
                store, inner = filesystem(path)
                store.create_dir(inner.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(inner)
            blob = pa.compress(b"".join(texts), _CODEC, asbytes=True)
            out.write(blob)
            row = {"chunk": number, "path": path, "offset": at, "stored": len(blob), "bytes": size,
                   "doc_ids": ids, "lengths": [len(t) for t in texts]}
            at += len(blob)
            number += 1
            ids, texts, size = [], [], 0
            return pa.RecordBatch.from_pylist([row], _CHUNK_ROW)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                if texts and size + len(data) > CHUNK_BYTES:
                    yield flush()
                ids.append(doc)
                texts.append(data)
                size += len(data)
        if ids:
            yield flush()
        if out is not None:
            out.close()

    return run


_CHUNK_ROW = pa.schema([
    ("chunk", pa.int64()), ("path", pa.string()), ("offset", pa.int64()), ("stored", pa.int64()), ("bytes", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
])
_CHUNK = "chunk long, path string, offset long, stored long, bytes long, doc_ids array<long>, lengths array<long>"


def _read(row: dict) -> Chunk:
    store, inner = filesystem(row["path"])
    with store.open_input_file(inner) as file:
        file.seek(row["offset"])
        blob = file.read(row["stored"])
    return Chunk(pa.decompress(blob, row["bytes"], _CODEC, asbytes=True), row["doc_ids"], row["lengths"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for n in range(batch.num_rows):
            yield batch.slice(n, 1).to_pylist()[0]


_MESSAGE = "chunk long, bucket long, blob binary"
_MESSAGE_ROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("blob", pa.binary())])


def _messages(chunk: list[int], bucket: list[int], blob: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([chunk, bucket, blob], _MESSAGE_ROW)


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes, bucket, _, counts = _read(row).sent(buckets)
            # Five bytes name a hash within its bucket; a chance match only makes a candidate more.
            short = mixed(hashes).view(np.uint8).reshape(-1, 8)[:, :5]
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
            ends = np.append(cuts[1:], len(bucket))
            blobs = []
            for a, b in zip(cuts, ends):
                many = np.flatnonzero(counts[a:b] > MANY)
                tail = np.concatenate((many, counts[a:b][many], [len(many)])).astype(np.uint32)
                blobs.append(short[a:b].tobytes() + tail.tobytes())
            yield _messages([row["chunk"]] * len(cuts), bucket[cuts].tolist(), blobs)

    return run


def _find_shared(hot: int):
    def run(table: pa.Table) -> pa.Table:
        blobs, weights = [], []
        for blob in table.column("blob").to_pylist():
            many = int.from_bytes(blob[-4:], "little")
            keys, tail = blob[: len(blob) - 8 * many - 4], np.frombuffer(blob, np.uint32, 2 * many, len(blob) - 8 * many - 4) if many else None
            blobs.append(np.frombuffer(keys, np.uint8).reshape(-1, 5))
            weights.append(np.ones(len(blobs[-1]), np.int64))
            if many:
                weights[-1][tail[:many]] = tail[many:]
        wide = np.zeros((sum(map(len, blobs)), 8), np.uint8)
        wide[:, :5] = np.concatenate(blobs)
        keys = wide.view(np.uint64).ravel()
        order = np.argsort(keys, kind="stable")
        begin = np.flatnonzero(np.append(True, keys[order[1:]] != keys[order[:-1]]))
        counts = np.diff(np.append(begin, len(keys)))
        often = np.add.reduceat(np.concatenate(weights)[order], begin) > hot
        shared, many = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        shared[order] = np.repeat(counts > 1, counts)
        many[order] = np.repeat(often, counts)
        cuts = np.cumsum([0, *map(len, blobs)])
        masks = [
            np.packbits(shared[a:b]).tobytes() + np.flatnonzero(many[a:b]).astype(np.uint32).tobytes()
            for a, b in zip(cuts, cuts[1:])
        ]
        return pa.table([table.column("chunk"), table.column("bucket"), pa.array(masks, pa.binary())], schema=_MESSAGE_ROW)

    return run


def _shared_of(chunk: Chunk, replies: list[dict], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct anchor hash of a chunk, from what its buckets replied, if it is shared and not hot, and if it
    is shared and hot."""
    _, bucket, here, _ = chunk.sent(buckets)
    shared, hot = here.copy(), np.zeros(len(here), bool)
    for reply in replies or []:
        a, b = np.searchsorted(bucket, [reply["bucket"], reply["bucket"] + 1])
        size = -(-(b - a) // 8)
        shared[a:b] |= np.unpackbits(np.frombuffer(reply["blob"][:size], np.uint8))[: b - a].astype(bool)
        hot[a + np.frombuffer(reply["blob"][size:], np.uint32)] = True
    return shared & ~hot, shared & hot


def _send_contexts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _read(row)
            shared, hot = _shared_of(chunk, row["replies"], buckets)
            _, _, e = chunk.contexts(shared, buckets)
            _, _, _, w = chunk.windows(hot, buckets)
            to = np.union1d(e["bucket"], w["bucket"])
            sent, blobs, size = [], [], 0
            for bucket, a, b, c, d in zip(to.tolist(), *(np.searchsorted(x["bucket"], to, side) for x in (e, w) for side in ("left", "right"))):
                text = _slices(chunk.data, e["first"][a:b], e["size"][a:b])
                whole = np.lib.stride_tricks.sliding_window_view(chunk.data, WINDOW)[w["first"][c:d]] if c < d else None
                sent.append(bucket)
                blobs.append(_pack(e["hash"][a:b], e["key"][a:b], e["doc"][a:b], e["left"][a:b].astype(np.uint8), e["size"][a:b].astype(np.uint8),
                                   text, *([w["key"][c:d], w["doc"][c:d], whole] if c < d else [])))
                size += len(blobs[-1])
                if size > SENT_BYTES:
                    yield _messages([row["chunk"]] * len(sent), sent, blobs)
                    sent, blobs, size = [], [], 0
            if sent:
                yield _messages([row["chunk"]] * len(sent), sent, blobs)

    return run


def may_share(
    hashes: np.ndarray, left: np.ndarray, sizes: np.ndarray, text: np.ndarray, starts: np.ndarray
) -> np.ndarray:
    """Which contexts may have a window in common with another of the same anchor; all others surely have none.

    A window has ``SPAN - 1`` bytes beside its anchor. Of ``PLACES`` neighbouring places of the anchor, all windows
    have the first one's bytes before it and the last one's behind it: only contexts that agree in them may share.
    ``left``: the place of the anchor in its context.
    """
    out = np.zeros(len(hashes), bool)
    words = _words(text)
    for before in range(0, SPAN, PLACES):
        behind = max(0, SPAN - before - PLACES)
        own = np.flatnonzero((left >= before) & (sizes - left - ANCHOR >= behind))
        begin, key = (starts + left)[own] - before, hashes[own]
        size = before + ANCHOR + behind
        for place in range(0, size, 8):
            key = mixed(key * np.uint64(_BASE) + words[begin + min(place, size - 8)])
        order = np.argsort(key)
        equal = key[order[1:]] == key[order[:-1]]
        out[own[order[1:][equal]]] = True
        out[own[order[:-1][equal]]] = True
    return out


def earliest_windows(
    hashes: np.ndarray, docs: np.ndarray, sizes: np.ndarray, text: np.ndarray, starts: np.ndarray,
    left: np.ndarray | None = None,
) -> np.ndarray:
    """Of every window of some distinct contexts the smallest doc_id of all contexts that hold its 50 bytes.

    ``hashes`` are the contexts' anchors, equal ones next to each other; ``starts`` their places in ``text``.
    With ``left`` the merge takes only contexts that ``may_share``.
    """
    windows = sizes - WINDOW + 1
    least = np.repeat(docs, windows)
    alone = np.ones(len(hashes), bool)
    if len(hashes):
        differs = hashes[1:] != hashes[:-1]
        alone[1:] &= differs
        alone[:-1] &= differs
    some = np.flatnonzero(~alone)
    if left is not None and len(some):
        some = some[may_share(hashes[some], left[some], sizes[some], text, starts[some])]
    if not len(some):
        return least
    window_starts = np.cumsum(windows) - windows
    shards = [
        Shard(_slices(text, starts[own], sizes[own]), sizes[own])
        for own in np.array_split(some, -(-len(some) // SHARD_STRINGS))
    ]
    interleave, block, _ = merge(shards, WINDOW)
    place = places_in_shards(interleave, shards)
    # Places in the shards' joined texts, terminators included, back to contexts and windows.
    lengths = sizes[some] + 1
    string = np.repeat(np.arange(len(some)), lengths)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    context, at = some[string[place]], offset[place]
    whole = at < windows[context]
    context, at, block = context[whole], at[whole], block[whole]
    first = np.full(int(block.max()) + 1, LAST)
    np.minimum.at(first, block, docs[context])
    least[window_starts[context] + at] = first[block]
    return least


def _solve(table: pa.Table) -> pa.Table:
    parts = [_unpack(b, "u8", "u8", "i8", "u1", "u1", "u1", "u8", "i8", "u1") for b in table.column("blob").to_pylist()]
    counts = [len(p[0]) for p in parts]
    hashes, keys, docs, left, sizes = (np.concatenate([p[k] for p in parts]) for k in range(5))
    left, sizes = left.astype(np.int64), sizes.astype(np.int64)
    text = np.concatenate([p[5] for p in parts])
    starts = np.cumsum(sizes) - sizes
    order = np.lexsort((keys, hashes))
    same = (keys[order[1:]] == keys[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
    same &= left[order[1:]] == left[order[:-1]]
    of_class, some = classes(order, same, text, starts, sizes)
    earliest = np.full(len(some), LAST)
    np.minimum.at(earliest, of_class, docs)
    least = earliest_windows(hashes[some], earliest, sizes[some], text, starts[some], left[some])
    windows = sizes[some] - WINDOW + 1
    window_starts = np.cumsum(windows) - windows
    own = windows[of_class]
    before = _slices(least, window_starts[of_class], own) < np.repeat(docs, own)
    bit = np.arange(len(before)) - np.repeat(np.cumsum(own) - own, own)
    bits = np.zeros(len(docs), np.uint32)
    if len(docs):
        bits = np.add.reduceat(before.astype(np.uint32) << bit.astype(np.uint32), np.cumsum(own) - own).astype(np.uint32)
    keys, docs = (np.concatenate([p[k] for p in parts]) for k in (6, 7))
    text = np.concatenate([p[8] for p in parts])
    sizes = np.full(len(keys), WINDOW)
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(keys, kind="stable")
    of_window, some = classes(order, keys[order[1:]] == keys[order[:-1]], text, starts, sizes)
    earliest = np.full(len(some), LAST)
    np.minimum.at(earliest, of_window, docs)
    least = earliest_windows(keys[some], earliest, sizes[some], text, starts[some])
    earlier = least[of_window] < docs
    cuts, ends = np.cumsum([0, *counts]), np.cumsum([0, *(len(p[6]) for p in parts)])
    answers = [
        _pack(bits[a:b], *([np.packbits(earlier[c:d])] if c < d else []))
        for a, b, c, d in zip(cuts, cuts[1:], ends, ends[1:])
    ]
    return pa.table([table.column("chunk"), table.column("bucket"), pa.array(answers, pa.binary())], schema=_MESSAGE_ROW)


def _remove(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _read(row)
            shared, hot = _shared_of(chunk, row["replies"], buckets)
            at, entry, e = chunk.contexts(shared, buckets)
            hot_place, hot_docs, hot_entry, w = chunk.windows(hot, buckets)
            earlier = np.zeros(len(w["doc"]), bool)
            bits = np.zeros(len(e["doc"]), np.uint32)
            for answer in row["answers"] or []:
                a, b = np.searchsorted(e["bucket"], [answer["bucket"], answer["bucket"] + 1])
                c, d = np.searchsorted(w["bucket"], [answer["bucket"], answer["bucket"] + 1])
                bits[a:b], of_windows = _unpack(answer["blob"], "u4", "u1")
                earlier[c:d] = np.unpackbits(of_windows)[: d - c]
            bits = bits[entry]
            # The same context in an earlier document of this chunk covers all its windows.
            bits[chunk.doc_ids[chunk.owner[at]] > e["doc"][entry]] = 0xFFFFFFFF
            windows = chunk.last[at] - chunk.first[at] + 1
            place = np.repeat(chunk.first[at], windows)
            bit = np.arange(len(place)) - np.repeat(np.cumsum(windows) - windows, windows)
            hit = (place + bit)[np.repeat(bits, windows) >> bit.astype(np.uint32) & 1 == 1]
            hit = np.concatenate((hit, hot_place[earlier[hot_entry] | (hot_docs > w["doc"][hot_entry])]))
            n = len(chunk.data)
            steps = np.bincount(hit, minlength=n + 1) - np.bincount(hit + WINDOW, minlength=n + 1)[: n + 1]
            removed = np.cumsum(steps)[:n] > 0
            ends = np.cumsum(chunk.lengths)
            rows = []
            for doc, a, b in zip(row["doc_ids"], ends - chunk.lengths, ends):
                gone = removed[a:b]
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(bool(len(gone) and gone[0]))
                kept = chunk.data[a:b][~gone] if spans else chunk.data[a:b]
                rows.append((doc, int(b - a), int(gone.sum()), spans, hashlib.sha256(kept.tobytes()).hexdigest()))
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def _by_chunk(messages: DataFrame, name: str) -> DataFrame:
    return messages.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "blob")).alias(name))


def repeated_strings(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Of each document its bytes, how many are removed in how many runs, and a digest of the rest."""
    spark = docs.sparkSession
    folder = new_folder(spark, "chunk-files")
    chunks = written(id_and_text(docs).mapInArrow(_write_chunks(folder), _CHUNK), "chunks")
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(FEWEST_BUCKETS, total // BUCKET_BYTES)
    # Chunks are few rows of much work: with a number, Spark does not join their partitions again.
    number = max(1, chunks.count())
    chunks = chunks.repartition(number, "chunk")
    sent = chunks.mapInArrow(_send_anchors(buckets), _MESSAGE)
    replies = written(_by_chunk(sent.groupBy("bucket").applyInArrow(_find_shared(hot), _MESSAGE), "replies"), "anchor-replies")
    known = chunks.join(replies.repartition(number, "chunk"), "chunk", "left")
    sent = known.mapInArrow(_send_contexts(buckets), _MESSAGE)
    answers = written(_by_chunk(sent.groupBy("bucket").applyInArrow(_solve, _MESSAGE), "answers"), "window-answers")
    return known.join(answers.repartition(number, "chunk"), "chunk", "left").mapInArrow(_remove(buckets), SCHEMA)
