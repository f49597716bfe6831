"""Texts as chunks of word numbers, and questions of chunks to buckets that see all chunks.

A task numbers the words of its documents and appends chunks of about ``CHUNK_TOKENS`` words to one file in
the shared folder. The list of chunks is written by Spark, so it names only files of tasks that ended; a retry
leaves an unnamed file at most. Later passes read the numbers and never split a text again.

``exchanged`` lets every chunk send one message to each bucket it has something for. What a chunk sends is
combined first, so a key that a third of all rows hold costs one entry a chunk. A bucket sees the messages of
all chunks together, in one task whose size the number of buckets bounds, and answers each of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import slices
from scanlake.llm.files import filesystem
from scanlake.session import new_folder, written

CHUNK_TOKENS = 4_000_000
PIECE_CHARS = 1_000_000
#: Tokens for which one bucket is added, and the fewest buckets.
BUCKET_TOKENS = 2_000_000
FEWEST_BUCKETS = 16
#: The number of a message that answers no chunk but belongs to the result.
RESULT = -1
MESSAGE = "chunk long, bucket long, blob binary"
_MESSAGE_ROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("blob", pa.binary())])
_CHUNK = "chunk long, path string, offset long, stored long, tokens long"
_CHUNK_NAMES = ["chunk", "path", "offset", "stored", "tokens"]


def packed(**columns: np.ndarray | pa.Array) -> bytes:
    """Arrays of any lengths as one compressed value."""
    arrays = {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()}
    lists = {
        k: pa.LargeListArray.from_arrays(pa.array([0, len(v)], pa.int64()), v) for k, v in arrays.items()
    }
    table = pa.table(lists)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> dict[str, np.ndarray | pa.Array]:
    """What ``packed`` was given: numbers as numpy arrays, bytes as Arrow arrays."""
    table = pa.ipc.open_stream(blob).read_all()
    out = {}
    for name in table.column_names:
        values = table.column(name).combine_chunks().flatten()
        out[name] = values if pa.types.is_large_binary(values.type) else values.to_numpy(zero_copy_only=False)
    return out


class Chunk:
    """``tokens``: word numbers of all documents; ``lengths``: of each document; ``words``: bytes by number."""

    def __init__(self, number: int, doc_ids: list, lengths: np.ndarray, tokens: np.ndarray, words: pa.Array):
        self.number, self.doc_ids, self.lengths, self.tokens, self.words = number, doc_ids, lengths, tokens, words


class _Table(dict):
    def __init__(self, words: list[bytes], prefix: bytes):
        self.words, self.prefix = words, prefix

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(self.prefix + word)
        return number


class Numbers:
    """One numbering of words over several tables; a word is stored with its table's prefix."""

    def __init__(self):
        self.words: list[bytes] = []
        self.tables: dict[bytes, _Table] = {}

    def table(self, prefix: bytes = b"") -> _Table:
        if prefix not in self.tables:
            self.tables[prefix] = _Table(self.words, prefix)
        return self.tables[prefix]


#: (texts, labels, numbers) to a list of word numbers for each text.
Tokenise = Callable[[list[str], list[str], Numbers], list[list[int]]]


def _write(folder: str, tokenise: Tokenise, chunk_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, count = None, 0, 0
        path = f"{folder}/words-{uuid.uuid4().hex}"
        numbers, docs, lengths, tokens = Numbers(), [], [], []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal out, at, count, numbers, docs, lengths, tokens, total
            if out is None:
                store, inner = filesystem(path)
                store.create_dir(inner.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(inner)
            valid = np.array([d is not None for d in docs], np.uint8)
            blob = packed(
                docs=np.array([0 if d is None else d for d in docs], np.int64), valid=valid,
                lengths=np.array(lengths, np.int64), tokens=np.concatenate(tokens) if tokens else np.zeros(0, np.int32),
                words=pa.array(numbers.words, pa.large_binary()),
            )
            out.write(blob)
            row = [TaskContext.get().partitionId() << 32 | count, path, at, len(blob), total]
            at, count = at + len(blob), count + 1
            numbers, docs, lengths, tokens, total = Numbers(), [], [], [], 0
            return pa.record_batch([[v] for v in row], names=_CHUNK_NAMES)

        for ids, texts, labels in _pieces(batches):
            lists = tokenise(texts, labels, numbers)
            own = [len(x) for x in lists]
            docs += ids
            lengths += own
            tokens.append(np.fromiter(chain.from_iterable(lists), np.int32, sum(own)))
            total += sum(own)
            if total >= chunk_tokens:
                yield flush()
        if docs:
            yield flush()
        if out is not None:
            out.close()

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """Ids, whole texts and labels in lists of about ``PIECE_CHARS``; a longer text is a list of its own."""
    ids, texts, labels, size = [], [], [], 0
    for batch in slices(batches):
        for doc, text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids.append(doc)
            texts.append(text)
            labels.append(label)
            size += len(text)
            if size >= PIECE_CHARS:
                yield ids, texts, labels
                ids, texts, labels, size = [], [], [], 0
    if ids:
        yield ids, texts, labels


def write_chunks(rows: DataFrame, tokenise: Tokenise, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """The list of chunks of (doc_id, text, label), each chunk in a partition of its own or nearly so."""
    folder = new_folder(rows.sparkSession, "word-chunks")
    chunks = written(rows.mapInArrow(_write(folder, tokenise, chunk_tokens), _CHUNK), "word-chunk-list")
    # Rows of a hundred bytes stand for megabytes of work: with a number, Spark does not join the partitions.
    return dealt(chunks)


def dealt(chunks: DataFrame) -> DataFrame:
    return chunks.repartition(max(1, chunks.count()), "chunk")


def read_chunk(row: dict) -> Chunk:
    store, inner = filesystem(row["path"])
    with store.open_input_file(inner) as file:
        file.seek(row["offset"])
        parts = unpacked(file.read(row["stored"]))
    ids = [d if v else None for d, v in zip(parts["docs"].tolist(), parts["valid"].tolist(), strict=True)]
    return Chunk(row["chunk"], ids, parts["lengths"], parts["tokens"], parts["words"])


def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for n in range(batch.num_rows):
            yield batch.slice(n, 1).to_pylist()[0]


def bucket_number(chunks: DataFrame) -> int:
    tokens = chunks.agg(F.sum("tokens")).first()[0] or 0
    return max(FEWEST_BUCKETS, tokens // BUCKET_TOKENS)


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """A stable order by bucket, and of each bucket present its number and its part of that order."""
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    cuts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(ordered))
    return order, [(int(ordered[a]), int(a), int(b)) for a, b in zip(cuts, ends)]


Send = Callable[[dict, Chunk], Iterable[tuple[int, bytes]]]
#: (bucket, messages) to an answer for each message, and results that belong to none.
Solve = Callable[[int, list[bytes]], tuple[list[bytes], list[bytes]]]


def asked(chunks: DataFrame, send: Send) -> DataFrame:
    """One message for each chunk and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chunk_rows(batches):
            found = list(send(row, read_chunk(row)))
            yield pa.record_batch(
                [[row["chunk"]] * len(found), [b for b, _ in found], [x for _, x in found]], _MESSAGE_ROW
            )

    return chunks.mapInArrow(run, MESSAGE)


def answered(messages: DataFrame, solve: Solve) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        answers, results = solve(bucket, table.column("blob").to_pylist())
        asked_by = table.column("chunk").to_pylist() if answers else []
        return pa.table(
            [asked_by + [RESULT] * len(results), [bucket] * (len(asked_by) + len(results)), answers + results],
            schema=_MESSAGE_ROW,
        )

    return messages.groupBy("bucket").applyInArrow(run, MESSAGE)


def exchanged(chunks: DataFrame, send: Send, solve: Solve, name: str) -> tuple[DataFrame, DataFrame]:
    """The chunks with their answers in a column ``name``, and the results; written once."""
    messages = written(answered(asked(chunks, send), solve), name)
    return with_answers(chunks, messages, name), messages.where(F.col("chunk") == RESULT)


def with_answers(chunks: DataFrame, messages: DataFrame, name: str) -> DataFrame:
    own = messages.where(F.col("chunk") != RESULT).groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "blob")).alias(name)
    )
    return dealt(chunks).join(own, "chunk", "left")
