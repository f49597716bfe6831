"""Token ids in binary files with Elias-Fano encoded document boundaries.

A file holds the ids of consecutive documents as one array, then where each document ends, encoded in about
``2 + log2(ids / documents)`` bits a document. ``select`` gives one boundary from a sampled directory; no
table of 64-bit offsets is stored or built. Layout: ids (2 bytes each if the vocabulary allows, else 4),
low bits, high bits, directory, document ids (8 bytes), their validity (1 byte), a JSON footer, its length
in 4 bytes and the magic text. All numbers are little-endian.

``write_token_files`` deals documents out by ranges of doc_id (one exchange, ids unique or nearly so), sorts
each range and lets each task write its files, ids first. Files get a new name per attempt and count only if
the manifest, written by Spark at the end, names them; a retried task leaves at most an unnamed file. The
manifest has one row per file, so numbering ids over all files sums that small table only.

Null text is empty text: the document has the end id alone. Rows with a null doc_id come first. Repeated rows
are documents of their own. An empty table gives an empty manifest and no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanlake.llm.common import id_and_text, pieces
from scanlake.llm.files import filesystem
from scanlake.llm.tokenizing import byte_level
from scanlake.session import new_folder, written

MAGIC = b"EFTOKEN1"
#: Ids after which a task begins its next file.
FILE_IDS = 32_000_000
PIECE_CHARS = 1_000_000
#: Every so many boundaries the directory says where the bits of the next one are.
SAMPLE = 256
#: Documents whose boundaries and ids a reader holds at once.
BLOCK = 2000
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class EliasFano:
    """A non-decreasing list of numbers below ``universe`` in near-minimal space."""

    def __init__(self, count: int, universe: int, low_bits: int, low: bytes, high: bytes, directory: bytes):
        self.count, self.universe, self.low_bits = count, universe, low_bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        #: Byte of ``high`` in which each sampled one lies, and the ones before that byte.
        self.directory = np.frombuffer(directory, "<u4").reshape(-1, 2)

    @classmethod
    def encode(cls, numbers: np.ndarray, universe: int) -> EliasFano:
        numbers = np.asarray(numbers, np.uint64)
        count = len(numbers)
        low_bits = max(0, (universe // count).bit_length() - 1) if count else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((numbers[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (numbers >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        bits = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little")
        before = np.concatenate(([0], np.cumsum(_ONES[high], dtype=np.int64)))
        places = ones[::SAMPLE] // 8
        directory = np.stack([places, before[places]], 1).astype("<u4")
        return cls(count, universe, low_bits, low.tobytes(), high.tobytes(), directory.tobytes())

    def select(self, index: int) -> int:
        """The number at ``index``, from the directory and the bytes up to its next entry."""
        return int(self.select_range(index, index + 1)[0])

    def select_range(self, first: int, end: int) -> np.ndarray:
        """The numbers at [first, end), from the high bits between two entries of the directory."""
        if first >= end:
            return np.zeros(0, np.int64)
        place, ones = map(int, self.directory[first // SAMPLE])
        beyond = (end - 1) // SAMPLE + 1
        stop = int(self.directory[beyond][0]) + 1 if beyond < len(self.directory) else len(self.high)
        bits = np.flatnonzero(np.unpackbits(self.high[place:stop], bitorder="little"))[first - ones : end - ones]
        indexes = np.arange(first, end)
        return (place * 8 + bits - indexes) << self.low_bits | self._low(indexes)

    def all(self) -> np.ndarray:
        """Every number, for tests and small lists; readers take blocks by ``select_range``."""
        return self.select_range(0, self.count)

    def _low(self, indexes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(indexes), np.int64)
        for bit in range(self.low_bits):
            at = indexes * self.low_bits + bit
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << bit
        return out

    @property
    def nbytes(self) -> int:
        return self.low.nbytes + self.high.nbytes + self.directory.nbytes


class TokenFileWriter:
    def __init__(self, path: str, width: int):
        self.store, self.inner = filesystem(path)
        self.store.create_dir(os.path.dirname(self.inner), recursive=True)
        self.path, self.width = path, width
        self.out = self.store.open_output_stream(self.inner)
        self.docs: list = []
        self.lengths: list[np.ndarray] = []
        self.ids = 0

    def write(self, doc_ids: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.docs += doc_ids
        self.lengths.append(lengths)
        self.ids += len(ids)

    def close(self) -> tuple[str, int, int]:
        lengths = np.concatenate(self.lengths) if self.lengths else np.zeros(0, np.int64)
        ends = EliasFano.encode(np.cumsum(lengths), self.ids + 1)
        valid = np.array([d is not None for d in self.docs], np.uint8)
        doc_ids = np.array([0 if d is None else d for d in self.docs], "<i8")
        parts = [ends.low.tobytes(), ends.high.tobytes(), ends.directory.tobytes(), doc_ids.tobytes(), valid.tobytes()]
        footer = json.dumps(
            {"ids": self.ids, "width": self.width, "documents": len(self.docs), "low_bits": ends.low_bits,
             "sizes": [len(p) for p in parts]}
        ).encode()
        for part in parts:
            self.out.write(part)
        self.out.write(footer + len(footer).to_bytes(4, "little") + MAGIC)
        self.out.close()
        return self.path, len(self.docs), self.ids


class TokenFile:
    """Reads boundaries at once and ids of any document on demand."""

    def __init__(self, path: str):
        store, inner = filesystem(path)
        self.file = store.open_input_file(inner)
        size = self.file.size()
        tail = self._read(size - 12, 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        length = int.from_bytes(tail[:4], "little")
        self.about = json.loads(self._read(size - 12 - length, length))
        at = self.about["ids"] * self.about["width"]
        parts = []
        for n in self.about["sizes"]:
            parts.append(self._read(at, n))
            at += n
        self.ends = EliasFano(
            self.about["documents"], self.about["ids"] + 1, self.about["low_bits"], parts[0], parts[1], parts[2]
        )
        valid = np.frombuffer(parts[4], np.uint8)
        self.doc_ids = [d if v else None for d, v in zip(np.frombuffer(parts[3], "<i8").tolist(), valid, strict=True)]

    def _read(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        return self.file.read(length)

    def ids(self, start: int, end: int) -> np.ndarray:
        width = self.about["width"]
        return np.frombuffer(self._read(start * width, (end - start) * width), f"<u{width}").astype("<u4")

    def document(self, index: int) -> np.ndarray:
        return self.ids(self.ends.select(index - 1) if index else 0, self.ends.select(index))


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str) -> DataFrame:
    """Write the files; the manifest: part, number, path, documents, ids of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_level(tokenizer_path)
        width = 2 if max(encoder.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        part, number, writer, done = TaskContext.get().partitionId(), 0, None, []

        def closed() -> pa.RecordBatch:
            path, documents, ids = writer.close()
            return pa.RecordBatch.from_pylist(
                [{"part": part, "number": number, "path": path, "documents": documents, "ids": ids}]
            )

        for doc_ids, texts in pieces(batches, PIECE_CHARS):
            if writer is None:
                name = f"tokens-{part:06d}-{number:04d}-{uuid.uuid4().hex}.eft"
                writer = TokenFileWriter(f"{folder}/{name}", width)
            ids, lengths = encoder.encode(texts)
            writer.write(doc_ids, np.insert(ids, np.cumsum(lengths), end_id), lengths + 1)
            if writer.ids >= FILE_IDS:
                yield closed()
                writer, number = None, number + 1
        if writer is not None:
            yield closed()

    ranges = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    schema = "part long, number long, path string, documents long, ids long"
    return written(ranges.mapInArrow(run, schema), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start over all files, n_tokens and ids_crc32, from the files the manifest names."""
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*[batch.column(n).to_pylist() for n in ("path", "base")], strict=True):
                file = TokenFile(path)
                last = 0
                for at in range(0, len(file.doc_ids), BLOCK):
                    ends = file.ends.select_range(at, min(at + BLOCK, len(file.doc_ids)))
                    own = np.concatenate(([last], ends))
                    last = int(own[-1])
                    ids = file.ids(int(own[0]), int(own[-1]))
                    cuts = own - own[0]
                    yield pa.record_batch(
                        [
                            pa.array(file.doc_ids[at : at + BLOCK], pa.int64()),
                            pa.array(own[:-1] + base, pa.int64()),
                            pa.array(np.diff(own), pa.int64()),
                            pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # A row of a hundred bytes stands for a whole file: with a number, Spark does not join the partitions.
    return (
        files.select("path", "base").repartition(max(1, manifest.count()), "path")
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def token_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    folder = new_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, tokenizer_path, end_id, folder))
