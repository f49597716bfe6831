"""Documents of any size to files, page by page.

The pages of a document come to one task in order, and each is appended to the document's files as it comes.
A document is never together in a row or in memory, so the 2 GB that a row may hold do not limit it. Counts
that stand before the pages come from a window over the same exchange, which spills. Files are equal to those
``text_bodies`` and ``json_bodies`` give for the document's row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlake.functions import paths
from scanlake.functions.times import iso_utc
from scanlake.operators.pages import PAGE_BREAK, with_metrics
from scanlake.options import Options
from scanlake.schemas import DOCUMENT, PAGE
from scanlake.sources.stores import filesystem

FORMATS = ("txt", "json")
MANIFEST = "image_id bigint, output_base string, format string, bytes bigint, error string"
COPY_BYTES = 8 << 20
# Rows are Python strings for about this many bytes at once, and a document's page records wait in memory for as many.
PART_BYTES = HELD_BYTES = 256 << 10
# A file is written in blocks, not page by page.
BUFFER_BYTES = 64 << 10


def write_pages(pages: DataFrame, formats: Sequence[str], options: Options, now: Column) -> DataFrame:
    """Write each document's files and return the manifest: bytes or an error for each document and format.

    ``pages`` are as ``document_rows`` takes them. A file is written aside and moved into place, so a repeated
    task only replaces it with equal content; one that cannot be written fails alone. The write happens when
    the manifest is evaluated. Pages may come in any order; equal numbers are ordered by text.
    """
    formats = [f for f in formats if f in FORMATS]
    rows = _ordered(pages, formats, options, now)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: list[_File] = []
        for batch in batches:
            done: list[_File] = []
            for row in _rows(batch):
                if row["head"] is not None:  # the first page of a document
                    done += files
                    for file in files:
                        file.end()
                    files = [KINDS[f](row) for f in formats]
                for file in files:
                    file.add(row)
            if done:
                yield _manifest(done)
        for file in files:
            file.end()
        yield _manifest(files)

    return rows.mapInArrow(write, MANIFEST)


def _ordered(pages: DataFrame, formats: Sequence[str], options: Options, now: Column) -> DataFrame:
    """Pages by document and order; the first of each has the document's fields as ``head`` and ``tail``."""
    path = F.col("file_path")
    own = ["image_id", "file_path", "file_size_bytes"]
    order = Window.partitionBy(*own).orderBy(*[f for f in PAGE.fieldNames()])
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    prepared = F.coalesce(F.bool_and("prepared").over(whole), F.lit(False)) if "prepared" in pages.columns else F.lit(False)
    values = {
        "source_path": path,
        "file_name": paths.file_name(path),
        "relative_path": paths.slashes(paths.relative_path(path, options.input.root_path)),
        "file_size_bytes": F.col("file_size_bytes"),
        "page_count": F.col("page_count"),
        "ocr_engine": F.lit(options.recogniser.engine),
        "ocr_language": F.lit(options.recogniser.language),
        "ocr_config": F.lit(options.recogniser.config),
        "preprocessing_enabled": F.col("all_prepared"),
        "processed_at": iso_utc(now),
        "total_processing_time_ms": F.col("total_ms"),
    }
    names = DOCUMENT.fieldNames()
    before = names[: names.index("full_text")]
    after = names[names.index("pages") + 1 :]

    def as_json(columns: Sequence[Column]) -> Column:
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    def fields(chosen: Sequence[str]) -> Column:
        return as_json([values[n].cast(DOCUMENT[n].dataType).alias(n) for n in chosen])

    rows = with_metrics(pages).withColumns(
        {
            "at": F.row_number().over(order),
            "page_count": F.count("*").over(whole),
            "total_ms": F.sum("processing_time_ms").over(whole),
            "all_prepared": prepared,
        }
    )
    first = F.col("at") == 1
    columns = {
        "image_id": F.col("image_id").cast("long"),
        "output_base": F.when(first, paths.output_base(path, options.input.root_path, options.output.root_path)),
        "head": F.when(first, fields(before)),
        "tail": F.when(first, fields(after)),
    }
    if "txt" in formats:
        columns["text"] = F.col("text")
    if "json" in formats:
        # Spark escapes the text, so that files are the same whoever writes them.
        columns["page_json"] = as_json([F.col(f.name).cast(f.dataType).alias(f.name) for f in PAGE])
    return rows.select(*[c.alias(n) for n, c in columns.items()])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows; only some are Python strings at a time, as a batch may be large."""
    texts = [c for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)]
    sizes = sum(pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in texts)
    parts = np.cumsum(sizes) // PART_BYTES
    starts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
    for start, end in zip(starts, starts[1:]):
        yield from batch.slice(start, end - start).to_pylist()


def _manifest(files: list[_File]) -> pa.RecordBatch:
    columns = {
        "image_id": pa.array([f.image_id for f in files], pa.int64()),
        "output_base": pa.array([f.base for f in files], pa.string()),
        "format": pa.array([f.format for f in files], pa.string()),
        "bytes": pa.array([None if f.error else f.bytes for f in files], pa.int64()),
        "error": pa.array([f.error for f in files], pa.string()),
    }
    return pa.record_batch(list(columns.values()), names=list(columns))


class _File:
    """A file that grows page by page; after a failure it takes no more and leaves nothing behind."""

    format = ""

    def __init__(self, row: dict) -> None:
        self.image_id, self.base = row["image_id"], row["output_base"]
        self.bytes, self.error, self.any_text = 0, None, False
        self.open: dict = {}  # paths of unfinished files and their streams
        self._try(self._begin, row)

    def add(self, row: dict) -> None:
        self._try(self._add, row)

    def end(self) -> None:
        self._try(self._end)

    def _try(self, step, *args) -> None:
        if self.error:
            return
        try:
            step(*args)
        except Exception as problem:  # noqa: BLE001 - any failure belongs to this file only
            self.error = f"{type(problem).__name__}: {problem}"
            self._give_up()

    def _give_up(self) -> None:
        for path, stream in self.open.items():
            for step in (stream.close, partial(self.fs.delete_file, path)):  # what is not written yet may fail again
                try:
                    step()
                except Exception:  # noqa: BLE001 - the first error is the one that counts
                    pass
        self.open = {}

    def _begin(self, row: dict) -> None:
        self.fs, self.path = filesystem(f"{self.base}.{self.format}")
        self.aside, self.out = self._new()

    def _new(self):
        path = f"{self.path}.{uuid.uuid4().hex}"
        try:
            stream = self.fs.open_output_stream(path, buffer_size=BUFFER_BYTES)
        except OSError:  # most often the folder is there
            self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
            stream = self.fs.open_output_stream(path, buffer_size=BUFFER_BYTES)
        self.open[path] = stream
        return path, stream

    def _put(self, text: str | bytes) -> None:
        data = text.encode("utf-8") if isinstance(text, str) else text
        self.out.write(data)
        self.bytes += len(data)

    def _end(self) -> None:
        self.out.close()
        self.fs.move(self.aside, self.path)
        del self.open[self.aside]


class _TextFile(_File):
    format = "txt"

    def _add(self, row: dict) -> None:
        if row["text"]:
            self._put((PAGE_BREAK if self.any_text else "") + row["text"])
            self.any_text = True


class _JsonFile(_File):
    """The text goes into the file; the page records wait, and many of them in a second file, till the end."""

    format = "json"
    BREAK = json.dumps(PAGE_BREAK)[1:-1]
    # What stands before and after the text in a page record; as quotes of the text are escaped, neither is in it.
    BEFORE, AFTER = (f',"{name}":' for name in ("text", PAGE.fieldNames()[PAGE.fieldNames().index("text") + 1]))

    def _begin(self, row: dict) -> None:
        super()._begin(row)
        self.tail, self.records, self.held = row["tail"], [], 0
        self.pages_path = self.pages = None
        self._put(row["head"][:-1] + ',"full_text":"')

    def _add(self, row: dict) -> None:
        record = row["page_json"]
        text = record[record.index(self.BEFORE) + len(self.BEFORE) : record.rindex(self.AFTER)]
        if text not in ("null", '""'):
            self._put((self.BREAK if self.any_text else "") + text[1:-1])
            self.any_text = True
        self.records.append(record)
        self.held += len(record)
        if self.held > HELD_BYTES:
            self._put_aside()

    def _put_aside(self) -> None:
        if self.pages is None:
            self.pages_path, self.pages = self._new()
        self.pages.write(",".join(self.records).encode("utf-8"))
        self.records, self.held = [""], 0  # the next ones go on behind a comma

    def _end(self) -> None:
        self._put('","pages":[')
        if self.pages is not None:
            self.pages.close()
            with self.fs.open_input_stream(self.pages_path) as pages:
                while block := pages.read(COPY_BYTES):
                    self._put(block)
            self.fs.delete_file(self.pages_path)
            del self.open[self.pages_path]
        self._put(",".join(self.records))
        self._put("]," + self.tail[1:])
        super()._end()


KINDS = {"txt": _TextFile, "json": _JsonFile}
