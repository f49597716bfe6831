"""Document output: one file per document in a mirrored tree, or JSON Lines for a search index."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.schemas import DOCUMENT
from scanlake.sources.files import BATCH_BYTES, _read_file, _tasks_for
from scanlake.sources.stores import filesystem


def write_json_lines(documents: DataFrame, path: str) -> None:
    documents.select(DOCUMENT.fieldNames()).write.mode("overwrite").json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents below a folder, be it JSON Lines or a tree with one file per document.

    The driver holds the list of files; ``read_document_files`` is for trees of many.
    """
    reader = spark.read.schema(DOCUMENT).option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", "*.json").json(path)


def read_document_files(files: DataFrame) -> DataFrame:
    """The documents in listed JSON files: file_path, bytes_on_disk and the document's fields.

    Takes rows as ``list_files`` gives them. Tasks open the files, so the driver holds neither their names nor
    a task for every few of them. A file has one document a line; what cannot be parsed has null fields.
    """
    rows = files.select("file_path", "file_size_bytes")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for path, length in zip(*(c.to_pylist() for c in batch.columns)):
                for line in _read_file(path).splitlines():
                    if line.strip():
                        held.append((path, length, line.decode("utf-8", "replace")))
                        size += len(line)
                if size > BATCH_BYTES:
                    yield _lines(held)
                    held, size = [], 0
            if held:
                yield _lines(held)

    lines = rows.repartition(_tasks_for(files)).mapInArrow(read, "file_path string, file_size_bytes bigint, line string")
    parsed = lines.select("file_path", "file_size_bytes", F.from_json("line", DOCUMENT).alias("document"))
    return parsed.select("file_path", F.col("file_size_bytes").alias("bytes_on_disk"), "document.*")


def _lines(held: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.string())
    columns = [pa.array(c, t) for c, t in zip(zip(*held), types)]
    return pa.record_batch(columns, names=["file_path", "file_size_bytes", "line"])


def text_bodies(documents: DataFrame) -> DataFrame:
    """(output_path, body) of the text files."""
    return documents.select(_file("txt").alias("output_path"), F.col("full_text").alias("body"))


def json_bodies(documents: DataFrame) -> DataFrame:
    """(output_path, body) of the JSON files; non-ASCII text stays readable."""
    body = F.to_json(F.struct(*DOCUMENT.fieldNames()), {"ignoreNullFields": "false"})
    return documents.select(_file("json").alias("output_path"), body.alias("body"))


def _file(extension: str) -> Column:
    return F.concat("output_base", F.lit("." + extension))


def write_files(bodies: DataFrame) -> DataFrame:
    """Write one file per row, text as UTF-8, and return the manifest (output_path, bytes, error).

    Line-based writers would split the text. Each file is written aside and
    moved into place, so a repeated task only replaces it with equal content.
    A file that cannot be written has an error and no bytes; the others are written.
    The write happens when the manifest is evaluated.
    """
    return bodies.mapInPandas(_write_batches, "output_path string, bytes bigint, error string")


def _write_one(target: str, body: str | bytes) -> int:
    import uuid

    fs, path = filesystem(target)
    data = body.encode("utf-8") if isinstance(body, str) else bytes(body)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    aside = f"{path}.{uuid.uuid4().hex}"
    try:
        with fs.open_output_stream(aside) as out:
            out.write(data)
        fs.move(aside, path)
    except Exception:
        if fs.get_file_info(aside).is_file:
            fs.delete_file(aside)
        raise
    return len(data)


def _write_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for target, body in zip(batch["output_path"], batch["body"]):
            try:
                rows.append((target, _write_one(target, body), None))
            except Exception as problem:
                rows.append((target, None, f"{type(problem).__name__}: {problem}"))
        found = pd.DataFrame(rows, columns=["output_path", "bytes", "error"])
        yield found.astype({"bytes": "Int64"})
