"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only these two columns, so that no other column of the table can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, so that a task holds few texts as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


def pieces(batches: Iterator[pa.RecordBatch], most_chars: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and whole texts in lists of about ``most_chars``; one longer text is a list of its own."""
    ids, texts, size = [], [], 0
    for batch in slices(batches):
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(doc)
            texts.append(text)
            size += len(text)
            if size >= most_chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts
