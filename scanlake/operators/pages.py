"""Documents to pages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.functions.text import char_count, word_count

# Fixed value: what stands between two page texts.
PAGE_BREAK = "\n\n--- Page Break ---\n\n"


def split_pages(documents: DataFrame, text: str, separator: str = "\n") -> DataFrame:
    """One row per page of a text column, numbered from 1."""
    others = [c for c in documents.columns if c != text]
    pages = documents.select(*others, F.posexplode(F.split(F.col(text), separator)))
    return pages.select(*others, (F.col("pos") + 1).alias("page_number"), F.col("col").alias(text))


def explode_pages(documents: DataFrame, pages: str = "pages") -> DataFrame:
    """One row per element of a nested page array; numbered from 1 unless pages know their number."""
    others = [c for c in documents.columns if c != pages]
    rows = documents.select(*others, F.posexplode(pages).alias("pos", "page"))
    fields = [f.name for f in documents.schema[pages].dataType.elementType]
    number = F.col("page.page_number") if "page_number" in fields else F.col("pos") + 1
    return rows.select(
        *others,
        number.alias("page_number"),
        *[F.col(f"page.{f}").alias(f) for f in fields if f != "page_number"],
    )


def with_metrics(pages: DataFrame) -> DataFrame:
    """Add word_count and char_count of ``text``."""
    return pages.withColumns(
        {"word_count": word_count(F.col("text")), "char_count": char_count(F.col("text"))}
    )


def joined_text(pages: Column) -> Column:
    """The non-empty texts of an ordered page array."""
    texts = F.transform(pages, lambda p: p["text"])
    return F.array_join(F.filter(texts, lambda t: t != ""), PAGE_BREAK)


def assemble_text(pages: DataFrame) -> DataFrame:
    """Document text and page count, one row per document; blank pages count but add no text."""
    ordered = F.sort_array(F.collect_list(F.struct("page_number", "text")))
    return pages.groupBy("image_id").agg(joined_text(ordered).alias("full_text"), F.count("*").cast("int").alias("page_count"))


def nest_pages_by(pages: DataFrame, own: list[str]) -> DataFrame:
    """The page records of each document as one ordered array.

    ``own`` are the document's columns, repeated on its pages. ``prepared`` is true if every page says so.
    """
    prepared = F.bool_and("prepared") if "prepared" in pages.columns else F.lit(False)
    ordered = F.sort_array(
        F.collect_list(
            F.struct(
                "page_number", "text", "confidence", "word_count", "char_count", "processing_time_ms"
            )
        )
    )
    return pages.groupBy(*own).agg(
        ordered.alias("pages"),
        F.count("*").cast("int").alias("page_count"),
        F.sum("processing_time_ms").alias("total_processing_time_ms"),
        F.coalesce(prepared, F.lit(False)).alias("prepared"),
    )


def document_times(pages: DataFrame) -> DataFrame:
    """Pages and summed page time of each document."""
    return pages.groupBy("image_id").agg(
        F.count("*").cast("int").alias("page_count"),
        F.sum("processing_time_ms").alias("total_processing_time_ms"),
    )
