"""Recognised pages to document rows, and documents to outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.functions import paths
from scanlake.functions.times import iso_utc
from scanlake.operators.pages import joined_text, nest_pages_by, with_metrics
from scanlake.options import Options


def document_rows(
    pages: DataFrame, options: Options, now: Column
) -> DataFrame:
    """One search-ready row per document.

    ``pages`` rows carry their file (image_id, file_path, file_size_bytes) next
    to page_number, text, confidence and processing_time_ms, so the whole job
    is a single exchange by document. preprocessing_enabled tells what was done:
    it is true if ``prepared``, as ``prepare_images`` sets it, is true on every page.
    """
    own = ["image_id", "file_path", "file_size_bytes"]
    nested = nest_pages_by(with_metrics(pages), own)
    path = F.col("file_path")
    relative = paths.relative_path(path, options.input.root_path)
    base = paths.output_base(path, options.input.root_path, options.output.root_path)
    return nested.select(
        "image_id",
        path.alias("source_path"),
        paths.file_name(path).alias("file_name"),
        paths.slashes(relative).alias("relative_path"),
        base.alias("output_base"),
        "file_size_bytes",
        "page_count",
        joined_text(F.col("pages")).alias("full_text"),
        "pages",
        F.lit(options.recogniser.engine).alias("ocr_engine"),
        F.lit(options.recogniser.language).alias("ocr_language"),
        F.lit(options.recogniser.config).alias("ocr_config"),
        F.col("prepared").alias("preprocessing_enabled"),
        iso_utc(now).alias("processed_at"),
        "total_processing_time_ms",
    )


def outcomes_of(pages: DataFrame, options: Options) -> DataFrame:
    """(id, error_message, output_path, page_count) per image; the first bad page decides."""
    counted = pages.groupBy(F.col("image_id").alias("id"), "file_path").agg(
        F.count("*").cast("int").alias("page_count")
    )
    # Messages make a sort-based aggregate, so only the few bad pages take part.
    first = F.min(F.struct("page_number", "error"))["error"]
    bad = pages.where(F.col("error").isNotNull()).groupBy(F.col("image_id").alias("id"))
    summed = counted.join(bad.agg(first.alias("error_message")), "id", "left")
    base = paths.output_base(
        F.col("file_path"), options.input.root_path, options.output.root_path
    )
    good = F.col("error_message").isNull()
    return summed.select(
        "id",
        "error_message",
        F.when(good, base).alias("output_path"),
        F.when(good, F.col("page_count")).alias("page_count"),
    )
