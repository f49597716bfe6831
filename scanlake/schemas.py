"""Declared schemas. Timestamps are UTC wall-clock values without a zone."""

from __future__ import annotations

from pyspark.sql import types as T

# The states a ledger row can be in.
PENDING = "pending"
PROCESSING = "processing"
COMPLETE = "complete"
FAILED = "failed"
STATUSES = (PENDING, PROCESSING, COMPLETE, FAILED)

LEDGER = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("file_path", T.StringType(), False),
        T.StructField("file_name", T.StringType(), False),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("worker_id", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("retry_count", T.IntegerType(), False),
        T.StructField("output_path", T.StringType()),
        T.StructField("page_count", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType(), False),
    ]
)

RESULTS = T.StructType(
    [
        T.StructField("image_id", T.LongType(), False),
        T.StructField("page_number", T.IntegerType(), False),
        T.StructField("extracted_text", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("processing_time_ms", T.IntegerType()),
        T.StructField("ocr_engine", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType(), False),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page_number", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("char_count", T.IntegerType()),
        T.StructField("processing_time_ms", T.IntegerType()),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("source_path", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("relative_path", T.StringType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("page_count", T.IntegerType()),
        T.StructField("full_text", T.StringType()),
        T.StructField("pages", T.ArrayType(PAGE)),
        T.StructField("ocr_engine", T.StringType()),
        T.StructField("ocr_language", T.StringType()),
        T.StructField("ocr_config", T.StringType()),
        T.StructField("preprocessing_enabled", T.BooleanType()),
        T.StructField("processed_at", T.StringType()),
        T.StructField("total_processing_time_ms", T.LongType()),
    ]
)

TOKEN = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("conf", T.DoubleType())]
)
