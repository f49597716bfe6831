"""Read-only reports over the ledger and the results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.functions.times import micros_between
from scanlake.operators.ledger import eligible
from scanlake.schemas import COMPLETE, FAILED, PENDING, PROCESSING

_GIB = 1_073_741_824.0


def status_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count("*").alias("n"))


def progress(ledger: DataFrame) -> DataFrame:
    """One row: total, each state, percent complete; zeros for an empty ledger."""

    def state(name: str) -> Column:
        return F.count_if(F.col("status") == name).alias(name)

    counts = ledger.agg(
        F.count("*").alias("total"), state(COMPLETE), state(PENDING), state(PROCESSING), state(FAILED)
    )
    share = F.try_divide(F.col(COMPLETE) * F.lit(100.0), F.col("total"))
    return counts.withColumn("percent_complete", F.coalesce(share, F.lit(0.0)))


def status_summary(ledger: DataFrame) -> DataFrame:
    """Per state: images, total size in GiB, mean processing time in ms."""
    micros = micros_between(F.col("started_at"), F.col("completed_at"))
    return ledger.groupBy("status").agg(
        F.count("*").alias("image_count"),
        (F.sum("file_size_bytes") / F.lit(_GIB)).alias("total_size_gb"),
        F.try_divide(F.sum(micros).cast("double"), F.count(micros) * F.lit(1000.0)).alias(
            "avg_processing_ms"
        ),
    )


def failed_list(ledger: DataFrame) -> DataFrame:
    return (
        ledger.where(F.col("status") == FAILED)
        .select("file_path", "retry_count", "error_message")
        .orderBy("file_path")
    )


def queue_empty(ledger: DataFrame, max_retries: int) -> DataFrame:
    """One row: is nothing left to claim?"""
    return eligible(ledger, max_retries).agg((F.count("*") == 0).alias("queue_empty"))


def exhausted_pending(ledger: DataFrame, max_retries: int) -> DataFrame:
    """Pending rows that no claim will ever take because stale resets used up their retries."""
    return ledger.where((F.col("status") == PENDING) & (F.col("retry_count") >= max_retries))


def worker_stats(ledger: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per worker: images processed and errors, from this round's outcomes (id, error_message)."""
    seen = ledger.select("id", "worker_id").join(outcomes.select("id", "error_message"), "id")
    return seen.groupBy("worker_id").agg(
        F.count_if(F.col("error_message").isNull()).alias("processed"),
        F.count_if(F.col("error_message").isNotNull()).alias("errors"),
    )


def review_queue(results: DataFrame, threshold: float) -> DataFrame:
    """Pages whose confidence is below the threshold, worst first."""
    return (
        results.where(F.col("confidence_score") < threshold)
        .select("image_id", "page_number", "confidence_score", "ocr_engine")
        .orderBy("confidence_score", "image_id", "page_number")
    )
