"""Ledger transitions: each takes the ledger and returns the ledger after the step.

Row counts that a caller wants to report are plain filters over the ledger
before the step (``eligible``, ``stale``, ``failed``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.functions.times import minutes_before
from scanlake.operators.ranking import number_rows
from scanlake.schemas import COMPLETE, FAILED, PENDING, PROCESSING, RESULTS

# Fixed value: longest error text kept.
ERROR_CHARS = 4000


def is_eligible(max_retries: int) -> Column:
    return (F.col("status") == PENDING) & (F.col("retry_count") < max_retries)


def is_stale(now: Column, minutes: int) -> Column:
    return (F.col("status") == PROCESSING) & (F.col("started_at") < minutes_before(now, minutes))


def eligible(ledger: DataFrame, max_retries: int) -> DataFrame:
    return ledger.where(is_eligible(max_retries))


def stale(ledger: DataFrame, now: Column, minutes: int) -> DataFrame:
    return ledger.where(is_stale(now, minutes))


def failed(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == FAILED)


def _change(ledger: DataFrame, when: Column, **changes: Column) -> DataFrame:
    """Set columns where ``when`` holds and leave every other row as it is."""
    types = {f.name: f.dataType for f in ledger.schema}
    return ledger.select(
        [
            F.when(when, changes[c].cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in changes
            else F.col(c)
            for c in ledger.columns
        ]
    )


def claim_slots(ledger: DataFrame, batch_size: int, max_retries: int) -> DataFrame:
    """(id, slot) of every eligible row: batches of ``batch_size`` by id, numbered from 0."""
    waiting = eligible(ledger, max_retries).select("id")
    slot = F.floor((F.col("n") - 1) / F.lit(batch_size)).cast("long")
    return number_rows(waiting, "id", "n").select("id", slot.alias("slot"))


def claim_picks(
    ledger: DataFrame, workers: Sequence[str], batch_size: int, max_retries: int
) -> DataFrame:
    """(id, worker) for the first ``batch_size`` eligible rows of each worker, by id."""
    names = F.array(*[F.lit(w) for w in workers])
    slots = claim_slots(ledger, batch_size, max_retries).where(F.col("slot") < len(workers))
    return slots.select("id", F.get(names, F.col("slot").cast("int")).alias("worker"))


def claim_batch(
    ledger: DataFrame, workers: Sequence[str], batch_size: int, max_retries: int, now: Column
) -> DataFrame:
    """Ledger after every worker claimed its batch; batches never overlap."""
    picks = claim_picks(ledger, workers, batch_size, max_retries)
    joined = ledger.join(picks, "id", "left")
    return _change(
        joined,
        F.col("worker").isNotNull(),
        status=F.lit(PROCESSING),
        worker_id=F.col("worker"),
        started_at=now,
    ).drop("worker")


def claim_all(ledger: DataFrame, worker: str, max_retries: int, now: Column) -> DataFrame:
    """Claim everything that is eligible for one Spark job."""
    return _change(
        ledger,
        is_eligible(max_retries),
        status=F.lit(PROCESSING),
        worker_id=F.lit(worker),
        started_at=now,
    )


def reset_stale(ledger: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Rows whose worker vanished go back to pending, one retry older."""
    return _change(
        ledger,
        is_stale(now, minutes),
        status=F.lit(PENDING),
        worker_id=F.lit(None),
        started_at=F.lit(None),
        retry_count=F.col("retry_count") + 1,
    )


def _one_each(delta: DataFrame) -> DataFrame:
    """One row per id, so that repeated ids do not multiply the ledger; the greatest row is taken."""
    others = [c for c in delta.columns if c != "id"]
    return delta.groupBy("id").agg(F.max(F.struct(*others)).alias("one")).select("id", "one.*")


def mark_complete(ledger: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """``done`` holds a row (id, output_path, page_count) per finished image; of repeated ids one counts."""
    delta = done.select(
        "id",
        F.col("output_path").alias("__output"),
        F.col("page_count").alias("__pages"),
        F.lit(True).alias("__done"),
    )
    return _change(
        ledger.join(_one_each(delta), "id", "left"),
        F.col("__done").isNotNull(),
        status=F.lit(COMPLETE),
        completed_at=now,
        output_path=F.col("__output"),
        page_count=F.col("__pages"),
    ).drop("__output", "__pages", "__done")


def mark_error(ledger: DataFrame, errors: DataFrame, max_retries: int) -> DataFrame:
    """``errors`` holds a row (id, error_message) per image that failed this time; of repeated ids one counts."""
    delta = errors.select(
        "id", F.left("error_message", F.lit(ERROR_CHARS)).alias("__error"), F.lit(True).alias("__bad")
    )
    tries = F.coalesce(F.col("retry_count"), F.lit(0)) + 1
    return _change(
        ledger.join(_one_each(delta), "id", "left"),
        F.col("__bad").isNotNull(),
        status=F.when(tries >= max_retries, FAILED).otherwise(PENDING),
        worker_id=F.lit(None),
        started_at=F.lit(None),
        error_message=F.col("__error"),
        retry_count=tries,
    ).drop("__error", "__bad")


def reset_failed(ledger: DataFrame) -> DataFrame:
    return _change(
        ledger,
        F.col("status") == FAILED,
        status=F.lit(PENDING),
        retry_count=F.lit(0),
        error_message=F.lit(None),
    )


def record_outcomes(
    ledger: DataFrame, outcomes: DataFrame, max_retries: int, now: Column
) -> DataFrame:
    """Apply a mixed batch (id, error_message, output_path, page_count) in one join.

    A null error means success, so one bad file never holds up the others. Of repeated ids one
    row counts, an error before a success.
    """
    delta = outcomes.select(
        "id",
        F.left("error_message", F.lit(ERROR_CHARS)).alias("__error"),
        F.col("output_path").alias("__output"),
        F.col("page_count").alias("__pages"),
        F.lit(True).alias("__seen"),
    )
    good = F.col("__error").isNull()
    tries = F.coalesce(F.col("retry_count"), F.lit(0)) + 1
    after_error = F.when(tries >= max_retries, FAILED).otherwise(PENDING)

    def pick(ok: Column, bad: Column) -> Column:
        return F.when(good, ok).otherwise(bad)

    return _change(
        ledger.join(_one_each(delta), "id", "left"),
        F.col("__seen").isNotNull(),
        status=pick(F.lit(COMPLETE), after_error),
        completed_at=pick(now, F.col("completed_at")),
        output_path=pick(F.col("__output"), F.col("output_path")),
        page_count=pick(F.col("__pages"), F.col("page_count")),
        worker_id=pick(F.col("worker_id"), F.lit(None)),
        started_at=pick(F.col("started_at"), F.lit(None)),
        error_message=pick(F.col("error_message"), F.col("__error")),
        retry_count=pick(F.col("retry_count"), tries),
    ).drop("__error", "__output", "__pages", "__seen")


def results_of(pages: DataFrame, now: Column) -> DataFrame:
    """Result rows for recognised pages."""
    values = {
        "extracted_text": F.col("text"),
        "confidence_score": F.col("confidence"),
        "created_at": now,
    }
    return pages.select(
        [values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RESULTS]
    )


def check_new_results(results: DataFrame, new: DataFrame) -> None:
    """Raise if ``new`` would break the uniqueness of (image, page)."""
    keys = ["image_id", "page_number"]
    added = new.select(keys)
    twice = added.groupBy(keys).agg(F.count("*").alias("n")).where("n > 1")
    # The new keys are the small side; the old ones need not be grouped again.
    known = results.select(keys).join(added, keys, "left_semi")
    if not (twice.isEmpty() and known.isEmpty()):
        raise ValueError("some (image_id, page_number) pairs already have a result")


def append_results(results: DataFrame, new: DataFrame, replace: bool = False) -> DataFrame:
    """Add pages of completed images.

    Finishing an image twice is an error unless ``replace`` drops the image's
    earlier pages first.
    """
    if replace:
        old = results.join(new.select("image_id").distinct(), "image_id", "left_anti")
        return old.unionByName(new)
    check_new_results(results, new)
    return results.unionByName(new)
