"""Run the queue to the end: claim, process and record in a few whole-queue rounds."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.operators import ledger as steps
from scanlake.options import Options
from scanlake.plans.document_job import outcomes_of
from scanlake.session import written

# Takes claimed ledger rows, returns page rows: image_id, file_path, page_number,
# text, confidence, ocr_engine, processing_time_ms, error.
Process = Callable[[DataFrame], DataFrame]


def run_rounds(
    ledger: DataFrame,
    results: DataFrame,
    process: Process,
    options: Options,
    worker: str,
    now: Column,
) -> tuple[DataFrame, DataFrame]:
    """The ledger once nothing is left to claim, and the result rows to add.

    ``results`` are the rows of earlier runs; only their keys are read.

    Each round is one job over everything eligible. A row fails at most
    max_retries times, which bounds the number of rounds.
    """
    run = options.run
    mine = steps.is_eligible(run.max_retries)
    new = []
    ledger = written(steps.reset_stale(ledger, now, run.stale_minutes), "ledger")
    for _ in range(run.max_retries):
        if steps.eligible(ledger, run.max_retries).isEmpty():
            break
        claimed = steps.claim_all(ledger.where(mine), worker, run.max_retries, now)
        # Recognition is the costly step: write its pages once, then read them twice.
        pages = written(process(claimed), "pages")
        outcomes = _every_claim(claimed, outcomes_of(pages, options))
        held = steps.claim_all(ledger, worker, run.max_retries, now)
        after = steps.record_outcomes(held, outcomes, run.max_retries, now)
        ledger = written(after, "ledger")
        bad = pages.where(F.col("error").isNotNull()).select("image_id").distinct()
        good = pages.join(bad, "image_id", "left_anti")
        new.append(steps.results_of(good, now))
    if not new:
        return ledger, results.limit(0)
    added = reduce(DataFrame.unionByName, new)
    steps.check_new_results(results, added)
    return ledger, added


def _every_claim(claimed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Outcomes of all claimed rows; a file that gave no page at all is an error."""
    silent = claimed.select("id").join(outcomes.select("id"), "id", "left_anti")
    missing = silent.withColumn("error_message", F.lit("file gave no pages"))
    return outcomes.unionByName(missing, allowMissingColumns=True)
