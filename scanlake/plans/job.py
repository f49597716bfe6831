"""The whole job: claim, process, assemble, write files, record; committed slice by slice.

The queue is numbered once a pass and stored by slice; rows that may be tried again are the next pass's queue. A
slice is the next rows by id. Its documents are written first; then its results and the ledger rows it changed are
published together, so a slice writes its own rows and not the ledger. Whatever stops the job before that leaves the
slice as it was: the next run takes it again and replaces its files by equal ones. A document whose file
cannot be written fails like one that cannot be read, and the others of its slice do not. So does one whose
output belongs to another document of the same folder and stem. Files are written page by page, so documents
may be larger than a row. Intermediate tables of a slice are deleted when it ends.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions.paths import output_base
from scanlake.operators import ledger as steps
from scanlake.operators.outputs import written_formats
from scanlake.operators.ranking import number_rows
from scanlake.options import Options
from scanlake.plans.document_job import outcomes_of
from scanlake.schemas import LEDGER, RESULTS
from scanlake.plans.rounds import Process, _every_claim
from scanlake.session import new_folder, scratch, written
from scanlake.sources import tables
from scanlake.sources.paged import write_pages


def run_job(
    spark: SparkSession,
    root: str,
    process: Process,
    options: Options,
    worker: str,
    now: Column,
    slice_rows: int = 1_000_000,
) -> int:
    """Work on the ledger below ``root`` until nothing is left to claim; the last version.

    ``process`` also passes on file_size_bytes. It works as in ``run_rounds``.
    """
    retries = options.run.max_retries
    version = tables.newest(spark, f"{root}/ledger")
    stale = steps.stale(tables.read_ledger(spark, root), now, options.run.stale_minutes)
    if not stale.isEmpty():
        free = steps.reset_stale(stale, now, options.run.stale_minutes)
        version = tables.commit_changes(free, None, root, version)
    while not (waiting := steps.eligible(tables.read_ledger(spark, root), retries)).isEmpty():
        with scratch():
            for queued in _slices(waiting, slice_rows):
                mine = steps.claim_all(queued, worker, retries, now)
                version = _run_slice(spark, root, process, options, mine, now, version)
    return version


def _slices(waiting: DataFrame, rows: int) -> Iterator[DataFrame]:
    """The queue by id in slices, numbered and stored once. Whoever else changes a row meanwhile takes the version."""
    spark = waiting.sparkSession
    path = new_folder(spark, "queue")
    slot = F.floor((F.col("n") - 1) / F.lit(rows)).cast("long")
    # Range partitions by id hold few slots each, so there are about as many files as partitions and slots.
    number_rows(waiting, "id", "n").withColumn("slot", slot).drop("n").write.partitionBy("slot").parquet(path)
    last = spark.read.parquet(path).agg(F.max("slot")).first()[0]
    for n in range(0 if last is None else last + 1):
        yield spark.read.schema(LEDGER).parquet(f"{path}/slot={n}")


def _run_slice(
    spark: SparkSession, root: str, process: Process, options: Options, mine: DataFrame, now: Column, version: int
) -> int:
    with scratch():
        # Recognition is the costly step: write its pages once, then read them for each use.
        pages = written(process(mine), "pages")
        read = outcomes_of(pages, options)
        bad = pages.where(F.col("error").isNotNull()).select("image_id").distinct()
        good = pages.join(bad, "image_id", "left_anti")
        base = output_base(F.col("file_path"), options.input.root_path, options.output.root_path)
        taken = _taken(good.select("image_id", base.alias("output_base")).distinct(), tables.read_ledger(spark, root))
        mine_alone = good.join(taken.select(F.col("id").alias("image_id")), "image_id", "left_anti")
        unwritten = _write(mine_alone, options, now).unionByName(taken)
        outcomes = written(_every_claim(mine, _with_unwritten(read, unwritten)), "outcomes")
        done = outcomes.where(F.col("error_message").isNull()).select(F.col("id").alias("image_id"))
        results = steps.results_of(good.join(done, "image_id", "left_semi"), now)
        # Rows that could be claimed have no committed results: only this slice can hold a page twice.
        steps.check_new_results(spark.createDataFrame([], RESULTS), results)
        after = steps.record_outcomes(mine, outcomes, options.run.max_retries, now)
        return tables.commit_changes(after, results, root, version)


def _taken(documents: DataFrame, ledger: DataFrame) -> DataFrame:
    """(id, problem) of the documents whose output belongs to another: one written before, or of a smaller id."""
    done = ledger.where(F.col("status") == steps.COMPLETE).select(
        F.col("output_path").alias("output_base"), F.col("id").alias("before"))
    # Stored, so that a small slice goes to the ledger and not the ledger through an exchange.
    documents = written(documents, "bases")
    done = done.join(documents.select("output_base"), "output_base", "left_semi")
    done = done.groupBy("output_base").agg(F.min("before").alias("before"))
    first = documents.groupBy("output_base").agg(F.min("image_id").alias("first"))
    owner = first.join(done, "output_base", "left").select("output_base", F.coalesce("before", "first").alias("owner"))
    clashing = documents.select("image_id", "output_base").join(owner, "output_base").where("image_id <> owner")
    problem = F.concat(F.lit("output "), "output_base", F.lit(" belongs to image "), "owner")
    return written(clashing.select(F.col("image_id").alias("id"), problem.alias("problem")), "taken")


def _write(pages: DataFrame, options: Options, now: Column) -> DataFrame:
    """(id, problem) of the documents that could not be written in every format asked for."""
    formats = written_formats(options.output.formats, options.recogniser.engine)
    manifest = written(write_pages(pages, formats, options, now), "manifest")
    failed = manifest.where("error is not null").groupBy(F.col("image_id").alias("id"))
    return failed.agg(F.min("error").alias("problem"))


def _with_unwritten(outcomes: DataFrame, unwritten: DataFrame) -> DataFrame:
    both = outcomes.join(unwritten.select("id", "problem"), "id", "left")
    fine = F.col("problem").isNull()
    return both.select(
        "id",
        F.coalesce("error_message", "problem").alias("error_message"),
        F.when(fine, F.col("output_path")).alias("output_path"),
        F.when(fine, F.col("page_count")).alias("page_count"),
    )
