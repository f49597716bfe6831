"""File listings: which files count, which are new, what gets registered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.functions import paths
from scanlake.operators.ranking import number_rows
from scanlake.options import InputOptions
from scanlake.schemas import LEDGER, PENDING
from scanlake.session import written


def matching_files(listing: DataFrame, options: InputOptions) -> DataFrame:
    """Rows of a listing (file_path, file_size_bytes) under the root with a wanted suffix."""
    prefix = options.root_path.rstrip("/") + "/"
    path = F.col("file_path")
    found = listing.where(F.startswith(path, F.lit(prefix))).where(
        paths.has_extension(paths.file_name(path), options.extensions)
    )
    if not options.recursive:
        found = found.where(F.instr(F.substr(path, F.lit(len(prefix) + 1)), "/") == 0)
    return found.select(
        "file_path", paths.file_name(path).alias("file_name"), "file_size_bytes"
    )


def _once_per_path(files: DataFrame) -> DataFrame:
    # The name follows from the path, so a numeric aggregate is all that is left.
    return files.groupBy("file_path").agg(F.max("file_size_bytes").alias("file_size_bytes"))


def unregistered_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row per path that the ledger does not hold yet."""
    # Stored, so that its size is known: a small listing is broadcast to the ledger's scan, which needs no exchange.
    listed = written(_once_per_path(files), "listed")
    known = ledger.select("file_path").join(listed.select("file_path"), "file_path", "left_semi")
    new = listed.join(known, "file_path", "left_anti")
    return new.select(
        "file_path", paths.file_name(F.col("file_path")).alias("file_name"), "file_size_bytes"
    )


def register_files(files: DataFrame, ledger: DataFrame, now: Column) -> DataFrame:
    """Ledger rows to append: pending, no retries, ids after the largest one in path order."""
    numbered = number_rows(unregistered_files(files, ledger), "file_path", "n")
    last = ledger.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).scalar()
    filled = {
        "id": last + F.col("n"),
        "status": F.lit(PENDING),
        "retry_count": F.lit(0),
        "created_at": now,
    }
    kept = {"file_path", "file_name", "file_size_bytes"}
    return numbered.select(
        [
            (F.col(f.name) if f.name in kept else filled.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in LEDGER
        ]
    )


def registration_stats(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: discovered, registered, skipped; zeros for an empty listing."""
    per_path = files.groupBy("file_path").agg(F.count("*").alias("n"))
    known = ledger.select("file_path", F.lit(True).alias("known"))
    counts = per_path.join(known, "file_path", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("discovered"),
        F.count_if(F.col("known").isNull()).alias("registered"),
    )
    return counts.withColumn("skipped", F.col("discovered") - F.col("registered"))
