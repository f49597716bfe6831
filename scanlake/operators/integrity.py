"""Relationship between ledger and results, and the checks Spark tables do not enforce."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def image_results(ledger: DataFrame, results: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Images with their pages, one row per page.

    ``keep_empty`` also keeps images that have no pages. They are added by an
    anti join, which leaves the big join an inner one that Spark can split on
    either side when one image owns a large share of the pages.
    """
    images = ledger.select(F.col("id").alias("image_id"), "file_path", "status")
    joined = results.join(images, "image_id")
    if not keep_empty:
        return joined
    # Keys are made unique first, so a hot image is one row of the anti join.
    with_pages = results.select("image_id").distinct()
    empty = images.join(with_pages, "image_id", "left_anti")
    return joined.unionByName(empty, allowMissingColumns=True)


def orphan_results(results: DataFrame, ledger: DataFrame) -> DataFrame:
    """Result rows whose image is not in the ledger."""
    return results.join(ledger.select(F.col("id").alias("image_id")), "image_id", "left_anti")


def duplicate_pages(results: DataFrame) -> DataFrame:
    """(image, page) pairs that occur more than once."""
    pairs = results.groupBy("image_id", "page_number").agg(F.count("*").alias("n"))
    return pairs.where(F.col("n") > 1)


def duplicate_paths(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("file_path").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def cascade_delete(results: DataFrame, surviving: DataFrame) -> DataFrame:
    """Results that remain once images missing from ``surviving`` are deleted."""
    return results.join(surviving.select(F.col("id").alias("image_id")), "image_id", "left_semi")


def check(ledger: DataFrame, results: DataFrame) -> None:
    """Raise if a uniqueness or reference rule is broken; run before publishing a snapshot."""
    broken = {
        "file_path is not unique": duplicate_paths(ledger),
        "(image_id, page_number) is not unique": duplicate_pages(results),
        "a result has no image": orphan_results(results, ledger),
    }
    for problem, rows in broken.items():
        if not rows.isEmpty():
            raise ValueError(problem)
