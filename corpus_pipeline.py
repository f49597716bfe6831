"""Documents to packed training windows in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's docs. All but the last keep the columns of documents. Toxic texts, all but one of equal texts
and all but one of each near-duplicate group go; secrets are replaced by a mark in the texts that stay; the
last stage packs what is left. Rows without a doc_id are never dropped as copies, since nothing names them.
Null texts, empty tables, repeated rows and further columns are handled as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import exact_dedup, near_dedup, packing, queries, secret_scan, toxicity
from scanlake.llm.common import documents
from scanlake.session import written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, queries.labels(spark, sf_dir))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.one_of_each(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, queries.WORD_BPE, end_id=1)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scans", secret_scan_stage),
    ("packing", packing_stage),
]
#: The network, the signatures and the tokenizer cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long"))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
