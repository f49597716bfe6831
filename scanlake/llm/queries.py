"""The registered queries of these operators and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import (
    bpe,
    collocations,
    exact_dedup,
    language_model,
    near_dedup,
    packing,
    periodic_runs,
    quality_grade,
    quality_rules,
    secret_scan,
    suffix_dedup,
    token_files,
    toxicity,
)
from scanlake.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_strings(documents(spark, sf_dir))


def op2_quality_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the labels: 0 bad, 1 good but toxic, 2 good."""
    grade = F.expr("case when quality = 0 then 0 when toxic = 1 then 1 when quality = 1 then 2 end")
    return quality_grade.graded(documents(spark, sf_dir), labels(spark, sf_dir), grade, top=2)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(documents(spark, sf_dir), BYTE_BPE, end_id=2)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(documents(spark, sf_dir), WORD_BPE)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), WORD_BPE, end_id=1)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.best_phrases(documents(spark, sf_dir))


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the documents whose checksum's remainder is not 1; a null doc_id counts as an empty one."""
    remainder = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5))
    return language_model.scored(documents(spark, sf_dir), remainder == 1)


def with_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document or so, by checksum, repeated periodically from some place on."""
    n = len(words)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(documents(spark, sf_dir), with_repeats)


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": exact_dedup.ORACLE, "op11_collocations": collocations.ORACLE}
