"""Exact deduplication by 128-bit content hash, with bytes compared inside the groups.

Texts are equal when identical after replacing every run of white space by one space. All steps are
DataFrame operations:

1. One exchange groups the normalised texts by (128-bit hash, text). The hash decides where a text goes
   and orders it; the text in the key is the comparison of bytes, so two texts that share a hash stay two
   classes. Copies are combined before the exchange, so a group of any size sends one row per task.
2. The classes, without texts, are written to the shared folder. Rows find their class by hash alone. This
   join moves a hash and a digest per row, and Spark splits its hot keys.
3. Hashes with more than one class are collisions. Only their rows are compared by text again. The table of
   such hashes is read with its size known, so Spark chooses the join; it is nearly always empty.

Null text is empty text and equals it. A null doc_id is never kept before a number. Repeated rows with one
doc_id are all "kept" if that id is the smallest. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import SPACE_RUN, id_and_text, whole_text
from scanlake.session import written


def normalised(column: str = "text"):
    return F.regexp_replace(column, SPACE_RUN, " ")


def content_hash(digest: str = "text_sha256"):
    """128 bits of the content's digest as two numbers, which joins compare fast."""

    def number(start: int):
        high = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
        low = F.conv(F.substring(digest, start + 8, 8), 16, 10).cast("long")
        return F.shiftleft(high, 32).bitwiseOR(low)

    return F.struct(number(1).alias("hi"), number(17).alias("lo"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, normalised text, its digest and the two halves of its hash."""
    rows = id_and_text(docs).select("doc_id", normalised().alias("norm"))
    rows = rows.withColumn("text_sha256", F.sha2(F.encode("norm", "UTF-8"), 256))
    return rows.withColumn("h", content_hash()).select("doc_id", "norm", "text_sha256", "h.hi", "h.lo")


def exact_groups(docs: DataFrame, keys=keyed) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, dropped ones too.

    ``keys`` can be replaced to test collisions.
    """
    rows = keys(docs)
    classes = written(
        rows.groupBy("hi", "lo", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("hi", "lo", "keep_id", "group_size", F.xxhash64("norm").alias("class_hash")),
        "exact-classes",
    )
    shared = written(classes.groupBy("hi", "lo").agg(F.count("*").alias("classes")).where("classes > 1"), "collisions")
    by_hash = rows.select("doc_id", "text_sha256", "hi", "lo").join(
        classes.join(shared, ["hi", "lo"], "left_anti"), ["hi", "lo"]
    )
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    collided = rows.join(shared.select("hi", "lo"), ["hi", "lo"])
    by_text = collided.groupBy("hi", "lo", "norm").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    compared = collided.join(by_text, ["hi", "lo", "norm"])
    return (
        by_hash.select(columns)
        .unionByName(compared.select(columns))
        .select(
            "doc_id", "keep_id", "group_size",
            F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
            "text_sha256",
        )
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of the table that stay, one of each text; rows without a doc_id stay too.

    A row is named by its doc_id and text together, as ids may repeat on unlike texts. Of rows that repeat both,
    one stays.
    """
    name = ["doc_id", "__sha"]
    groups = exact_groups(docs).where("group_size > 1 and doc_id is not null")
    groups = written(groups.select("doc_id", F.col("text_sha256").alias("__sha"), "kept"), "exact-decisions")
    rows = docs.withColumn("__sha", F.sha2(F.encode(F.regexp_replace(whole_text(), SPACE_RUN, " "), "UTF-8"), 256))
    rows = rows.join(groups.where("not kept").select(*name).distinct(), name, "left_anti")
    repeated = written(groups.where("kept").groupBy(*name).agg(F.count("*").alias("n")).where("n > 1").select(*name), "repeated-rows")
    if not repeated.isEmpty():
        again = rows.join(repeated, name, "left_semi").dropDuplicates(name)
        rows = rows.join(repeated, name, "left_anti").unionByName(again)
    return rows.select(*docs.columns)


ORACLE = r"""
with t as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
  from documents)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
       doc_id = min(doc_id) over (partition by norm) as kept, text_sha256
from t
"""
