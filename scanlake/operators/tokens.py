"""Recogniser tokens (image_id, page_number, token_no, text, conf) to page text and confidence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanlake.functions.numbers import mean_of_units, score_units
from scanlake.functions.text import strip

PAGE_KEY = ["image_id", "page_number"]

# Tokens are joined in runs of this length before they meet in one page.
RUN_TOKENS = 4096


def page_confidence(pages: DataFrame, tokens: DataFrame, scale: int = 100) -> DataFrame:
    """Page text with its mean token score on 0..1; negative scores do not count."""
    units = score_units(F.col("conf"), scale)
    scores = tokens.groupBy(PAGE_KEY).agg(
        F.sum(units).alias("units"), F.count(units).alias("scored")
    )
    mean = mean_of_units(F.col("units"), F.coalesce(F.col("scored"), F.lit(0)))
    return pages.join(scores, PAGE_KEY, "left").select(
        *PAGE_KEY, strip(F.col("text")).alias("text"), mean.alias("confidence")
    )


def pages_from_tokens(
    pages: DataFrame, tokens: DataFrame, separator: str, scale: int = 1
) -> DataFrame:
    """Page text made of its tokens in order, and their mean score.

    ``pages`` gives the keys of all pages, so that pages without tokens stay.
    Tokens with a null text are skipped. Neighbouring tokens become one row before the only
    exchange of the texts, by page. Tokens may come in any order.
    """
    pieces = _pieces(tokens, scale).repartition(*PAGE_KEY)
    runs = pieces.groupBy(*PAGE_KEY, "run").agg(
        _in_order(separator).alias("text"), F.sum("units").alias("units"), F.sum("scored").alias("scored")
    )
    ordered = F.sort_array(F.collect_list(F.struct("run", "text")))
    texts = runs.groupBy(PAGE_KEY).agg(
        F.array_join(F.transform(ordered, lambda t: t["text"]), separator).alias("text"),
        F.sum("units").alias("units"),
        F.sum("scored").alias("scored"),
    )
    mean = mean_of_units(F.col("units"), F.coalesce(F.col("scored"), F.lit(0)))
    return pages.select(PAGE_KEY).join(texts, PAGE_KEY, "left").select(
        *PAGE_KEY,
        F.coalesce(strip(F.col("text")), F.lit("")).alias("text"),
        mean.alias("confidence"),
    )


def _pieces(tokens: DataFrame, scale: int) -> DataFrame:
    """Tokens with consecutive numbers of one page and run as a row: first number, texts, sum and count of scores."""
    run = F.floor(F.col("token_no") / F.lit(RUN_TOKENS))
    rows = tokens.where(F.col("text").isNotNull()).select(
        *PAGE_KEY, run.alias("run"), F.col("token_no").alias("first"), "text", score_units(F.col("conf"), scale).alias("units")
    )
    schema = T.StructType(
        [f for f in rows.schema if f.name not in ("text", "units")]
        + [T.StructField("texts", T.ArrayType(T.StringType())), T.StructField("units", T.LongType()),
           T.StructField("scored", T.LongType())]
    )
    key = [*PAGE_KEY, "run"]

    def starts_of(batch: pa.RecordBatch) -> np.ndarray:
        """Where a row does not go on with the piece of the row before it."""
        before, after = batch.slice(0, batch.num_rows - 1), batch.slice(1)
        new = pc.not_equal(pc.subtract(after["first"], before["first"]), 1)
        for name in key:
            new = pc.or_kleene(new, pc.not_equal(after[name], before[name]))
        return np.concatenate(([0], np.flatnonzero(new.fill_null(True).to_numpy(zero_copy_only=False)) + 1))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = starts_of(batch)
            if len(starts) * 4 > batch.num_rows:  # few neighbours as they come
                batch = batch.sort_by([(name, "ascending") for name in (*key, "first")])
                starts = starts_of(batch)
            units = batch["units"]
            texts = pa.ListArray.from_arrays(np.append(starts, batch.num_rows).astype(np.int32), batch["text"])
            sums = np.add.reduceat(units.fill_null(0).to_numpy(zero_copy_only=False), starts)
            scored = np.add.reduceat(units.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), starts)
            own = [batch[name].take(pa.array(starts)) for name in (*key, "first")]
            yield pa.record_batch(
                [*own, texts, pa.array(sums, pa.int64(), mask=scored == 0), pa.array(scored)], names=schema.fieldNames()
            )

    return rows.mapInArrow(gather, schema)


def _in_order(separator: str) -> Column:
    """The texts of collected pieces; tokens of the same number go by text."""
    pieces = F.collect_list(F.struct("first", "texts"))
    alone = F.array_join(pieces[0]["texts"], separator)
    numbered = F.transform(
        pieces, lambda p: F.transform(p["texts"], lambda t, i: F.struct((p["first"] + i).alias("no"), t.alias("text")))
    )
    ordered = F.transform(F.sort_array(F.flatten(numbered)), lambda t: t["text"])
    return F.when(F.size(pieces) == 1, alone).otherwise(F.array_join(ordered, separator))


def row_units(tokens: Column, scale: int) -> Column:
    """The scores of a token array held in one row that count, as whole billionths."""
    return F.filter(F.transform(tokens["conf"], lambda conf: score_units(conf, scale)), F.isnotnull)


def row_confidence(units: Column) -> Column:
    """Mean of the ``row_units`` of a row, which should be a column of an earlier select: here they are used twice."""
    total = F.aggregate(units, F.lit(0).cast("bigint"), lambda a, u: a + u)
    return mean_of_units(total, F.coalesce(F.size(units), F.lit(0)))


def row_text(tokens: Column, separator: str) -> Column:
    """Text of a token array held in one row; null texts are skipped."""
    return strip(F.array_join(F.transform(tokens, lambda t: t["text"]), separator))
