"""Resolution columns: parse the recorded dpi, plan the resample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.options import PrepOptions

# Resolutions believed, largest enlargement, largest page.
LOWEST_DPI = 10.0
HIGHEST_DPI = 1200.0
LARGEST_SCALE = 5.0
LARGEST_PAGE_PIXELS = 20_000_000

_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def _number(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(_NUMBER)), F.trim(text).try_cast("double"))


def with_dpi(pages: DataFrame, default_dpi: float) -> DataFrame:
    """Add original_dpi = struct(x, y) from ``dpi``, an array of one or two strings.

    The default stands in where a value is missing, not a number or not positive.
    """
    numbers = pages.withColumn("__x", _number(F.get("dpi", 0))).withColumn(
        "__y", F.when(F.size("dpi") >= 2, _number(F.get("dpi", 1))).otherwise(F.col("__x"))
    )
    valid = (F.col("__x") > 0) & (F.col("__y") > 0)
    default = F.lit(float(default_dpi))
    pair = F.when(valid, F.struct(F.col("__x").alias("x"), F.col("__y").alias("y"))).otherwise(
        F.struct(default.alias("x"), default.alias("y"))
    )
    return numbers.withColumn("original_dpi", pair).drop("__x", "__y")


def with_resample_plan(pages: DataFrame, options: PrepOptions) -> DataFrame:
    """Add scale, resized, new_width and new_height from original_dpi, width and height."""
    x = F.col("original_dpi.x")
    known = x.between(LOWEST_DPI, HIGHEST_DPI)
    current = F.when(known, x).otherwise(F.lit(float(options.default_dpi)))
    scaled = _with_size(
        pages.withColumn("__dpi", current).withColumn(
            "scale", F.lit(float(options.target_dpi)) / F.col("__dpi")
        )
    )
    resized = (
        (F.col("scale") <= LARGEST_SCALE)
        & (F.abs(F.col("scale") - 1.0) > 1e-9)
        & (F.col("__dpi") < float(options.min_dpi))
        & (F.col("__w") * F.col("__h") <= LARGEST_PAGE_PIXELS)
    )
    return _with_new_size(scaled.withColumn("resized", resized)).drop("__dpi")


def with_scaled_size(pages: DataFrame, target_dpi: float) -> DataFrame:
    """Add new_width and new_height for a resize to the target whatever the resolution."""
    scaled = _with_size(
        pages.withColumn("scale", F.lit(float(target_dpi)) / F.col("original_dpi.x"))
    )
    resized = (
        (F.col("scale") > 0)
        & (F.abs(F.col("scale") - 1.0) >= 1e-9)
        & (F.col("scale") <= LARGEST_SCALE)
        & (F.col("__w") * F.col("__h") <= LARGEST_PAGE_PIXELS)
    )
    return _with_new_size(scaled.withColumn("resized", resized))


def _with_size(pages: DataFrame) -> DataFrame:
    one = F.lit(1).cast("bigint")
    return pages.withColumns(
        {
            "__w": F.greatest(one, (F.col("width") * F.col("scale")).cast("bigint")),
            "__h": F.greatest(one, (F.col("height") * F.col("scale")).cast("bigint")),
        }
    )


def _with_new_size(pages: DataFrame) -> DataFrame:
    def size(new: str, old: str) -> Column:
        return F.when(F.col("resized"), F.col(new).cast("int")).otherwise(F.col(old))

    return pages.withColumns(
        {"new_width": size("__w", "width"), "new_height": size("__h", "height")}
    ).drop("__w", "__h")
