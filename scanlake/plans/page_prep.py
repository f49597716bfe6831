"""The page cleaning chain: resample, gray, deskew, binarise."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.functions.dpi import with_dpi, with_resample_plan
from scanlake.operators import tiles
from scanlake.operators.raster import PAGE_KEY
from scanlake.options import PrepOptions
from scanlake.session import written

#: Image bytes to pixels (height, width, channels).
Decoder = Callable[[bytes], np.ndarray]


def size_plan(pages: DataFrame, options: PrepOptions) -> DataFrame:
    """Per page (PAGE_KEY, dpi, width, height): original_dpi, new size and whether it changes."""
    planned = with_resample_plan(with_dpi(pages, options.default_dpi), options).drop("dpi")
    # One small row per page, written because every later step filters or joins on it.
    return written(planned, "size-plan")


def prepare_pages(
    pixels: DataFrame, pages: DataFrame, options: PrepOptions
) -> tuple[DataFrame, DataFrame]:
    """Clean tiles and one provenance row per page.

    ``pixels`` are tiles of one or three channels. ``pages`` has PAGE_KEY, dpi, width and height. Tiles are
    written once where both the page statistics and the next step read them.
    """
    plan = size_plan(pages, options)
    if not options.enabled:
        return tiles.to_gray(pixels), _provenance(plan, None, False)
    clean = tiles.to_gray(tiles.resample(pixels, plan))
    method = (options.binarization or "none").lower()
    angles = None
    if options.deskew:
        clean = written(clean, "resampled")
        angles = written(tiles.page_statistics(clean), "statistics")
        turning = angles.where(F.abs("angle") >= options.deskew_threshold_degrees)
        clean = tiles.rotate(clean, turning)
    if method == "sauvola":
        clean = tiles.sauvola(clean)
    elif method == "otsu":
        clean = tiles.otsu_binarise(written(clean, "gray"))
    return clean, _provenance(plan, angles, options.deskew, options.deskew_threshold_degrees)


def prepare_images(
    pages: DataFrame, options: PrepOptions, decode: Decoder = tiles.portable_map
) -> tuple[DataFrame, DataFrame]:
    """Pages with their images cleaned, and the provenance rows.

    ``pages`` has PAGE_KEY, image (bytes that ``decode`` reads) and dpi, and any other columns, which stay. In the
    result ``image`` is the clean page as a portable gray map, and ``prepared`` tells that it is. A page that
    cannot be decoded keeps its row with an ``error`` and no image, so it fails alone.
    """
    if "error" in pages.columns:
        early = pages.where("error is not null").withColumn("prepared", F.lit(False))
        pages = pages.where("error is null").drop("error")
    else:
        early = None
    cut = written(tiles.from_images(pages, decode), "tiles")
    sizes = cut.where("ty = 0 and tx = 0").select(*PAGE_KEY, "width", "height")
    about = pages.select(*PAGE_KEY, "dpi").join(sizes, PAGE_KEY)
    clean, provenance = prepare_pages(cut, about, options)
    images = tiles.page_images(clean).select(*PAGE_KEY, F.col("image").alias("__clean"))
    bad = tiles.undecodable(pages, decode)
    joined = pages.drop("image").join(images, PAGE_KEY, "left").join(bad, PAGE_KEY, "left")
    joined = joined.withColumnRenamed("__clean", "image").withColumn(
        "prepared", F.lit(options.enabled) & F.col("image").isNotNull())
    if early is not None:
        joined = joined.unionByName(early)
    return joined, provenance


def _provenance(
    plan: DataFrame, angles: DataFrame | None, deskew: bool, least: float = 0.0
) -> DataFrame:
    if angles is None:
        angled = plan.withColumn("angle", F.lit(0.0))
    else:
        angled = plan.join(angles, PAGE_KEY, "left").fillna({"angle": 0.0})
    return angled.select(
        *PAGE_KEY,
        "original_dpi",
        F.col("resized").alias("was_upscaled"),
        (F.lit(deskew) & (F.abs("angle") >= least)).alias("was_deskewed"),
        F.col("angle").alias("skew_angle_degrees"),
    )
