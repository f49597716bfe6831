"""Which output files a collection produces."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.functions import paths

# The formats that exist, and the one engine that can render pdf.
FORMATS = ("pdf", "txt", "json")
PDF_ENGINE = "tesseract"


def written_formats(formats: Sequence[str], engine: str) -> list[str]:
    """The formats that will be written; pdf needs the engine that can render it."""
    if "pdf" in formats and engine != PDF_ENGINE:
        warnings.warn(f"pdf output needs the {PDF_ENGINE} engine and is left out", stacklevel=2)
    return [f for f in FORMATS if f in formats and (f != "pdf" or engine == PDF_ENGINE)]


def with_output_base(files: DataFrame, input_root: str, output_root: str) -> DataFrame:
    base = paths.output_base(F.col("file_path"), input_root, output_root)
    return files.withColumn("output_base", base)


def output_plan(files: DataFrame, formats: Sequence[str], engine: str) -> DataFrame:
    """One row per file and written format; ``files`` carries output_base."""
    wanted = F.array(*[F.lit(f) for f in written_formats(formats, engine)]).cast("array<string>")
    rows = files.select("file_path", "output_base", F.explode(wanted).alias("format"))
    return rows.withColumn("output_path", F.concat_ws(".", "output_base", "format"))


def output_collisions(files: DataFrame) -> DataFrame:
    """Output bases that several files would write to."""
    counts = files.groupBy("output_base").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > 1)
