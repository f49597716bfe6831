"""File listings and page images."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import partial, reduce
from itertools import islice
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanlake.operators.registering import matching_files, unregistered_files
from scanlake.options import InputOptions
from scanlake.session import make_folder, written
from scanlake.sources import tables
from scanlake.sources.stores import entries, filesystem, opens, qualified


def _name_glob(extensions: tuple[str, ...]) -> str:
    """Coarse pre-filter for the lister; case-insensitive through character classes."""
    def any_case(ext: str) -> str:
        return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)

    return "{" + ",".join("*" + any_case(e) for e in extensions) + "}"


def _binary_reader(reader, options: InputOptions):
    return (
        reader.format("binaryFile")
        .option("pathGlobFilter", _name_glob(options.extensions))
        .option("recursiveFileLookup", str(options.recursive).lower())
    )


def _plain_path() -> F.Column:
    """The path without a local scheme, as users write it."""
    return F.regexp_replace("path", "^file:(//)?(?=/)", "")


def list_files(spark: SparkSession, options: InputOptions) -> DataFrame:
    """Files under the root: file_path, file_name, file_size_bytes. Reads no content.

    Folders are listed in tasks, one level of the tree after the other, so neither the driver nor one
    task holds the tree. Empty files and names that start with ``_`` or ``.`` count; a size is null where
    it cannot be told. A flat listing takes files only, a recursive one dangling links as well. Paths are
    absolute and carry their store unless it is the local one. A root that does not exist is an error.
    """
    return _walked(spark, replace(options, root_path=qualified(spark, options.root_path)), _list_folders)


def visible_files(spark: SparkSession, options: InputOptions) -> DataFrame:
    """The files of ``list_files`` that Spark's file sources find as well.

    Empty files, hidden ones and hidden folders are left out. Links to folders are entered, unless they lead
    back to a folder on their way. A store that tasks cannot open by themselves is listed by Spark, whose
    driver then holds the listing.
    """
    options = replace(options, root_path=qualified(spark, options.root_path))
    if opens(options.root_path):
        return _walked(spark, options, partial(_list_folders, visible=True)).where("file_size_bytes > 0")
    found = _binary_reader(spark.read, options).load(options.root_path)
    return matching_files(found.select(_plain_path().alias("file_path"), F.col("length").alias("file_size_bytes")), options)


def _walked(spark: SparkSession, options: InputOptions, lister: Callable) -> DataFrame:
    tasks = spark.sparkContext.defaultParallelism
    level = spark.createDataFrame([(options.root_path,)], "file_path string")
    found = []
    while True:
        listed = level.repartition(tasks).mapInPandas(lister, _ENTRIES)
        listed = written(listed, "listing")
        found.append(listed.where("not is_folder" if options.recursive else "is_file"))
        level = listed.where("is_folder").select("file_path")
        if not options.recursive or level.isEmpty():
            break
    listing = reduce(DataFrame.unionByName, found).select("file_path", "file_size_bytes")
    return matching_files(listing, options)


_ENTRIES = "file_path string, is_folder boolean, is_file boolean, file_size_bytes bigint"
# Entries leave a listing task in batches of this many.
LISTED_AT_ONCE = 10_000


def _list_folders(batches: Iterator[pd.DataFrame], visible: bool = False) -> Iterator[pd.DataFrame]:
    columns = ["file_path", "is_folder", "is_file", "file_size_bytes"]
    for batch in batches:
        for folder in batch["file_path"]:
            rows = filter(_is_visible, entries(folder, links=True)) if visible else entries(folder)
            while some := list(islice(rows, LISTED_AT_ONCE)):
                yield pd.DataFrame(some, columns=columns).astype({"file_size_bytes": "Int64"})


def _is_visible(entry: tuple[str, bool, bool, int | None]) -> bool:
    """Whether Spark's file sources take the name in; they do not find names that are no UTF-8 either."""
    path, is_folder, *_ = entry
    name = path.rpartition("/")[2]
    if is_folder and name.startswith(("_metadata", "_common_metadata")):
        return True
    hidden = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
    return not hidden and not re.search("[\ud800-\udfff]", name)


def read_contents(spark: SparkSession, options: InputOptions) -> DataFrame:
    """Files with their bytes (file_path, content), for a page decoder."""
    found = _binary_reader(spark.read, options).load(options.root_path)
    return found.select(_plain_path().alias("file_path"), "content")


def stream_files(spark: SparkSession, options: InputOptions, known: DataFrame, folder: str) -> DataFrame:
    """Files under the root as a stream: all that are there now and whose file_path ``known`` lacks.

    Tasks list the tree and store the new rows as one more table below ``folder``; the stream reads these
    tables, each once. So the driver and the checkpoint hold the tables' few files, not those of the tree,
    and a batch may have any number of rows. Takes in what ``visible_files`` finds; registering ``list_files``
    adds empty files and names that start with ``_`` or ``.``.
    """
    new = written(unregistered_files(visible_files(spark, options), known), "new")
    make_folder(spark, folder)
    if not new.isEmpty():
        tables.write_snapshot(new, folder)
    return spark.readStream.schema(new.schema).option("recursiveFileLookup", "true").parquet(folder)


# A decoder yields one (image bytes, width, height, dpi strings or None) per page.
Decoder = Callable[[bytes], Iterator[tuple[bytes, int, int, list[str] | None]]]


def text_pages(content: bytes) -> Iterator[tuple[bytes, int, int, list[str] | None]]:
    """Pages of a UTF-8 text file separated by form feeds."""
    for page in content.decode("utf-8").split("\f"):
        yield page.encode("utf-8"), 0, 0, None


# Page images leave a decoding task in batches of about this size.
BATCH_BYTES = 16 << 20

_DECODED = "page_number int, image binary, width int, height int, dpi array<string>, error string"


def decode_pages(
    files: DataFrame, decoder: Decoder, tasks: int | None = None
) -> DataFrame:
    """One row per page of each file; the other columns are repeated.

    Without a ``content`` column the tasks open ``file_path`` themselves, so
    that file bytes are never shuffled; the short rows are dealt to ``tasks``
    tasks first. By default that is four per core, or more where file_size_bytes
    tells that a task would then read over ``TASK_BYTES``. A file that cannot be
    read or decoded gives one row with page_number 0 and an error.
    """
    kept = [f for f in files.schema if f.name != "content"]
    names = [f.name for f in kept]
    schema = T.StructType(kept + T.StructType.fromDDL(_DECODED).fields)
    if "content" not in files.columns:
        files = files.repartition(tasks or _tasks_for(files))

    def pages_of(row: dict[str, Any]) -> Iterator[dict[str, Any]]:
        own = {c: row[c] for c in names}
        try:
            content = bytes(row["content"]) if "content" in row else _read_file(row["file_path"])
            for number, (image, width, height, dpi) in enumerate(decoder(content), 1):
                yield own | {"page_number": number, "image": image, "width": width,
                             "height": height, "dpi": dpi, "error": None}
        except Exception as problem:  # noqa: BLE001 - a bad file must not stop the batch
            yield own | {"page_number": 0, "image": None, "width": None, "height": None,
                         "dpi": None, "error": str(problem) or type(problem).__name__}

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, size = [], 0
            for row in batch.to_dict("records"):
                for page in pages_of(row):
                    held.append(page)
                    size += len(page["image"] or b"")
                    if size > BATCH_BYTES:
                        yield pd.DataFrame(held, columns=schema.fieldNames(), dtype=object)
                        held, size = [], 0
            if held:
                yield pd.DataFrame(held, columns=schema.fieldNames(), dtype=object)

    return files.mapInPandas(decode, schema)


# What a lost decoding task has to read again, about.
TASK_BYTES = 256 << 20


def _tasks_for(files: DataFrame) -> int:
    least = files.sparkSession.sparkContext.defaultParallelism * 4
    if "file_size_bytes" not in files.columns:
        return least
    total = files.agg(F.sum("file_size_bytes")).first()[0] or 0
    return max(least, -(-total // TASK_BYTES))


def _read_file(path: str) -> bytes:
    fs, inner = filesystem(path)
    with fs.open_input_file(inner) as source:
        return source.read()


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """First pages through Spark's image source; undecodable files stay with height -1."""
    images = spark.read.format("image").option("dropInvalid", "false").load(path)
    return images.select(
        F.regexp_replace("image.origin", "^file:(//)?(?=/)", "").alias("file_path"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    )


def image_pixels(images: DataFrame) -> DataFrame:
    """Pixels of decoded images: file_path, y, x, r, g, b. The source stores b, g, r.

    Bytes become one integer array per scanline in Arrow batches; the rest is Spark.
    """
    def scanlines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            for row in batch.itertuples(index=False):
                lines = np.frombuffer(row.data, np.uint8).reshape(row.height, -1).astype("int16")
                yield pd.DataFrame(
                    {"file_path": row.file_path, "channels": row.channels,
                     "y": range(row.height), "line": list(lines)}
                )

    decoded = images.where(F.col("height") > 0).select(
        "file_path", "height", "channels", "data"
    )
    lines = decoded.mapInPandas(
        scanlines, "file_path string, channels int, y int, line array<smallint>"
    )
    width = F.floor(F.size("line") / F.col("channels")).cast("int")
    cells = lines.select(
        "file_path", "channels", "y", "line", F.explode(F.sequence(F.lit(0), width - 1)).alias("x")
    )
    first = F.col("x") * F.col("channels")
    last = F.least(F.col("channels"), F.lit(3)) - 1

    def channel(offset: int):
        return F.get("line", first + F.least(F.lit(offset), last)).cast("int")

    return cells.select(
        "file_path", "y", "x", channel(2).alias("r"), channel(1).alias("g"), channel(0).alias("b")
    )
