"""The given tables seen as scan collections.

The tables hold documents, conversations, labels, events, parts and vectors,
but no scans and no ledger. These views derive both from every row; the same
definitions appear as SQL in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions.paths import file_name
from scanlake.functions.times import moment
from scanlake.operators import tiles as tile_operators
from scanlake.operators.pages import split_pages
from scanlake.schemas import LEDGER, RESULTS
from scanlake.session import spread
from scanlake.sources.documents import write_files

# The moment all views agree on, and the rows of one pixel page.
START = "2024-01-01 00:00:00"
NOW = "2024-01-01 06:00:00"
PAGE_ROWS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _file_path():
    folder = (
        F.when(F.col("doc_id") % 13 == 0, "/other/")
        .when(F.col("doc_id") % 7 == 0, "/scans/")
        .otherwise(F.concat(F.lit("/scans/"), "lang", F.lit("/"), "source", F.lit("/")))
    )
    kind = F.col("doc_id") % 5
    extension = (
        F.when(kind == 0, ".tif").when(kind == 1, ".tiff").when(kind == 2, ".TIF")
        .when(kind == 3, ".jpg").otherwise(".tar.tiff")
    )
    number = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    return F.concat(folder, F.lit("doc_"), number, extension)


def _file_size():
    return F.when(F.col("doc_id") % 17 != 0, F.col("n_chars"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file: id, file_path, file_name, file_size_bytes, lang."""
    found = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), _file_path().alias("file_path"),
        _file_size().alias("file_size_bytes"), "lang",
    )
    return found.withColumn("file_name", file_name(F.col("file_path")))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file at some point of its life."""
    step = F.col("id") % 10
    status = (
        F.when(step < 5, "complete").when(step < 7, "pending").when(step < 9, "processing")
        .otherwise("failed")
    )
    held = (step < 5) | (step == 7) | (step == 8)
    started = moment(START) + F.make_dt_interval(secs=F.col("id") * 37)
    values = {
        "status": status,
        "worker_id": F.when(held, F.concat(F.lit("host-"), F.col("id") % 4)),
        "started_at": F.when(held, started),
        "completed_at": F.when(step < 5, started + F.make_dt_interval(secs=F.col("id") % 7 + 1)),
        "error_message": F.when(step == 9, "disk full"),
        "retry_count": F.when(step == 9, 3).otherwise(F.floor(F.col("id") / 10) % 4),
        "created_at": moment(START),
    }
    from_file = {"id", "file_path", "file_name", "file_size_bytes"}
    return files(spark, sf_dir).select(
        [
            (F.col(f.name) if f.name in from_file else values.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in LEDGER
        ]
    )


def text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of a document is a page, between a blank cover and a blank back page."""
    docs = spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("image_id"), _file_path().alias("file_path"),
        _file_size().alias("file_size_bytes"),
        F.concat(F.lit("\n"), "text", F.lit("\n")).alias("text"),
    )
    return split_pages(docs, "text")


# Parts of file names that listings and openers may trip over.
ODD_FOLDERS = ("", "sub/", ".hidden/", "_x/two words/", "50% #1/")
ODD_PREFIXES = ("", "_", ".", "a b#", "q?%20", "ü")
ODD_SUFFIXES = (".tif", ".TIFF", ".txt")


def chat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation is a document, each turn a page."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("image_id"), (F.col("turn") + 1).cast("int").alias("page_number"), "text"
    )


def _conf(token_no):
    return (F.col("image_id") * 31 + F.col("page_number") * 7 + token_no * 13) % 102 - 1


def tokens(pages: DataFrame) -> DataFrame:
    """The words of each page with a score of -1..100."""
    words = pages.select("image_id", "page_number", F.posexplode(F.split("text", " ")))
    numbered = words.where(F.col("col") != "").withColumn("token_no", F.col("pos") + 1)
    return numbered.select(
        "image_id", "page_number", "token_no", F.col("col").alias("text"),
        _conf(F.col("token_no")).cast("int").alias("conf"),
    )


def _page_score():
    return ((F.col("image_id") * 13 + F.col("page_number") * 29) % 101) / F.lit(100.0)


def _page_ms():
    return ((F.col("image_id") * 7 + F.col("page_number") * 3) % 2000).cast("int")


def _page_engine():
    kind = F.col("image_id") % 3
    return F.when(kind == 0, "tesseract").when(kind == 1, "easyocr").otherwise("paddleocr")


def recognised_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text pages with score and time, still carrying their file."""
    return text_pages(spark, sf_dir).withColumns(
        {"confidence": _page_score(), "processing_time_ms": _page_ms()}
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {
        "extracted_text": F.col("text"),
        "confidence_score": _page_score(),
        "processing_time_ms": _page_ms(),
        "ocr_engine": _page_engine(),
        "created_at": moment(START),
    }
    return text_pages(spark, sf_dir).select(
        [values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RESULTS]
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the rows in processing end; the error length crosses its limit."""
    running = ledger(spark, sf_dir).where(F.col("status") == "processing")
    bad = F.col("id") % 2 == 1
    message = F.repeat(F.lit("e"), (F.col("id") % 20 + 3990).cast("int"))
    return running.select(
        "id",
        F.when(bad, message).alias("error_message"),
        F.when(~bad, F.concat(F.lit("/out/"), "file_name")).alias("output_path"),
        F.when(~bad, (F.col("id") % 9 + 1).cast("int")).alias("page_count"),
    )


def dpi_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a page with some recorded resolution."""
    kind = F.col("p_partkey") % 12
    # One resolution entry per remainder, none for the last.
    entries = [
        ["150", "160"], ["0", "160"], ["150", "0"], ["150"], ["0"], ["200"], ["-5"],
        ["invalid"], [], ["5"], ["1300"],
    ]
    dpi = F.lit(None).cast("array<string>")
    for remainder, values in enumerate(entries):
        entry = F.array(*[F.lit(v) for v in values]).cast("array<string>")
        dpi = F.when(kind == remainder, entry).otherwise(dpi)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_size") * 100).alias("width"),
        (F.col("p_size") * 60).alias("height"), dpi.alias("dpi"),
    )


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 vectors of 64 numbers make a page of scanlines, four pages an image."""
    page = F.floor(F.col("vec_id") / PAGE_ROWS)
    return table(spark, sf_dir, "embeddings").select(
        F.floor(page / 4).alias("image_id"),
        (page % 4 + 1).cast("int").alias("page_number"),
        (F.col("vec_id") % PAGE_ROWS).cast("int").alias("y"),
        F.col("embedding").alias("line"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Neighbouring scanlines stay together, which lets partial sums meet early.
    block = F.floor(F.col("y") / 16)
    return spread(_vectors(spark, sf_dir), "image_id", "page_number", block)


def _gray(value: Column) -> Column:
    return F.floor((value.cast("double") + 1) * 127.5).cast("int")


def colour_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colour pixels: a gray value and its two right-hand neighbours, wrapping around."""
    cells = _lines(spark, sf_dir).select(
        "image_id", "page_number", "y", "line", F.posexplode("line").alias("x", "value")
    )
    size = F.size("line")
    return cells.select(
        "image_id", "page_number", "y", "x", _gray(F.col("value")).alias("r"),
        _gray(F.get("line", (F.col("x") + 1) % size)).alias("g"),
        _gray(F.get("line", (F.col("x") + 2) % size)).alias("b"),
    )


def tiles(spark: SparkSession, sf_dir: str, colour: bool = False, side: int = 32) -> DataFrame:
    """The pixel pages as tiles; small ones, so that pages of 64 scanlines have neighbours to ask."""
    sizes = grid_pages(spark, sf_dir).select("image_id", "page_number", "width", "height")
    lines = _vectors(spark, sf_dir).join(sizes, ["image_id", "page_number"])
    gray = F.transform("line", _gray)
    if colour:
        following = [F.concat(F.slice(gray, k + 1, F.size("line") - k), F.slice(gray, 1, k)) for k in (1, 2)]
        triples = F.arrays_zip(gray.alias("r"), following[0].alias("g"), following[1].alias("b"))
        gray = F.flatten(F.transform(triples, lambda p: F.array(p["r"], p["g"], p["b"])))
    return tile_operators.from_lines(lines.withColumn("line", gray), side, 3 if colour else 1)


def grid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page sizes and recorded resolutions of the pixel pages."""
    sizes = _vectors(spark, sf_dir).groupBy("image_id", "page_number").agg(
        F.max(F.size("line")).alias("width"), (F.max("y") + 1).alias("height")
    )
    kind = (F.col("image_id") + F.col("page_number")) % 3
    recorded = (
        F.when(kind == 0, F.array(F.lit("150"), F.lit("150")))
        .when(kind == 1, F.array(F.lit("300")))
    )
    return sizes.withColumn("dpi", recorded)


def status_events(stream_or_batch: DataFrame) -> DataFrame:
    """User events as ledger events."""
    kind = F.col("event_type")
    action = (
        F.when(kind == "signup", "registered").when(kind == "view", "claimed")
        .when(kind == "purchase", "completed").when(kind == "error", "failed")
        .otherwise("stale_reset")
    )
    return stream_or_batch.select(
        F.col("user_id").alias("image_id"), "ts", "event_id", action.alias("action")
    )


def write_bitmaps(colour: DataFrame, root: str) -> DataFrame:
    """Write each pixel page as a 24-bit bitmap file ``<image>-<page>.bmp``.

    A page has at most 64 scanlines here, so one row can hold it. Returns the
    written paths; the write happens when they are evaluated.
    """
    line = F.sort_array(F.collect_list(F.struct("x", "r", "g", "b")))
    lines = colour.groupBy("image_id", "page_number", "y").agg(line.alias("cells"))
    page = F.sort_array(F.collect_list(F.struct("y", "cells")), asc=False)
    pages = lines.groupBy("image_id", "page_number").agg(page.alias("lines"))

    def hex_of(value, size: int):
        """Little-endian bytes as hex digits."""
        digits = F.lpad(F.hex(value), size * 2, "0")
        return F.concat(*[F.substring(digits, 2 * i - 1, 2) for i in range(size, 0, -1)])

    width, height = F.size(F.col("lines")[0]["cells"]), F.size("lines")
    # 64 pixels of 3 bytes fill whole 4-byte words, so scanlines need no padding.
    body = F.array_join(
        F.transform(
            "lines",
            lambda row: F.array_join(
                F.transform(
                    row["cells"],
                    lambda p: F.concat(hex_of(p["b"], 1), hex_of(p["g"], 1), hex_of(p["r"], 1)),
                ),
                "",
            ),
        ),
        "",
    )
    length = width * height * 3
    # The bitmap header fields in their order.
    header = F.concat(
        F.lit("424D"), hex_of(length + 54, 4), F.lit("00000000"), hex_of(F.lit(54), 4),
        hex_of(F.lit(40), 4), hex_of(width, 4), hex_of(height, 4), hex_of(F.lit(1), 2),
        hex_of(F.lit(24), 2), F.lit("00000000"), hex_of(length, 4), F.lit("00" * 16),
    )
    name = F.concat(F.lit(root + "/"), "image_id", F.lit("-"), "page_number", F.lit(".bmp"))
    files_out = pages.select(name.alias("output_path"), F.unhex(F.concat(header, body)).alias("body"))
    return write_files(files_out)
