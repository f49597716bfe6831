"""The registered queries: each runs one operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions import dpi as dpi_columns
from scanlake.functions import numbers, paths, text, times
from scanlake.operators import (
    integrity,
    ledger as steps,
    outputs,
    pages,
    raster,
    recognising,
    registering,
    reports,
    tiles,
    tokens,
)
from scanlake.options import InputOptions, Options, OutputOptions, PrepOptions, RecogniserOptions
from scanlake.plans import document_job, job, page_prep, rounds, views
from scanlake.session import new_folder, spread, written
from scanlake.sources import documents as document_files
from scanlake.sources import files as file_sources
from scanlake.sources import tables
from scanlake.sources.paged import write_pages
from scanlake.streaming import discovery, feed

Query = Callable[[SparkSession, str], DataFrame]

INPUT_ROOT = "/scans"
OUTPUT_ROOT = "/out"
MAX_RETRIES = 3
STALE_MINUTES = 60
REVIEW_BELOW = 0.6
WORKERS = ("host-a", "host-b", "host-c")
BATCH = 10
OPTIONS = Options(
    input=InputOptions(root_path=INPUT_ROOT),
    output=OutputOptions(root_path=OUTPUT_ROOT, formats=("pdf", "txt", "json")),
)
PREP = PrepOptions()

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _no_nulls(df: DataFrame, column: str) -> DataFrame:
    """Null as -1: clients turn integer columns with nulls into floats, which compare badly."""
    return df.withColumn(column, F.coalesce(column, F.lit(-1)))


def _now():
    return times.moment(views.NOW)


# ------------------------------------------------------------ files and paths


@query
def scan_files(spark, sf):
    found = registering.matching_files(views.files(spark, sf), OPTIONS.input)
    return _no_nulls(found, "file_size_bytes")


@query
def scan_flat(spark, sf):
    flat = InputOptions(root_path=INPUT_ROOT, recursive=False)
    found = registering.matching_files(views.files(spark, sf), flat)
    return _no_nulls(found, "file_size_bytes")


@query
def filter_ext(spark, sf):
    wanted = paths.has_extension(F.col("file_name"), (".TIF", ".jpg"))
    return views.files(spark, sf).select(
        "id", paths.suffix(F.col("file_name")).alias("suffix"), wanted.alias("wanted")
    )


def _known(spark, sf):
    """The ledger of an earlier run that only had seen the labelled documents."""
    labelled = views.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return views.ledger(spark, sf).join(labelled, "id", "left_semi")


@query
def register_new(spark, sf):
    new = registering.register_files(views.files(spark, sf), _known(spark, sf), _now())
    return _no_nulls(new, "file_size_bytes").select(
        "id", "file_path", "file_name", "file_size_bytes", "status", "retry_count", "created_at"
    )


@query
def register_stats(spark, sf):
    return registering.registration_stats(views.files(spark, sf), _known(spark, sf))


@query
def relative_path(spark, sf):
    rel = paths.slashes(paths.relative_path(F.col("file_path"), INPUT_ROOT))
    return views.files(spark, sf).select("id", rel.alias("relative_path"))


def _placed(spark, sf):
    return outputs.with_output_base(views.files(spark, sf), INPUT_ROOT, OUTPUT_ROOT)


@query
def output_base(spark, sf):
    stem = paths.stem(F.col("file_name"))
    return _placed(spark, sf).select("id", stem.alias("stem"), "output_base")


@query
def output_plan(spark, sf):
    return outputs.output_plan(_placed(spark, sf), ("json", "txt", "pdf"), "tesseract")


@query
def output_collisions(spark, sf):
    # Every file is also delivered a second time under the other common suffix.
    placed = _placed(spark, sf)
    base = F.left("file_path", F.char_length("file_path") - F.char_length(paths.suffix(F.col("file_path"))))
    other = views.files(spark, sf).withColumn("file_path", F.concat(base, F.lit(".tiff")))
    both = placed.unionByName(outputs.with_output_base(other, INPUT_ROOT, OUTPUT_ROOT))
    once = both.select("file_path", "output_base").distinct()
    return outputs.output_collisions(once)


# ---------------------------------------------------------------- the ledger


@query
def status_counts(spark, sf):
    return reports.status_counts(views.ledger(spark, sf))


@query
def progress(spark, sf):
    return reports.progress(views.ledger(spark, sf))


@query
def status_summary(spark, sf):
    return reports.status_summary(views.ledger(spark, sf))


@query
def failed_list(spark, sf):
    return reports.failed_list(views.ledger(spark, sf))


@query
def eligible(spark, sf):
    return steps.eligible(views.ledger(spark, sf), MAX_RETRIES).select("id", "file_path", "retry_count")


@query
def queue_empty(spark, sf):
    return reports.queue_empty(views.ledger(spark, sf), MAX_RETRIES)


@query
def exhausted_pending(spark, sf):
    return reports.exhausted_pending(views.ledger(spark, sf), MAX_RETRIES).select(
        "id", "file_path", "retry_count"
    )


@query
def worker_stats(spark, sf):
    return reports.worker_stats(views.ledger(spark, sf), views.outcomes(spark, sf))


@query
def claim_batch(spark, sf):
    after = steps.claim_batch(views.ledger(spark, sf), WORKERS, BATCH, MAX_RETRIES, _now())
    return after.select("id", "file_path", "file_name", "status", "worker_id", "started_at")


@query
def claim_everything(spark, sf):
    """As many workers as there are batches."""
    slots = steps.claim_slots(views.ledger(spark, sf), BATCH, MAX_RETRIES)
    return slots.select("id", F.concat(F.lit("worker-"), F.col("slot")).alias("worker"))


@query
def reset_stale(spark, sf):
    after = steps.reset_stale(views.ledger(spark, sf), _now(), STALE_MINUTES)
    return after.select("id", "status", "worker_id", "started_at", "retry_count")


@query
def mark_complete(spark, sf):
    done = views.outcomes(spark, sf).where(F.col("error_message").isNull())
    after = steps.mark_complete(views.ledger(spark, sf), done, _now())
    return _no_nulls(after, "page_count").select(
        "id", "status", "worker_id", "started_at", "completed_at", "output_path", "page_count"
    )


@query
def mark_error(spark, sf):
    errors = views.outcomes(spark, sf).where(F.col("error_message").isNotNull())
    after = steps.mark_error(views.ledger(spark, sf), errors, MAX_RETRIES)
    return after.select("id", "status", "worker_id", "started_at", "error_message", "retry_count")


@query
def isolate_errors(spark, sf):
    after = steps.record_outcomes(
        views.ledger(spark, sf), views.outcomes(spark, sf), MAX_RETRIES, _now()
    )
    return _no_nulls(after, "page_count").select(
        "id", "status", "worker_id", "started_at", "completed_at", "error_message", "retry_count",
        "output_path", "page_count",
    )


@query
def reset_failed(spark, sf):
    after = steps.reset_failed(views.ledger(spark, sf))
    return after.select("id", "status", "retry_count", "error_message")


@query
def image_results(spark, sf):
    return integrity.image_results(
        views.ledger(spark, sf), views.results(spark, sf), keep_empty=True
    ).select("image_id", "file_path", "status", "page_number", "confidence_score", "ocr_engine")


def _after_purge(spark, sf):
    """The ledger once failed images were deleted."""
    return views.ledger(spark, sf).where(F.col("status") != "failed")


@query
def orphan_results(spark, sf):
    return integrity.orphan_results(views.results(spark, sf), _after_purge(spark, sf)).select(
        "image_id", "page_number", "ocr_engine"
    )


@query
def cascade_delete(spark, sf):
    return integrity.cascade_delete(views.results(spark, sf), _after_purge(spark, sf)).select(
        "image_id", "page_number", "ocr_engine"
    )


@query
def dup_pages(spark, sf):
    # Documents labelled as poor were scanned again and delivered twice.
    results = views.results(spark, sf)
    poor = views.table(spark, sf, "labels").where("quality = 0").select(
        F.col("doc_id").alias("image_id")
    )
    again = results.join(poor, "image_id", "left_semi")
    return integrity.duplicate_pages(results.unionByName(again))


@query
def review_queue(spark, sf):
    return reports.review_queue(views.results(spark, sf), REVIEW_BELOW)


@query
def append_results(spark, sf):
    # A second scan of the poor documents replaces their earlier pages.
    poor = views.table(spark, sf, "labels").where("quality = 0").select(
        F.col("doc_id").alias("image_id")
    )
    results = views.results(spark, sf)
    again = results.join(poor, "image_id", "left_semi").withColumn("ocr_engine", F.lit("easyocr"))
    return steps.append_results(results, again, replace=True).select(
        "image_id", "page_number", "extracted_text", "ocr_engine"
    )


@query
def snapshot_roundtrip(spark, sf):
    root = new_folder(spark, "snapshots")
    tables.write_snapshot(views.ledger(spark, sf), f"{root}/ledger")
    tables.write_snapshot(steps.reset_failed(tables.read_ledger(spark, root)), f"{root}/ledger")
    return tables.read_ledger(spark, root).select("id", "file_path", "status", "retry_count")


@query
def retention(spark, sf):
    """Commits, results whose commit never came, and a sweep: the results that are left, and folders beside them."""
    root = new_folder(spark, "retention")
    ledger, results = views.ledger(spark, sf), views.results(spark, sf)
    tables.commit(ledger, None, root, 0)
    tables.commit(ledger, results.where("image_id % 2 = 0"), root, 1)
    tables.commit(ledger, results.where("image_id % 2 = 1"), root, 2)
    results.write.parquet(f"{root}/results/run-lost")
    gone = tables.sweep(spark, root, keep=1, older_than=0)
    return tables.read_results(spark, root).select(
        "image_id", "page_number", "ocr_engine", F.lit(" ".join(gone)).alias("swept")
    )


@query
def ledger_changes(spark, sf):
    """Four commits of changed and new rows alone, each on what the last one left, and a sweep: the ledger after it."""
    root = new_folder(spark, "changes")
    version = tables.commit(views.ledger(spark, sf), None, root, 0)
    for n in range(4):
        now = tables.read_ledger(spark, root).where("id < 1000000000")
        changed = now.where((F.col("id") % 8).isin(n, n + 1)).withColumns({
            "retry_count": F.col("retry_count") + n + 1, "error_message": F.lit(f"change {n}")})
        new = now.where("id % 8 = 5").withColumn("id", F.col("id") + 1_000_000_000 * (n + 1))
        version = tables.commit_changes(changed.unionByName(new), None, root, version)
    tables.sweep(spark, root, keep=1, older_than=0)
    return tables.read_ledger(spark, root).select("id", "file_path", "status", "retry_count", "error_message")


@query
def init_ledger(spark, sf):
    """A first run: create the empty tables, register every file, read the ledger back."""
    root = new_folder(spark, "first-run")
    tables.init_tables(spark, root)
    empty = tables.read_ledger(spark, root)
    new = registering.register_files(views.files(spark, sf), empty, _now())
    tables.write_snapshot(empty.unionByName(new), f"{root}/ledger")
    return tables.read_ledger(spark, root).select(
        "id", "file_path", "file_name", "status", "retry_count", "created_at"
    )


def _queue(spark, sf):
    """Text pages as page images, one row per page, for the claimed files."""
    pages_in = views.text_pages(spark, sf)
    bad = views.table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("image_id"))
    marked = pages_in.join(bad.withColumn("bad", F.lit(True)), "image_id", "left")
    # Bytes that are not UTF-8 stand for an unreadable scan.
    image = F.when(F.col("bad"), F.unhex(F.lit("FF"))).otherwise(F.encode("text", "UTF-8"))

    def process(claimed: DataFrame) -> DataFrame:
        todo = claimed.select(F.col("id").alias("image_id"))
        page_images = marked.join(todo, "image_id", "left_semi").select(
            "image_id", "file_path", "file_size_bytes", "page_number", image.alias("image")
        )
        return recognising.recognise(page_images, RecogniserOptions(engine="plain"))

    return process


@query
def run_rounds(spark, sf):
    ledger, _ = rounds.run_rounds(
        views.ledger(spark, sf),
        spark.createDataFrame([], tables.RESULTS),
        _queue(spark, sf), OPTIONS, "job-1", _now(),
    )
    return _no_nulls(ledger, "page_count").select(
        "id", "status", "worker_id", "retry_count", "output_path", "page_count",
        F.col("error_message").isNotNull().alias("has_error"),
    )


@query
def run_rounds_results(spark, sf):
    _, results = rounds.run_rounds(
        views.ledger(spark, sf),
        spark.createDataFrame([], tables.RESULTS),
        _queue(spark, sf), OPTIONS, "job-1", _now(),
    )
    return results.select("image_id", "page_number", "extracted_text", "confidence_score", "ocr_engine")


@query
def run_job(spark, sf):
    """The job with files and commits: how each row ended, its result rows, and is its text file there."""
    root = new_folder(spark, "job")
    options = replace(OPTIONS, output=OutputOptions(root_path=f"{root}/out"))
    tables.commit(views.ledger(spark, sf), None, root, 0)
    job.run_job(spark, root, _queue(spark, sf), options, "job-1", _now())
    results = tables.read_results(spark, root).groupBy(F.col("image_id").alias("id"))
    texts = file_sources.list_files(spark, InputOptions(root_path=f"{root}/out", extensions=(".txt",)))
    there = texts.select(
        F.regexp_extract("file_path", "/out/(.*)[.]txt$", 1).alias("base"), F.lit(True).alias("there")
    ).where("base <> ''")
    ended = tables.read_ledger(spark, root).withColumn("base", F.regexp_extract("output_path", "/out/(.*)$", 1))
    both = ended.join(results.agg(F.count("*").alias("n_results")), "id", "left").join(there, "base", "left")
    return _no_nulls(both, "page_count").select(
        "id", "status", "worker_id", "retry_count", "page_count",
        F.col("error_message").isNotNull().alias("has_error"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.coalesce("there", F.lit(False)).alias("on_disk"),
    )


# --------------------------------------------------------- pages and documents


@query
def page_explode(spark, sf):
    return views.text_pages(spark, sf).select("image_id", "page_number", "text")


@query
def page_metrics(spark, sf):
    return pages.with_metrics(views.text_pages(spark, sf)).select(
        "image_id", "page_number", "word_count", "char_count"
    )


@query
def chat_metrics(spark, sf):
    return pages.with_metrics(views.chat_pages(spark, sf)).select(
        "image_id", "page_number", "word_count", "char_count"
    )


@query
def text_strip(spark, sf):
    padded = F.concat(F.lit(" \t\n"), "text", F.lit("\r\n "))
    return views.text_pages(spark, sf).select(
        "image_id", "page_number", text.strip(padded).alias("stripped")
    )


@query
def assemble_text(spark, sf):
    return pages.assemble_text(views.text_pages(spark, sf))


@query
def assemble_chat(spark, sf):
    return pages.assemble_text(views.chat_pages(spark, sf))


def _nested(spark, sf):
    measured = pages.with_metrics(views.recognised_pages(spark, sf))
    return pages.nest_pages_by(measured, ["image_id"]).drop("prepared")


@query
def document_json(spark, sf):
    return pages.explode_pages(_nested(spark, sf)).select(
        "image_id", "page_count", "page_number", "text", "confidence",
        "word_count", "char_count", "processing_time_ms",
    )


@query
def doc_time(spark, sf):
    return pages.document_times(views.recognised_pages(spark, sf))


def _documents(spark, sf):
    return document_job.document_rows(views.recognised_pages(spark, sf), OPTIONS, _now())


@query
def document_index(spark, sf):
    """The flagship: recognised pages to search-ready documents in one exchange."""
    mean = F.aggregate(
        "pages", F.lit(0).cast("bigint"),
        lambda a, p: a + numbers.score_units(p["confidence"], 1),
    )
    words = F.aggregate("pages", F.lit(0), lambda a, p: a + p["word_count"])
    return _no_nulls(_documents(spark, sf), "file_size_bytes").select(
        "image_id", "source_path", "file_name", "relative_path", "output_base",
        "file_size_bytes", "page_count", "full_text", words.alias("word_count"),
        numbers.mean_of_units(mean, F.col("page_count")).alias("confidence"),
        "ocr_engine", "ocr_language", "ocr_config", "preprocessing_enabled", "processed_at",
        "total_processing_time_ms",
    )


@query
def docs_roundtrip(spark, sf):
    path = new_folder(spark, "documents")
    document_files.write_json_lines(_documents(spark, sf), path)
    back = document_files.read_documents(spark, path).select(
        "relative_path", "total_processing_time_ms", "processed_at", "pages"
    )
    return pages.explode_pages(back)


def _into(documents: DataFrame, root: str) -> DataFrame:
    """Documents whose output tree is moved below ``root``."""
    moved = F.concat(F.lit(root), F.substr("output_base", F.lit(len(OUTPUT_ROOT) + 1)))
    return documents.withColumn("output_base", moved)


def _sunk(spark, bodies, root):
    """Write files, then look at what lies on disk."""
    manifest = written(document_files.write_files(bodies), "manifest")
    kinds = InputOptions(root_path=root, extensions=(".txt", ".json"))
    found = file_sources.list_files(spark, kinds)
    top = root.rsplit("/", 1)[-1]
    tail = F.substring_index("output_path", top, -1)
    listed = found.select(
        F.substring_index("file_path", top, -1).alias("relative_path"),
        F.col("file_size_bytes").alias("bytes_on_disk"),
    )
    return manifest.select(tail.alias("relative_path"), "bytes").join(listed, "relative_path", "left")


@query
def sink_txt(spark, sf):
    # The given paths collide by stem, so the image id goes into the name.
    root = new_folder(spark, "txt")
    named = _documents(spark, sf).withColumn("output_base", F.concat_ws("-", "output_base", "image_id"))
    return _sunk(spark, document_files.text_bodies(_into(named, root)), root)


@query
def sink_json(spark, sf):
    root = new_folder(spark, "json")
    named = _documents(spark, sf).withColumn("output_base", F.concat_ws("-", "output_base", "image_id"))
    manifest = written(document_files.write_files(document_files.json_bodies(_into(named, root))), "manifest")
    return _read_back(spark, root, manifest)


def _read_back(spark, root, manifest):
    """Each JSON file by itself: pages and text it holds, and whether it has the size its writer says."""
    listed = file_sources.list_files(spark, InputOptions(root_path=root, extensions=(".json",)))
    said = manifest.select(_below(root, "output_path").alias("relative_path"), "bytes")
    held = document_files.read_document_files(listed).select(
        _below(root, "file_path").alias("relative_path"), "page_count", "bytes_on_disk",
        F.size("pages").alias("n_pages"), F.sha2("full_text", 256).alias("text_sha256"),
    )
    return held.join(said, "relative_path", "left").select(
        "relative_path", "page_count", "n_pages", "text_sha256",
        F.coalesce(F.col("bytes") == F.col("bytes_on_disk"), F.lit(False)).alias("size_as_said"),
    )


def _below(root, column):
    return F.substring_index(column, root.rsplit("/", 1)[-1], -1)


@query
def sink_paged(spark, sf):
    """Files written page by page: text files as in sink_txt, and what the JSON files hold."""
    root = new_folder(spark, "paged")
    options = replace(OPTIONS, output=replace(OPTIONS.output, root_path=root))
    named = views.recognised_pages(spark, sf).withColumn(
        "file_path", F.regexp_replace("file_path", "([.][^./]*)$", F.concat(F.lit("-"), "image_id", F.lit("$1")))
    )
    manifest = written(write_pages(named, options.output.formats, options, _now()), "manifest").withColumn(
        "output_path", F.concat_ws(".", "output_base", "format")
    )
    texts = manifest.where("format = 'txt'").select(
        F.concat(_below(root, "output_base"), F.lit(".json")).alias("relative_path"), F.col("bytes").alias("txt_bytes")
    )
    return _read_back(spark, root, manifest.where("format = 'json'")).join(texts, "relative_path", "left")


# ----------------------------------------------------------------- recognition


@query
def conf_percent(spark, sf):
    text_pages = views.text_pages(spark, sf)
    return tokens.page_confidence(text_pages, views.tokens(text_pages), 100)


@query
def tokens_space(spark, sf):
    text_pages = views.text_pages(spark, sf)
    return tokens.pages_from_tokens(text_pages, views.tokens(text_pages), " ", 100)


@query
def lines_newline(spark, sf):
    text_pages = views.text_pages(spark, sf)
    # A line without a score counts as a null line.
    lines = views.tokens(text_pages).withColumn("text", F.when(F.col("conf") >= 0, F.col("text")))
    return tokens.pages_from_tokens(text_pages, lines, "\n", 100)


@query
def round4(spark, sf):
    """Characters per word of each document, rounded half up."""
    words = text.word_count(F.col("text")).cast("bigint")
    return spread(views.table(spark, sf, "documents")).select(
        "doc_id",
        F.when(words > 0, numbers.half_up4(F.col("n_chars"), words)).alias("chars_per_word"),
    )


@query
def lang_split(spark, sf):
    """Each document's language with English as the second choice."""
    languages = F.concat("lang", F.lit("+en"))
    return views.table(spark, sf, "documents").select(
        "doc_id",
        F.array_join(text.language_list(languages), ",").alias("all_languages"),
        text.first_language(languages).alias("first_language"),
    )


@query
def iso_time(spark, sf):
    return views.table(spark, sf, "events").select("event_id", times.iso_utc(F.col("ts")).alias("iso"))


@query
def recognise_stub(spark, sf):
    images = views.text_pages(spark, sf).select(
        "image_id", "page_number", F.encode("text", "UTF-8").alias("image")
    )
    return recognising.recognise(images, RecogniserOptions(engine="plain")).drop("processing_time_ms")


@query
def recognise_guarded(spark, sf):
    """Pages of toxic documents end the engine's process; they fail and all others are read."""
    bad = views.table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("image_id")).distinct()
    marked = views.text_pages(spark, sf).join(bad.withColumn("bad", F.lit(True)), "image_id", "left")
    image = F.when(F.col("bad"), F.unhex(F.lit("FF"))).otherwise(F.encode("text", "UTF-8"))
    images = marked.select("image_id", "page_number", image.alias("image"))
    options = RecogniserOptions(engine="abrupt", page_seconds=60.0)
    return recognising.recognise(images, options).drop("processing_time_ms", "ocr_engine")


# ---------------------------------------------------------------------- pixels


def _parsed(spark, sf):
    return dpi_columns.with_dpi(views.dpi_pages(spark, sf), PREP.default_dpi)


@query
def dpi_parse(spark, sf):
    return _parsed(spark, sf).select(
        "id", F.col("original_dpi.x").alias("x_dpi"), F.col("original_dpi.y").alias("y_dpi")
    )


@query
def dpi_plan(spark, sf):
    planned = dpi_columns.with_resample_plan(_parsed(spark, sf), PREP)
    return planned.select("id", "scale", "resized", "new_width", "new_height")


@query
def dpi_scale(spark, sf):
    planned = dpi_columns.with_scaled_size(_parsed(spark, sf), PREP.target_dpi)
    return planned.select("id", "new_width", "new_height")


@query
def grid_luma(spark, sf):
    return tiles.to_pixels(tiles.to_gray(views.tiles(spark, sf, colour=True)))


@query
def grid_resample(spark, sf):
    plan = page_prep.size_plan(views.grid_pages(spark, sf), PREP)
    return tiles.to_pixels(tiles.resample(views.tiles(spark, sf), plan))


@query
def otsu_threshold(spark, sf):
    return tiles.page_statistics(views.tiles(spark, sf)).select("image_id", "page_number", "threshold")


@query
def otsu_binarise(spark, sf):
    return tiles.to_pixels(tiles.otsu_binarise(views.tiles(spark, sf)))


@query
def skew_angle(spark, sf):
    angles = tiles.page_statistics(views.tiles(spark, sf))
    return angles.select("image_id", "page_number", F.round("angle", 6).alias("angle"))


@query
def grid_rotate(spark, sf):
    # Angles of -9..9 degrees, one per page; zero leaves a page alone.
    degrees = ((F.col("image_id") * 4 + F.col("page_number")) * 5 % 19 - 9).cast("double")
    angles = views.grid_pages(spark, sf).select("image_id", "page_number", degrees.alias("angle"))
    return tiles.to_pixels(tiles.rotate(views.tiles(spark, sf), angles))


@query
def sauvola(spark, sf):
    return tiles.to_pixels(tiles.sauvola(views.tiles(spark, sf)))


@query
def page_prep_pixels(spark, sf):
    clean, _ = page_prep.prepare_pages(
        views.tiles(spark, sf, colour=True), views.grid_pages(spark, sf), PREP
    )
    return tiles.to_pixels(clean)


@query
def recognise_clean(spark, sf):
    """Page images cleaned and read, and the same images read as they come."""
    images = tiles.page_images(views.tiles(spark, sf, colour=True)).drop("width", "height")
    images = written(images.join(views.grid_pages(spark, sf).drop("width", "height"), ["image_id", "page_number"]), "images")
    options = replace(RecogniserOptions(), engine="ink")
    read = [
        recognising.recognise(page_prep.prepare_images(images, prep)[0], options)
        for prep in (PREP, replace(PREP, enabled=False))
    ]
    columns = ["image_id", "page_number", "prepared", "text", "confidence", "error"]
    return read[0].select(columns).unionByName(read[1].select(columns))


@query
def page_prep_flags(spark, sf):
    _, flags = page_prep.prepare_pages(
        views.tiles(spark, sf, colour=True), views.grid_pages(spark, sf), PREP
    )
    return flags.select(
        "image_id", "page_number", F.col("original_dpi.x").alias("x_dpi"),
        F.col("original_dpi.y").alias("y_dpi"), "was_upscaled", "was_deskewed",
        F.round("skew_angle_degrees", 6).alias("skew_angle_degrees"),
    )


@query
def image_scan(spark, sf):
    """Pixel pages written as image files and read back through the image source."""
    root = new_folder(spark, "images")
    written(views.write_bitmaps(views.colour_grid(spark, sf), root), "manifest")
    images = file_sources.read_images(spark, root)
    gray = raster.luma(F.col("r"), F.col("g"), F.col("b"))
    pixels = file_sources.image_pixels(images)
    name = F.substring_index(F.substring_index("file_path", "/", -1), ".", 1)
    return pixels.groupBy(name.alias("name")).agg(
        (F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"),
        F.sum(gray).alias("gray_sum"), F.sum(gray * F.col("x")).alias("gray_x"),
    )


@query
def list_tree(spark, sf):
    """Files with empty, hidden, upper-case and spaced names, written and then listed both ways."""
    root = new_folder(spark, "tree")

    def one_of(values, number):
        return F.element_at(F.array(*map(F.lit, values)), (number + 1).cast("int"))

    doc_id = F.col("doc_id")
    name = F.concat(
        one_of(views.ODD_FOLDERS, doc_id % 5), one_of(views.ODD_PREFIXES, doc_id % 6),
        doc_id.cast("string"), one_of(views.ODD_SUFFIXES, doc_id % 7 % 3),
    )
    bodies = views.table(spark, sf, "documents").select(
        F.concat(F.lit(root + "/"), name).alias("output_path"),
        F.when(doc_id % 11 == 0, "").otherwise(F.coalesce("text", F.lit(""))).alias("body"),
    )
    written(document_files.write_files(bodies), "manifest")
    options = InputOptions(root_path=root)
    flat = file_sources.list_files(spark, InputOptions(root_path=root, recursive=False))
    flat = flat.select("file_path", F.lit(True).alias("flat"))
    found = file_sources.list_files(spark, options).join(flat, "file_path", "left")
    return found.select(
        F.substring_index("file_path", root.rsplit("/", 1)[-1] + "/", -1).alias("relative_path"),
        "file_size_bytes", F.coalesce("flat", F.lit(False)).alias("in_flat"),
    )


@query
def decode_scan(spark, sf):
    """A file per document, each line a page, some no UTF-8; listed, decoded, told page by page."""
    root = new_folder(spark, "scans")
    bad = views.table(spark, sf, "labels").where("toxic = 1").select("doc_id", F.lit(True).alias("bad"))
    scan = F.encode(F.translate(F.coalesce("text", F.lit("")), "\n", "\f"), "UTF-8")
    bodies = views.table(spark, sf, "documents").join(bad, "doc_id", "left").select(
        F.concat(F.lit(root + "/"), F.col("doc_id").cast("string"), F.lit(".tif")).alias("output_path"),
        F.when(F.col("bad"), F.unhex(F.lit("FF"))).otherwise(scan).alias("body"),
    )
    written(document_files.write_files(bodies), "manifest")
    found = file_sources.list_files(spark, InputOptions(root_path=root))
    pages_in = file_sources.decode_pages(found, file_sources.text_pages)
    size = F.octet_length("image").cast("bigint")
    return _no_nulls(pages_in.withColumn("bytes", size), "bytes").select(
        F.substring_index("file_name", ".", 1).cast("bigint").alias("image_id"), "page_number", "bytes",
        F.col("error").isNotNull().alias("has_error"),
    )


# ------------------------------------------------------------------- streaming


@query
def stream_discovery(spark, sf):
    """Two runs of the discovery stream over written files; the second adds nothing."""
    root, ledger_root, checkpoint = (new_folder(spark, n) for n in ("in", "ledger", "stream"))
    named = _documents(spark, sf).withColumn("output_base", F.concat_ws("-", "output_base", "image_id"))
    written(document_files.write_files(document_files.text_bodies(_into(named, root))), "manifest")
    options = InputOptions(root_path=root, extensions=(".txt",))
    for _ in range(2):
        discovery.register_available(spark, options, ledger_root, checkpoint, _now())
    return discovery.registered(spark, ledger_root).select(
        "id", F.substring_index("file_path", root.rsplit("/", 1)[-1], -1).alias("relative_path"),
        "file_size_bytes",
        "status", "retry_count",
    )


@query
def document_feed(spark, sf):
    root, checkpoint = new_folder(spark, "feed"), new_folder(spark, "stream")
    schema = views.table(spark, sf, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    )
    feed.feed_completed(
        views.status_events(events), "image_id", "ts", root, checkpoint
    ).awaitTermination()
    return feed.fed(spark, root, "image_id bigint, ts timestamp_ntz").select("image_id", "ts")
