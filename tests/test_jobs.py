"""Jobs that write: rounds over the queue, snapshots, streams."""

import datetime

import pytest
from pyspark.sql import functions as F

from scanlake.functions.times import moment
from scanlake.operators import integrity, ledger as steps, recognising, registering
from scanlake.options import InputOptions, Options, OutputOptions, RecogniserOptions, RunOptions
from scanlake.plans.document_job import document_rows
from scanlake.plans.rounds import run_rounds
from scanlake.schemas import LEDGER, RESULTS
from scanlake.session import new_folder
from scanlake.sources import documents as document_files, files as file_sources, tables
from scanlake.streaming import discovery, feed
from tests.test_ledger import ledger_of, row

OPTIONS = Options(
    input=InputOptions(root_path="/in"), output=OutputOptions(root_path="/out"), run=RunOptions(max_retries=3)
)


def queue(spark, images):
    """Page images by id; ids without an entry have no file."""
    rows = [(i, p, bytearray(b)) for i, page_list in images.items() for p, b in enumerate(page_list, 1)]
    stored = spark.createDataFrame(rows, "image_id bigint, page_number int, image binary")

    def process(claimed):
        todo = claimed.select(F.col("id").alias("image_id"), "file_path")
        return recognising.recognise(todo.join(stored, "image_id"), RecogniserOptions(engine="plain"))

    return process


def test_rounds_finish_retry_and_isolate(spark):
    ledger = ledger_of(
        spark, row(1, "pending"), row(2, "pending", retry_count=1), row(3, "pending"), row(4, "pending", retry_count=3),
        row(5, "complete"), row(6, "processing", worker_id="gone", started_at=datetime.datetime(2024, 1, 1)),
    )
    process = queue(spark, {1: [b"one", b""], 2: [b"fine", b"\xff"], 4: [b"x"], 6: [b"six"]})
    after, results = run_rounds(
        ledger, spark.createDataFrame([], RESULTS), process, OPTIONS, "job", moment("2024-01-01 06:00:00")
    )
    got = {r["id"]: r for r in after.collect()}
    assert {i: r["status"] for i, r in got.items()} == {
        1: "complete", 2: "failed", 3: "failed", 4: "pending", 5: "complete", 6: "complete"
    }
    assert (got[1]["output_path"], got[1]["page_count"], got[1]["worker_id"]) == ("/out/1", 2, "job")
    assert got[2]["retry_count"] == 3 and "utf-8" in got[2]["error_message"]
    assert got[3]["error_message"] == "file gave no pages" and got[6]["retry_count"] == 1
    assert sorted((r["image_id"], r["page_number"], r["extracted_text"]) for r in results.collect()) == [
        (1, 1, "one"), (1, 2, ""), (6, 1, "six")
    ]
    again, more = run_rounds(after, results, process, OPTIONS, "job", moment("2024-01-01 06:30:00"))
    assert {r["id"]: r for r in again.collect()} == got and more.count() == 0


def test_collection_from_files_to_documents(spark, tmp_path):
    """Register, run, assemble and write; then a second run with a repaired and a new file."""
    inbox, out, work = tmp_path / "in", tmp_path / "out", str(tmp_path / "work")
    (inbox / "sub").mkdir(parents=True)
    (inbox / "a.tif").write_bytes("Hello Wörld\f\fthird page".encode())
    (inbox / "sub" / "b.tiff").write_bytes(b"single")
    (inbox / "bad.tif").write_bytes(b"\xff\xfe")
    options = Options(
        input=InputOptions(root_path=str(inbox)), output=OutputOptions(root_path=f"file://{out}"),
        recogniser=RecogniserOptions(engine="plain"),
    )
    now = moment("2024-01-01 06:00:00")

    def process(claimed):
        todo = claimed.selectExpr("id AS image_id", "file_path", "file_size_bytes")
        pages = file_sources.decode_pages(todo, file_sources.text_pages, tasks=3)
        return recognising.recognise(pages, options.recogniser)

    def run():
        known = tables.read_ledger(spark, work)
        new = registering.register_files(file_sources.list_files(spark, options.input), known, now)
        ledger, results = run_rounds(
            known.unionByName(new), tables.read_results(spark, work), process, options, "job", now
        )
        tables.write_snapshot(results, f"{work}/results")
        tables.write_snapshot(ledger, f"{work}/ledger")
        integrity.check(ledger, tables.read_results(spark, work))
        return {r["file_name"]: r for r in tables.read_ledger(spark, work).collect()}

    first = run()
    assert {n: (r["status"], r["page_count"]) for n, r in first.items()} == {
        "a.tif": ("complete", 3), "b.tiff": ("complete", 1), "bad.tif": ("failed", None)
    }
    assert first["a.tif"]["output_path"] == f"file://{out}/a"
    results = tables.read_results(spark, work).join(
        tables.read_ledger(spark, work).selectExpr("id AS image_id", "file_path", "file_size_bytes"), "image_id"
    )
    pages = results.withColumnsRenamed({"extracted_text": "text", "confidence_score": "confidence"})
    docs = document_rows(pages, options, now)
    assert document_files.write_files(document_files.text_bodies(docs)).count() == 2
    assert (out / "a.txt").read_text() == "Hello Wörld\n\n--- Page Break ---\n\nthird page"
    assert (out / "sub" / "b.txt").read_text() == "single"

    (inbox / "bad.tif").write_bytes(b"repaired")
    (inbox / "c.tif").write_bytes(b"new")
    tables.write_snapshot(steps.reset_failed(tables.read_ledger(spark, work)), f"{work}/ledger")
    second = run()
    assert {r["status"] for r in second.values()} == {"complete"} and len(second) == 4
    assert second["a.tif"] == first["a.tif"]
    assert tables.read_results(spark, work).count() == 6


def test_snapshots_are_versioned(spark, tmp_path):
    root = str(tmp_path)
    assert tables.read_ledger(spark, root).count() == 0
    tables.init_tables(spark, root)
    tables.init_tables(spark, root)
    assert (tmp_path / "ledger" / "v=1" / "_SUCCESS").exists() and not (tmp_path / "ledger" / "v=2").exists()
    tables.write_snapshot(ledger_of(spark, row(1, "pending")), f"{root}/ledger")
    # Half-written versions do not count, and the next attempt replaces them.
    (tmp_path / "ledger" / "v=3").mkdir()
    assert tables.read_ledger(spark, root).count() == 1
    both = tables.read_ledger(spark, root).unionByName(ledger_of(spark, row(2, "pending")))
    assert tables.write_snapshot(both, f"{root}/ledger") == 3
    assert tables.read_ledger(spark, root).count() == 2
    assert tables.read_results(spark, root).schema.names == RESULTS.names


def test_stream_registers_each_file_once(spark, tmp_path):
    inbox, root, checkpoint = tmp_path / "in", str(tmp_path / "ledger"), str(tmp_path / "check")
    (inbox / "sub").mkdir(parents=True)
    (inbox / "a.tif").write_bytes(b"1")
    (inbox / "note.txt").write_bytes(b"1")
    options = InputOptions(root_path=str(inbox))
    now = moment("2024-01-01 00:00:00")

    def run():
        discovery.register_available(spark, options, root, checkpoint, now)
        found = discovery.registered(spark, root)
        return sorted((r["id"], r["file_name"], r["status"]) for r in found.collect())

    assert run() == [(1, "a.tif", "pending")] == run()
    (inbox / "sub" / "b.TIFF").write_bytes(b"22")
    assert run() == [(1, "a.tif", "pending"), (2, "b.TIFF", "pending")]


def test_feed_delivers_each_document_once(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("events", "feed", "check"))
    schema = "relative_path string, ts timestamp_ntz, action string"

    def add(*rows):
        spark.createDataFrame(list(rows), "relative_path string, ts string, action string").select(
            "relative_path", F.col("ts").cast("timestamp_ntz"), "action"
        ).write.mode("append").parquet(source)

    def run():
        events = spark.readStream.schema(schema).parquet(source)
        feed.feed_completed(events, "relative_path", "ts", root, checkpoint).awaitTermination()
        got = feed.fed(spark, root, "relative_path string, ts timestamp_ntz").collect()
        return sorted((r["relative_path"], r["ts"].hour) for r in got)

    add(("a", "2024-01-01 01:00:00", "completed"), ("a", "2024-01-01 00:00:00", "completed"), ("b", "2024-01-01 00:00:00", "failed"))
    assert run() == [("a", 0)]
    add(("a", "2024-01-01 02:00:00", "completed"), ("b", "2024-01-01 03:00:00", "completed"))
    assert run() == [("a", 0), ("b", 3)] == run()


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        pytest.skip("no spark.checkpoint.dir in this session")
    assert new_folder(spark, "x").startswith(f"file:{configured}/x-")
    assert LEDGER.names[0] == "id"
