"""The composed job: files before completion, one commit point, the same end after any stop."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scanlake.functions.times import moment
from scanlake.operators import integrity, recognising, registering
from scanlake.options import InputOptions, Options, OutputOptions, RecogniserOptions, RunOptions
from scanlake.plans import job
from scanlake.sources import files as file_sources
from scanlake.sources import tables

NOW = "2024-01-01 06:00:00"


def collection(spark, root, blocked=False):
    inbox, out = root / "in", root / "out"
    (inbox / "sub").mkdir(parents=True)
    (inbox / "a.tif").write_bytes("Hello Wörld\f\fthird".encode())
    (inbox / "sub" / "b c#1.tiff").write_bytes(b"single")
    (inbox / "bad.tif").write_bytes(b"\xff\xfe")
    (inbox / "d.tif").write_bytes(b"last")
    if blocked:  # a folder where a file should be
        (out / "d.txt" / "x").mkdir(parents=True)
    options = Options(
        input=InputOptions(root_path=str(inbox)), output=OutputOptions(root_path=str(out)),
        recogniser=RecogniserOptions(engine="plain"), run=RunOptions(max_retries=1),
    )

    def process(claimed):
        todo = claimed.selectExpr("id AS image_id", "file_path", "file_size_bytes")
        pages = file_sources.decode_pages(todo, file_sources.text_pages, tasks=2)
        return recognising.recognise(pages, options.recogniser)

    work = str(root / "work")
    known = tables.read_ledger(spark, work)
    new = registering.register_files(file_sources.list_files(spark, options.input), known, moment(NOW))
    tables.commit(known.unionByName(new), None, work, 0)
    return work, out, lambda: job.run_job(spark, work, process, options, "job", moment(NOW), slice_rows=3)


def state(spark, work, out):
    rows = tables.read_ledger(spark, work).select("file_name", "status", "retry_count", "page_count").collect()
    keys = tables.read_results(spark, work).select("image_id", "page_number", "extracted_text").orderBy("image_id", "page_number").collect()
    # JSON files hold measured times and the input's folder, so their names alone are compared.
    found = [p for p in out.rglob("*") if p.is_file()]
    written = {str(p.relative_to(out)): p.read_text() if p.suffix == ".txt" else None for p in found}
    return sorted(map(tuple, rows)), list(map(tuple, keys)), written


def test_job_ends_the_same_after_a_stop_at_any_step(spark, tmp_path, monkeypatch):
    (tmp_path / "whole").mkdir()
    work, out, run = collection(spark, tmp_path / "whole")
    run()
    ledger, results, written = expected = state(spark, work, out)
    assert [r[:2] for r in ledger] == [
        ("a.tif", "complete"), ("b c#1.tiff", "complete"), ("bad.tif", "failed"), ("d.tif", "complete")
    ]
    assert sorted(written) == ["a.json", "a.txt", "d.json", "d.txt", "sub/b c#1.json", "sub/b c#1.txt"]
    assert len(results) == 5
    integrity.check(tables.read_ledger(spark, work), tables.read_results(spark, work))

    for step, (where, name) in enumerate([(job, "_write"), (tables, "_publish")]):
        work, out, run = collection(spark, tmp_path / str(step))

        def stop(*args, **kwargs):
            raise KeyboardInterrupt

        with monkeypatch.context() as patched:
            patched.setattr(where, name, stop)
            with pytest.raises(KeyboardInterrupt):
                run()
        assert tables.read_results(spark, work).count() == 0
        run()
        assert state(spark, work, out) == expected


def test_one_file_that_cannot_be_written(spark, tmp_path):
    work, out, run = collection(spark, tmp_path, blocked=True)
    run()
    ledger, results, _ = state(spark, work, out)
    assert {r[0]: r[1] for r in ledger} == {
        "a.tif": "complete", "b c#1.tiff": "complete", "bad.tif": "failed", "d.tif": "failed"
    }
    assert "last" not in {r[2] for r in results}


def test_retries_and_stale_rows_go_by_passes(spark, tmp_path):
    work, out, _ = collection(spark, tmp_path)
    ledger = tables.read_ledger(spark, work)
    left = F.when(F.col("file_name") == "d.tif", "processing").otherwise(F.col("status"))
    begun = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    changed = ledger.withColumn("status", left).withColumn("started_at", begun).where("status = 'processing'")
    version = tables.commit_changes(changed, None, work, 1)
    tries = []

    def process(claimed):
        tries.append(sorted(r.file_name for r in claimed.collect()))
        pages = file_sources.decode_pages(
            claimed.selectExpr("id AS image_id", "file_path", "file_size_bytes"), file_sources.text_pages, tasks=2)
        return recognising.recognise(pages, RecogniserOptions(engine="plain"))

    options = Options(
        input=InputOptions(root_path=str(tmp_path / "in")), output=OutputOptions(root_path=str(out)),
        recogniser=RecogniserOptions(engine="plain"), run=RunOptions(max_retries=2),
    )
    assert job.run_job(spark, work, process, options, "job", moment(NOW), slice_rows=2) == version + 4
    assert tries == [["a.tif", "bad.tif"], ["b c#1.tiff", "d.tif"], ["bad.tif"]]
    rows = {r.file_name: (r.status, r.retry_count) for r in tables.read_ledger(spark, work).collect()}
    assert rows == {"a.tif": ("complete", 0), "b c#1.tiff": ("complete", 0), "bad.tif": ("failed", 2), "d.tif": ("complete", 1)}


def test_a_version_is_given_once(spark, tmp_path):
    work = str(tmp_path)
    tables.init_tables(spark, work)
    first = tables.read_ledger(spark, work)
    assert tables.commit(first, None, work, 1) == 2
    with pytest.raises(tables.VersionTaken):
        tables.commit(first.where(F.lit(False)), None, work, 1)
    assert [p.name for p in (tmp_path / "ledger").iterdir() if p.name.startswith("_aside")] == []


def test_of_two_files_with_one_output_the_later_fails(spark, tmp_path):
    work, out, run = collection(spark, tmp_path)
    run()
    inbox = tmp_path / "in"
    (inbox / "a.tiff").write_bytes(b"the same stem as a file that is done")
    (inbox / "e.tif").write_bytes(b"first")
    (inbox / "e.TIFF").write_bytes(b"second")
    known = tables.read_ledger(spark, work)
    options = InputOptions(root_path=str(inbox))
    new = registering.register_files(file_sources.list_files(spark, options), known, moment(NOW))
    tables.commit(known.unionByName(new), None, work, tables.newest(spark, f"{work}/ledger"))
    run()
    rows = {r.file_name: r for r in tables.read_ledger(spark, work).collect()}
    assert rows["a.tif"].status == "complete" and rows["a.tiff"].status == "failed"
    assert rows["a.tiff"].error_message == f"output {out}/a belongs to image {rows['a.tif'].id}"
    first, second = sorted((rows["e.tif"], rows["e.TIFF"]), key=lambda r: r.id)
    assert (first.status, second.status) == ("complete", "failed")
    assert (out / "e.txt").read_text() == ("first" if first.file_name == "e.tif" else "second")
    assert (out / "a.txt").read_text().startswith("Hello")
    ids = {r.image_id for r in tables.read_results(spark, work).collect()}
    assert rows["a.tif"].id in ids and not ids & {rows["a.tiff"].id, second.id}
