"""Files written page by page, the sweep of folders, and engines that hang or die."""

from __future__ import annotations

import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from scanlake.functions.times import moment
from scanlake.operators import recognising
from scanlake.operators.registering import unregistered_files
from scanlake.options import InputOptions, Options, OutputOptions, RecogniserOptions
from scanlake.plans.document_job import document_rows
from scanlake.schemas import LEDGER, RESULTS
from scanlake.session import folders_with_age, new_folder, scratch, shared_folder, sweep_scratch, written
from scanlake.sources import documents as document_files
from scanlake.sources import tables
from scanlake.sources.paged import write_pages

PAGES = (
    "image_id long, file_path string, file_size_bytes long, page_number int, text string, confidence double,"
    " processing_time_ms int, prepared boolean"
)
NOW = "2024-01-01 06:00:00"


def options_for(root) -> Options:
    return Options(input=InputOptions(root_path="/scans"), output=OutputOptions(root_path=str(root)))


def sample() -> list[tuple]:
    odd = ['quote " back \\ slash /', "tab\tline\nreturn\r\x01\x1f\x7f ", "Wörld 字 😀", "", None, " ", "</script>"]
    draw = random.Random(1)
    rows = []
    for image in range(40):
        for page in range(draw.choice([1, 2, 7])):
            score = draw.choice([0.0, 1e-05, 0.95, None, 1 / 3])
            rows.append((image, f"/scans/d {image % 3}/f{image}.x.tif", draw.choice([None, 5]) if image < 0 else image,
                         page + 1, draw.choice(odd), score, draw.choice([0, 12]), draw.random() < 0.9))
    rows += [(100, "/scans/big.tif", None, n, f"page {n} " * 50, 0.5, 1, True) for n in range(1, 3001)]
    rows += [(101, "/scans/twice.tif", 7, 1, t, 0.5, 1, None) for t in ("b", "a", "a")]
    draw.shuffle(rows)
    return rows


def test_files_are_those_of_whole_documents(spark, tmp_path):
    pages = spark.createDataFrame(sample(), PAGES).repartition(7)
    now = moment(NOW)
    whole = document_rows(pages, options_for(tmp_path / "a"), now)
    for bodies in (document_files.text_bodies, document_files.json_bodies):
        assert document_files.write_files(bodies(whole)).where("error is not null").count() == 0
    manifest = write_pages(pages, ("pdf", "txt", "json"), options_for(tmp_path / "b"), now).collect()
    assert len(manifest) == 2 * 42 and not [r for r in manifest if r.error]
    found = {str(p.relative_to(tmp_path / "a")): p.read_bytes() for p in (tmp_path / "a").rglob("*") if p.is_file()}
    paged = {str(p.relative_to(tmp_path / "b")): p.read_bytes() for p in (tmp_path / "b").rglob("*") if p.is_file()}
    assert paged == found and len(found) == 84
    assert {f"{r.output_base}.{r.format}": r.bytes for r in manifest} == {
        str(tmp_path / "b" / name): len(body) for name, body in found.items()
    }


def test_small_batches_no_pages_and_no_format(spark, tmp_path):
    pages = spark.createDataFrame(sample(), PAGES)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        write_pages(pages.where("page_number < 9"), ("txt",), options_for(tmp_path), moment(NOW)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert (tmp_path / "twice.txt").read_text() == "a\n\n--- Page Break ---\n\na\n\n--- Page Break ---\n\nb"
    assert len([p for p in tmp_path.rglob("*") if p.is_file()]) == 42
    assert write_pages(pages.limit(0), ("txt", "json"), options_for(tmp_path), moment(NOW)).count() == 0
    assert write_pages(pages, (), options_for(tmp_path), moment(NOW)).count() == 0


def test_a_file_that_cannot_be_written_fails_alone_and_leaves_nothing(spark, tmp_path):
    (tmp_path / "big.json" / "x").mkdir(parents=True)  # a folder where a file should be
    pages = spark.createDataFrame(sample(), PAGES)
    rows = write_pages(pages, ("txt", "json"), options_for(tmp_path), moment(NOW)).collect()
    assert [(r.image_id, r.format, r.bytes) for r in rows if r.error] == [(100, "json", None)]
    names = sorted(p.name for p in tmp_path.iterdir() if p.is_file())
    assert names == ["big.txt", "twice.json", "twice.txt"]


def test_sweep_keeps_what_ledgers_name(spark, tmp_path):
    root = str(tmp_path)
    tables.init_tables(spark, root)
    ledger = tables.read_ledger(spark, root)
    results = spark.createDataFrame(
        [(1, 1, "t", 0.5, 1, "plain", None)], "image_id long, page_number int, extracted_text string,"
        " confidence_score double, processing_time_ms int, ocr_engine string, created_at timestamp_ntz")
    results = results.withColumn("created_at", F.lit(NOW).cast("timestamp_ntz"))
    for after in (1, 2, 3):
        tables.commit(ledger, results, root, after)
    results.write.parquet(f"{root}/results/run-left")  # its commit never came
    results.write.parquet(f"{root}/ledger/_aside-left")
    assert tables.sweep(spark, root) == ["ledger/v=1", "ledger/v=2"]  # the rest may be of a running commit
    assert tables.sweep(spark, root, keep=1, older_than=0) == ["ledger/_aside-left", "ledger/v=3", "results/run-left"]
    assert tables.read_results(spark, root).count() == 3 and tables.newest(spark, f"{root}/ledger") == 4
    assert tables.sweep(spark, root, keep=1, older_than=0) == []
    with pytest.raises(ValueError):
        tables.sweep(spark, root, keep=0)


def test_changes_are_written_as_parts_and_read_back_whole(spark, tmp_path):
    root, rng = str(tmp_path), random.Random(6)

    def table(rows):
        data = [(i, f"/in/{i}", str(i), 1, s, None, None, None, None, n, None, None, NOW) for i, (s, n) in rows.items()]
        names = ", ".join(f.name + " " + ("string" if "time" in f.dataType.typeName() else f.dataType.simpleString()) for f in LEDGER)
        frame = spark.createDataFrame(data, names)
        return frame.select([F.col(f.name).cast(f.dataType) for f in LEDGER]).coalesce(1)

    def read():
        rows = tables.read_ledger(spark, root).collect()
        assert len({r.id for r in rows}) == len(rows)
        return {r.id: (r.status, r.retry_count) for r in rows}

    def size(folder):
        return sum(p.stat().st_size for p in (tmp_path / "ledger" / folder).iterdir())

    model = {i: ("pending", rng.randrange(1 << 30)) for i in range(20_000)}
    assert tables.commit_changes(table(model), None, root, 0) == 1 and read() == model
    results = spark.createDataFrame([], RESULTS)
    for version in range(1, 10):
        ids = rng.sample(sorted(model), 40) + [100_000 + version] * (version % 3 == 0)
        change = {i: ("complete", rng.randrange(1 << 30)) for i in ids}
        model |= change
        assert tables.commit_changes(table(change), results if version == 2 else None, root, version) == version + 1
        assert size(f"v={version + 1}") < size("v=1") / 2
    assert read() == model
    parts = tables._parts(spark, root, 10)
    assert parts[0] == "v=1" and parts[-1] == "v=10" and len(parts) < 6
    assert len(tables._runs(spark, root, 10)) == 1
    with pytest.raises(tables.VersionTaken):
        tables.commit_changes(table({1: ("failed", 1)}), None, root, 9)
    tables.sweep(spark, root, keep=1, older_than=0)
    assert read() == model and len(list((tmp_path / "ledger").iterdir())) == len(parts)
    # A change as large as half the ledger makes the version a whole ledger again.
    change = {i: ("failed", rng.randrange(1 << 30)) for i in range(0, 20_000, 2)}
    model |= change
    tables.commit_changes(table(change), None, root, 10)
    assert tables._parts(spark, root, 11) == ["v=11"] and read() == model
    tables.commit_changes(table({}), None, root, 11)
    assert read() == model


def test_a_small_listing_needs_no_exchange_of_the_ledger(spark, tmp_path):
    files = spark.range(20).selectExpr("concat('/in/', sha(cast(id AS string))) AS file_path", "id AS file_size_bytes")
    spark.range(10, 20_000).selectExpr("concat('/in/', sha(cast(id AS string))) AS file_path").write.parquet(f"{tmp_path}/l")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        new = unregistered_files(files, spark.read.parquet(f"{tmp_path}/l"))
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"BroadcastHashJoin .*LeftSemi, BuildRight", plan), plan
        assert new.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scratch_folders_go_and_others_stay(spark, tmp_path):
    def names() -> set[str]:
        return {name for name, _ in folders_with_age(spark, shared_folder(spark))}

    before = names()
    outer = written(spark.range(3), "outer")
    with pytest.raises(KeyboardInterrupt), scratch():
        written(spark.range(3), "inner")
        with scratch():
            written(spark.range(3), "innermost")
        assert len(names() - before) == 2
        raise KeyboardInterrupt
    assert {n.split("-")[0] for n in names() - before} == {"outer"} and outer.count() == 3
    assert not (names() - before) & set(sweep_scratch(spark, 3600))
    os.makedirs(lost := new_folder(spark, "lost").removeprefix("file:"))
    os.utime(lost, (0, 0))
    assert os.path.basename(lost) in sweep_scratch(spark, 10**9) and not os.path.exists(lost)


class Moody:
    """An engine that hangs, dies, raises or answers, as the page says."""

    def read(self, image):
        word = bytes(image).decode()
        if word == "hang":
            time.sleep(3600)
        if word == "die":
            os._exit(9)
        if word == "raise":
            raise ValueError("no good")
        return None, [(word, 0.5), (str(os.getpid()), -1.0)]


def test_one_hanging_page_fails_alone(spark):
    recognising.register_engine("moody", recognising.EngineSpec(lambda options: Moody(), 1, " "))
    words = ["one", "hang", "two", "die", "die", "raise", "three", "x" * 1_000_000]
    rows = [(i, w.encode()) for i, w in enumerate(words)]
    pages = spark.createDataFrame(rows, "page_number int, image binary").coalesce(1)
    options = RecogniserOptions(engine="moody", page_seconds=2.0)
    start = time.monotonic()
    got = {r.page_number: r for r in recognising.recognise(pages, options).collect()}
    assert time.monotonic() - start < 60
    assert [got[i].error for i in range(8)] == [
        None, "page took over 2 s", None, "engine ended with code 9", "engine ended with code 9", "no good", None, None
    ]
    assert [got[i].text.split()[0] for i in (0, 2, 6, 7)] == ["one", "two", "three", "x" * 1_000_000]
    assert got[1].processing_time_ms >= 2000


def test_an_engine_that_cannot_be_built_fails_its_pages(spark):
    def broken(options):
        raise OSError("no model")

    recognising.register_engine("broken", recognising.EngineSpec(broken, 1, " "))
    pages = spark.createDataFrame([(1, b"a"), (2, b"b")], "page_number int, image binary").coalesce(1)
    got = recognising.recognise(pages, RecogniserOptions(engine="broken", page_seconds=5.0)).collect()
    assert [r.error for r in got] == ["no model", "no model"]
