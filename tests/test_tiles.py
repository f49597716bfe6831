"""Tiles: any tile size gives the same pages, pages leave and come back whole, and clean pages reach the engine."""

import json
from dataclasses import replace

import numpy as np
import pytest

from scanlake.functions.times import moment
from scanlake.operators import recognising, registering, tiles
from scanlake.options import InputOptions, Options, OutputOptions, PrepOptions, RecogniserOptions, RunOptions
from scanlake.plans import job
from scanlake.plans.page_prep import prepare_images, prepare_pages
from scanlake.sources import files as file_sources
from scanlake.sources import tables

IMAGE = "image_id bigint, page_number int, image binary, dpi array<string>"


def page(height, width, channels=1, seed=3):
    """A light page with dark lines that rise a little."""
    draw = np.random.default_rng(seed)
    pixels = draw.integers(200, 256, (height, width, channels))
    for y in range(15, height - 25, 12):
        for x in range(5, width - 5):
            at = y + round(x * 0.06)
            if x % 9 and at + 2 < height:
                pixels[at : at + 2, x] = draw.integers(0, 60, channels)
    return pixels.astype(np.uint8)


def images_of(spark, *pages, dpi=("100", "100")):
    rows = [(1, n, tiles.to_portable_map(p), list(dpi)) for n, p in enumerate(pages, 1)]
    return spark.createDataFrame(rows, IMAGE)


def read_back(found):
    return {r.page_number: tiles.portable_map(bytes(r.image)) for r in found.collect()}


def test_images_come_back_as_they_were(spark):
    pages = [page(70, 90), page(33, 20, 3), page(1, 1), page(16, 16)]
    for side in (16, 64):
        got = read_back(tiles.page_images(tiles.from_images(images_of(spark, *pages), side=side)))
        assert all((got[n] == p).all() for n, p in enumerate(pages, 1)) and len(got) == 4


def test_headers_with_comments_and_bad_images():
    plain = b"P5 # a comment\n# another\n3 2\n255\n" + bytes(range(6))
    assert tiles.portable_map(plain)[:, :, 0].tolist() == [[0, 1, 2], [3, 4, 5]]
    for bad in (b"", b"P5 3", b"P4 1 1 1 x", b"P5 3 2 255 ab", b"P5 1 1 65535 ab"):
        with pytest.raises(ValueError):
            tiles.portable_map(bad)


@pytest.mark.parametrize("method", ["sauvola", "otsu"])
def test_the_chain_does_not_depend_on_tiles(spark, method):
    images = images_of(spark, page(90, 130, 3), page(50, 41, 3, 4))
    plan = images.selectExpr("image_id", "page_number", "dpi", "if(page_number = 1, 130, 41) width", "if(page_number = 1, 90, 50) height")
    options = PrepOptions(target_dpi=250, binarization=method)
    found = []
    for side in (32, 57, 512):
        clean, flags = prepare_pages(tiles.from_images(images, side=side), plan, options)
        found.append(({n: p.tobytes() for n, p in read_back(tiles.page_images(clean)).items()}, sorted(map(tuple, flags.collect()))))
    assert found[0] == found[1] == found[2]
    assert all(row[3] and row[2] for row in found[0][1])  # enlarged and turned
    assert set(np.frombuffer(found[0][0][1], np.uint8)) == {0, 255}


def test_statistics_of_pages_over_many_tiles(spark):
    pixels = page(300, 200)
    grid = tiles.from_images(images_of(spark, pixels), side=32).repartition(6)
    row = tiles.page_statistics(grid).first()
    counts = np.bincount(pixels.ravel(), minlength=256)
    assert (row.v_min, row.v_max, row.threshold) == (pixels.min(), pixels.max(), tiles._otsu(counts))
    y, x = np.nonzero(pixels[:, :, 0] < row.threshold)
    covariance = np.cov(x, y)
    angle = np.degrees(0.5 * np.arctan2(2 * covariance[0, 1], covariance[0, 0] - covariance[1, 1]))
    assert row.angle == pytest.approx(angle - 90 if angle > 45 else angle)


def test_an_undecodable_page_fails_alone(spark):
    images = images_of(spark, page(40, 40)).unionByName(spark.createDataFrame([(1, 2, b"no image", None), (1, 3, None, None)], IMAGE))
    found = {r.page_number: r for r in prepare_images(images, PrepOptions())[0].collect()}
    assert found[1].prepared and found[1].error is None and found[1].image is not None
    assert not found[2].prepared and found[2].error and found[2].image is None
    assert not found[3].prepared and found[3].error


def test_empty_tables(spark):
    images = spark.createDataFrame([], IMAGE)
    clean, flags = prepare_images(images, PrepOptions())
    assert clean.count() == flags.count() == 0
    assert tiles.page_statistics(tiles.from_images(images)).count() == 0


def pages_of(content):
    """Decoder of files that hold portable maps one after the other, each after its length in four bytes."""
    at = 0
    while at < len(content):
        size = int.from_bytes(content[at : at + 4], "little")
        pixels = tiles.portable_map(content[at + 4 : at + 4 + size])
        yield content[at + 4 : at + 4 + size], pixels.shape[1], pixels.shape[0], ["100", "100"]
        at += 4 + size


@pytest.mark.parametrize("enabled", [True, False])
def test_the_job_reads_clean_pages(spark, tmp_path, enabled):
    inbox, out, work = tmp_path / "in", tmp_path / "out", str(tmp_path / "work")
    inbox.mkdir()
    images = [tiles.to_portable_map(page(60, 80, 3, seed)) for seed in (1, 2)]
    (inbox / "a.tif").write_bytes(b"".join(len(i).to_bytes(4, "little") + i for i in images))
    (inbox / "bad.tif").write_bytes(b"\x05\0\0\0hello")
    options = Options(
        input=InputOptions(root_path=str(inbox)), output=OutputOptions(root_path=str(out)),
        recogniser=RecogniserOptions(engine="ink"), run=RunOptions(max_retries=1),
        prep=replace(PrepOptions(), enabled=enabled),
    )

    def process(claimed):
        todo = claimed.selectExpr("id AS image_id", "file_path", "file_size_bytes")
        clean, _ = prepare_images(file_sources.decode_pages(todo, pages_of, tasks=2), options.prep)
        return recognising.recognise(clean, options.recogniser)

    known = tables.read_ledger(spark, work)
    new = registering.register_files(file_sources.list_files(spark, options.input), known, moment("2024-01-01 06:00:00"))
    tables.commit(known.unionByName(new), None, work, 0)
    job.run_job(spark, work, process, options, "job", moment("2024-01-01 06:00:00"))
    ledger = {r.file_name: r.status for r in tables.read_ledger(spark, work).collect()}
    assert ledger == {"a.tif": "complete", "bad.tif": "failed"}
    told = json.loads((out / "a.json").read_text())
    assert told["preprocessing_enabled"] is enabled and told["page_count"] == 2
    # Enlarged three times, a page has more bands of scanlines.
    assert [len(p["text"].split()) for p in told["pages"]] == [12 if enabled else 4] * 2
