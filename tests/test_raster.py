"""Pixel operators against plain loops over small pages."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanlake.operators import tiles
from scanlake.options import PrepOptions
from scanlake.plans.page_prep import prepare_pages

CELL = "image_id bigint, page_number int, y int, x int, v int"


def grid_of(spark, *arrays, side=8):
    rows = [
        (1, p, int(y), int(x), int(a[y, x]))
        for p, a in enumerate(arrays, 1) for y in range(a.shape[0]) for x in range(a.shape[1])
    ]
    return tiles.from_pixels(spark.createDataFrame(rows, CELL), side)


def arrays_of(found):
    pages = {}
    for r in tiles.to_pixels(found).collect():
        cells = pages.setdefault(r["page_number"], {})
        assert (r["y"], r["x"]) not in cells
        cells[r["y"], r["x"]] = r["v"]
    out = {}
    for p, cells in pages.items():
        h, w = (max(k[i] for k in cells) + 1 for i in (0, 1))
        assert len(cells) == h * w
        out[p] = np.array([[cells[y, x] for x in range(w)] for y in range(h)])
    return out


def noise(h, w, seed=1):
    return np.random.default_rng(seed).integers(0, 256, (h, w))


def otsu(a):
    best, th = -1.0, int(a.max())
    for t in range(int(a.min()), int(a.max())):
        low, high = a[a <= t], a[a > t]
        if len(low) and len(high):
            var = len(low) * len(high) * (low.mean() - high.mean()) ** 2
            if var > best * (1 + 1e-12):
                best, th = var, t
    return th


def test_otsu(spark):
    uniform, two = np.full((5, 7), 255), np.array([[10] * 6 + [200] * 3])
    pages = [noise(20, 30), uniform, two]
    grid = grid_of(spark, *pages)
    got = {r["page_number"]: r["threshold"] for r in tiles.page_statistics(grid).collect()}
    assert got == {p: otsu(a) for p, a in enumerate(pages, 1)}
    binary = arrays_of(tiles.otsu_binarise(grid))
    assert (binary[2] == 0).all()  # a blank page turns black
    assert binary[3].tolist() == [[0] * 6 + [255] * 3]
    assert set(np.unique(binary[1])) == {0, 255}


def test_skew(spark):
    def page(*ink):
        a = np.full((40, 60), 255)
        for y, x in ink:
            a[y, x] = 0
        return a

    line = page(*[(10 + round(x * math.tan(math.radians(7))), x) for x in range(60)])
    steep = page(*[(y, 20 + round(y * 0.1)) for y in range(40)])
    few = page((1, 1), (2, 2), (3, 3), (9, 4))
    diagonal = page(*[(i, i) for i in range(5)])
    flat = np.full((8, 8), 17)
    grid = grid_of(spark, line, steep, few, diagonal, flat)
    # Threshold 0 splits ink from paper only if "below" includes it; use one above it.
    thresholds = grid.select("image_id", "page_number").distinct().withColumn("threshold", F.lit(128))
    got = {r["page_number"]: r["angle"] for r in tiles.page_statistics(grid, thresholds).collect()}
    assert got[1] == pytest.approx(7, abs=0.3)
    assert got[2] == pytest.approx(-5.7, abs=0.5)
    assert got[3] == 0.0 and got[4] == pytest.approx(45.0)
    by_otsu = {r["page_number"]: r["angle"] for r in tiles.page_statistics(grid).collect()}
    assert by_otsu[5] == 0.0


def sauvola(a, window=25, k=0.2, r=127.5):
    reach = window // 2

    def mirror(i, n):
        period = 2 * (n - 1)
        if period == 0:
            return 0
        i %= period
        return i if i < n else period - i

    h, w = a.shape
    padded = np.array(
        [[a[mirror(y, h), mirror(x, w)] for x in range(-reach, w + reach)] for y in range(-reach, h + reach)], float
    )
    out = np.zeros_like(a)
    for y in range(h):
        for x in range(w):
            block = padded[y : y + window, x : x + window]
            m = block.sum() / block.size
            s = math.sqrt(max((block**2).sum() / block.size - m * m, 0))
            out[y, x] = 255 if a[y, x] > m * (1 + k * (s / r - 1)) else 0
    return out


@pytest.mark.parametrize("side", [13, 16, 27, 256])
def test_sauvola_across_tiles_and_edges(spark, side):
    pages = [noise(40, 53), noise(9, 70, 2), noise(1, 30, 3), noise(5, 1, 4), noise(2, 2, 5)]
    got = arrays_of(tiles.sauvola(grid_of(spark, *pages, side=side)))
    for p, a in enumerate(pages, 1):
        assert (got[p] == sauvola(a)).all()


def lanczos(a, new, axis):
    old = a.shape[axis]
    step = old / new
    stretch = max(step, 1.0)
    rows = []
    for d in range(new):
        centre = (d + 0.5) * step
        lo, hi = max(int(centre - 3 * stretch + 0.5), 0), min(int(centre + 3 * stretch + 0.5), old)
        w = np.array([np.sinc(t) * np.sinc(t / 3) if abs(t) < 3 else 0.0 for t in
                      [(i + 0.5 - centre) / stretch for i in range(lo, hi)]])
        rows.append(np.tensordot(w / w.sum(), np.take(a, range(lo, hi), axis), (0, axis)))
    return np.clip(np.floor(np.stack(rows, axis) + 0.5), 0, 255)


@pytest.mark.parametrize("size", [(40, 60), (7, 11), (20, 64), (1, 1)])
def test_resample(spark, size):
    a, b = noise(20, 30), noise(6, 6, 2)
    plan = spark.createDataFrame(
        [(1, 1, 30, 20, size[1], size[0]), (1, 2, 6, 6, 6, 6)],
        "image_id bigint, page_number int, width int, height int, new_width int, new_height int",
    )
    got = arrays_of(tiles.resample(grid_of(spark, a, b), plan))
    want = lanczos(lanczos(a, size[1], 1), size[0], 0)
    assert got[1].shape == size and (np.abs(got[1] - want) <= 1).all() and (got[1] == want).mean() > 0.99
    assert (got[2] == b).all()


def rotate(a, angle):
    h, w = a.shape
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    my, mx = h / 2 - 0.5, w / 2 - 0.5

    def kernel(t):
        t = abs(t)
        return 1.5 * t**3 - 2.5 * t**2 + 1 if t < 1 else -0.5 * t**3 + 2.5 * t**2 - 4 * t + 2 if t < 2 else 0.0

    out = np.zeros((h, w))
    for y in range(h):
        for x in range(w):
            fx, fy = c * (x - mx) - s * (y - my) + mx, s * (x - mx) + c * (y - my) + my
            for ky in range(math.floor(fy) - 1, math.floor(fy) + 3):
                for kx in range(math.floor(fx) - 1, math.floor(fx) + 3):
                    v = a[ky, kx] if 0 <= ky < h and 0 <= kx < w else 255
                    out[y, x] += kernel(fx - kx) * kernel(fy - ky) * v
    return out


@pytest.mark.parametrize("angle", [3.5, -12.0, 44.0, 90.0])
def test_rotate(spark, angle):
    a, b, flat = noise(17, 23), noise(9, 9, 2), np.full((12, 15), 77)
    angles = spark.createDataFrame([(1, 1, angle), (1, 2, 0.0), (1, 3, angle)], "image_id bigint, page_number int, angle double")
    got = arrays_of(tiles.rotate(grid_of(spark, a, b, flat), angles))
    want = np.clip(np.floor(rotate(a, angle) + 1e-4), a.min(), a.max())
    white = np.abs(rotate(a, angle) - 255) < 1e-6
    off = np.abs(np.where(white, 255, want) - got[1])
    assert got[1].shape == a.shape and off.max() <= 1 and (off == 0).mean() > 0.95
    assert (got[2] == b).all()
    assert set(np.unique(got[3][4:8, 5:10])) == {77}


def test_turning_a_line_by_its_skew_levels_it(spark):
    a = np.full((60, 90), 255)
    for x in range(10, 80):
        y = round(30 + (x - 45) * math.tan(math.radians(6)))
        a[y - 1 : y + 2, x] = 0
    grid = grid_of(spark, a)
    angles = tiles.page_statistics(grid, grid.select("image_id", "page_number").distinct().withColumn("threshold", F.lit(128)))
    turned = tiles.rotate(grid, angles)
    after = tiles.page_statistics(turned, angles.select("image_id", "page_number", F.lit(128).alias("threshold"))).first()
    assert angles.first()["angle"] == pytest.approx(6, abs=0.4) and abs(after["angle"]) < 0.5


def test_luma_and_chain_without_filters(spark):
    rows = [(1, 1, 0, 0, 255, 0, 0), (1, 1, 0, 1, 0, 255, 0), (1, 1, 0, 2, 0, 0, 255), (1, 1, 0, 3, 255, 255, 255)]
    colour = spark.createDataFrame(rows, "image_id bigint, page_number int, y int, x int, r int, g int, b int")
    pages = spark.createDataFrame([(1, 1, ["300"], 4, 1)], "image_id bigint, page_number int, dpi array<string>, width int, height int")
    for options in (PrepOptions(enabled=False), PrepOptions(deskew=False, binarization=None)):
        grid, flags = prepare_pages(tiles.from_pixels(colour), pages, options)
        assert arrays_of(grid)[1].tolist() == [[76, 150, 29, 255]]
        row = flags.first()
        assert (row["was_upscaled"], row["was_deskewed"], row["skew_angle_degrees"]) == (False, False, 0.0)
        assert tuple(row["original_dpi"]) == (300.0, 300.0)


@pytest.mark.parametrize("method", ["Otsu", "SAUVOLA"])
def test_chain_gives_black_and_white(spark, method):
    pages = spark.createDataFrame(
        [(1, 1, ["100", "100"], 30, 20), (1, 2, None, 25, 10)],
        "image_id bigint, page_number int, dpi array<string>, width int, height int",
    )
    grid, flags = prepare_pages(grid_of(spark, noise(20, 30), noise(10, 25, 2), side=16), pages, PrepOptions(binarization=method))
    got = arrays_of(grid)
    assert got[1].shape == (60, 90) and got[2].shape == (10, 25)
    assert set(np.unique(got[1])) <= {0, 255}
    assert {r["page_number"]: r["was_upscaled"] for r in flags.collect()} == {1: True, 2: False}
