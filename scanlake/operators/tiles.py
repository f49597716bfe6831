"""Page pixels as tiles: one row for up to ``side`` x ``side`` pixels, its bytes in scanline order.

A tile row says its page's size, so its own place and shape follow. Filters that look at one pixel at a time
map tiles to tiles. Those that look around have one exchange: every tile cuts out the parts other tiles need
of it, the parts are dealt out by the tile they go to, and that task pastes them together and works on arrays.
No task ever holds a page, however large, except where a whole page is asked for (``page_images``), and no row
is a pixel except in ``to_pixels``.

Sums are of integers, so results depend neither on tile size nor on the order of tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby, product
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.operators.raster import (
    FEWEST_INK_PIXELS, PAGE_KEY, SAUVOLA_K, SAUVOLA_R, SAUVOLA_WINDOW, WEIGHT_ONE, WHITE, angle_of_sums,
)

SIDE = 256
TILE_KEY = [*PAGE_KEY, "ty", "tx"]
_HEAD = "image_id long, page_number int, width int, height int, side int, channels int, ty int, tx int"
SCHEMA = f"{_HEAD}, data binary"
_PIECE = f"{_HEAD}, y0 int, x0 int, h int, w int, a double, b double, low int, high int, data binary"
_HEAD_NAMES = [c.split()[0] for c in _HEAD.split(", ")]
_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
#: Output batches hold about so many bytes of pixels.
BATCH_BYTES = 8 << 20

Row = dict[str, Any]
#: Parts (ty, tx, top, left, bottom, right) in page places that tiles (ty, tx) need of this one.
Needs = Callable[[Row], Iterator[tuple[int, int, int, int, int, int]]]


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in ddl.split(", ")])


def _batches(rows: Iterator[Row], ddl: str) -> Iterator[pa.RecordBatch]:
    schema, held, size = _arrow(ddl), [], 0
    for row in rows:
        held.append(row)
        size += len(row["data"]) + 200
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
    for batch in batches:
        yield from batch.to_pylist()


def _place(row: Row) -> tuple[int, int, int, int]:
    """Top, left, bottom and right of a tile in its page."""
    side = row["side"]
    top, left = row["ty"] * side, row["tx"] * side
    return top, left, min(top + side, row["height"]), min(left + side, row["width"])


def _pixels(row: Row) -> np.ndarray:
    top, left, bottom, right = _place(row)
    return np.frombuffer(row["data"], np.uint8).reshape(bottom - top, right - left, row["channels"])


def _head(row: Row) -> Row:
    return {name: row[name] for name in _HEAD_NAMES}


def mapped(tiles: DataFrame, change: Callable[[Row, np.ndarray], np.ndarray]) -> DataFrame:
    """Each tile's pixels changed by themselves; page columns joined to the tiles are in the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[Row]:
            for row in _rows(batches):
                pixels = change(row, _pixels(row)).astype(np.uint8)
                yield _head(row) | {"channels": pixels.shape[2], "data": pixels.tobytes()}

        yield from _batches(out(), SCHEMA)

    return tiles.mapInArrow(run, SCHEMA)


def _cut(tiles: DataFrame, needs: Needs, page: Callable[[Row], Row]) -> DataFrame:
    """The parts of all tiles for those that need them; ``page`` gives the columns of the page they are for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[Row]:
            for row in _rows(batches):
                top, left, _, _ = _place(row)
                pixels, own = _pixels(row), _head(row) | {"a": 0.0, "b": 0.0, "low": 0, "high": 255} | page(row)
                for ty, tx, y0, x0, y1, x1 in needs(row):
                    part = pixels[y0 - top : y1 - top, x0 - left : x1 - left]
                    yield own | {"ty": ty, "tx": tx, "y0": y0, "x0": x0, "h": part.shape[0], "w": part.shape[1],
                                 "data": part.tobytes()}

        yield from _batches(out(), _PIECE)

    return tiles.mapInArrow(run, _PIECE)


#: (a row of the tile, top and left of the region, the region's pixels) to the tile's pixels.
Make = Callable[[Row, int, int, np.ndarray], np.ndarray]


def _pasted(pieces: DataFrame, make: Make) -> DataFrame:
    """The one exchange: parts meet in the task of their tile, which makes the tile from the region they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[Row]:
            for _, group in groupby(_rows(batches), lambda r: tuple(r[k] for k in TILE_KEY)):
                parts = list(group)
                some = [p for p in parts if p["h"] and p["w"]] or parts[:1]
                y0, x0 = (min(p[k] for p in some) for k in ("y0", "x0"))
                y1, x1 = (max(p[a] + p[b] for p in some) for a, b in (("y0", "h"), ("x0", "w")))
                region = np.zeros((y1 - y0, x1 - x0, parts[0]["channels"]), np.uint8)
                for p in some:
                    at = slice(p["y0"] - y0, p["y0"] - y0 + p["h"]), slice(p["x0"] - x0, p["x0"] - x0 + p["w"])
                    region[at] = np.frombuffer(p["data"], np.uint8).reshape(p["h"], p["w"], p["channels"])
                pixels = make(parts[0], y0, x0, region)
                yield _head(parts[0]) | {"channels": pixels.shape[2], "data": pixels.astype(np.uint8).tobytes()}

        yield from _batches(out(), SCHEMA)

    return pieces.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY).mapInArrow(run, SCHEMA)


# ------------------------------------------------------------ building, leaving


def from_lines(lines: DataFrame, side: int = SIDE, channels: int = 1) -> DataFrame:
    """Tiles from scanlines (PAGE_KEY, width, height, y, line), ``line`` an array of width x channels values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[Row]:
            for row in _rows(batches):
                line = np.array(row["line"], np.uint8).reshape(-1, channels)
                for tx in range(-(-row["width"] // side)):
                    strip = line[tx * side : (tx + 1) * side]
                    yield {
                        **{k: row[k] for k in (*PAGE_KEY, "width", "height")}, "side": side, "channels": channels,
                        "ty": row["y"] // side, "tx": tx, "y0": row["y"], "x0": tx * side, "h": 1, "w": len(strip),
                        "a": 0.0, "b": 0.0, "low": 0, "high": 255, "data": strip.tobytes(),
                    }

        yield from _batches(out(), _PIECE)

    strips = lines.select(*PAGE_KEY, "width", "height", "y", "line").mapInArrow(run, _PIECE)
    return _pasted(strips, lambda row, y0, x0, region: region)


def portable_map(image: bytes) -> np.ndarray:
    """Pixels (height, width, channels) of a binary portable gray map or pixel map with values up to 255."""
    fields, at = [], 0
    while len(fields) < 4:
        while image[at : at + 1].isspace() or image[at : at + 1] == b"#":
            at = image.index(b"\n", at) + 1 if image[at : at + 1] == b"#" else at + 1
        end = at
        while not image[end : end + 1].isspace():
            if end >= len(image):
                raise ValueError("image header ends early")
            end += 1
        fields.append(image[at:end])
        at = end
    kind, width, height, top = fields[0], *map(int, fields[1:])
    if kind not in (b"P5", b"P6") or top > 255:
        raise ValueError("not a portable gray map or pixel map of 8 bits")
    channels = 1 if kind == b"P5" else 3
    return np.frombuffer(image, np.uint8, width * height * channels, at + 1).reshape(height, width, channels)


def to_portable_map(pixels: np.ndarray) -> bytes:
    height, width, channels = pixels.shape
    return b"P%d %d %d 255\n" % (5 if channels == 1 else 6, width, height) + pixels.tobytes()


def from_images(
    pages: DataFrame, decode: Callable[[bytes], np.ndarray] = portable_map, side: int = SIDE
) -> DataFrame:
    """Tiles of page images (PAGE_KEY, image); no exchange. Pages that ``decode`` refuses are in ``undecodable``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[Row]:
            for row in _rows(batches):
                try:
                    pixels = decode(row["image"])
                except Exception:  # noqa: BLE001 - told by undecodable()
                    continue
                height, width, channels = pixels.shape
                for ty, tx in product(range(-(-height // side)), range(-(-width // side))):
                    part = pixels[ty * side : (ty + 1) * side, tx * side : (tx + 1) * side]
                    yield {**{k: row[k] for k in PAGE_KEY}, "width": width, "height": height, "side": side,
                           "channels": channels, "ty": ty, "tx": tx, "data": part.tobytes()}

        yield from _batches(out(), SCHEMA)

    return pages.select(*PAGE_KEY, "image").mapInArrow(run, SCHEMA)


def undecodable(pages: DataFrame, decode: Callable[[bytes], np.ndarray] = portable_map) -> DataFrame:
    """PAGE_KEY and error of the pages whose image cannot be decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            try:
                decode(row["image"])
            except Exception as problem:  # noqa: BLE001 - any failure belongs to this page only
                yield pa.RecordBatch.from_pylist(
                    [{**{k: row[k] for k in PAGE_KEY}, "error": str(problem) or type(problem).__name__}],
                    pa.schema([("image_id", pa.int64()), ("page_number", pa.int32()), ("error", pa.string())]),
                )

    return pages.select(*PAGE_KEY, "image").mapInArrow(run, "image_id long, page_number int, error string")


def from_pixels(grid: DataFrame, side: int = SIDE) -> DataFrame:
    """Tiles from one row per pixel (PAGE_KEY, y, x and v or r, g, b)."""
    values = ["v"] if "v" in grid.columns else ["r", "g", "b"]
    sizes = grid.groupBy(PAGE_KEY).agg(
        (F.max("x") + 1).cast("int").alias("width"), (F.max("y") + 1).cast("int").alias("height")
    )
    placed = grid.join(sizes, PAGE_KEY).select(
        F.col("image_id").cast("long").alias("image_id"), F.col("page_number").cast("int").alias("page_number"),
        "width", "height", "y", "x", *values,
        F.floor(F.col("y") / side).cast("int").alias("ty"), F.floor(F.col("x") / side).cast("int").alias("tx"),
    )

    def run(table: pa.Table) -> pa.Table:
        row = table.slice(0, 1).to_pylist()[0] | {"side": side, "channels": len(values)}
        top, left, bottom, right = _place(row)
        pixels = np.zeros((bottom - top, right - left, len(values)), np.uint8)
        at = table.column("y").to_numpy() - top, table.column("x").to_numpy() - left
        pixels[at] = np.stack([table.column(v).to_numpy() for v in values], 1)
        return pa.Table.from_pylist([_head(row) | {"data": pixels.tobytes()}], _arrow(SCHEMA))

    return placed.groupBy(*TILE_KEY).applyInArrow(run, SCHEMA)


def to_pixels(tiles: DataFrame, channels: int = 1) -> DataFrame:
    """One row per pixel, for those who want to look at pixels in SQL."""
    values = ["v"] if channels == 1 else ["r", "g", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            top, left, bottom, right = _place(row)
            y, x = np.mgrid[top:bottom, left:right].astype(np.int32).reshape(2, -1)
            pixels = _pixels(row).reshape(len(y), -1).astype(np.int32)
            yield pa.record_batch(
                [
                    pa.array(np.full(len(y), row["image_id"])), pa.array(np.full(len(y), row["page_number"], np.int32)),
                    pa.array(y), pa.array(x), *[pa.array(np.ascontiguousarray(pixels[:, k])) for k in range(len(values))],
                ],
                names=[*PAGE_KEY, "y", "x", *values],
            )

    ddl = "image_id long, page_number int, y int, x int, " + ", ".join(f"{v} int" for v in values)
    return tiles.mapInArrow(run, ddl)


def page_images(tiles: DataFrame, encode: Callable[[np.ndarray], bytes] = to_portable_map) -> DataFrame:
    """Whole pages as image bytes (PAGE_KEY, width, height, image), their tiles pasted in order; one exchange.

    Whoever reads a page wants it whole, so a page has to fit into a row here, and only here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(_rows(batches), lambda r: tuple(r[k] for k in PAGE_KEY)):
            page = None
            for row in group:
                if page is None:
                    page = np.zeros((row["height"], row["width"], row["channels"]), np.uint8)
                top, left, bottom, right = _place(row)
                page[top:bottom, left:right] = _pixels(row)
            yield pa.record_batch(
                [
                    pa.array([row["image_id"]], pa.int64()), pa.array([row["page_number"]], pa.int32()),
                    pa.array([row["width"]], pa.int32()), pa.array([row["height"]], pa.int32()),
                    pa.array([encode(page)], pa.binary()),
                ],
                names=[*PAGE_KEY, "width", "height", "image"],
            )

    ordered = tiles.repartition(*PAGE_KEY).sortWithinPartitions(*TILE_KEY)
    return ordered.mapInArrow(run, "image_id long, page_number int, width int, height int, image binary")


# ------------------------------------------------------------- pixel by pixel


def to_gray(tiles: DataFrame) -> DataFrame:
    """Red, green and blue as one gray value, by the integers of ``raster.luma``."""

    def gray(row: Row, pixels: np.ndarray) -> np.ndarray:
        if pixels.shape[2] == 1:
            return pixels
        r, g, b = (pixels[:, :, k : k + 1].astype(np.int32) for k in range(3))
        # 0.299, 0.587 and 0.114 times 65536.
        return (r * 19595 + g * 38470 + b * 7471 + 32768) >> 16

    return mapped(tiles, gray)


def otsu_binarise(tiles: DataFrame, statistics: DataFrame | None = None) -> DataFrame:
    """White above the page's threshold, else black."""
    if statistics is None:
        statistics = page_statistics(tiles)
    joined = tiles.join(statistics.select(*PAGE_KEY, "threshold"), PAGE_KEY)
    return mapped(joined, lambda row, pixels: np.where(pixels > row["threshold"], WHITE, 0))


# ------------------------------------------------------------- page statistics

_SUMS = ["n", "sy", "sx", "syy", "sxx", "sxy"]
_BINS = 256 * len(_SUMS)
#: Pages whose bins a task holds before it passes them on.
_PAGES_HELD = 512


def page_bins(tiles: DataFrame) -> DataFrame:
    """PAGE_KEY, height, width and, for each of the 256 values, count and moments of its pixels; one exchange.

    A task sums the tiles of a page before they leave it, so a page costs one row a task.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for row in _rows(batches):
            top, left, bottom, right = _place(row)
            v = _pixels(row)[:, :, 0].ravel()
            y, x = np.mgrid[top:bottom, left:right].astype(np.float64).reshape(2, -1)
            # Sums of whole numbers below 2^53 are exact in floating point.
            sums = [np.bincount(v, w, 256).astype(np.int64) for w in (np.ones(len(v)), y, x, y * y, x * x, x * y)]
            page = row["image_id"], row["page_number"]
            held[page] = held.get(page, 0) + np.concatenate(sums)
            if len(held) >= _PAGES_HELD:
                yield _bin_rows(held)
                held = {}
        if held:
            yield _bin_rows(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, page = None, None
        for batch in batches:
            bins = batch.column("bins").flatten().to_numpy().reshape(-1, _BINS)
            keys = zip(batch.column("image_id").to_pylist(), batch.column("page_number").to_pylist(), strict=True)
            done: dict[tuple, np.ndarray] = {}
            for key, own in zip(keys, bins, strict=True):
                if key == page:
                    held = held + own
                    continue
                if page is not None:
                    done[page] = held
                page, held = key, own
            if done:
                yield _bin_rows(done)
        if page is not None:
            yield _bin_rows({page: held})

    ddl = "image_id long, page_number int, bins array<long>"
    summed = tiles.mapInArrow(add, ddl)
    return summed.repartition(*PAGE_KEY).sortWithinPartitions(*PAGE_KEY).mapInArrow(merge, ddl)


def _bin_rows(pages: dict[tuple, np.ndarray]) -> pa.RecordBatch:
    flat = pa.array(np.concatenate(list(pages.values())))
    return pa.record_batch(
        [
            pa.array([k[0] for k in pages], pa.int64()), pa.array([k[1] for k in pages], pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.arange(len(pages) + 1, dtype=np.int32) * _BINS), flat),
        ],
        names=[*PAGE_KEY, "bins"],
    )


def _otsu(counts: np.ndarray) -> int:
    """The value that best splits dark from light, the smallest of equals; the only one if there is one."""
    values = np.flatnonzero(counts)
    w1 = np.cumsum(counts[values]).astype(np.float64)
    s1 = np.cumsum(counts[values] * values).astype(np.float64)
    w, s = w1[-1], s1[-1]
    if len(values) == 1:
        return int(values[0])
    w1, s1 = w1[:-1], s1[:-1]
    gap = s1 / w1 - (s - s1) / (w - w1)
    return int(values[np.argmax(w1 * (w - w1) * gap * gap)])


def page_statistics(tiles: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """PAGE_KEY, threshold, v_min, v_max and angle of every page, from one pass over its tiles.

    The threshold is Otsu's unless ``thresholds`` (PAGE_KEY, threshold) gives it; pixels below it are ink, and
    the angle is that of the ink's principal axis in degrees, folded to -45..45, zero for a few pixels.
    """
    bins, chosen = page_bins(tiles), thresholds is not None
    if chosen:
        bins = bins.join(thresholds.select(*PAGE_KEY, "threshold"), PAGE_KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            given = batch.column("threshold").to_pylist() if chosen else [None] * batch.num_rows
            for own, threshold in zip(batch.column("bins").flatten().to_numpy().reshape(-1, _BINS), given, strict=True):
                sums = own.reshape(len(_SUMS), 256)
                values = np.flatnonzero(sums[0])
                threshold = _otsu(sums[0]) if threshold is None else threshold
                rows.append([threshold, int(values[0]), int(values[-1]), *sums[:, : max(0, threshold)].sum(1).tolist()])
            columns = list(zip(*rows, strict=True)) or [[]] * (3 + len(_SUMS))
            yield pa.record_batch(
                [batch.column("image_id"), batch.column("page_number"), *[pa.array(c, pa.int32()) for c in columns[:3]],
                 *[pa.array(c, pa.int64()) for c in columns[3:]]],
                names=[*PAGE_KEY, "threshold", "v_min", "v_max", *_SUMS],
            )

    ddl = "image_id long, page_number int, threshold int, v_min int, v_max int, " + ", ".join(f"{s} long" for s in _SUMS)
    found = bins.mapInArrow(run, ddl)
    angle = F.when(F.col("n") >= FEWEST_INK_PIXELS, angle_of_sums()).otherwise(F.lit(0.0))
    return found.select(*PAGE_KEY, "threshold", "v_min", "v_max", angle.alias("angle"))


# ---------------------------------------------------------------- around a pixel


def _mirrored(at: np.ndarray, size: int) -> np.ndarray:
    """Places beyond an edge, mirrored at the edge's pixel."""
    if size == 1:
        return np.zeros_like(at)
    at = np.mod(at, 2 * size - 2)
    return np.where(at < size, at, 2 * size - 2 - at)


def sauvola(
    tiles: DataFrame, window: int = SAUVOLA_WINDOW, k: float = SAUVOLA_K, r: float = SAUVOLA_R
) -> DataFrame:
    """Local threshold from mean and deviation around each pixel, page edges mirrored.

    Window sums come from summed-area tables of value and square: four look-ups a pixel, whatever the window.
    Tiles get a border of half a window from their neighbours. A tile side must be at least that wide.
    """
    reach = window // 2

    def needs(row: Row):
        top, left, bottom, right = _place(row)
        side = row["side"]
        for ty in range(max(0, (top - reach) // side), min((bottom - 1 + reach) // side, (row["height"] - 1) // side) + 1):
            for tx in range(max(0, (left - reach) // side), min((right - 1 + reach) // side, (row["width"] - 1) // side) + 1):
                y0, x0 = max(top, ty * side - reach), max(left, tx * side - reach)
                y1, x1 = min(bottom, (ty + 1) * side + reach), min(right, (tx + 1) * side + reach)
                if y0 < y1 and x0 < x1:
                    yield ty, tx, y0, x0, y1, x1

    def make(row: Row, y0: int, x0: int, region: np.ndarray) -> np.ndarray:
        top, left, bottom, right = _place(row)
        ys = _mirrored(np.arange(top - reach, bottom + reach), row["height"]) - y0
        xs = _mirrored(np.arange(left - reach, right + reach), row["width"]) - x0
        near = region[:, :, 0][np.ix_(ys, xs)].astype(np.int64)

        def sums(values: np.ndarray) -> np.ndarray:
            area = np.zeros((len(ys) + 1, len(xs) + 1), np.int64)
            area[1:, 1:] = values.cumsum(0).cumsum(1)
            size = 2 * reach + 1
            return area[size:, size:] - area[:-size, size:] - area[size:, :-size] + area[:-size, :-size]

        n = float((2 * reach + 1) ** 2)
        mean, square = sums(near) / n, sums(near * near) / n
        deviation = np.sqrt(np.maximum(square - mean * mean, 0.0))
        threshold = mean * (1.0 + k * (deviation / r - 1.0))
        own = near[reach : reach + bottom - top, reach : reach + right - left]
        return np.where(own > threshold, WHITE, 0)[:, :, None]

    return _pasted(_cut(tiles, needs, lambda row: {}), make)


# ------------------------------------------------------------------------ geometry


def _lanczos(t: float) -> float:
    if t == 0.0:
        return 1.0
    a = 3.141592653589793 * t
    return 3.0 * math.sin(a) * math.sin(a / 3.0) / (a * a) if abs(t) < 3.0 else 0.0


def _taps(size: int, new_size: int, to: int) -> tuple[int, int]:
    """First source place of a target place, and the end."""
    if size == new_size:
        return to, to + 1
    step = size / new_size
    support = max(step, 1.0) * 3.0
    centre = (to + 0.5) * step
    return max(math.floor(centre - support + 0.5), 0), min(math.floor(centre + support + 0.5), size)


@lru_cache(maxsize=256)
def _weights(size: int, new_size: int, begin: int, end: int) -> tuple[int, np.ndarray]:
    """First source place of the target places [begin, end), and a matrix of whole weights, one row each."""
    first, last = _taps(size, new_size, begin)[0], _taps(size, new_size, end - 1)[1]
    out = np.zeros((end - begin, last - first))
    step = size / new_size
    stretch = max(step, 1.0)
    for to in range(begin, end):
        a, b = _taps(size, new_size, to)
        for at in range(a, b):
            t = (at + 0.5 - (to + 0.5) * step) / stretch
            out[to - begin, at - first] = WEIGHT_ONE if size == new_size else math.floor(_lanczos(t) * WEIGHT_ONE + 0.5)
    return first, out


def _weighed(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted means along the last axis, rounded half up, within 0..255. All sums are whole and exact."""
    total = weights.sum(1).astype(np.int64)
    sums = (values.astype(np.float64) @ weights.T).astype(np.int64)
    return np.clip((2 * sums + total) // (2 * total), 0, WHITE)


def resample(tiles: DataFrame, plan: DataFrame) -> DataFrame:
    """Resize pages with the Lanczos kernel (3 lobes), first along x, then along y, rounded in between.

    ``plan``: PAGE_KEY, new_width, new_height. Pages that keep their size are not exchanged.
    """
    sized = tiles.join(plan.select(*PAGE_KEY, "new_width", "new_height"), PAGE_KEY)
    same = (F.col("width") == F.col("new_width")) & (F.col("height") == F.col("new_height"))

    def spans(begin: int, end: int, size: int, new_size: int, side: int):
        """Target tiles along one axis that need places of [begin, end), and which."""
        for t in range(-(-new_size // side)):
            a = _taps(size, new_size, t * side)[0]
            b = _taps(size, new_size, min((t + 1) * side, new_size) - 1)[1]
            if max(a, begin) < min(b, end):
                yield t, max(a, begin), min(b, end)

    def needs(row: Row):
        top, left, bottom, right = _place(row)
        across = list(spans(left, right, row["width"], row["new_width"], row["side"]))
        for ty, y0, y1 in spans(top, bottom, row["height"], row["new_height"], row["side"]):
            for tx, x0, x1 in across:
                yield ty, tx, y0, x0, y1, x1

    def page(row: Row) -> Row:
        # The piece tells the new page's size, and the old one besides.
        return {"width": row["new_width"], "height": row["new_height"], "low": row["width"], "high": row["height"]}

    def make(row: Row, y0: int, x0: int, region: np.ndarray) -> np.ndarray:
        top, left, bottom, right = _place(row)
        _, across = _weights(row["low"], row["width"], left, right)
        _, down = _weights(row["high"], row["height"], top, bottom)
        wide = _weighed(region.transpose(0, 2, 1), across)
        tall = _weighed(wide.transpose(2, 1, 0), down)
        return tall.transpose(2, 0, 1)

    kept = sized.where(same).select(*_HEAD_NAMES, "data")
    return kept.unionByName(_pasted(_cut(sized.where(~same), needs, page), make))


def _cubic(a: np.ndarray) -> np.ndarray:
    """Catmull-Rom kernel at distance a."""
    near = (a * 1.5 - 2.5) * a * a + 1.0
    far = ((a * -0.5 + 2.5) * a - 4.0) * a + 2.0
    return np.where(a < 1.0, near, np.where(a < 2.0, far, 0.0))


def _towards_zero(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    return np.sign(a) * (np.abs(a) // b)


def rotate(tiles: DataFrame, angles: DataFrame) -> DataFrame:
    """Turn pages about their centre by ``angle`` degrees, same size, white outside, cubic between pixels.

    ``angles``: PAGE_KEY, angle, and v_min and v_max, the page's range of values, which its new values keep to;
    without these it is looked up first. Pages without an angle, or with a zero one, are not exchanged.
    """
    if "v_min" not in angles.columns:
        angles = angles.join(page_statistics(tiles).select(*PAGE_KEY, "v_min", "v_max"), PAGE_KEY)
    turning = angles.where(F.col("angle") != 0.0).select(
        *PAGE_KEY, F.cos(F.radians("angle")).alias("c"), F.sin(F.radians("angle")).alias("s"), "v_min", "v_max"
    )
    placed = tiles.join(turning, PAGE_KEY, "left")

    def corners(top, left, bottom, right, row, c, s):
        """Least and largest place, along y and x, of a rectangle's corners after a turn."""
        mid_x, mid_y = row["width"] / 2.0 - 0.5, row["height"] / 2.0 - 0.5
        dx = np.array([left, left, right, right]) - mid_x
        dy = np.array([top, bottom, top, bottom]) - mid_y
        xs, ys = c * dx - s * dy + mid_x, s * dx + c * dy + mid_y
        return ys.min(), xs.min(), ys.max(), xs.max()

    def needs(row: Row):
        top, left, bottom, right = _place(row)
        side, c, s = row["side"], row["c"], row["s"]
        # Each tile calls itself to life, even if no pixel reaches it.
        yield row["ty"], row["tx"], top, left, top, left
        low_y, low_x, high_y, high_x = corners(top - 3, left - 3, bottom + 2, right + 2, row, c, -s)
        for ty in range(max(0, int(low_y // side)), min(int(high_y // side), (row["height"] - 1) // side) + 1):
            for tx in range(max(0, int(low_x // side)), min(int(high_x // side), (row["width"] - 1) // side) + 1):
                target = row | {"ty": ty, "tx": tx}
                a, b, e, f = _place(target)
                y_low, x_low, y_high, x_high = corners(a, b, e - 1, f - 1, row, c, s)
                y0, x0 = max(top, math.floor(y_low) - 2), max(left, math.floor(x_low) - 2)
                y1, x1 = min(bottom, math.ceil(y_high) + 3), min(right, math.ceil(x_high) + 3)
                if y0 < y1 and x0 < x1:
                    yield ty, tx, y0, x0, y1, x1

    def page(row: Row) -> Row:
        return {"a": row["c"], "b": row["s"], "low": row["v_min"], "high": row["v_max"]}

    def make(row: Row, y0: int, x0: int, region: np.ndarray) -> np.ndarray:
        top, left, bottom, right = _place(row)
        width, height, c, s = row["width"], row["height"], row["a"], row["b"]
        mid_x, mid_y = width / 2.0 - 0.5, height / 2.0 - 0.5
        dy, dx = np.mgrid[top:bottom, left:right].astype(np.float64)
        dx, dy = dx - mid_x, dy - mid_y
        at_x, at_y = c * dx - s * dy + mid_x, s * dx + c * dy + mid_y
        base_x, base_y = np.floor(at_x), np.floor(at_y)
        total = np.zeros(at_x.shape, np.int64)
        weight = np.zeros(at_x.shape, np.int64)
        values = region[:, :, 0].astype(np.int64)
        for j, i in product(range(-1, 3), range(-1, 3)):
            x, y = base_x + i, base_y + j
            inside = (x >= 0) & (x < width) & (y >= 0) & (y < height)
            units = np.floor(_cubic(np.abs(at_x - x)) * _cubic(np.abs(at_y - y)) * WEIGHT_ONE + 0.5).astype(np.int64)
            units = np.where(inside, units, 0)
            yi = np.clip(y.astype(np.int64) - y0, 0, max(0, values.shape[0] - 1))
            xi = np.clip(x.astype(np.int64) - x0, 0, max(0, values.shape[1] - 1))
            if values.size:
                total += units * values[yi, xi]
            weight += units
        whole = (base_x >= 1) & (np.ceil(at_x) + 1 < width) & (base_y >= 1) & (np.ceil(at_y) + 1 < height)
        mean = _towards_zero(total, np.maximum(weight, 1))
        edged = _towards_zero(total + (WEIGHT_ONE - weight) * WHITE, WEIGHT_ONE)
        value = np.where(whole & (weight > 0), mean, edged)
        return np.where(value == WHITE, WHITE, np.clip(value, row["low"], row["high"]))[:, :, None]

    kept = placed.where("c is null").select(*_HEAD_NAMES, "data")
    return kept.unionByName(_pasted(_cut(placed.where("c is not null"), needs, page), make))
