import datetime

import pytest
from pyspark.sql import functions as F

from scanlake.functions import dpi, numbers, paths, text, times
from scanlake.options import Options, PrepOptions


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


@pytest.mark.parametrize(
    "value",
    ["", "a", " a  b ", "a b", "a b\n", "a\x1cb\x1f", "\x85a", "café \U0001f600 x", "\t\n", "　a"],
)
def test_text_agrees_with_python(spark, value):
    c = F.lit(value)
    assert one(spark, text.word_count(c)) == len(value.split())
    assert one(spark, text.char_count(c)) == len(value)
    assert one(spark, text.strip(c)) == value.strip()


def test_text_of_null(spark):
    nothing = F.lit(None).cast("string")
    assert one(spark, text.word_count(nothing)) == 0
    assert one(spark, text.char_count(nothing)) == 0


def test_languages(spark):
    assert one(spark, text.language_list(F.lit("eng+deu"))) == ["eng", "deu"]
    assert one(spark, text.first_language(F.lit("eng+deu"))) == "eng"
    assert one(spark, text.first_language(F.lit("eng"))) == "eng"


@pytest.mark.parametrize(
    "path, relative, base",
    [
        ("/in/a.tif", "a.tif", "/out/a"),
        ("/in/sub/b.tar.TIFF", "sub/b.tar.TIFF", "/out/sub/b.tar"),
        ("/elsewhere/x/c.tif", "c.tif", "/out/c"),
        ("/inside/d.tif", "d.tif", "/out/d"),
        ("/in/noext", "noext", "/out/noext"),
        ("/in/.hidden", ".hidden", "/out/.hidden"),
    ],
)
def test_paths(spark, path, relative, base):
    assert one(spark, paths.relative_path(F.lit(path), "/in/")) == relative
    assert one(spark, paths.output_base(F.lit(path), "/in", "/out/")) == base


def test_extension_ignores_case(spark):
    for name, wanted in [("a.TIF", True), ("a.tiff", True), ("a.jpg", False), ("tif", False), (".tif", False)]:
        assert one(spark, paths.has_extension(F.lit(name), (".tif", ".TIFF"))) is wanted


def test_backslashes(spark):
    assert one(spark, paths.slashes(F.lit("a\\b/c.tif"))) == "a/b/c.tif"


@pytest.mark.parametrize("n, d, want", [(1, 3, 0.3333), (5, 100000, 0.0001), (4, 100000, 0.0), (17, 20, 0.85)])
def test_half_up(spark, n, d, want):
    assert one(spark, numbers.half_up4(F.lit(n), F.lit(d))) == want


def test_iso_time(spark):
    assert one(spark, times.iso_utc(times.moment("2024-05-06 07:08:09"))) == "2024-05-06T07:08:09+00:00"
    assert one(spark, times.iso_utc(times.moment("2024-05-06 07:08:09.012"))) == "2024-05-06T07:08:09.012000+00:00"
    moment = datetime.datetime(2024, 5, 6, 7, 8, 9, 12)
    assert one(spark, times.iso_utc(times.moment(moment))) == moment.isoformat() + "+00:00"


def test_micros(spark):
    start, end = times.moment("2024-03-10 01:59:59.5"), times.moment("2024-03-10 03:00:00.25")
    assert one(spark, times.micros_between(start, end)) == 3_600_750_000


DPI = [
    (["150", "160"], (150, 160)), (["150"], (150, 150)), (["200"], (200, 200)), (["0"], (300, 300)),
    (["-1"], (300, 300)), ([], (300, 300)), (["not-a-number"], (300, 300)), (["x", "y"], (300, 300)),
    (None, (300, 300)), (["150", "0"], (300, 300)), (["0", "150"], (300, 300)), (["5d"], (300, 300)),
    (["nan"], (300, 300)), (["72.5"], (72.5, 72.5)),
]


def test_dpi_table(spark):
    rows = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(DPI)], "id int, dpi array<string>")
    got = {r["id"]: tuple(r["original_dpi"]) for r in dpi.with_dpi(rows, 300).collect()}
    assert got == {i: want for i, (_, want) in enumerate(DPI)}


@pytest.mark.parametrize(
    "x, width, height, options, want",
    [
        (100, 100, 50, PrepOptions(), (True, 300, 150)),
        (300, 400, 100, PrepOptions(), (False, 400, 100)),
        (5, 100, 50, PrepOptions(), (False, 100, 50)),
        (1300, 100, 50, PrepOptions(), (False, 100, 50)),
        (50, 100, 50, PrepOptions(), (False, 100, 50)),
        (150, 4000, 4000, PrepOptions(), (False, 4000, 4000)),
        (180, 100, 100, PrepOptions(target_dpi=90), (True, 50, 50)),
        (100, 1, 1, PrepOptions(target_dpi=50), (True, 1, 1)),
    ],
)
def test_resample_plan(spark, x, width, height, options, want):
    page = spark.createDataFrame([([str(x)], width, height)], "dpi array<string>, width int, height int")
    row = dpi.with_resample_plan(dpi.with_dpi(page, options.default_dpi), options).first()
    assert (row["resized"], row["new_width"], row["new_height"]) == want


def test_scaled_size_has_no_lower_bound_on_dpi(spark):
    page = spark.createDataFrame([(["250"], 100, 50)], "dpi array<string>, width int, height int")
    row = dpi.with_scaled_size(dpi.with_dpi(page, 300), 300).first()
    assert (row["new_width"], row["new_height"]) == (120, 60)


def test_options_replace_whole_sections():
    options = Options.from_mapping({"input": {"root_path": "/in"}, "prep": {"min_dpi": 96}, "database": {"server": "x"}})
    assert options.input.extensions == (".tif", ".tiff") and options.input.root_path == "/in"
    assert options.prep.min_dpi == 96 and options.prep.target_dpi == 300
    assert Options.from_mapping(None) == Options()
    named = Options.from_mapping({
        "ocr": {"engine": "plain", "tesseract_config": "c", "tesseract_cmd": None}, "preprocessing": {"denoise": True},
        "pipeline": {"num_workers": 2, "stale_processing_minutes": 5},
    })
    assert (named.recogniser.engine, named.recogniser.config, named.run.stale_minutes) == ("plain", "c", 5)
    for wrong in ({"other": {}}, {"ocr": {}, "recogniser": {}}):
        with pytest.raises(ValueError):
            Options.from_mapping(wrong)
    with pytest.raises(TypeError):
        Options.from_mapping({"input": {"nonsense": 1}})
