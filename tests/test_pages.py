import random

import pytest
from pyspark.sql import functions as F

from scanlake.functions.times import moment
from scanlake.operators import outputs, pages, recognising, tokens
from scanlake.options import InputOptions, Options, OutputOptions, RecogniserOptions
from scanlake.plans.document_job import document_rows
from scanlake.sources import documents as document_files
from scanlake.sources import files as file_sources


def pages_of(spark, *rows):
    return spark.createDataFrame(list(rows), "image_id bigint, page_number int, text string")


def tokens_of(spark, *rows):
    return spark.createDataFrame(
        list(rows), "image_id bigint, page_number int, token_no int, text string, conf double"
    )


def test_split_counts_from_one(spark):
    docs = spark.createDataFrame([(1, "a\n\nb")], "image_id bigint, text string")
    assert [(r["page_number"], r["text"]) for r in pages.split_pages(docs, "text").collect()] == [
        (1, "a"), (2, ""), (3, "b")
    ]


def test_blank_pages_count_but_add_no_text(spark):
    got = pages.assemble_text(pages_of(spark, (1, 3, "c"), (1, 1, "a"), (1, 2, ""), (2, 1, ""), (3, 1, None))).collect()
    assert {r["image_id"]: (r["full_text"], r["page_count"]) for r in got} == {
        1: ("a\n\n--- Page Break ---\n\nc", 3), 2: ("", 1), 3: ("", 1)
    }


def test_long_documents_are_one_row(spark):
    many = 9000
    got = pages.assemble_text(pages_of(spark, *[(1, n, str(n)) for n in range(many, 0, -1)])).collect()
    joined = "\n\n--- Page Break ---\n\n".join(str(n) for n in range(1, many + 1))
    assert [(r["full_text"], r["page_count"]) for r in got] == [(joined, many)]


def test_percent_scores(spark):
    text = pages_of(spark, (1, 1, " x \n"), (1, 2, "y"), (1, 3, ""), (1, 4, "z"))
    scores = tokens_of(
        spark, (1, 1, 1, "x", 80.0), (1, 1, 2, "x", 90.0), (1, 1, 3, "x", -1.0), (1, 2, 1, "y", -1.0),
        (1, 4, 1, "z", None), (1, 4, 2, "z", float("nan")),
    )
    got = {r["page_number"]: (r["text"], r["confidence"]) for r in tokens.page_confidence(text, scores).collect()}
    assert got == {1: ("x", 0.85), 2: ("y", 0.0), 3: ("", 0.0), 4: ("z", 0.0)}


@pytest.mark.parametrize("run", [4096, 2])
def test_tokens_joined_in_order(spark, monkeypatch, run):
    monkeypatch.setattr(tokens, "RUN_TOKENS", run)
    keys = pages_of(spark, (1, 1, ""), (1, 2, ""), (1, 3, ""))
    found = tokens_of(
        spark, (1, 1, 2, "world", 0.8), (1, 1, 1, "hello", 0.9), (1, 2, 3, "line two", 0.85),
        (1, 2, 1, "line one", 0.95), (1, 2, 2, None, 0.1),
    )
    got = {r["page_number"]: (r["text"], r["confidence"]) for r in tokens.pages_from_tokens(keys, found, " ").collect()}
    assert got == {1: ("hello world", 0.85), 2: ("line one line two", 0.9), 3: ("", 0.0)}
    lines = tokens.pages_from_tokens(keys, found, "\n").where("page_number = 2").first()
    assert lines["text"] == "line one\nline two"


def images_of(spark, *rows):
    return spark.createDataFrame([(i, p, bytearray(b)) for i, p, b in rows], "image_id bigint, page_number int, image binary")


def test_stub_engines(spark):
    images = images_of(spark, (1, 1, b"ab"), (1, 2, b"cd"))
    fixed = recognising.recognise(images, RecogniserOptions(engine="fixed")).collect()
    assert {(r["text"], r["confidence"], r["ocr_engine"], r["error"]) for r in fixed} == {("Hello OCR World", 0.95, "fixed", None)}
    empty = recognising.recognise(images, RecogniserOptions(engine="empty")).collect()
    assert {(r["text"], r["confidence"]) for r in empty} == {("", 0.0)}


def test_bad_page_does_not_stop_its_neighbours(spark):
    images = images_of(spark, (1, 1, b"\xff"), (1, 2, b" good page "))
    got = {r["page_number"]: r for r in recognising.recognise(images, RecogniserOptions(engine="plain")).collect()}
    assert got[1]["text"] is None and "utf-8" in got[1]["error"]
    assert (got[2]["text"], got[2]["error"]) == ("good page", None)


def test_unknown_engine_fails_before_any_job(spark):
    with pytest.raises(ValueError, match="nonsense"):
        recognising.recognise(images_of(spark, (1, 1, b"x")), RecogniserOptions(engine="nonsense"))


def test_own_engine_joins_its_tokens(spark):
    class Lines:
        def __init__(self, options):
            self.first = options.language.split("+")[0]

        def read(self, image):
            return None, [("line one", 0.95), (None, 0.85), (self.first, 0.85)]

    recognising.register_engine("lines", recognising.EngineSpec(Lines, 1, "\n"))
    got = recognising.recognise(images_of(spark, (1, 1, b"x")), RecogniserOptions(engine="lines", language="fr+en")).first()
    assert (got["text"], got["confidence"]) == ("line one\nfr", 0.8833)


def test_unknown_engine_is_reported(spark):
    with pytest.raises(ValueError, match="easyocr"):
        recognising.recognise(images_of(spark, (1, 1, b"x")), RecogniserOptions(engine="easyocr")).collect()


def test_odd_names_and_bad_targets(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    names = ["a b.txt", "a#1.txt", "a#2.txt", "e?f.txt", "c%20d.txt", "ü/ß.txt"]
    targets = [f"file:{tmp_path}/{n}" for n in names] + [f"file:{tmp_path}/file/below.txt"]
    bodies = spark.createDataFrame([(t, t) for t in targets], "output_path string, body string")
    got = {r["output_path"]: r for r in document_files.write_files(bodies).collect()}
    for name, target in zip(names, targets):
        assert (tmp_path / name).read_text() == target and got[target]["error"] is None
    assert got[targets[-1]]["error"] and got[targets[-1]]["bytes"] is None


def test_pdf_needs_its_engine(spark):
    with pytest.warns(UserWarning):
        assert outputs.written_formats(["pdf", "txt"], "easyocr") == ["txt"]
    files = spark.createDataFrame([("/in/a.tif", "/out/a")], "file_path string, output_base string")
    plan = outputs.output_plan(files, ["json", "pdf"], "tesseract").collect()
    assert sorted(r["output_path"] for r in plan) == ["/out/a.json", "/out/a.pdf"]
    assert outputs.output_plan(files, [], "tesseract").count() == 0


def test_collisions_by_stem(spark):
    files = spark.createDataFrame([("/in/a.tif",), ("/in/a.tiff",), ("/in/b.tif",)], "file_path string")
    found = outputs.output_collisions(outputs.with_output_base(files, "/in", "/out")).collect()
    assert [tuple(r) for r in found] == [("/out/a", 2)]


def tree(root, **content):
    for name, data in content.items():
        path = root / name.replace("__", "/").replace("_dot_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)


def test_file_scan(spark, tmp_path):
    tree(tmp_path, a_dot_tif=b"1", sub__b_dot_TIFF=b"22", c_dot_jpg=b"3", sub__d_dot_pdf=b"4")
    deep = file_sources.list_files(spark, InputOptions(root_path=str(tmp_path))).collect()
    assert {(r["file_path"], r["file_name"], r["file_size_bytes"]) for r in deep} == {
        (f"{tmp_path}/a.tif", "a.tif", 1), (f"{tmp_path}/sub/b.TIFF", "b.TIFF", 2)
    }
    flat = file_sources.list_files(spark, InputOptions(root_path=str(tmp_path), recursive=False)).collect()
    assert [r["file_name"] for r in flat] == ["a.tif"]


def test_decode_pages(spark, tmp_path):
    tree(tmp_path, good_dot_tif=b"one\ftwo\fthree", bad_dot_tif=b"\xff", empty_dot_tif=b"")
    files = file_sources.read_contents(spark, InputOptions(root_path=str(tmp_path)))
    got = file_sources.decode_pages(files, file_sources.text_pages).collect()
    seen = sorted((r["file_path"].rsplit("/", 1)[1], r["page_number"], r["image"] and bytes(r["image"])) for r in got)
    assert seen == [
        ("bad.tif", 0, None), ("good.tif", 1, b"one"), ("good.tif", 2, b"two"),
        ("good.tif", 3, b"three"),
    ]
    assert [r["error"] is not None for r in got if r["page_number"] == 0] == [True]


def test_images_that_cannot_be_decoded_stay(spark, tmp_path):
    tree(tmp_path, bad_dot_bmp=b"garbage")
    assert file_sources.read_images(spark, str(tmp_path)).first()["height"] == -1


def test_golden_document_and_files(spark, tmp_path):
    options = Options(
        input=InputOptions(root_path="/in"), output=OutputOptions(root_path=f"file://{tmp_path}"),
        recogniser=RecogniserOptions(engine="fixed"),
    )
    found = spark.createDataFrame(
        [(1, "/in/s/d.tif", 9, n, t, 0.5, 7) for n, t in [(2, "naïve café"), (1, "one two"), (3, "")]],
        "image_id bigint, file_path string, file_size_bytes bigint, page_number int, text string, confidence double, processing_time_ms int",
    )
    docs = document_rows(found, options, moment("2024-01-01 00:00:00"))
    row = docs.first()
    assert (row["relative_path"], row["page_count"], row["total_processing_time_ms"]) == ("s/d.tif", 3, 21)
    assert [p["word_count"] for p in row["pages"]] == [2, 2, 0]
    text = document_files.write_files(document_files.text_bodies(docs)).collect()
    assert text[0]["bytes"] == len((tmp_path / "s" / "d.txt").read_bytes())
    assert (tmp_path / "s" / "d.txt").read_text() == "one two\n\n--- Page Break ---\n\nnaïve café"
    document_files.write_files(document_files.json_bodies(docs)).collect()
    assert "naïve" in (tmp_path / "s" / "d.json").read_text()
    back = document_files.read_documents(spark, str(tmp_path / "s"))
    assert back.first()["full_text"] == row["full_text"] and back.first()["pages"] == row["pages"]
    document_files.write_json_lines(docs, str(tmp_path / "lines"))
    lines = document_files.read_documents(spark, str(tmp_path / "lines"))
    assert lines.first()["relative_path"] == "s/d.tif"
    assert pages.explode_pages(lines.select("relative_path", "pages")).count() == 3


def test_tokens_in_any_order_with_repeated_and_null_numbers(spark):
    draw = random.Random(3)
    rows = [(i, p, n, f"w{i}-{p}-{n}", 0.5 if n % 7 else None) for i in (1, 2, None) for p in (1, 2) for n in range(1, 9000, 1 + p)]
    rows += [(1, 1, 4095, "z", 0.25), (1, 1, 4095, "a", -1.0), (1, 1, None, "null", 1.0), (1, 1, None, "nil", 1.0), (1, 2, 5, None, 1.0)]
    draw.shuffle(rows)
    found = spark.createDataFrame(rows, "image_id long, page_number int, token_no int, text string, conf double")
    keys = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1), (2, 9), (None, 1)], "image_id long, page_number int")
    for tokens_in in (found.repartition(5), found.coalesce(1).sortWithinPartitions("image_id", "page_number", "token_no")):
        got = tokens.pages_from_tokens(keys, tokens_in, " ").collect()
        expected = []
        for image, page in [(1, 1), (1, 2), (2, 1), (2, 1), (2, 9), (None, 1)]:
            own = [r for r in rows if image and r[:2] == (image, page) and r[3] is not None]
            own.sort(key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
            scores = [r[4] for r in own if r[4] is not None and r[4] >= 0]
            expected.append((image, page, " ".join(r[3] for r in own), round(sum(scores) / len(scores), 4) if scores else 0.0))
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    plan = tokens.pages_from_tokens(keys, found, " ")._jdf.queryExecution().sparkPlan().toString()
    executed = tokens.pages_from_tokens(keys, found, " ")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and executed.count("Exchange hashpartitioning") == 2


def test_answers_of_many_pages_are_not_held_together(spark):
    class Wordy:
        def read(self, image):
            with open("/proc/self/statm") as sizes:
                held = int(sizes.read().split()[1]) * 4 // 1024
            return str(held), [(f"word {n}", 0.5) for n in range(400)]

    recognising.register_engine("wordy", recognising.EngineSpec(lambda options: Wordy(), 1, " "))
    images = spark.range(9000).select(F.col("id").alias("image_id"), F.lit(1).alias("page_number"), F.lit(b"x").alias("image"))
    read = recognising.recognise(images.coalesce(1), RecogniserOptions(engine="wordy"))
    least, most, rows, score = read.agg(
        F.min(F.col("text").cast("int")), F.max(F.col("text").cast("int")), F.count("*"), F.min("confidence")
    ).first()
    assert (rows, score) == (9000, 0.5) and most - least < 200
