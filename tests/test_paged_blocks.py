"""Files written in blocks: which rows and records wait in memory, and what a failure leaves."""

from __future__ import annotations

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scanlake.functions.times import moment
from scanlake.options import Options, OutputOptions
from scanlake.sources import paged

TEXTS = ['a "quoted" ,"confidence":1 text', None, "", ',"text":', "null", "ü\n😀", " "]


def write(kind, base, texts, monkeypatch):
    """The file's class, its content, and how many files were opened for it."""
    opened = []
    new = paged._File._new
    monkeypatch.setattr(paged._File, "_new", lambda self: opened.append(1) or new(self))
    head, tail = json.dumps({"name": "n"}), json.dumps({"total": 1})
    file = None
    for number, text in enumerate(texts, 1):
        record = json.dumps({"page_number": number, "text": text, "confidence": 0.5}, ensure_ascii=False, separators=(",", ":"))
        row = {"image_id": 1, "output_base": None, "head": None, "tail": None, "text": text, "page_json": record}
        if file is None:
            row |= {"output_base": str(base), "head": head, "tail": tail}
            file = paged.KINDS[kind](row)
        file.add(row)
    file.end()
    return file, len(opened)


@pytest.mark.parametrize("times, files", [(1, 1), (20_000, 2)])
def test_only_many_page_records_need_a_second_file(tmp_path, monkeypatch, times, files):
    texts = TEXTS * times
    file, opened = write("json", tmp_path / "new" / "folder" / "d", texts, monkeypatch)
    assert file.error is None and opened == files
    body = (tmp_path / "new" / "folder" / "d.json").read_bytes()
    found = json.loads(body)
    assert found["full_text"] == "\n\n--- Page Break ---\n\n".join(t for t in texts if t) and len(body) == file.bytes
    assert found["pages"] == [{"page_number": n, "text": t, "confidence": 0.5} for n, t in enumerate(texts, 1)]
    assert (found["name"], found["total"]) == ("n", 1)
    assert [p.name for p in (tmp_path / "new" / "folder").iterdir()] == ["d.json"]


def test_a_block_that_cannot_be_written_leaves_nothing(tmp_path, monkeypatch):
    class Full:
        def __init__(self, stream):
            self.stream = stream

        def write(self, data):
            pass

        def close(self):
            self.stream.close()
            raise OSError("disk full")

    new = paged._File._new
    monkeypatch.setattr(paged._File, "_new", lambda self: full(self, *new(self)))

    def full(self, path, stream):
        self.open[path] = Full(stream)
        return path, self.open[path]

    row = {"image_id": 1, "output_base": str(tmp_path / "d"), "head": "{}", "tail": "{}", "text": "a"}
    file = paged.KINDS["txt"](row)
    file.add(row)
    file.end()
    assert file.error == "OSError: disk full" and not list(tmp_path.iterdir())


def test_rows_are_strings_a_part_at_a_time(monkeypatch):
    monkeypatch.setattr(paged, "PART_BYTES", 1000)
    texts = ["x" * 10] * 500 + [None, "", "y" * 5000, "z"] + ["x" * 300] * 50
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["n", "text"])
    cut = []
    part = pa.RecordBatch.slice

    class Seen:
        columns, num_rows = batch.columns, batch.num_rows

        def slice(self, start, length):
            cut.append(sum(len(t or "") for t in texts[start : start + length]))
            return part(batch, start, length)

    assert [(r["n"], r["text"]) for r in paged._rows(Seen())] == list(enumerate(texts))
    assert len(cut) > 5 and sorted(cut)[-2] < 1300 and list(paged._rows(batch.slice(0, 0))) == []


def test_pages_become_json_once_and_documents_have_one_path(spark):
    columns = "image_id long, file_path string, file_size_bytes long, page_number int, text string, confidence double, processing_time_ms int"
    rows = [(1, "/scans/a.tif", 1, 2, "two words", 0.5, 1), (1, "/scans/a.tif", 1, 1, "one", 0.5, 1), (2, "/scans/b.tif", None, 1, None, None, None)]
    options = Options(output=OutputOptions(root_path="/out"))
    ordered = paged._ordered(spark.createDataFrame(rows, columns), ("txt", "json"), options, moment("2024-01-01 06:00:00"))
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == 3 and plan.count("Exchange hashpartitioning") == 1, plan
    got = [(r.image_id, r.output_base, r.text, json.loads(r.page_json)["word_count"]) for r in ordered.orderBy("image_id", F.col("head").isNull()).collect()]
    assert got == [(1, "/out/scans/a", "one", 1), (1, None, "two words", 2), (2, "/out/scans/b", None, 0)]
