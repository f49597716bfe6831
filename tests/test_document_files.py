"""Trees of many document files, read by tasks that open them."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from scanlake.options import InputOptions
from scanlake.plans import catalog
from scanlake.schemas import DOCUMENT
from scanlake.sources import documents as document_files
from scanlake.sources import files as file_sources


def test_files_read_in_tasks_are_what_the_json_reader_gives(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "1.json").write_text(json.dumps({"full_text": "x\ny é z", "page_count": 2, "pages": [{"text": "p"}]}))
    (tmp_path / "2%20+.json").write_text('{"full_text": "one"}\r\n\n{"full_text": "two", "page_count": 1}\n')
    (tmp_path / "3.json").write_text("no json")
    (tmp_path / "4.json").write_text("")
    (tmp_path / "5.txt").write_text("{}")
    listed = file_sources.list_files(spark, InputOptions(root_path=str(tmp_path), extensions=(".json",)))
    read = document_files.read_document_files(listed)
    by_spark = document_files.read_documents(spark, str(tmp_path))
    assert sorted(map(str, read.select(DOCUMENT.fieldNames()).collect())) == sorted(map(str, by_spark.collect()))
    sizes = {r.file_path.rsplit("/", 1)[-1]: r.bytes_on_disk for r in read.collect()}
    assert sizes == {p.name: p.stat().st_size for p in tmp_path.rglob("[123]*.json")}


def test_reading_back_has_no_task_for_every_few_files(spark, tmp_path):
    root = f"file:{tmp_path}"
    bodies = spark.range(600).select(
        F.concat(F.lit(root + "/d/"), "id", F.lit(".json")).alias("output_path"),
        F.lit('{"page_count":1,"full_text":"t","pages":[]}').alias("body"),
    )
    manifest = document_files.write_files(bodies)
    manifest.write.parquet(str(tmp_path / "manifest"))
    back = catalog._read_back(spark, root, spark.read.parquet(str(tmp_path / "manifest")))
    got = back.collect()
    assert len(got) == 600 and all(r.size_as_said and r.n_pages == 0 for r in got)
    plan = back._jdf.queryExecution().toString()
    assert "FileScan json" not in plan and "binaryFile" not in plan
