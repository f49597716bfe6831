"""Listing folders of a local tree."""

import os
import tracemalloc

import pytest

from scanlake.options import InputOptions
from scanlake.sources.files import list_files
from scanlake.sources.stores import entries


def sizes(spark, root, **kind):
    rows = list_files(spark, InputOptions(root_path=root, **kind)).collect()
    assert len({r["file_path"] for r in rows}) == len(rows)
    return {r["file_path"]: r["file_size_bytes"] for r in rows}


def test_every_file_counts_and_roots_are_qualified(spark, tmp_path):
    top = tmp_path / "in"
    (top / "sub" / ".h").mkdir(parents=True)
    names = ["a.tif", "_b.tif", ".c.TIFF", "sub/.h/d e#%20?.tif", "n.txt"]
    for name in names:
        (top / name).write_bytes(name.encode())
    (top / "empty.tif").touch()
    os.symlink("gone", top / "gone.tif")
    os.symlink(top, top / "loop")
    expected = {f"{top}/{n}": len(n) for n in names[:4]} | {f"{top}/empty.tif": 0, f"{top}/gone.tif": None}
    for root in (f"{top}", f"{top}/", f"{top}/../in", f"file://{top}", os.path.relpath(top)):
        assert sizes(spark, root) == expected
    flat = {k: v for k, v in expected.items() if v is not None and "/sub/" not in k}
    assert sizes(spark, str(top), recursive=False) == flat


def test_empty_and_missing_roots(spark, tmp_path):
    assert sizes(spark, str(tmp_path)) == {}
    with pytest.raises(FileNotFoundError):
        list_files(spark, InputOptions(root_path=f"{tmp_path}/none"))


def test_a_large_folder_is_not_held_while_it_is_listed(tmp_path):
    for n in range(10_000):
        (tmp_path / f"{n}.txt").touch()
    tracemalloc.start()
    try:
        found = sum(size == 0 for _, _, is_file, size in entries(str(tmp_path)) if is_file)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 10_000 and most < 1_000_000
    assert list(entries(f"{tmp_path}/gone")) == []
