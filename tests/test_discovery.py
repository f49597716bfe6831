"""The discovery stream: what it takes in, in which order, and what the driver keeps of it."""

import os

import pytest

from scanlake.functions.times import moment
from scanlake.options import InputOptions
from scanlake.session import new_folder
from scanlake.sources import files as file_sources
from scanlake.streaming import discovery

NOW = "2024-01-01 00:00:00"


@pytest.fixture
def places(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in", str(tmp_path / "ledger"), str(tmp_path / "check")


def run(spark, places, **kind):
    inbox, root, checkpoint = places
    discovery.register_available(spark, InputOptions(root_path=str(inbox), **kind), root, checkpoint, moment(NOW))
    rows = discovery.registered(spark, root).collect()
    found = {r["file_path"].removeprefix(f"{inbox}/"): r["id"] for r in rows}
    assert len(found) == len(rows)
    return found


def test_the_checkpoint_holds_none_of_the_trees_files(spark, places):
    inbox, _, checkpoint = places
    for n in range(1000):
        (inbox / f"{n:04}.tif").write_bytes(b"1")
        os.utime(inbox / f"{n:04}.tif", (2e9 - n, 2e9 - n))
    expected = {f"{n:04}.tif": n + 1 for n in range(1000)}
    assert run(spark, places) == expected == run(spark, places)
    held = [f for folder, _, names in os.walk(f"{checkpoint}/sources") for f in map(f"{folder}/".__add__, names)]
    lines = [line for f in held if not f.endswith(".crc") for line in open(f)]
    assert lines and len(lines) < 50 and not any(".tif" in line for line in lines)


def test_late_files_with_old_times_count(spark, places):
    inbox = places[0]
    (inbox / "b.tif").write_bytes(b"1")
    assert run(spark, places) == {"b.tif": 1}
    (inbox / "empty.tif").touch()
    assert run(spark, places) == {"b.tif": 1}
    (inbox / "a.tif").write_bytes(b"copied with its time")
    os.utime(inbox / "a.tif", (1e9, 1e9))
    (inbox / "empty.tif").write_bytes(b"filled")
    assert run(spark, places) == {"b.tif": 1, "a.tif": 2, "empty.tif": 3}


@pytest.mark.parametrize("opens", [True, False])
def test_it_takes_in_what_sparks_file_sources_find(spark, places, monkeypatch, opens):
    inbox, other = places[0], places[0].parent / "other"
    names = ["a.tif", "_c=d.tif", "e #%20?.TIFF", "sub/deep/f.tif", "x=1/g.tif", "ü/h.tif"]
    for name in [*names, "_b.tif", ".h.tif", "n.txt", ".hid/i.tif", "_x/j.tif"]:
        (inbox / name).parent.mkdir(parents=True, exist_ok=True)
        (inbox / name).write_bytes(b"1")
    other.mkdir()
    (other / "o.tif").write_bytes(b"1")
    (inbox / "empty.tif").touch()
    os.symlink(other, inbox / "link")
    os.symlink("gone", inbox / "gone.tif")
    os.symlink("self.tif", inbox / "self.tif")
    if opens:  # Spark's own listing follows a loop for as long as the system does, and fails at such a name
        os.symlink(inbox, inbox / "sub" / "loop")
        os.symlink(inbox / "sub", other / "back")
        open(os.fsencode(inbox) + b"/\xff.tif", "w").write("1")
        names += ["link/back/deep/f.tif"]
    monkeypatch.setattr(file_sources, "opens", lambda path: opens)
    assert set(run(spark, places)) == {*names, "link/o.tif"}


def test_a_run_that_broke_off_is_taken_up(spark, places, monkeypatch):
    inbox = places[0]
    for name in ("b.tif", "d.tif"):
        (inbox / name).write_bytes(b"1")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(discovery, "register_files", fails)
        with pytest.raises(Exception, match="lost"):
            run(spark, places)
    for name in ("a.tif", "c.tif"):
        (inbox / name).write_bytes(b"1")
    # The stored listing is batch 0 once more; what came since is the next one.
    assert run(spark, places) == {"b.tif": 1, "d.tif": 2, "a.tif": 3, "c.tif": 4} == run(spark, places)


def test_nothing_to_find_and_no_root(spark, places):
    assert run(spark, places) == {} == run(spark, places, recursive=False)
    (places[0] / "sub").mkdir()
    for name in ("a.tif", "sub/b.tif"):
        (places[0] / name).write_bytes(b"1")
    assert run(spark, places, recursive=False) == {"a.tif": 1}
    assert run(spark, places) == {"a.tif": 1, "sub/b.tif": 2}
    with pytest.raises(FileNotFoundError):
        discovery.register_available(spark, InputOptions(root_path=new_folder(spark, "none")), *places[1:], moment(NOW))
