"""Files and folders of any store, by the path as Spark names it."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The absolute path with its store and without dots; local paths without a scheme.

    Raises if nothing is there.
    """
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = given.getFileSystem(spark._jsc.hadoopConfiguration())
    full = store.makeQualified(given)
    if not store.exists(full):
        raise FileNotFoundError(path)
    return re.sub("^file:(//)?(?=/)", "", full.toString())


def opens(path: str) -> bool:
    """Whether what lies at a qualified path can be reached without Spark."""
    try:
        store, inner = filesystem(path)
        return store.get_file_info(inner).type != fs.FileType.NotFound
    except Exception:  # noqa: BLE001 - a scheme, library or right that is missing has its own error in each store
        return False


def entries(folder: str, links: bool = False) -> Iterator[tuple[str, bool, bool, int | None]]:
    """What lies in a folder: path, is it a folder, is it a file, size (null where it cannot be told).

    Links to folders are left out, or with ``links`` only those that lead back, so a walk ends; a dangling
    link is neither folder nor file. A folder that went meanwhile is empty.
    """
    store, inner = filesystem(folder)
    prefix = folder.rstrip("/") + "/"
    if isinstance(store, fs.LocalFileSystem):
        try:
            found = os.scandir(inner)
        except FileNotFoundError:
            return
        with found:  # one entry at a time: a folder may hold as many as there are documents
            for entry in found:
                try:
                    is_folder, is_file = entry.is_dir(), entry.is_file()
                except OSError:  # a link that leads to itself
                    is_folder = is_file = False
                if is_folder:
                    if not entry.is_symlink() or links and not _leads_back(entry.path):
                        yield prefix + entry.name, True, False, None
                    continue
                try:
                    size = entry.stat().st_size
                except OSError:
                    size = None
                yield prefix + entry.name, False, is_file, size
        return
    for info in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        is_folder = info.type == fs.FileType.Directory
        yield prefix + info.base_name, is_folder, not is_folder, None if is_folder else info.size


def _leads_back(link: str) -> bool:
    """Whether a link leads to one of the folders on its way."""
    target, above = os.path.realpath(link), os.path.dirname(link)
    while above != os.path.dirname(above):
        if os.path.realpath(above) == target:
            return True
        above = os.path.dirname(above)
    return above == target


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a qualified path, and the path within it.

    Scheme and authority alone name the store; the rest is passed on as it is, so names may have any
    characters.
    """
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, inner = rest.removeprefix("//").partition("/")
    if scheme in ("s3", "s3a", "s3n"):
        return fs.S3FileSystem(), f"{authority}/{inner}"
    return fs.FileSystem.from_uri(f"{scheme}://{authority}/")[0], "/" + inner
