"""Path columns: name, suffix, stem, relative path, mirrored output base."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(name: Column) -> Column:
    """Last suffix with its dot; a name that only starts with a dot has none."""
    return F.regexp_extract(name, r".(\.[^.]+)$", 1)


def stem(name: Column) -> Column:
    return F.left(name, F.char_length(name) - F.char_length(suffix(name)))


def has_extension(name: Column, extensions: tuple[str, ...]) -> Column:
    return F.lower(suffix(name)).isin(sorted({e.lower() for e in extensions}))


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``; the bare file name where it lies elsewhere."""
    prefix = root.rstrip("/") + "/"
    below = F.substr(path, F.lit(len(prefix) + 1))
    return F.when(F.startswith(path, F.lit(prefix)), below).otherwise(file_name(path))


def slashes(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def output_base(path: Column, input_root: str, output_root: str) -> Column:
    """Where the outputs of ``path`` go, without extension, mirroring the input tree."""
    rel = relative_path(path, input_root)
    name = file_name(path)
    folder = F.left(rel, F.char_length(rel) - F.char_length(name))
    return F.concat(F.lit(output_root.rstrip("/") + "/"), folder, stem(name))
