"""Options that change results, grouped the way users configure them.

``Options.from_mapping`` takes the nested dict of a settings file: a missing
section keeps its defaults, a present section replaces the whole section. Names of
settings files stand for ours; what Spark has no use for is left out, other names raise.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields


# Section and field names of settings files.
SECTIONS = {"ocr": "recogniser", "preprocessing": "prep", "pipeline": "run"}
FIELDS = {"tesseract_config": "config", "stale_processing_minutes": "stale_minutes"}
UNUSED_SECTIONS = {"database"}
UNUSED_FIELDS = {
    "ocr": {"tessdata_prefix", "tesseract_cmd", "default_dpi"},
    "preprocessing": {"denoise", "denoise_strength"},
    "pipeline": {"num_workers", "log_level", "log_dir"},
}


@dataclass(frozen=True)
class InputOptions:
    root_path: str = ""
    extensions: tuple[str, ...] = (".tif", ".tiff")
    recursive: bool = True


@dataclass(frozen=True)
class OutputOptions:
    root_path: str = ""
    formats: tuple[str, ...] = ("txt", "json")


@dataclass(frozen=True)
class RecogniserOptions:
    engine: str = "tesseract"
    language: str = "eng"
    config: str = "--oem 1 --psm 3"
    #: Longest time for a page; none by default.
    page_seconds: float | None = None


@dataclass(frozen=True)
class PrepOptions:
    enabled: bool = True
    min_dpi: float = 200
    target_dpi: float = 300
    default_dpi: float = 300
    deskew: bool = True
    deskew_threshold_degrees: float = 0.5
    binarization: str | None = "sauvola"


@dataclass(frozen=True)
class RunOptions:
    batch_size: int = 10
    max_retries: int = 3
    stale_minutes: int = 60


@dataclass(frozen=True)
class Options:
    input: InputOptions = field(default_factory=InputOptions)
    output: OutputOptions = field(default_factory=OutputOptions)
    recogniser: RecogniserOptions = field(default_factory=RecogniserOptions)
    prep: PrepOptions = field(default_factory=PrepOptions)
    run: RunOptions = field(default_factory=RunOptions)

    @classmethod
    def from_mapping(cls, settings: Mapping[str, Mapping] | None) -> Options:
        sections = {f.name: f.default_factory for f in fields(cls)}
        given = {}
        for name, values in (settings or {}).items():
            if name in UNUSED_SECTIONS:
                continue
            ours = SECTIONS.get(name, name)
            if ours not in sections:
                raise ValueError(f"unknown section {name!r}; known: {', '.join(sorted({*sections, *SECTIONS}))}")
            if ours in given:
                raise ValueError(f"section {ours!r} is given twice")
            unused = UNUSED_FIELDS.get(name, set())
            used = {FIELDS.get(k, k): v for k, v in values.items() if k not in unused}
            given[ours] = sections[ours](**_tuples(used))
        return cls(**given)


def _tuples(values: Mapping) -> dict:
    return {k: tuple(v) if isinstance(v, list) else v for k, v in values.items()}
