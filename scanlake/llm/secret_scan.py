"""Secrets in whole texts: fixed patterns, and tokens that pass as random by a battery of tests.

One pass over the table finds base spans and scores candidates; nothing but a histogram is shuffled.

* *Base*: assignments, access keys and hex strings, as given.
* *Candidates*: runs of 20 or more letters, digits and ``+/_-`` that overlap no base span. ``=``
  ends a run and belongs to it only as padding, so names and values of ``name=value`` are judged apart. The
  encoding (hex, base32, base36, base62, base64) is the smallest alphabet that holds the run. The parts of a run
  between ``-_``, between ``+/`` and between all four are candidates too, so that a secret in a path or behind a
  prefix is found whatever surrounds it; a part counts only outside what is found random.
* *Battery*: under "uniform and independent over the encoding's alphabet", (1) chi-squared of symbol counts over
  the alphabet, (2) number of runs above and below its middle, (3) serial correlation of
  neighbouring symbols, (4) that capitals, small letters or digits are not too few, which tells words and
  numbers. The four p-values are combined by the Cauchy rule, which holds under dependence.
* *False discoveries*: words and names deviate, secrets do not. Over the whole corpus, p-values are held
  against Benjamini and Hochberg's line within each stratum of encoding and length, so that a test of few
  symbols is judged among its like. Candidates beyond the line are discovered to be not random and dropped;
  the others are spans of kind "random". p-values are counted in ``P_BINS`` bins a stratum, rounded up, so the
  table of limits is at most strata x bins rows whatever the corpus.

Null text is empty and has no spans. Offsets are code points, ends exclusive. Repeated rows give repeated
results but count as evidence once each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import id_and_text, pieces, slices
from scanlake.session import written

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run of at least 32; shorter runs fail, and no longer run starts inside one.
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?")
#: What lies between signs that one of the two base64 alphabets lacks, and between all signs.
PARTS = tuple(re.compile(r) for r in (r"[A-Za-z0-9+/]{20,}=*", r"[A-Za-z0-9_-]{20,}=*", r"[A-Za-z0-9]{20,}=*"))
ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
CLASSES = (ENCODINGS[5][1][:26], ENCODINGS[5][1][26:52], ENCODINGS[5][1][52:])
#: Of the four tests. No digit in 20 signs of base36 has p 0.003, which its weight must keep under 0.01.
WEIGHTS = (0.2, 0.2, 0.2, 0.4)
#: Share of secrets that may be lost to the battery in a stratum.
FALSE_DISCOVERY_RATE = 0.01
P_BINS = 400
LARGEST_EXPONENT = 20.0
PIECE_CHARS = 1_000_000


def normal_tail(z: float) -> float:
    """Two-sided."""
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared_tail(x: float, freedom: int) -> float:
    """Wilson and Hilferty's cube-root approximation, upper tail."""
    if freedom < 1:
        return 1.0
    z = ((x / freedom) ** (1 / 3) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom))
    return 0.5 * math.erfc(z / math.sqrt(2))


def binomial_tail(few: int, n: int, share: float) -> float:
    """Of at most ``few`` hits in n draws."""
    if few >= n * share:
        return 1.0
    odds = math.log(share), math.log1p(-share)
    logs = [
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * odds[0] + (n - k) * odds[1]
        for k in range(few, max(-1, few - 200), -1)
    ]
    return min(1.0, sum(map(math.exp, logs)))


def battery(run: str) -> tuple[str, float] | None:
    """The encoding and the combined p-value of "random"; None if no encoding holds the run."""
    body = run.rstrip("=")
    found = next(((name, letters) for name, letters in ENCODINGS if not body.strip(letters) and set(body) <= set(letters)), None)
    if not found or len(body) < 20:
        return None
    name, letters = found
    place = {c: n for n, c in enumerate(letters)}
    values = np.array([place[c] for c in body], np.float64)
    n, size = len(values), len(letters)
    counts = np.bincount(values.astype(int), minlength=size)
    uniform = chi_squared_tail(float((counts**2).sum()) * size / n - n, size - 1)
    high = values * 2 >= size
    runs = 1 + int(np.count_nonzero(high[1:] != high[:-1]))
    alternate = normal_tail((runs - 1 - (n - 1) / 2) / math.sqrt((n - 1) / 4))
    centred = values - (size - 1) / 2
    variance = (size * size - 1) / 12
    serial = normal_tail(float((centred[1:] * centred[:-1]).sum()) / (variance * math.sqrt(n - 1)))
    shares = [sum(c in letters for c in kind) / size for kind in CLASSES]
    few = [binomial_tail(sum(map(body.count, kind)), n, x) for kind, x in zip(CLASSES, shares) if x]
    # A p-value of 1 would outweigh any small one.
    p = [min(max(x, 1e-15), 0.99) for x in (uniform, alternate, serial, min(few) * len(few))]
    cauchy = sum(w * math.tan((0.5 - x) * math.pi) for w, x in zip(WEIGHTS, p, strict=True))
    return name, max(1e-20, 0.5 - math.atan(cauchy) / math.pi)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Runs and their parts outside the base spans, by start, the longer first."""
    starts, ends = [], []  # of the base spans, those that overlap joined
    for _, start, end in base:
        if ends and start < ends[-1]:
            ends[-1] = max(end, ends[-1])
        else:
            starts.append(start)
            ends.append(end)
    out = []
    for run in RUN.finditer(text):
        own = {run.span(), *(m.span() for part in PARTS for m in part.finditer(text, *run.span()))}
        for start, end in sorted(own, key=lambda s: (s[0], -s[1])):
            near = bisect_right(ends, start)
            if near < len(ends) and starts[near] < end:
                continue
            if scored := battery(text[start:end]):
                out.append({"start": start, "end": end, "encoding": scored[0], "size": (end - start).bit_length(),
                            "bin": min(P_BINS - 1, int(-math.log10(scored[1]) * P_BINS / LARGEST_EXPONENT))})
    return out


def random_spans(found: list[dict], limits: dict[str, int]) -> list[tuple[int, int]]:
    """The candidates within the limits, without those inside another."""
    out, furthest = [], 0
    for c in found:
        if c["end"] > furthest and c["bin"] < limits.get(f"{c['encoding']}:{c['size']}", 0):
            out.append((c["start"], c["end"]))
            furthest = c["end"]
    return out


_SPANS = "array<struct<kind: string, start: int, end: int>>"
_FOUND = "array<struct<start: int, end: int, encoding: string, size: int, bin: int>>"
_STRUCTS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_CANDIDATES = pa.list_(pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()), ("size", pa.int32()), ("bin", pa.int32())]
))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_ids, texts in pieces(batches, PIECE_CHARS):
        base = [base_spans(t) for t in texts]
        found = [candidates(t, b) for t, b in zip(texts, base, strict=True)]
        yield pa.record_batch(
            [
                pa.array(doc_ids, pa.int64()),
                pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in b] for b in base], _STRUCTS),
                pa.array(found, _CANDIDATES),
            ],
            names=["doc_id", "base", "found"],
        )


def _limits(scored: DataFrame) -> dict[str, int]:
    """Of each stratum the first bin, by falling p, that is taken for not random."""
    counted = (
        scored.select(F.explode("found").alias("c"))
        .groupBy(F.concat_ws(":", "c.encoding", F.col("c.size").cast("string")).alias("stratum"), "c.bin")
        .count()
        .collect()
    )
    strata: dict[str, dict[int, int]] = {}
    for stratum, p_bin, n in counted:
        strata.setdefault(stratum, {})[p_bin] = n
    limits = {}
    for stratum, bins in strata.items():
        total, smaller, limits[stratum] = sum(bins.values()), 0, P_BINS
        for p_bin in sorted(bins, reverse=True):  # ascending p
            smaller += bins[p_bin]
            largest_p = 10 ** (-p_bin * LARGEST_EXPONENT / P_BINS)
            if largest_p <= FALSE_DISCOVERY_RATE * smaller / total:
                limits[stratum] = p_bin
    return limits


def _scored(docs: DataFrame) -> DataFrame:
    return written(id_and_text(docs).mapInArrow(_scan, f"doc_id long, base {_SPANS}, found {_FOUND}"), "scored-runs")


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base: array of (kind, start, end), and spans: those and the random ones, by start and kind."""
    scored = _scored(docs)
    limits = _limits(scored)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            random = [
                [{"kind": "random", "start": s, "end": e} for s, e in random_spans(found, limits)]
                for found in batch.column(2).to_pylist()
            ]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(random, _STRUCTS)], names=["doc_id", "base", "random"]
            )

    judged = scored.select("doc_id", "base", "found").mapInArrow(run, f"doc_id long, base {_SPANS}, random {_SPANS}")
    ranks = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.sort_array(
        F.transform(
            F.concat("base", "random"),
            lambda s: F.struct(s["start"].alias("start"), F.array_position(ranks, s["kind"]).alias("rank"), s.alias("s")),
        )
    )
    return judged.select("doc_id", "base", F.transform(ordered, lambda x: x["s"]).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    def text(column: str):
        return F.array_join(
            F.transform(
                column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
            ),
            ",",
        )

    return secret_spans(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(text("base"), 256).alias("base_sha256"),
        text("spans").alias("spans"),
    )


def replace_spans(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """Spans that overlap become one mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The table with every span of its texts replaced by a mark, and n_chars brought up to date if there.

    Limits come from a first pass over the table; the second finds the spans again row by row, so repeated
    ids need no join. All rows and columns stay; null texts stay null.
    """
    limits = _limits(_scored(docs))
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(columns.index("text")).to_pylist()
            for n, text in enumerate(texts):
                if text:
                    base = base_spans(text)
                    spans = [(s, e) for _, s, e in base] + random_spans(candidates(text, base), limits)
                    texts[n] = replace_spans(text, spans, mark) if spans else text
            arrays = dict(zip(columns, batch.columns, strict=True))
            arrays["text"] = pa.array(texts, arrays["text"].type)
            if "n_chars" in arrays:
                sizes = [None if t is None else len(t) for t in texts]
                arrays["n_chars"] = pa.array(sizes, arrays["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=columns)

    return docs.mapInArrow(run, docs.schema)
