"""Which runs of a text are judged as secrets, and how many random keys are found."""

import random

from scanlake.llm import secret_scan

BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def report(spark, texts):
    table = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r.spans.split(",") for r in secret_scan.report(table).collect()}
    clean = {r.doc_id: r.text for r in secret_scan.redacted(table).collect()}
    return [(rows[n], clean[n]) for n in range(len(texts))]


def test_values_behind_names_and_in_paths(spark):
    rng = random.Random(11)
    befores = [
        "AWS_ACCESS_VALUE=", "auth=", "GET /v1/file-list?sig=", "=", "https://example.org/some_path/to-file/",
        "x=y=", "/srv/long-lived/data_files/", "export BUILD_SIGNING_MATERIAL=",
    ]
    cases = []
    for before in befores:
        for alphabet, padding in ((BASE62, ""), (BASE62 + "+/", "=="), (BASE62 + "-_", "")):
            cases += [(before, "".join(rng.choices(alphabet, k=40)) + padding) for _ in range(8)]
    got = report(spark, [f"see {before}{key} there" for before, key in cases])
    whole = [key not in text for (_, key), (_, text) in zip(cases, got)]
    assert sum(whole) >= 0.96 * len(cases)
    # Names before "=" are not part of the span.
    named = [n for n, (before, _) in enumerate(cases) if before.endswith("=")]
    exact = [f"random:{4 + len(cases[n][0])}:{4 + len(cases[n][0] + cases[n][1])}" in got[n][0] for n in named]
    assert sum(exact) >= 0.96 * len(named)
    for before in ("AWS_ACCESS_VALUE=", "export BUILD_SIGNING_MATERIAL="):
        kept = [f"see {before}[secret]" in text for (b, _), (_, text) in zip(cases, got) if b == before]
        assert sum(kept) >= 0.9 * len(kept)


def test_spans_inside_others_are_not_told_twice():
    limits = {"a:6": 1}
    found = [{"start": s, "end": e, "encoding": "a", "size": 6, "bin": b} for s, e, b in ((0, 60, 0), (0, 30, 0), (31, 60, 0), (70, 130, 2), (70, 99, 0))]
    assert secret_scan.random_spans(found, limits) == [(0, 60), (70, 99)]


def test_short_keys_of_any_alphabet(spark):
    rng = random.Random(12)
    alphabets = [BASE62, BASE62[:26] + "234567", BASE62[26:], BASE62 + "+/"]
    keys = {(a, n): ["".join(rng.choices(a, k=n)) for _ in range(150)] for a in alphabets for n in (20, 24)}
    words = ["erberbeeinheitkeiter", "schverlicheinpfauung", "internationalization", "getElementsByClassNameAndTag", "AWS_SECRET_ACCESS_KEY",
             "31415926535897932384", "27182818284590452353", "-" * 20, "_" * 31]
    texts = [f"see {key} there" for own in keys.values() for key in own]
    got = report(spark, texts)
    for n, (alphabet, size) in enumerate(keys):
        hits = sum(f"random:4:{4 + size}" in spans for spans, _ in got[n * 150 : n * 150 + 150])
        assert hits >= 0.97 * 150, (alphabet, size, hits)
    # Where words and numbers are most of what is long, they stay.
    long = [f"see {w} there" for w in words * 40]
    assert [text for _, text in report(spark, long + texts[:5])][: len(long)] == long


def test_tokens_of_any_length(spark):
    rng = random.Random(13)
    keys = ["".join(rng.choices(BASE62, k=n)) for n in (513, 520, 531, 600, 1041, 5000, 200_000) for _ in range(4)]
    got = report(spark, [f"see {key} there" for key in keys])
    assert sum(text == "see [secret] there" for _, text in got) >= len(keys) - 1
