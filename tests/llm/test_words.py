"""Phrases, the language model and periodic runs against plain loops, on given and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from scanlake.llm import collocations, language_model, periodic_runs, queries
from scanlake.llm.common import documents
from tests.compare import differences, duck

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["f", "w0", "label", "chunk", "bucket", "blob", "part", "rank", "n", "tokens", "score", "start"]


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(3)
    few = ["der", "Hund", "läuft", "a", "b", "ÉTÉ", "x" * 3000]
    texts = [" ".join(rng.choices(few, [9, 5, 3, 3, 2, 2, 1], k=rng.randint(1, 60))) + rng.choice(["", ". ", "!\n", "\x0b", "\t"])
             for _ in range(120)]
    rows = [(0, None, None), (1, "", "en"), (2, " \n\t ", "en"), (3, "...", ""), (None, "der Hund der Hund", "de"), (None, None, None)]
    rows += [(n + 4, t, rng.choice(["de", "de", "und", None, "é"])) for n, t in enumerate(texts)]
    rows += [(200, "ab cd " * 20_000 + "end", "en"), (201, "a a a a a a", "en"), (202, "\x1c a\x1cb   c " * 4, "de"), rows[9], rows[9]]
    table = spark.createDataFrame([(d, t, g, "s", 1) for d, t, g in rows], SCHEMA)
    return table.selectExpr("*", *[f"7 as {c}" for c in CLASHING])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(params=["awkward", "given"])
def docs(request, spark):
    return request.getfixturevalue("awkward") if request.param == "awkward" else documents(spark, SMALL)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# Phrases.


def counted_phrases(rows):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            own = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(own)
            for size in (1, 2, 3):
                f.update((lang, *own[i : i + size]) for i in range(len(own) - size + 1))
    return n, f


def best(rows, top=2000, least=10):
    n, f = counted_phrases(rows)
    found = {}
    for (lang, *phrase), a in f.items():
        if len(phrase) < 2 or a < least:
            continue
        cuts = [(1000000 * a * a // (f[(lang, *phrase[:k])] * f[(lang, *phrase[k:])]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        longer = [b for (other, *p), b in f.items() if len(phrase) == 2 and len(p) == 3 and other == lang and b >= least
                  and (p[:2] == phrase or p[1:] == phrase)]
        if not any(100 * b >= 50 * a for b in longer):
            found.setdefault(lang, []).append(
                (-score, -a, " ".join(phrase).encode(), f[(lang, *phrase[:k])], f[(lang, *phrase[k:])]))
    return {
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, own in found.items() for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1)
    }


def test_phrases_equal_loops(awkward):
    rows = [(r.text, r.lang) for r in awkward.select("text", "lang").collect()]
    got = [tuple(r) for r in collocations.best_phrases(awkward).collect()]
    assert len(got) == len(set(got)) > 20 and set(got) == best(rows)
    small = [tuple(r) for r in collocations.best_phrases(awkward, top=3, least=5).collect()]
    assert set(small) == best(rows, 3, 5)


def test_phrases_equal_sql(spark):
    assert differences(queries.op11_collocations(spark, SMALL), duck(SMALL), queries.oracle_sql()["op11_collocations"]) == []


def test_phrases_of_small_chunks_are_the_same(awkward):
    order = ["lang", "phrase"]
    whole = collocations.phrases(awkward).orderBy(order).collect()
    assert whole == collocations.phrases(awkward, chunk_tokens=50).orderBy(order).collect()


def test_no_phrases_without_rows(empty):
    assert collocations.best_phrases(empty).collect() == []


def test_exact_scores_beyond_64_bits(spark):
    row = spark.sql(f"select {collocations._score('a', 'l', 'r')} as s from values (1000000000000L, 1000000000001L, 3000000000000L) t(a, l, r)").first()
    assert row.s == 1000000 * 10**24 // (1000000000001 * 3 * 10**12)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_partitions_are_the_frequent_keys(depth):
    draw = np.random.default_rng(depth)
    for n, least in ((0, 1), (1, 1), (1, 2), (400, 1), (400, 7), (3000, 10)):
        keys = [draw.zipf(1.4, n) % 50 for _ in range(depth)]
        weights = draw.integers(1, 4, n)
        want = Counter()
        for *key, w in zip(*keys, weights):
            want[tuple(map(int, key))] += int(w)
        group = collocations.multikey_groups(keys, weights, least)
        named = {}
        for *key, g in zip(*keys, group.tolist()):
            named.setdefault(tuple(map(int, key)), set()).add(g)
        assert all(len(g) == 1 for g in named.values())
        frequent = {k for k, g in named.items() if g != {-1}}
        assert frequent == {k for k, w in want.items() if w >= least}
        assert len({min(named[k]) for k in frequent}) == len(frequent)


# The language model.


def remainder(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def model_scores(rows, order):
    """(doc_id, held_out, n_tokens, n_known, N, base, score) with exact levels instead of a filter."""
    texts = [(d, remainder(d) == 1, [*words(lowered(t or "")), None]) for d, t in rows]
    count, grams, learned = Counter(), Counter(), 0
    for _, held_out, own in texts:
        if not held_out:
            learned += 1
            count.update(own)
            padded = [0] * (order - 1) + own
            for size in range(2, order + 1):
                grams.update((size, *padded[i - size + 1 : i + 1]) for i in range(order - 1, len(padded)))
    total, distinct = sum(count.values()), len(count)

    def estimate(gram):
        level = grams[gram].bit_length()
        return (2 ** (level - 1) + 2**level - 1) / 2 if level else 0.0

    out = []
    for doc_id, held_out, own in texts:
        padded = [0] * (order - 1) + own
        base = score = 0.0
        for i in range(order - 1, len(padded)):
            p = (count[padded[i]] + 0.5) / (total + 0.5 * (distinct + 1))
            base += math.log10(p)
            context = learned if padded[i - 1] == 0 else count[padded[i - 1]]
            for size in range(2, order + 1):
                own_count = min(estimate((size, *padded[i - size + 1 : i + 1])), context)
                strength = language_model.STRENGTHS[size - 1]
                p = (own_count + strength * p) / (context + strength)
                before = padded[i - size : i] if i >= size else None
                if size < order:
                    above = padded[i - size]
                    context = learned if padded[i - 1] == 0 else min(
                        estimate((size, *padded[i - size : i])), learned if above == 0 else context_count(count, padded, i, size, learned, estimate))
            score += math.log10(p)
        out.append((doc_id, held_out, len(own), sum(count[w] > 0 for w in own), total, base, score))
    return out


def context_count(count, padded, i, size, learned, estimate):
    return learned if padded[i - 2] == 0 else count[padded[i - 2]]


def by_row(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5], r[6]))


def scores(docs, **options):
    from pyspark.sql import functions as F

    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return by_row(tuple(r) for r in language_model.scored(docs, F.pmod(checksum, F.lit(5)) == 1, **options).collect())


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_loops_but_for_chance_hits(docs, order):
    want = by_row(model_scores([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], order))
    got = scores(docs, order=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))
    # A chance hit takes a missing n-gram for one seen once: scores differ a little.
    gap = [abs(g[6] - w[6]) / w[2] for g, w in zip(got, want)]
    assert max(gap) < 0.15 and sum(gap) / len(gap) < 0.03


def test_scores_equal_loops_without_chance_hits(docs, monkeypatch):
    monkeypatch.setattr(language_model, "BITS_PER_ENTRY", 400.0)
    monkeypatch.setattr(language_model, "PROBES", 12)
    found = language_model.build_segment(np.arange(1000, dtype=np.uint64), np.arange(1, 1001))
    got = language_model.levels(found, np.arange(2000, dtype=np.uint64)).tolist()
    assert got == [n.bit_length() for n in range(1, 1001)] + [0] * 1000


def test_chance_hits_are_as_rare_as_said():
    draw = np.random.default_rng(1)
    names = draw.integers(0, 2**63, 60_000, dtype=np.uint64)
    counts = draw.zipf(1.6, 30_000)
    found = language_model.build_segment(names[:30_000], counts)
    level = language_model.levels(found, names)
    assert (level[:30_000] >= np.frexp(counts.astype(float))[1]).all()
    assert 0.02 < (level[30_000:] > 0).mean() < 0.045


def test_both_ways_and_any_chunks_agree(docs):
    assert scores(docs) == scores(docs, broadcast_bytes=0) == scores(docs, broadcast_bytes=0, chunk_tokens=300)


def test_held_out_texts_are_likelier_by_the_model(spark):
    held_out = [r for r in scores(documents(spark, "/root/testdata/sf0.01")) if r[1]]
    assert sum(r[6] for r in held_out) > 0.95 * sum(r[5] for r in held_out)
    assert language_model.scored.__defaults__[0] == 3


def test_nothing_learned_and_no_rows(spark, empty, awkward):
    from pyspark.sql import functions as F

    assert scores(empty) == []
    rows = language_model.scored(awkward, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in rows} == {(0, 0, 0.0, 0.0)}


# Periodic runs.


def run_list(own):
    out = []
    for q in range(1, len(own) // 4 + 1):
        i = 0
        while i + q < len(own):
            if own[i] != own[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(own) and own[i] == own[i + q]:
                i += 1
            length = i - start + q
            part = own[start : start + length]
            if length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(doc_id, own):
    runs = run_list(own)
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *longest, 1000 * longest[1] // longest[2] if runs else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
        sha(" ".join(w for i, w in enumerate(own) if i not in gone)),
    )


def repeated(doc_id, own):
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is None or h % 10 or not own:
        return own
    a = g % len(own)
    p = 1 + (len(own) - a) // (3 + g % 8)
    return [own[i] if i < a else own[a + (i - a) % p] for i in range(len(own))]


def test_runs_equal_loops(docs, spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = [(d, t if len(t or "") < 50_000 else None) for d, t in rows]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = periodic_runs.periodic_runs(table, queries.with_repeats).select(*periodic_runs.NAMES[:8]).collect()
    assert Counter(map(tuple, found)) == Counter(run_row(d, repeated(d, words(t or ""))) for d, t in rows)
    plain = periodic_runs.periodic_runs(table).select(*periodic_runs.NAMES[:8]).collect()
    assert Counter(map(tuple, plain)) == Counter(run_row(d, words(t or "")) for d, t in rows)


def test_runs_of_the_whole_query(spark, awkward, empty):
    got = queries.op13_periodic_runs(spark, SMALL)
    rows = documents(spark, SMALL).select("doc_id", "text").collect()
    assert got.count() == len(rows) and got.where("n_runs > 0").count() > 10
    long = periodic_runs.periodic_runs(awkward.where("doc_id = 200")).first()
    assert (long.n_runs, long.start, long.length, long.period, long.n_dropped) == (1, 0, 40_000, 2, 39_998)
    assert periodic_runs.periodic_runs(empty).collect() == []


def test_random_words_of_few_kinds():
    rng = random.Random(1)
    for _ in range(400):
        lists = []
        for _ in range(rng.randint(1, 4)):
            own = []
            while len(own) < rng.randint(0, 90):
                block = [rng.randint(0, rng.choice([0, 1, 2, 30])) for _ in range(rng.randint(1, 14))]
                own += (block * rng.randint(1, 7))[: rng.randint(1, 70)]
            lists.append(own)
        flat = np.array([w for own in lists for w in own], np.int64)
        got = periodic_runs.find_runs(flat, np.array([len(own) for own in lists]))
        assert got == [(n, *r) for n, own in enumerate(lists) for r in run_list(own)]


def test_text_without_repeats():
    assert periodic_runs.collapse_words("so a b a b a b a b a c") == "so a b c"
    assert periodic_runs.collapse_words("") == ""
