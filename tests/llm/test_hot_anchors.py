"""Phrases shorter than a window that many documents hold."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from scanlake.llm import suffix_dedup

PHRASE = "a phrase that a third of documents hold"


def texts(n, seed=4):
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    tails = [noise(20) for _ in range(5)]
    return [noise(90) + PHRASE + (rng.choice(tails) if k % 7 == 0 else "") + noise(90) for k in range(n)]


def test_results_do_not_depend_on_the_route(spark):
    rows = [(n % 290, t) for n, t in enumerate(texts(300))] + [(None, t) for t in texts(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = Counter(map(tuple, suffix_dedup.repeated_strings(docs, hot=1 << 40).collect()))
    assert sum(r[2] for r in want) > 1000
    assert Counter(map(tuple, suffix_dedup.repeated_strings(docs, hot=3).collect())) == want


def removed_by_brute_force(rows):
    first = {}
    for doc, text in rows:
        for at in range(len(text) - 49):
            first[text[at : at + 50]] = min(doc, first.get(text[at : at + 50], doc))
    out = []
    for doc, text in rows:
        gone = set()
        for at in range(len(text) - 49):
            if first[text[at : at + 50]] < doc:
                gone.update(range(at, at + 50))
        kept = bytes(b for at, b in enumerate(text) if at not in gone)
        out.append((doc, len(text), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def by_group(batches, key):
    groups = defaultdict(list)
    for batch in batches:
        for r in batch.to_pylist():
            groups[r[key]].append(r)
    return groups


@pytest.mark.parametrize("hot", [4, 1 << 40])
@pytest.mark.parametrize("values", [2, 64, None])
def test_equal_hashes_of_different_strings_decide_nothing(monkeypatch, hot, values):
    real = suffix_dedup.mixed
    if values:  # few different hashes, so anchors, contexts and windows collide all the time
        monkeypatch.setattr(suffix_dedup, "mixed", lambda a: real(a) & np.uint64(values - 1 << 40))
    monkeypatch.setattr(suffix_dedup, "_rows", lambda rows: rows)
    monkeypatch.setattr(suffix_dedup, "_read", lambda r: suffix_dedup.Chunk(r["data"], r["doc_ids"], r["lengths"]))
    monkeypatch.setattr(suffix_dedup, "SHARD_STRINGS", 50)
    monkeypatch.setattr(suffix_dedup, "COMPARED", 7)
    monkeypatch.setattr(suffix_dedup, "SENT_BYTES", 1000)
    rows = [(k * 7 % 41, t.encode()) for k, t in enumerate(texts(36))]
    rows += [(100 + k, t[20:] + t[:80]) for k, (_, t) in enumerate(rows[:9])]
    chunks = {}
    for at in range(0, len(rows), 6):
        part = rows[at : at + 6]
        chunks[at] = {"chunk": at, "data": b"".join(t for _, t in part), "doc_ids": [d for d, _ in part], "lengths": [len(t) for _, t in part]}

    def exchanged(send, solve):
        back = defaultdict(list)
        for group in by_group(send, "bucket").values():
            for r in solve(suffix_dedup.pa.Table.from_pylist(group, suffix_dedup._MESSAGE_ROW)).to_pylist():
                back[r["chunk"]].append(r)
        return back

    replies = exchanged(suffix_dedup._send_anchors(8)(iter(chunks.values())), suffix_dedup._find_shared(hot))
    known = [c | {"replies": replies[k]} for k, c in chunks.items()]
    answers = exchanged(suffix_dedup._send_contexts(8)(iter(known)), suffix_dedup._solve)
    done = suffix_dedup._remove(8)(iter([c | {"answers": answers[c["chunk"]]} for c in known]))
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for b in done for r in b.to_pylist())
    want = removed_by_brute_force(rows)
    assert got == want and sum(r[2] for r in want) > 1000


@pytest.mark.parametrize("per_chunk", [1500, 50])
def test_no_bucket_holds_a_phrase(monkeypatch, per_chunk):
    monkeypatch.setattr(suffix_dedup, "_rows", lambda rows: rows)
    monkeypatch.setattr(suffix_dedup, "_read", lambda r: suffix_dedup.Chunk(r["data"], r["doc_ids"], r["lengths"]))
    own = [t.encode() for t in texts(1500)]
    chunks = {}
    for at in range(0, len(own), per_chunk):
        part = own[at : at + per_chunk]
        chunks[at] = {"chunk": at, "data": b"".join(part), "doc_ids": [*range(at, at + len(part))], "lengths": [*map(len, part)]}

    def by_bucket(messages):
        groups = defaultdict(list)
        for batch in messages:
            for r in batch.to_pylist():
                groups[r["bucket"]].append(r)
        return {b: suffix_dedup.pa.Table.from_pylist(g, suffix_dedup._MESSAGE_ROW) for b, g in groups.items()}

    hot = suffix_dedup._find_shared(100)
    replies = defaultdict(list)
    for group in by_bucket(suffix_dedup._send_anchors(64)(iter(chunks.values()))).values():
        for r in hot(group).to_pylist():
            replies[r["chunk"]].append(r)
    sent = by_bucket(suffix_dedup._send_contexts(64)(iter([c | {"replies": replies[k]} for k, c in chunks.items()])))
    entries = [sum(len(suffix_dedup._unpack(b, *"u8 u8 i8 u1 u1 u1 u8 i8 u1".split())[k]) for b in g.column("blob").to_pylist() for k in (0, 6)) for g in sent.values()]
    assert max(entries) < 3 * sum(entries) / 64
