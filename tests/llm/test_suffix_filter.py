"""Which windows belong to an anchor, and which contexts the merge is spared."""

import random

import numpy as np
import pytest

from scanlake.llm import suffix_dedup


def test_merge_takes_only_contexts_that_agree_in_nearly_a_window():
    rng = random.Random(3)
    noise = lambda k: bytes(rng.choices(b"abcdefghij", k=k))
    anchor, contexts, left = noise(24), [], []

    def add(before, behind):
        contexts.append(before + anchor + behind)
        left.append(len(before))

    for _ in range(40):  # 13 bytes before the anchor are equal, nothing else
        add(noise(13) + b"0123456789abc", noise(26))
    for _ in range(40):  # 13 bytes behind it
        add(noise(26), b"cba9876543210" + noise(13))
    alone = len(contexts)
    for k in range(27):  # pairs with one window in common
        window = noise(k), noise(26 - k)
        for _ in range(2):
            add(noise(rng.randint(0, 26 - k)) + window[0], window[1] + noise(rng.randint(0, k)))
    sizes = np.array([*map(len, contexts)])
    text = np.frombuffer(b"".join(contexts), np.uint8)
    starts = np.cumsum(sizes) - sizes
    hashes = np.full(len(sizes), 7, np.uint64)
    found = suffix_dedup.may_share(hashes, np.array(left), sizes, text, starts)
    assert not found[:alone].any() and found[alone:].all()
    docs = np.arange(len(sizes))
    least = suffix_dedup.earliest_windows(hashes, docs, sizes, text, starts, np.array(left))
    assert np.array_equal(least, suffix_dedup.earliest_windows(hashes, docs, sizes, text, starts))


@pytest.mark.parametrize("step", [1, 64, 1 << 14])
def test_each_window_has_one_anchor_wherever_it_stands(monkeypatch, step):
    monkeypatch.setattr(suffix_dedup, "STEP", step)
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"ab", k=k)) for k in (0, 49, 50, 51, 3, 0, 400, 120, 49, 77, 50, 1)]
    texts += [texts[6][30:200], b"", b"a" * 300, texts[6]]
    data = b"".join(texts)
    chunk = suffix_dedup.Chunk(data, [*range(len(texts))], [*map(len, texts)])
    own = [(w, d, a, h) for f, e, d, a, h in zip(*(x.tolist() for x in (chunk.first, chunk.last, chunk.owner, chunk.anchor, chunk.hash)))
           for w in range(f, e + 1)]
    at, want = 0, []
    for d, text in enumerate(texts):
        want += [(at + w, d) for w in range(len(text) - 49)]
        at += len(text)
    assert [x[:2] for x in own] == want
    places = {}
    for w, _, a, h in own:
        assert 0 <= a - w <= 26 and places.setdefault(data[w : w + 50], (a - w, h)) == (a - w, h)


def test_messages_come_back_as_they_were():
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.int64), np.frombuffer(b"text", np.uint8)]
    back = suffix_dedup._unpack(suffix_dedup._pack(*arrays), "u8", "i8", "u1", "u4")
    assert [x.tolist() for x in back] == [x.tolist() for x in arrays] + [[]]
    assert [len(x) for x in suffix_dedup._unpack(suffix_dedup._pack(np.zeros(0, np.uint32)), "u4", "u1")] == [0, 0]
