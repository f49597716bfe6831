"""Blocks of open bucket members against brute force."""

import numpy as np
import pyarrow as pa

from scanlake.llm.near_dedup import SHARE, _linked


def groups(n, links):
    label = list(range(n))
    for a, b in links:
        old, new = label[b], label[a]
        label = [new if x == old else x for x in label]
    return {frozenset(i for i in range(n) if label[i] == x) for x in label}


def test_links_of_a_block_join_what_all_pairs_join():
    draw = np.random.default_rng(5)
    base = draw.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.where(draw.random(60) < draw.choice([0.03, 0.1, 0.2]), draw.integers(0, 2**63, 60, dtype=np.uint64), base))
            for _ in range(80)]
    n = len(sets)
    block = pa.table({
        "doc_id": pa.array([*range(n)] * 2, pa.int64()), "component": pa.array([*range(n)] * 2, pa.int64()),
        "asks": pa.array([True] * n + [False] * n), "shingles": pa.array([s.tobytes() for s in sets] * 2, pa.binary()),
    })
    links = list(zip(*(_linked(block).column(c).to_pylist() for c in "ab")))
    every = [(a, b) for a in range(n) for b in range(a + 1, n)
             if 100 * (both := len(np.intersect1d(sets[a], sets[b]))) >= SHARE * (len(sets[a]) + len(sets[b]) - both)]
    assert 0 < len(links) < n and set(links) <= set(every) and groups(n, links) == groups(n, every)


def test_a_block_without_asked_rows_has_no_links():
    block = pa.table({"doc_id": pa.array([1]), "component": pa.array([1]), "asks": pa.array([True]),
                      "shingles": pa.array([np.array([7], np.uint64).tobytes()], pa.binary())})
    assert _linked(block).num_rows == 0
