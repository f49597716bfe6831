"""Burrows-Wheeler transforms of string collections, and their merge by interleave refinement.

Strings are arrays of symbols 1..256 (a byte plus one), each followed by the terminator 0. ``Shard`` sorts
the suffixes of its own strings once. ``merge`` then finds the merged order of all shards' suffixes without
comparing or sorting suffixes again: it keeps only the *interleave*, which says for each merged place from
which shard it comes. One refinement reads the shards' transforms along the interleave and distributes it
stably by the symbols read; after h refinements places are in order by their first h symbols. Places whose
first h symbols are equal form a block; the refinement in which a block splits gives the common prefix of
the neighbours at that place, and the blocks left after ``depth`` refinements are the repeated intervals.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order; ``ends``: of each place the place of its string's terminator.

    A suffix ends with its terminator. Equal suffixes stay in order of their strings.
    """
    n = len(text)
    places = np.arange(n)
    # Seven symbols of nine bits; those behind a terminator are cut off.
    symbols = np.zeros(n + 6, np.int64)
    symbols[:n] = text
    pairs = symbols[:-1] << 9 | symbols[1:]
    key = pairs[:n] << 45 | pairs[2 : n + 2] << 27 | pairs[4 : n + 4] << 9 | symbols[6:]
    key &= np.array([~0 << 9 * (7 - k) for k in range(8)])[np.minimum(ends - places + 1, 7)]
    rank = _ranks(key)
    step = 7
    longest = int((ends - places).max(initial=0)) + 1
    while step < longest and int(rank.max(initial=0)) < n - 1:
        behind = np.where(places + step <= ends, rank[np.minimum(places + step, n - 1)] + 1, 0)
        rank = _ranks(rank * (n + 2) + behind)
        step *= 2
    return np.argsort(rank * n + places)


def _ranks(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.concatenate(([False], ordered[1:] != ordered[:-1])))
    return rank


class Shard:
    """Strings with their suffix order and transform: the symbol before each suffix, in order."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        """``data``: the strings' bytes one after the other."""
        self.lengths = np.asarray(lengths, np.int64)
        stops = np.cumsum(self.lengths + 1) - 1
        self.starts = stops - self.lengths
        text = np.zeros(len(data) + len(self.lengths), np.uint16)
        inside = np.ones(len(text), bool)
        inside[stops] = False
        text[inside] = data.astype(np.uint16) + 1
        self.order = suffix_order(text, np.repeat(stops, self.lengths + 1))
        before = np.concatenate((text[-1:], text[:-1]))
        before[self.starts] = 0
        self.transform = before[self.order]


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each merged place: its shard, its block, and the common prefix with the place before.

    Blocks are numbered in order. Common prefixes are exact below ``depth``, and ``depth`` within a block; no
    prefix reaches beyond a terminator that is unequal only in what follows it.
    """
    sizes = [len(s.order) for s in shards]
    n = sum(sizes)
    symbols = np.concatenate([s.transform for s in shards]) if shards else np.zeros(0, np.uint16)
    if n and symbols.max() < 256:  # always so for UTF-8
        symbols = symbols.astype(np.uint8)
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint8 if len(shards) < 256 else np.uint16), sizes)
    block = np.zeros(n, np.int32)
    common = np.full(n, depth, np.int32)
    if n:
        common[0] = 0
    blocks = 1
    for done in range(depth):
        read = np.empty(n, symbols.dtype)
        read[np.argsort(interleave, kind="stable")] = symbols
        order = np.argsort(read, kind="stable")
        new = interleave[order]
        read, behind = read[order], block[order]
        split = np.zeros(n, bool)
        # Terminators are all alike: what comes after one is another string.
        split[1:] = (read[1:] != read[:-1]) | ((behind[1:] != behind[:-1]) & (read[1:] != 0))
        common[split & (common == depth)] = done
        block = np.cumsum(split, dtype=np.int32)
        now = int(block[-1]) + 1 if n else 0
        stable = now == blocks and np.array_equal(new, interleave)
        interleave, blocks = new, now
        if stable:
            break
    return interleave, block, common


def places_in_shards(interleave: np.ndarray, shards: list[Shard]) -> np.ndarray:
    """Of each merged place, the place of its suffix among all shards' texts joined."""
    out = np.empty(len(interleave), np.int64)
    base = 0
    found = []
    for s in shards:
        found.append(s.order + base)
        base += len(s.order)
    out[np.argsort(interleave, kind="stable")] = np.concatenate(found) if found else np.zeros(0, np.int64)
    return out
