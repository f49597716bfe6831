"""Words of whole texts as numbers, for models in numpy."""

from __future__ import annotations

from itertools import chain

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(4096, 0x100000001B3, np.uint64), dtype=np.uint64)


def mixed(numbers: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers."""
    x = numbers.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Vocabulary:
    """Numbers for the distinct words of some texts, in order of first sight."""

    def __init__(self, lists: list[list[str]]):
        table = _Numbers()
        self.lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        self.numbers = np.fromiter(
            map(table.__getitem__, chain.from_iterable(lists)), np.int64, int(self.lengths.sum())
        )
        self.words = list(table)

    def bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct words' bytes one after the other, and where each begins, with the end."""
        encoded = [w.encode("utf-8", "surrogatepass") for w in self.words]
        starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))))
        return np.frombuffer(b"".join(encoded), np.uint8), starts


def word_hashes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if len(starts) < 2:
        return np.zeros(0, np.uint64)
    place = np.arange(len(codes)) - np.repeat(starts[:-1], np.diff(starts))
    values = (codes.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 4095] * (
        (place >> 12).astype(np.uint64) * _MULTIPLIER + np.uint64(1)
    )
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return mixed(sums[starts[1:]] - sums[starts[:-1]] + np.diff(starts).astype(np.uint64) * _MULTIPLIER)


def trigram_hashes(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word's byte trigrams, the word bordered by blanks, and the word of each."""
    n = len(starts) - 1
    lengths = np.diff(starts)
    padded = np.full(len(codes) + 2 * n, 32, np.int64)
    word = np.repeat(np.arange(n), lengths)
    padded[np.arange(len(codes)) + 2 * word + 1] = codes
    owner = np.repeat(np.arange(n), lengths + 2)
    same = owner[2:] == owner[:-2]
    keys = (padded[:-2] << 16 | padded[1:-1] << 8 | padded[2:])[same]
    return mixed(keys), owner[2:][same]
