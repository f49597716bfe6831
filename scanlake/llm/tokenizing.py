"""Ids of whole texts from a tokenizer file, with equal chunks encoded once.

The tokenizers library encodes; this module only avoids asking it twice for the same piece of text. A text
is cut where the file's own pre-tokenizer always cuts, so the ids of the pieces joined are the ids of the
text. Both tables of known pieces are emptied when full, which changes no result.
"""

from __future__ import annotations

import os
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np

KNOWN_CHUNKS = 800_000
KNOWN_PARTS = 500_000
#: Characters after which a table of known pieces is emptied, however few pieces they are.
KNOWN_CHARS = 12_000_000
#: Pieces that the library encodes as one text, a special token between them.
JOINED = 200
#: White space to Python that is none to the tokenizers' patterns.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACE_NOT_BEFORE_WORD = re.compile(r" (?=\s|$)")
_CUT_BEFORE_SPACE = re.compile(r"(?= \S)")


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices ``flat[start[i] : start[i] + length[i]]``, one after the other."""
    ends = np.cumsum(length)
    return flat[np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]


class Known(dict):
    """Numbers for pieces in order of their first sight; ``fresh`` lists those not yet encoded."""

    def __init__(self):
        self.fresh: list = []
        self.chars = 0
        self.flat = np.zeros(0, np.uint32)
        self.start = self.length = np.zeros(0, np.int64)

    def __missing__(self, piece):
        number = self[piece] = len(self)
        self.fresh.append(piece)
        self.chars += len(piece)
        return number

    def full(self, most: int) -> bool:
        return len(self) > most or self.chars > KNOWN_CHARS

    def numbers(self, lists: list[list]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))

    def add(self, flat: np.ndarray, length: np.ndarray) -> None:
        self.start = np.append(self.start, len(self.flat) + np.cumsum(length) - length)
        self.length = np.append(self.length, length)
        self.flat = np.append(self.flat, flat)
        self.fresh = []

    def ids(self, numbers: np.ndarray, lists: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all lists of known pieces joined, and how many each list has."""
        lengths = self.length[numbers]
        ends = np.cumsum([0, *map(len, lists)])
        total = np.concatenate(([0], np.cumsum(lengths)))
        return gather(self.flat, self.start[numbers], lengths), np.diff(total[ends])


class CachedEncoder:
    """Subclasses say how a text is cut into chunks, and, if that pays, a chunk into parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known, self.known_parts = Known(), Known()
        #: A special token that the library cuts at before it looks at anything else.
        self.mark, self.mark_text = next(
            ((n, t.content) for n, t in self.library.get_added_tokens_decoder().items()
             if t.content.startswith("<|") and not (t.lstrip or t.rstrip or t.single_word or t.normalized)), (None, "")
        )

    def chunks(self, text: str) -> list:
        raise NotImplementedError

    #: Cuts a chunk into parts that recur more often than it, where encoding a part is the costly step.
    parts = None

    def encode_parts(self, fresh: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces joined, and how many each has.

        An encoding of its own costs more than the short piece in it, so pieces go in joined by a special token.
        """
        if self.mark is None or any("<|" in piece for piece in fresh):
            return self._encode_single(fresh)
        texts = [self.mark_text.join([*fresh[at : at + JOINED], ""]) for at in range(0, len(fresh), JOINED)]
        ids, _ = self._encode_single(texts)
        marks = np.flatnonzero(ids == self.mark)
        return ids[ids != self.mark], np.diff(marks, prepend=-1) - 1

    def _encode_single(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, as unsigned 32-bit integers, and how many each text has."""
        if self.known.full(KNOWN_CHUNKS):
            self.known = Known()
        if self.known_parts.full(KNOWN_PARTS):
            self.known_parts = Known()
        cut = [self.chunks(t) for t in texts]
        numbers = self.known.numbers(cut)
        fresh = self.known.fresh
        if fresh and self.parts:
            split = [self.parts(c) for c in fresh]
            part_numbers = self.known_parts.numbers(split)
            if self.known_parts.fresh:
                self.known_parts.add(*self.encode_parts(self.known_parts.fresh))
            self.known.add(*self.known_parts.ids(part_numbers, split))
        elif fresh:
            self.known.add(*self.encode_parts(fresh))
        return self.known.ids(numbers, cut)


class ByteLevelEncoder(CachedEncoder):
    """For byte-level files whose words may begin with one space.

    Their pattern always cuts before a space that a non-space follows.
    """

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if _SPACE_NOT_BEFORE_WORD.search(text):
            return [c for c in _CUT_BEFORE_SPACE.split(text) if c]
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + c for c in rest]


class WordLevelEncoder(CachedEncoder):
    """For lower-casing files that drop white space: a text is cut at white space.

    It is lower-cased first where that is sure to be what the file's normaliser does. Special tokens match
    before lower-casing, a capital sigma lowers by its place in Python alone, and some texts change on
    composing: these keep their case, and the library lowers it.
    """

    def chunks(self, text: str) -> list[str]:
        plain = "<|" not in text and (
            text.isascii() or ("Σ" not in text and "İ" not in text and unicodedata.is_normalized("NFC", text))
        )
        return at_white_space(text.lower() if plain else text)


def at_white_space(text: str) -> list[str]:
    if _ODD_SPACE.search(text):
        return [c for c in re.split("[^\\S\x1c-\x1f]+", text) if c]
    return text.split()


@lru_cache(maxsize=4)
def byte_level(path: str) -> ByteLevelEncoder:
    """One encoder per worker process and file."""
    return ByteLevelEncoder(path)


@lru_cache(maxsize=4)
def word_level(path: str) -> WordLevelEncoder:
    return WordLevelEncoder(path)
