"""BPE by speculating and verifying: greedy longest match first, exact merging only where that fails.

``encoded`` is one pass over the table without an exchange. Every task cuts its texts into words as the
tokenizer file says (composition, lower case, white space, pattern, byte alphabet). Words not seen before
are handled together:

1. *Speculate*: each word is covered by the longest token at every place.
2. *Verify*: a sequence of tokens is what merging gives exactly if every adjacent pair is, and each token is.
   A pair is compatible if no merge across its boundary comes before the merges that made both sides. All
   pairs of all words are tested at once by walking down the tokens' merges, newest first, in numpy.
3. *Merge*: words with an incompatible pair are merged step by step.

Null text is empty text: no ids, and the empty string back. Texts of any length are taken whole. An empty
table gives no rows; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scanlake.llm.common import id_and_text, pieces
from scanlake.llm.tokenizing import CachedEncoder, Known, at_white_space

NEVER = np.iinfo(np.int64).max
PIECE_CHARS = 1_000_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if visible, else the next from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class SpeculativeBpe(CachedEncoder):
    """Encoder and decoder for a word-level BPE file, read from the file's own vocabulary and merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_specials = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        import regex

        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.letters = dict(enumerate(byte_alphabet()))
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[tuple[int, int], int] = {}
        for n, (a, b) in enumerate(merges):
            pair = (self.vocab[a], self.vocab[b])
            if pair not in self.rank:
                self.rank[pair] = n
                self.made[pair] = self.vocab[a + b]
        size = max(max(self.vocab.values()), *self.specials.values()) + 1
        #: The merge that made each token: its place in the order (-1: a single byte) and its two sides.
        self.born = np.full(size, -1, np.int64)
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        pairs = np.array(list(self.rank), np.int64).reshape(-1, 2)
        ranks = np.array(list(self.rank.values()), np.int64)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], ranks[order]
        self.names = [""] * size
        for name, number in {**self.vocab, **self.specials}.items():
            self.names[number] = name
        # A token is proposed only if merging its own text gives it back.
        self.proposable: dict[str, int] = {}
        for name, number in self.vocab.items():
            symbols = self.symbols(name)
            if len(symbols) == 1:
                self.proposable[name] = number
                continue
            last: list = []
            if self.merged(symbols, last) == [number]:
                self.proposable[name] = number
                (self.left[number], self.right[number]), self.born[number] = last[0], self.rank[last[0]]
        self.longest = max(map(len, self.proposable), default=1)
        self.known, self.known_parts = Known(), Known()
        self.decoded: dict = {}
        self.tested: np.ndarray = np.zeros(0, np.int64)

    def symbols(self, name: str) -> list[int]:
        """Single-byte tokens of a token's text; the last one carries the end of the word."""
        if self.suffix and name.endswith(self.suffix) and name != self.suffix:
            body = name[: -len(self.suffix)]
            return [self.vocab[c] for c in body[:-1]] + [self.vocab[body[-1] + self.suffix]]
        return [self.vocab[c] for c in name]

    def merged(self, ids: list[int], last: list | None = None) -> list[int]:
        """Exact merging: the earliest merge first, leftmost among equals.

        Pairs wait in a heap by (rank, place); places are linked, and a pair that has changed is passed over. So a
        word of any length costs its length times the depth of the heap.
        """
        ids = list(ids)
        n, rank = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, at) for at, pair in enumerate(zip(ids, ids[1:])) if (r := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            r, at = heapq.heappop(heap)
            right = after[at]
            if ids[at] < 0 or right >= n or rank(pair := (ids[at], ids[right])) != r:
                continue
            if last is not None:
                last[:] = [pair]
            ids[at], ids[right] = self.made[pair], -1
            after[at] = end = after[right]
            if end < n:
                before[end] = at
                if (r := rank((ids[at], ids[end]))) is not None:
                    heapq.heappush(heap, (r, at))
            if (left := before[at]) >= 0 and (r := rank((ids[left], ids[at]))) is not None:
                heapq.heappush(heap, (r, left))
        return [i for i in ids if i >= 0]

    def proposed(self, word: str) -> list[int]:
        """Longest token at each place; ``word`` is in the byte alphabet, without the suffix."""
        ids, at, end = [], 0, len(word)
        tokens, suffix, longest = self.proposable, self.suffix, self.longest
        while at < end:
            if end - at <= longest and (whole := tokens.get(word[at:] + suffix)) is not None:
                ids.append(whole)
                break
            for stop in range(min(end - 1 if suffix else end, at + longest), at, -1):
                if (found := tokens.get(word[at:stop])) is not None:
                    ids.append(found)
                    at = stop
                    break
            else:
                raise ValueError(f"no token for byte {word[at]!r}")
        return ids

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: would merging leave the boundary between them?"""
        a, b = a.astype(np.int64), b.astype(np.int64)
        good = np.ones(len(a), bool)
        limit = np.full(len(a), NEVER)  # a merge across the boundary must not come before this
        rows = np.arange(len(a))
        while len(rows):
            x, y = a[rows], b[rows]
            bad = self.ranks_of(x, y) < limit[rows]
            good[rows[bad]] = False
            x_newer = self.born[x] > self.born[y]
            newest = np.maximum(self.born[x], self.born[y])
            going = ~bad & (newest >= 0)
            # Of equal merges the leftmost comes first: the left token's own before the boundary's, the
            # boundary's before the right token's own.
            limit[rows] = np.where(x_newer, newest, newest + 1)
            a[rows] = np.where(x_newer, self.right[x], x)
            b[rows] = np.where(x_newer, y, self.left[y])
            rows = rows[going]
        return good

    def encode_parts(self, fresh: list) -> tuple[np.ndarray, np.ndarray]:
        letters = self.letters
        words = [w if isinstance(w, tuple) else w.encode().decode("latin-1").translate(letters) for w in fresh]
        ids = [[w[0]] if isinstance(w, tuple) else self.proposed(w) for w in words]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for own in ids for i in own), np.int64)
        owner = np.repeat(np.arange(len(ids)), length)
        inside = owner[1:] == owner[:-1]
        keys, back = np.unique(flat[:-1][inside] << 32 | flat[1:][inside], return_inverse=True)
        good = self.compatible(keys >> 32, keys & 0xFFFFFFFF)
        failing = np.unique(owner[1:][inside][~good[back]])
        if len(failing):
            for n in failing.tolist():
                word = words[n]
                byte_ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + self.suffix]]
                ids[n] = self.merged(byte_ids)
            length = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for own in ids for i in own), np.int64)
        return flat.astype(np.uint32), length

    def chunks(self, text: str) -> list:
        """Words between white space, normalised; a special token is a tuple with its id."""
        if "<|" not in text:
            return at_white_space(self.normal(text))
        out: list = []
        for part in self.cut_specials.split(text):
            if part in self.specials:
                out.append((self.specials[part],))
            else:
                out += at_white_space(self.normal(part))
        return out

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def parts(self, chunk) -> list:
        if isinstance(chunk, tuple) or chunk.isalpha():
            return [chunk]
        return self.pattern.findall(chunk)

    def decode(self, ids: np.ndarray) -> str:
        """As the library without a decoder: the tokens' names joined by spaces."""
        names = self.names
        return " ".join([names[i] for i in ids.tolist()])


@lru_cache(maxsize=4)
def speculative(path: str) -> SpeculativeBpe:
    """One per worker process and file."""
    return SpeculativeBpe(path)


def encoded(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = speculative(tokenizer_path)
        for doc_ids, texts in pieces(batches, PIECE_CHARS):
            ids, lengths = bpe.encode(texts)
            ends = np.cumsum(lengths)
            own = [ids[end - n : end] for n, end in zip(lengths, ends)]
            yield pa.record_batch(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in own], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs).mapInArrow(run, SCHEMA)
