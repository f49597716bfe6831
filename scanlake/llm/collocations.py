"""Phrases whose words belong together, by multikey three-way quicksort of suffix pointers.

Texts are lower-cased (A-Z) and cut into pieces, the pieces into words. Every word begins a suffix of its piece,
of which the first ``DEPTH`` words matter. Everything is counted per language, exactly:

1. *Words*. Chunks (``word_chunks``) send their distinct words with counts, dealt out by word. A bucket knows
   all occurrences of its words: it numbers those that occur often enough. Suffixes that begin with any other
   word are abandoned at once.
2. *Routing*. The other suffixes go to buckets by their leading words: first two, then, for suffixes whose both
   adjacent pairs are frequent, three. A chunk combines equal ones before it sends them, so one phrase is one
   entry a chunk, however often it occurs, and no leading word has a bucket to itself.
3. *Sorting*. A bucket sorts its pointers by multikey three-way quicksort: a segment is split by a pivot word
   into less, equal and greater; the equal part goes on with the next word, and at the last one its size is the
   phrase's count. A segment of fewer than ``least`` occurrences cannot hold a frequent phrase and is abandoned.
   All segments of a bucket take their split together, in numpy.
4. *Scores*. Words, pairs and triples are tables; cutting a phrase joins its parts' counts. Products are decimals
   of 38 digits, exact for counts up to 10^15.

Null text is empty, null lang is ``und``, a null doc_id changes nothing, and repeated rows count each. Texts of
any length are taken whole. Ties in score go by count, then by phrase in byte order. An empty table gives no
rows; a table without a column lang is not accepted. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanlake.llm.common import whole_text
from scanlake.llm.features import mixed, word_hashes
from scanlake.llm.word_chunks import (
    CHUNK_TOKENS,
    Chunk,
    Numbers,
    bucket_number,
    by_bucket,
    chunk_rows,
    exchanged,
    packed,
    unpacked,
    write_chunks,
)
from scanlake.session import written

LEAST = 10
DEPTH = 3
#: Percent of a phrase's occurrences inside a longer candidate from which on it is part of that.
ABSORBED = 50
TOP = 2000
#: Parts into which a language is dealt before its best phrases are ranked together.
PARTS = 16
_CUT = 0xFF  # no byte of UTF-8
_BREAK = bytes([_CUT])
_PIECE_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)
_BETWEEN = b" " + _BREAK + b" "
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _tokenise(texts: list[str], labels: list[str], numbers: Numbers) -> list[list[int]]:
    """Numbers of (language, word); every piece ends with the break of its language."""
    out = []
    for text, lang in zip(texts, labels, strict=True):
        data = text.encode("utf-8", "surrogatepass").lower().translate(_PIECE_ENDS) + _BREAK
        number = numbers.table(lang.encode("utf-8", "surrogatepass") + _BREAK).__getitem__
        out.append(list(map(number, data.replace(_BREAK, _BETWEEN).split())))
    return out


def _keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and which are words, not breaks."""
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets - offsets[0]
    is_word = np.ones(len(words), bool)
    if len(words):
        is_word = data[starts[1:] - 1] != _CUT
    return word_hashes(data, starts), is_word


def _send_words(buckets: int):
    def send(row: dict, chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        hashes, is_word = _keys(chunk.words)
        counts = np.bincount(chunk.tokens, minlength=len(chunk.words))
        own = np.flatnonzero(is_word)
        order, parts = by_bucket((hashes[own] % np.uint64(buckets)).astype(np.int64))
        for bucket, a, b in parts:
            some = own[order[a:b]]
            yield bucket, packed(words=chunk.words.take(pa.array(some)), counts=counts[some])

    return send


def _number_words(buckets: int, least: int):
    def solve(bucket: int, blobs: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        parts = [unpacked(b) for b in blobs]
        coded = pa.chunked_array([p["words"] for p in parts]).combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        codes = coded.indices.to_numpy()
        total = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(total, codes, np.concatenate([p["counts"] for p in parts]))
        often = np.flatnonzero(total >= least)
        number = np.full(len(total), -1, np.int64)
        number[often] = np.arange(len(often)) * buckets + bucket
        ends = np.cumsum([len(p["counts"]) for p in parts])[:-1]
        answers = [packed(number=n) for n in np.split(number[codes], ends)]
        langs = pc.split_pattern(coded.dictionary, _BREAK, max_splits=1)
        result = packed(
            number=number[often], counts=total[often], words=coded.dictionary.take(pa.array(often)),
            all_langs=pc.list_element(langs, 0).cast(pa.large_binary()), all_counts=total,
        )
        return answers, [result]

    return solve


def _numbers_of(row: dict, chunk: Chunk, buckets: int) -> np.ndarray:
    """The global number of each of the chunk's words, -1 for rare ones and breaks."""
    hashes, is_word = _keys(chunk.words)
    own = np.flatnonzero(is_word)
    order, parts = by_bucket((hashes[own] % np.uint64(buckets)).astype(np.int64))
    answers = {a["bucket"]: unpacked(a["blob"])["number"] for a in row["word_numbers"] or []}
    number = np.full(len(chunk.words), -1, np.int64)
    for bucket, a, b in parts:
        number[own[order[a:b]]] = answers[bucket]
    return number


def _route(buckets: int, *words: np.ndarray) -> np.ndarray:
    key = np.zeros(len(words[0]), np.uint64)
    for w in words:
        key = mixed(key * _MIX + w.astype(np.uint64))
    return (key % np.uint64(buckets)).astype(np.int64)


class _Suffixes:
    """Distinct leading pairs of a chunk's suffixes, as they are sent, and of each suffix its pair."""

    def __init__(self, row: dict, chunk: Chunk, buckets: int):
        number = _numbers_of(row, chunk, buckets)
        tokens = number[chunk.tokens]
        self.tokens = tokens
        self.at = np.flatnonzero((tokens[:-1] >= 0) & (tokens[1:] >= 0)) if len(tokens) else np.zeros(0, np.int64)
        local = chunk.tokens.astype(np.int64)
        keys, back, self.counts = np.unique(
            local[self.at] << 32 | local[self.at + 1], return_inverse=True, return_counts=True
        )
        self.first, self.second = number[keys >> 32], number[keys & 0xFFFFFFFF]
        self.order, self.parts = by_bucket(_route(buckets, self.first, self.second))
        self.pair = back


def _send_pairs(buckets: int):
    def send(row: dict, chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        s = _Suffixes(row, chunk, buckets)
        for bucket, a, b in s.parts:
            own = s.order[a:b]
            yield bucket, packed(w0=s.first[own], w1=s.second[own], counts=s.counts[own])

    return send


def _send_triples(buckets: int):
    def send(row: dict, chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        s = _Suffixes(row, chunk, buckets)
        answers = {a["bucket"]: unpacked(a["blob"])["often"] for a in row["frequent_pairs"] or []}
        often = np.zeros(len(s.counts), bool)
        for bucket, a, b in s.parts:
            often[s.order[a:b]] = np.unpackbits(answers[bucket])[: b - a].astype(bool)
        # Of each place the frequent pair that begins there, -1 for none.
        pair = np.full(len(s.tokens), -1, np.int64)
        pair[s.at] = np.where(often[s.pair], s.pair, -1)
        at = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0)) if len(pair) else np.zeros(0, np.int64)
        keys, counts = np.unique(pair[at] << 32 | pair[at + 1], return_counts=True)
        left, right = keys >> 32, keys & 0xFFFFFFFF
        words = s.first[left], s.second[left], s.second[right]
        order, parts = by_bucket(_route(buckets, *words))
        for bucket, a, b in parts:
            own = order[a:b]
            yield bucket, packed(**{f"w{k}": w[own] for k, w in enumerate(words)}, counts=counts[own])

    return send


def multikey_groups(keys: list[np.ndarray], weights: np.ndarray, least: int) -> np.ndarray:
    """Of each pointer the number of its equal partition at full depth, -1 where that was abandoned.

    ``keys[d]`` holds every pointer's word at depth d, ``weights`` the occurrences it stands for.
    """
    n, depth = len(weights), len(keys)
    group = np.full(n, -1, np.int64)
    words = np.stack(keys) if n else np.zeros((depth, 0), np.int64)
    pointers = np.arange(n)
    size = np.array([n] if n and int(weights.sum()) >= least else [], np.int64)
    at_depth = np.zeros(len(size), np.int64)
    done, turn = 0, 0
    if not len(size):
        return group
    while len(size):
        start = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(size)), size)
        turn += 1
        pick = mixed(np.arange(len(size), dtype=np.uint64) * _MIX + np.uint64(turn)) % size.astype(np.uint64)
        pivot = words[at_depth, pointers[start + pick.astype(np.int64)]]
        word = words[at_depth[segment], pointers]
        side = (word > pivot[segment]).astype(np.int64) - (word < pivot[segment]) + 1
        part = 3 * segment + side
        many = np.bincount(part, minlength=3 * len(size))
        heavy = np.bincount(part, weights[pointers], 3 * len(size)).astype(np.int64)
        equal = np.arange(3 * len(size)) % 3 == 1
        part_depth = np.repeat(at_depth, 3) + equal
        alive = heavy >= least
        whole = alive & (part_depth == depth)
        name = np.full(3 * len(size), -1, np.int64)
        name[whole] = done + np.arange(whole.sum())
        done += int(whole.sum())
        ended = whole[part]
        group[pointers[ended]] = name[part[ended]]
        going = alive & ~whole
        # Pointers of each part, in their order, behind those of the parts before it.
        room = np.where(going, many, 0)
        place = np.cumsum(room) - room
        moved = np.empty(int(room.sum()), np.int64)
        for k in range(3):
            own = np.flatnonzero((side == k) & going[part])
            of = part[own]
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(own) else own
            rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
            moved[place[of] + rank] = pointers[own]
        pointers, size, at_depth = moved, many[going], part_depth[going]
    return group


def _count_phrases(depth: int, least: int, answer: bool):
    def solve(bucket: int, blobs: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        parts = [unpacked(b) for b in blobs]
        words = [np.concatenate([p[f"w{k}"] for p in parts]) for k in range(depth)]
        counts = np.concatenate([p["counts"] for p in parts])
        group = multikey_groups(words, counts, least)
        often = group >= 0
        total = np.zeros(int(group.max(initial=-1)) + 1, np.int64)
        np.add.at(total, group[often], counts[often])
        some = np.zeros(len(total), np.int64)
        some[group[often]] = np.flatnonzero(often)
        result = packed(**{f"w{k}": w[some] for k, w in enumerate(words)}, counts=total)
        ends = np.cumsum([len(p["counts"]) for p in parts])[:-1]
        answers = [packed(often=np.packbits(x)) for x in np.split(often, ends)] if answer else []
        return answers, [result]

    return solve


def _rows(results: DataFrame, names: list[str], schema: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chunk_rows(batches):
            found = unpacked(row["blob"])
            yield pa.record_batch([pa.array(found[n]) for n in names], names=schema.replace(" long", "").split(", "))

    return written(results.mapInArrow(run, schema), name)


def _word_rows(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(number, lang, word, f) of frequent words, and (lang, n) over all words."""

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chunk_rows(batches):
            found = unpacked(row["blob"])
            split = [w.split(_BREAK, 1) for w in found["words"].to_pylist()]
            yield pa.record_batch(
                [pa.array(found["number"]), pa.array([x[0] for x in split], pa.binary()),
                 pa.array([x[1] for x in split], pa.binary()), pa.array(found["counts"])],
                names=["number", "lang", "word", "f"],
            )

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chunk_rows(batches):
            found = unpacked(row["blob"])
            table = pa.table({"lang": found["all_langs"].cast(pa.binary()), "n": pa.array(found["all_counts"])})
            table = table.group_by("lang").aggregate([("n", "sum")]).select(["lang", "n_sum"]).rename_columns(["lang", "n"])
            yield from table.combine_chunks().to_batches()

    text = lambda c: F.col(c).cast("string").alias(c)
    words = written(results.mapInArrow(frequent, "number long, lang binary, word binary, f long"), "frequent-words")
    sums = results.mapInArrow(totals, "lang binary, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    return words.select("number", text("lang"), text("word"), "f"), sums.select(text("lang"), "n")


def _score(a: str, left: str, right: str) -> str:
    wide = [f"cast({c} as decimal(19, 0))" for c in (a, left, right)]
    return f"(cast({wide[0]} * {wide[0]} as decimal(38, 0)) * 1000000BD div ({wide[1]} * {wide[2]}))"


def phrases(docs: DataFrame, least: int = LEAST, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Every candidate of two to three words with a = f(phrase), its decisive cut (l, r), n and score.

    Columns: lang, phrase, size (words), a, l, r, n, score, absorbed (part of a longer candidate).
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"),
        F.coalesce(F.col("lang"), F.lit("und")).alias("label"),
    )
    chunks = write_chunks(rows, _tokenise, chunk_tokens)
    buckets = bucket_number(chunks)
    chunks, results = exchanged(chunks, _send_words(buckets), _number_words(buckets, least), "word_numbers")
    words, totals = _word_rows(results)
    chunks, results = exchanged(chunks, _send_pairs(buckets), _count_phrases(2, least, True), "frequent_pairs")
    pairs = _rows(results, ["w0", "w1", "counts"], "w0 long, w1 long, f long", "pairs")
    _, results = exchanged(chunks, _send_triples(buckets), _count_phrases(DEPTH, least, False), "triples")
    triples = _rows(results, ["w0", "w1", "w2", "counts"], "w0 long, w1 long, w2 long, f long", "triples")

    word = lambda k: words.select(
        F.col("number").alias(f"w{k}"), F.col("word").alias(f"t{k}"), F.col("f").alias(f"f{k}")
    )
    of_two = pairs.join(words.select(F.col("number").alias("w0"), "lang", F.col("word").alias("t0"), F.col("f").alias("f0")), "w0")
    of_two = of_two.join(word(1), "w1")
    inside = triples.select("w0", "w1", "f").unionByName(triples.select(F.col("w1").alias("w0"), F.col("w2").alias("w1"), "f"))
    inside = inside.groupBy("w0", "w1").agg(F.max("f").alias("longer"))
    two = of_two.join(inside, ["w0", "w1"], "left").select(
        "lang", F.concat_ws(" ", "t0", "t1").alias("phrase"), F.lit(2).alias("size"), F.col("f").alias("a"),
        F.col("f0").alias("l"), F.col("f1").alias("r"), F.expr(_score("f", "f0", "f1")).alias("score"),
        F.coalesce(F.expr(f"100 * longer >= {ABSORBED} * f"), F.lit(False)).alias("absorbed"),
    )
    pair = lambda x, y, f: pairs.select(F.col("w0").alias(f"w{x}"), F.col("w1").alias(f"w{y}"), F.col("f").alias(f))
    of_three = (
        triples.join(pair(0, 1, "f01"), ["w0", "w1"]).join(pair(1, 2, "f12"), ["w1", "w2"])
        .join(words.select(F.col("number").alias("w0"), "lang", F.col("word").alias("t0"), F.col("f").alias("f0")), "w0")
        .join(word(1), "w1").join(word(2), "w2")
        .withColumn("s1", F.expr(_score("f", "f0", "f12"))).withColumn("s2", F.expr(_score("f", "f01", "f2")))
    )
    early = F.expr("s1 <= s2")
    three = of_three.select(
        "lang", F.concat_ws(" ", "t0", "t1", "t2").alias("phrase"), F.lit(3).alias("size"), F.col("f").alias("a"),
        F.when(early, F.col("f0")).otherwise(F.col("f01")).alias("l"),
        F.when(early, F.col("f12")).otherwise(F.col("f2")).alias("r"),
        F.least("s1", "s2").alias("score"), F.lit(False).alias("absorbed"),
    )
    return two.unionByName(three).join(totals, "lang")


def best_phrases(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """Each language's first ``top`` phrases that are no part of a longer one."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = phrases(docs, least).where("not absorbed").withColumn("part", F.expr(f"pmod(xxhash64(phrase), {PARTS})"))
    # A language may hold nearly all rows: the best of each part first, then the best of those.
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    found = found.where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return found.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, row_number() over () as doc,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
lists as (
  select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as ws from pieces),
tokens as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from lists where len(ws) > 0),
grams as (
  select lang, ws[i] as w1, ws[i+1] as w2, ws[i+2] as w3, len(ws) - i as after from tokens),
n as (select lang, count(*) as n from grams group by lang),
f1 as (select lang, w1, count(*) as f from grams group by all),
f2 as (select lang, w1, w2, count(*) as f from grams where after >= 1 group by all having count(*) >= 10),
f3 as (select lang, w1, w2, w3, count(*) as f from grams where after >= 2 group by all having count(*) >= 10),
two as (
  select p.lang, p.w1 || ' ' || p.w2 as phrase, p.f as a, x.f as l, y.f as r,
         (1000000::hugeint * p.f * p.f) // (x.f::hugeint * y.f) as score
  from f2 p join f1 x on x.lang = p.lang and x.w1 = p.w1 join f1 y on y.lang = p.lang and y.w1 = p.w2
  where not exists (
    select 1 from f3 t where t.lang = p.lang and 100 * t.f >= 50 * p.f
      and ((t.w1 = p.w1 and t.w2 = p.w2) or (t.w2 = p.w1 and t.w3 = p.w2)))),
cuts as (
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 as phrase, t.f as a, x.f as l1, yz.f as r1, xy.f as l2, z.f as r2,
         (1000000::hugeint * t.f * t.f) // (x.f::hugeint * yz.f) as s1,
         (1000000::hugeint * t.f * t.f) // (xy.f::hugeint * z.f) as s2
  from f3 t
  join f1 x on x.lang = t.lang and x.w1 = t.w1
  join f2 yz on yz.lang = t.lang and yz.w1 = t.w2 and yz.w2 = t.w3
  join f2 xy on xy.lang = t.lang and xy.w1 = t.w1 and xy.w2 = t.w2
  join f1 z on z.lang = t.lang and z.w1 = t.w3),
every as (
  select lang, phrase, a, l, r, score from two
  union all
  select lang, phrase, a, case when s1 <= s2 then l1 else l2 end, case when s1 <= s2 then r1 else r2 end, least(s1, s2)
  from cuts),
ranked as (
  select every.*, n.n, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from every join n using (lang))
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked where rank <= 2000
"""
