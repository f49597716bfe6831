"""Near-duplicate groups by SuperMinHash signatures, banding, verification on full sets and union-find.

* *Signatures*. A document's set is its distinct shingles as 64-bit hashes. In SuperMinHash an element gets the
  ranks of a random permutation instead of independent values: rank j goes to the place that j steps of a
  Fisher-Yates shuffle give, with value j plus a fraction. All elements of a batch of documents take step j
  together; a document stops once every place has a value, since later steps only bring larger ones.
* *Classes*. Equal sets (128-bit hash and size) are one class; only its smallest document goes on, so groups
  of exact copies of any size cost one row per task.
* *Banding*. ``BANDS`` keys of ``ROWS`` places each: documents at similarity 0.75 share a key with a chance of
  over 0.99999. In each bucket every member is paired with the smallest one only: no all-pairs.
* *Verification*. Pairs meet their full sets, and ``100 * intersection >= 75 * union`` decides.
* *Rest*. A bucket that still spans several components may hide links between its other members. In buckets
  of more than ``SMALL_BUCKET`` members a bound goes first: with ``k`` elements shared with the bucket's
  smallest member c, and ``r`` elements outside c that any other member compared with c has too, a member
  shares at most ``k + r`` elements with any other. Members that cannot reach the similarity so are closed.
  Of the rest, those outside the component of c ask all others, full set against full set, in blocks of
  bounded size; no pair becomes a row unless it is a link. No link of a bucket is lost, and a group of mutual
  near-copies costs one pair a member.
* *Grouping*. Union-find on links as joins: every node points to its smallest neighbour, pointers are jumped,
  links are contracted to the ends' pointers until none is left. Each round is written to the shared folder.

Null, empty and blank texts have no shingles, link with nothing and are components of their own. Texts of
under five words have the whole sequence as one shingle. Rows that repeat a doc_id are one node with the links of all
their texts. A row without a doc_id belongs to the component of a row with an equal set and is not kept; if there
is none its component is null and it is kept. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import id_and_text, pieces, whole_text
from scanlake.llm.features import Vocabulary, mixed, word_hashes
from scanlake.operators.ranking import number_rows
from scanlake.session import written

SHINGLE = 5
BANDS, ROWS = 32, 4
PLACES = BANDS * ROWS
SHARE = 75
SMALL_BUCKET = 8
# A block of a bucket holds about so many sets, and shingles, on each side.
BLOCK_SETS, BLOCK_SHINGLES = 512, 500_000
PIECE_CHARS = 1_000_000
UNSET = np.int64(2**62)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _ByteWords(Vocabulary):
    def bytes(self):
        starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)))))
        return np.frombuffer(b"".join(self.words), np.uint8), starts


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text."""
    # On bytes, lower() and split() know the letters A-Z and the six white space characters only.
    words = _ByteWords([t.encode("utf-8", "surrogatepass").lower().split() for t in texts])
    hashes = word_hashes(*words.bytes())[words.numbers] if len(words.numbers) else np.zeros(0, np.uint64)
    n = len(hashes)
    mixed_all = np.zeros(0, np.uint64)
    if n >= SHINGLE:
        total = np.zeros(n - SHINGLE + 1, np.uint64)
        for k in range(SHINGLE):
            total = (total + hashes[k : n - SHINGLE + 1 + k]) * np.uint64(0xD6E8FEB86659FD93)
        mixed_all = mixed(total)
    sets, at = [], 0
    for length in words.lengths.tolist():
        if length >= SHINGLE:
            sets.append(np.unique(mixed_all[at : at + length - SHINGLE + 1]))
        elif length:
            key = np.uint64(length)
            for h in hashes[at : at + length]:
                key = np.uint64((int(key) * 0xD6E8FEB86659FD93 + int(h)) & 0xFFFFFFFFFFFFFFFF)
            sets.append(mixed(np.array([key], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += length
    return sets


def super_minhash(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """One signature per set, values rank * 2^32 + fraction; empty sets keep UNSET."""
    out = np.full((len(sets), places), UNSET)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    if not len(owner):
        return out
    elements = np.concatenate(sets)
    flat = out.reshape(-1)
    state: np.ndarray | None = None
    for j in range(places):
        drawn = mixed(elements + np.uint64((j + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        value = np.int64(j) << np.int64(32) | (drawn & np.uint64(0xFFFFFFFF)).astype(np.int64)
        k = j + ((drawn >> np.uint64(32)) * np.uint64(places - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            place, first = k, k
        else:
            rows = np.arange(len(elements))
            place = state[rows, k].astype(np.int64)
            state[rows, k] = state[:, j]
        np.minimum.at(flat, owner * places + place, value)
        open_sets = (out == UNSET).any(1)
        going = open_sets[owner]
        if not going.any():
            break
        if j == 0:
            state = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (int(going.sum()), 1))
            state[np.arange(len(state)), first[going]] = 0
        elif not going.all():
            state = state[going]
        if not going.all():
            elements, owner = elements[going], owner[going]
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, the band's number included."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key + parts[:, :, k] * np.uint64(0xD6E8FEB86659FD93))
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_ids, texts in pieces(batches, PIECE_CHARS):
        sets = shingle_sets(texts)
        keys = band_keys(super_minhash(sets))
        sizes = np.array([len(s) for s in sets], np.int64)
        halves = [
            np.array([int(mixed(s ^ np.uint64(salt)).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)
            for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)
        ]
        offsets = np.concatenate(([0], np.cumsum(np.where(sizes > 0, BANDS, 0))))
        bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[sizes > 0].ravel(), pa.int64()))
        yield pa.record_batch(
            [pa.array(doc_ids, pa.int64()), pa.array(sizes), pa.array(halves[0]), pa.array(halves[1]), bands],
            names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_ids, texts in pieces(batches, PIECE_CHARS):
        yield pa.record_batch(
            [pa.array(doc_ids, pa.int64()), pa.array([s.tobytes() for s in shingle_sets(texts)], pa.binary())],
            names=["doc_id", "shingles"],
        )


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (batch.column(n).to_pylist() for n in ("x", "y"))
        counts = []
        for p, q in zip(x, y, strict=True):
            u, v = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            counts.append((len(u), len(v), len(np.intersect1d(u, v, assume_unique=True))))
        columns = [pa.array(c, pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * 3
        yield pa.record_batch([batch.column("a"), batch.column("b"), *columns], names=["a", "b", "n_a", "n_b", "both"])


def _outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (batch.column(n).to_pylist() for n in ("x", "y"))
        found = [np.setdiff1d(np.frombuffer(p, np.int64), np.frombuffer(q, np.int64), assume_unique=True) for p, q in zip(x, y, strict=True)]
        rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
        elements = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.record_batch(
            [batch.column("a").take(pa.array(rows)), batch.column("b").take(pa.array(rows)), pa.array(elements)],
            names=["a", "b", "element"],
        )


def _linked(block: pa.Table) -> pa.Table:
    """Similar (a, b) of one block, one row that asks at a time against all that are asked.

    Only links that join components not yet joined here are given, so a block has fewer links than members.
    """
    ids, label, asks = (block.column(n).to_numpy() for n in ("doc_id", "component", "asks"))
    label = label.copy()
    sets = [np.frombuffer(s, np.uint64) for s in block.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets], np.int64)
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(codes, np.cumsum(sizes)[:-1])
    asked = np.flatnonzero(~asks)
    links: list[tuple[int, int]] = []
    if len(asked):
        rows = np.concatenate([codes[j] for j in asked])
        starts = np.concatenate(([0], np.cumsum(sizes[asked])[:-1]))
        flags = np.zeros(int(sizes.sum()), bool)
        for i in np.flatnonzero(asks):
            flags[codes[i]] = True
            both = np.add.reduceat(flags[rows], starts, dtype=np.int64)
            flags[codes[i]] = False
            near = 100 * both >= SHARE * (sizes[i] + sizes[asked] - both)
            while (new := near & (label[asked] != label[i])).any():
                j = asked[new.argmax()]
                links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                label[label == label[j]] = label[i]
    return pa.table({n: pa.array([x[k] for x in links], pa.int64()) for k, n in enumerate("ab")})


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    return (
        pairs.select("a", "b").join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
        .select("a", "b", "x", "y")
    )


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and shingles of the documents in ``ids``; written."""
    rows = id_and_text(docs).join(ids.select(F.col("doc_id").alias("wanted")), F.col("doc_id") == F.col("wanted"), "left_semi")
    return written(rows.mapInArrow(_sets, "doc_id long, shingles binary").dropDuplicates(["doc_id"]), "shingle-sets")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with the sizes of their full sets and of what both have; written."""
    both = _with_sets(pairs.distinct(), sets)
    return written(both.mapInArrow(_compared, "a long, b long, n_a long, n_b long, both long"), "compared")


def similar(pairs: DataFrame) -> DataFrame:
    return pairs.where(f"100 * both >= {SHARE} * (n_a + n_b - both)").select("a", "b")


def rest(members: DataFrame, stars: DataFrame, sets: DataFrame) -> DataFrame:
    """Further links (a, b) between components of one bucket; written.

    ``members``: bucket, doc_id, n_shingles, component, low (the bucket's smallest member) and
    low_component. ``stars``: all pairs (member, low) as compared.
    """
    many = members.groupBy("bucket").agg(F.count("*").alias("many"))
    members = written(members.join(many, "bucket"), "bucket-sizes")
    large = members.where(F.col("many") > SMALL_BUCKET)
    stars = stars.join(large.select(F.col("low").alias("b")).distinct(), "b", "left_semi")
    outside = written(_with_sets(stars, sets).mapInArrow(_outside, "a long, b long, element long"), "outside")
    again = outside.groupBy("b", "element").agg(F.count("*").alias("n")).where("n > 1").select("b", "element")
    again = outside.join(again, ["b", "element"]).groupBy("a", "b").agg(F.count("*").alias("r"))
    reach = stars.join(again, ["a", "b"], "left").select(
        F.col("a").alias("doc_id"), F.col("b").alias("low"),
        # Largest set with which so many common elements reach the similarity.
        F.expr(f"div((100L + {SHARE}) * (both + coalesce(r, 0L)), {SHARE}L) - n_a").alias("reach"),
    )
    large = large.join(reach, ["doc_id", "low"], "left").withColumn(
        "reach", F.when(F.col("doc_id") == F.col("low"), F.expr(f"div(100L * n_shingles, {SHARE}L)")).otherwise(F.col("reach"))
    )
    least = large.groupBy("bucket").agg(F.min("n_shingles").alias("least"))
    large = large.join(least, "bucket").where(f"reach >= least and reach >= div({SHARE}L * n_shingles + 99, 100L)").drop("least")
    small = members.where(F.col("many") <= SMALL_BUCKET)
    names = ["bucket", "doc_id", "n_shingles", "component", "low_component"]
    still = written(large.select(names).unionByName(small.select(names)), "open-members")
    asks = F.expr("component <> low_component")
    blocks = lambda mine: F.ceil(F.greatest(
        F.sum(F.when(mine, F.col("n_shingles"))) / BLOCK_SHINGLES, F.count_if(mine) / BLOCK_SETS)).cast("int")
    split = still.groupBy("bucket").agg(
        F.min("component").alias("c"), F.max("component").alias("d"),
        blocks(asks).alias("rows"), blocks(F.lit(True)).alias("columns"),
    ).where("c < d").select("bucket", "rows", "columns")
    dealt = still.join(split, "bucket")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    of = ["bucket", "doc_id", "component"]
    askers = dealt.where(asks).select(*of, F.lit(True).alias("asks"), own("rows").alias("row"), every("columns").alias("column"))
    asked = dealt.select(*of, F.lit(False).alias("asks"), every("rows").alias("row"), own("columns").alias("column"))
    with_sets = askers.unionByName(asked).join(sets, "doc_id")
    found = with_sets.groupBy("bucket", "row", "column").applyInArrow(_linked, "a long, b long")
    return written(found.distinct(), "more-links")


def components(edges: DataFrame) -> DataFrame:
    """node and component, the smallest node reachable, for every node with an edge (a, b)."""
    spark = edges.sparkSession
    ordered = lambda df: df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = written(ordered(edges), "edges")
    found = spark.createDataFrame([], "node long, component long")
    first = True
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointer = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        pointer = written(pointer, "pointers")
        for _ in range(2):
            further = pointer.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
            pointer = pointer.join(further, "to", "left").select("node", F.coalesce("beyond", "to").alias("to"))
        pointer = written(pointer, "pointers")
        if first:
            found, first = pointer.select("node", F.col("to").alias("component")), False
        else:
            step = pointer.select(F.col("node").alias("component"), "to")
            found = written(
                found.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component")),
                "components",
            )
        left = written(
            ordered(
                left.join(pointer.select(F.col("node").alias("a"), F.col("to").alias("a_to")), "a")
                .join(pointer.select(F.col("node").alias("b"), F.col("to").alias("b_to")), "b")
                .select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
            ),
            "edges",
        )
    return found


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    if not repeated_ids(docs).isEmpty():
        return _groups_of_texts(docs)
    return _groups_of_ids(docs)


def repeated_ids(docs: DataFrame) -> DataFrame:
    """The doc_ids on more than one row."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    return ids.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")


def _numbered(docs: DataFrame) -> DataFrame:
    """number, doc_id and text of each distinct (doc_id, text), numbered in order of doc_id; written."""
    rows = id_and_text(docs).where("doc_id is not null").withColumn("digest", F.sha2(F.encode("text", "UTF-8"), 256))
    rows = rows.dropDuplicates(["doc_id", "digest"]).withColumn("order", F.struct("doc_id", "digest"))
    return written(number_rows(rows, "order", "number").select("number", "doc_id", "digest", "text"), "numbered-texts")


def _groups_of_texts(docs: DataFrame) -> DataFrame:
    """As ``near_groups`` where a doc_id may stand on unlike texts: texts are linked, then the texts of one id."""
    texts = _numbered(docs)
    nameless = id_and_text(docs).where("doc_id is null")
    found = written(
        _groups_of_ids(texts.select(F.col("number").alias("doc_id"), "text").unionByName(nameless))
        .select(F.col("doc_id").alias("number"), "n_shingles", F.col("component_id").alias("low")),
        "text-groups",
    )
    of_low = texts.select(F.col("number").alias("low"), F.col("doc_id").alias("b"))
    linked = written(
        found.join(of_low, "low", "left").join(texts.select("number", F.col("doc_id").alias("a"), "digest"), "number", "left"),
        "text-links",
    )
    groups = components(linked.where("a is not null").select("a", "b"))
    of_b = groups.select(F.col("node").alias("b"), "component")
    component = F.coalesce("component", "b").alias("component")
    rows = id_and_text(docs).where("doc_id is not null").select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"))
    named = linked.where("a is not null").join(of_b, "b", "left").select(F.col("a").alias("doc_id"), "digest", "n_shingles", component)
    named = rows.join(named, ["doc_id", "digest"]).select("doc_id", "n_shingles", "component")
    unnamed = linked.where("a is null").join(of_b, "b", "left").select(F.col("a").alias("doc_id"), "n_shingles", component)
    return _decided(named.unionByName(unnamed))


def _decided(rows: DataFrame) -> DataFrame:
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, component.isNull())
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _groups_of_ids(docs: DataFrame) -> DataFrame:
    """As ``near_groups`` where no doc_id stands on two rows."""
    signed = written(id_and_text(docs).mapInArrow(
        _sign, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"), "signatures")
    key = ["n_shingles", "set_a", "set_b"]
    classes = written(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("class_id")), "classes"
    )
    first = signed.where("n_shingles > 0").select("doc_id", "n_shingles", "bands").join(
        classes.select("class_id").distinct(), F.col("doc_id") == F.col("class_id"), "left_semi"
    )
    placed = first.select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    shared = written(
        placed.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high"),
        "buckets",
    )
    members = written(placed.join(shared, "bucket").drop("high"), "bucket-members")
    sets = full_sets(docs, members.select("doc_id").distinct())
    stars = compared(members.where("low <> doc_id").select(F.col("doc_id").alias("a"), F.col("low").alias("b")), sets)
    found = similar(stars)
    groups = components(found)
    of_low = groups.select(F.col("node").alias("low"), F.col("component").alias("low_component"))
    grouped = (
        members.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").join(of_low, "low", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
        .withColumn("low_component", F.coalesce("low_component", "low"))
    )
    split = grouped.groupBy("bucket").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d")
    grouped = grouped.join(split.select("bucket"), "bucket", "left_semi")
    more = rest(grouped, stars, sets)
    if not more.isEmpty():
        groups = components(found.unionByName(more))
    of_class = classes.join(groups.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        *key, F.coalesce("component", "class_id").alias("component")
    )
    of_class = written(of_class, "class-components")
    return _decided(signed.select("doc_id", *key).join(of_class, key, "left"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of the table that are the smallest of their component; rows without a doc_id stay.

    Where ids repeat, texts are decided by themselves: a text stays unless one like it stays, whatever other
    texts its doc_id stands on. Of rows that repeat doc_id and text, one stays.
    """
    if repeated_ids(docs).isEmpty():
        gone = _groups_of_ids(docs).where("not kept").select(F.col("doc_id").alias("dropped")).distinct()
        return docs.join(gone, F.col("doc_id") == F.col("dropped"), "left_anti")
    texts = _numbered(docs)
    kept = _groups_of_ids(texts.select(F.col("number").alias("doc_id"), "text")).where("kept")
    kept = texts.join(kept.select(F.col("doc_id").alias("number")), "number", "left_semi").select("doc_id", "digest")
    rows = docs.withColumn("__digest", F.sha2(F.encode(whole_text(), "UTF-8"), 256))
    name = [F.col("doc_id") == F.col("__id"), F.col("__digest") == F.col("__own")]
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__own"))
    stay = rows.where("doc_id is not null").join(kept, name, "left_semi").dropDuplicates(["doc_id", "__digest"])
    return stay.unionByName(rows.where("doc_id is null")).select(*docs.columns)
