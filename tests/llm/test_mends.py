"""Repeated ids, long words, foreign labels and files of many tasks."""

import inspect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from scanlake.llm import (
    bpe, exact_dedup, near_dedup, packing, quality_grade, queries, suffix_dedup, token_files, tokenizing, toxicity,
)
from scanlake.llm.common import documents

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over a lazy dog and then it sleeps under that old tree until morning comes"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_a_text_without_a_copy_stays_whatever_its_id(spark):
    rows = [(3, "A a a"), (5, "A a a"), (5, "B b unlike")]
    for stage in (exact_dedup.one_of_each, near_dedup.one_of_each):
        assert kept(stage(table(spark, rows))) == [(3, "A a a"), (5, "B b unlike")]
    # Rows repeated in full are one; rows without an id stay.
    rows += [(7, LONG), (7, LONG), (8, LONG + " again"), (9, LONG + "\n again"), (None, "A a a"), (None, None)]
    assert kept(exact_dedup.one_of_each(table(spark, rows))) == sorted(
        [(3, "A a a"), (5, "B b unlike"), (7, LONG), (8, LONG + " again"), (None, "A a a"), (None, None)], key=str)
    assert kept(near_dedup.one_of_each(table(spark, rows))) == sorted(
        [(3, "A a a"), (5, "B b unlike"), (7, LONG), (None, "A a a"), (None, None)], key=str)


def test_extra_columns_and_types_stay(spark):
    docs = table(spark, [(1, "x y"), (1, "x y"), (2, "z")]).withColumn("kept", F.lit("k")).withColumn("m", F.create_map(F.lit(1), F.lit(2)))
    for stage in (exact_dedup.one_of_each, near_dedup.one_of_each):
        found = stage(docs)
        assert found.columns == docs.columns and [r.doc_id for r in found.orderBy("doc_id").collect()] == [1, 2]


def test_links_of_every_text_of_an_id(spark):
    other = " ".join(f"w{n}" for n in range(40))
    rows = [(5, LONG), (5, other), (3, other + " end"), (9, LONG + " end"), (6, "alone"), (6, "alone"), (None, other), (None, "none")]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_groups(table(spark, rows)).collect()}
    assert got == {
        (5, 16): (3, False), (5, 36): (3, False), (3, 37): (3, True), (9, 17): (3, False), (6, 1): (6, True),
        (None, 36): (3, False), (None, 1): (None, True),
    }
    plain = near_dedup.near_groups(table(spark, [r for r in rows if r[0] in (3, 9, None)]))
    assert {(r.doc_id, r.component_id, r.kept) for r in plain.collect()} == {
        (3, 3, True), (9, 9, True), (None, None, True)}


def test_the_pipeline_on_repeated_ids_and_on_nothing(spark, tmp_path):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    for name, rows in (("few", [(3, "A a a"), (5, "A a a"), (5, "B b unlike"), (None, None)]), ("none", [])):
        table(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.limit(0).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert found.groupBy("doc_id").count().count() == (3 if rows else 0)


def test_long_words_are_merged_in_time(spark):
    draw = random.Random(1)
    word = "".join(draw.choices("abcdefghijklmnop", k=1_000_000))
    plain = Tokenizer.from_file(queries.WORD_BPE)
    plain.no_truncation()
    want = plain.encode(word[:30_000], add_special_tokens=False).ids
    own = bpe.SpeculativeBpe(queries.WORD_BPE)
    assert own.encode([word[:30_000]])[0].tolist() == want
    ids, lengths = own.encode([word])
    assert len(ids) == lengths[0] and own.decode(ids).replace(" ", "").replace("</w>", "") == word
    assert tokenizing.WordLevelEncoder(queries.WORD_BPE).encode([word])[0].tolist() == ids.tolist()
    # A table that one text has filled is emptied before the next one.
    own.known.chars = tokenizing.KNOWN_CHARS + 1
    own.encode(["next"])
    assert len(own.known) == 1


def test_merging_is_the_library_s(spark):
    draw = random.Random(2)
    plain = Tokenizer.from_file(queries.WORD_BPE)
    own = bpe.SpeculativeBpe(queries.WORD_BPE)
    for k in (1, 2, 3, 5, 8, 40, 400):
        for letters in ("ab", "aaab", "etaoinsh", "日本語a"):
            word = "".join(draw.choices(letters, k=k))
            parts = [own.vocab[c] for c in word.encode().decode("latin-1").translate(own.letters)]
            last = own.vocab[word.encode().decode("latin-1").translate(own.letters)[-1] + own.suffix]
            assert own.merged([*parts[:-1], last]) == plain.encode(word, add_special_tokens=False).ids


@pytest.mark.parametrize("encoder", [
    tokenizing.ByteLevelEncoder(queries.BYTE_BPE), tokenizing.WordLevelEncoder(queries.WORD_BPE)])
def test_joined_pieces_are_encoded_as_single_ones(encoder):
    pieces = ["a", " <", "<", "|>", " the", "ÉTÉ", "\n", " x" * 90, "日本", "<<", ">", "''", " ", "\x00"] * 40
    ids, lengths = encoder.encode_parts(pieces)
    single = [encoder.library.encode(p, add_special_tokens=False).ids for p in pieces]
    assert ids.tolist() == [i for own in single for i in own] and lengths.tolist() == [len(own) for own in single]
    marked = [*pieces, "a<|endoftext|>b", "<|"]
    single = [encoder.library.encode(p, add_special_tokens=False).ids for p in marked]
    assert encoder.encode_parts(marked)[0].tolist() == [i for own in single for i in own]


def test_foreign_labels_do_not_use_up_the_samples(spark):
    docs = documents(spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic")
    outside = spark.range(10**9, 10**9 + 200_000).selectExpr("id as doc_id", "1 as quality", "cast(id % 2 as int) as toxic")
    more = labels.unionByName(outside)
    assert toxicity.labelled_sample(docs, labels)[0] == toxicity.labelled_sample(docs, more)[0]
    grade = F.col("quality")
    assert quality_grade.rated_sample(docs, labels, grade)[0] == quality_grade.rated_sample(docs, more, grade)[0]


def test_offsets_come_from_select(spark):
    docs = documents(spark, SMALL)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = token_files.write_token_files(docs, queries.BYTE_BPE, 2, token_files.new_folder(spark, "files"))
    assert ".all()" not in inspect.getsource(token_files.read_token_files)
    found = token_files.read_token_files(manifest)
    files = manifest.count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # Spark would join rows this short into one task if the exchange had no number.
    assert files == 4 and found.rdd.getNumPartitions() == files
    rows = found.orderBy("start").collect()
    plain = Tokenizer.from_file(queries.BYTE_BPE)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert [r.doc_id for r in rows] == sorted(texts)
    assert [r.n_tokens for r in rows] == [len(plain.encode(texts[r.doc_id], add_special_tokens=False).ids) + 1 for r in rows]


def test_select_range_equals_the_list():
    draw = np.random.default_rng(1)
    for count, top in ((1, 1), (5, 3), (2000, 10**4), (3000, 10**9), (700, 2)):
        numbers = np.sort(draw.integers(0, top, count))
        numbers[count // 2 :] += 10 * top
        known = token_files.EliasFano.encode(numbers, int(numbers[-1]) + 1)
        for _ in range(30):
            a, b = sorted(draw.integers(0, count + 1, 2).tolist())
            assert known.select_range(a, b).tolist() == numbers[a:b].tolist()
        assert [known.select(i) for i in range(0, count, 97)] == numbers[::97].tolist()


def test_rows_without_an_id_and_no_rows_in_every_query(spark, tmp_path):
    texts = [(None, LONG), (None, None), (1, LONG), (2, ""), (3, 'password = "abcdefgh12"')]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    for name, rows in (("nameless", texts), ("empty", [])):
        sf = f"{tmp_path}/{name}"
        table(spark, rows).write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        for query, run in queries.queries().items():
            got = run(spark, sf)
            if query.startswith("op11"):
                assert got.count() == 0
                continue
            ids = [r.doc_id for r in got.select("doc_id").collect()]
            if query.startswith("op7"):  # the last window is cut into powers of two
                ids = [r.doc_id for r in got.where("start = 0").collect()]
            assert sorted(ids, key=str) == sorted([d for d, _ in rows], key=str), query
