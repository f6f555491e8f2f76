"""Token files against the tokenizers library, exact round trips and damaged files."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from spokecast.llm import rangecoder, token_files
from spokecast.llm.registered import QUERIES, vocabulary
from spokecast.session import scratch_path

WORDS, BYTES = (vocabulary(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def library(path, rows, end=2):
    """Per row in order of the key: key, start, ids."""
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    out, start = [], 0
    for key, text in rows:
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, end]
        out.append((key, start, ids))
        start += len(ids)
    return out


def written(spark, docs, path=WORDS, **more):
    at = scratch_path(spark, "token-files")
    token_files.write(docs, path, at, **more)
    return at


def back(spark, at):
    rows = token_files.read(spark, at).collect()
    assert all(r.n_tokens == len(r.ids) // 4 for r in rows)
    return sorted(((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows), key=lambda r: r[1])


def test_query_against_the_library(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    want = {(k, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, s, ids in library(WORDS, rows)}
    got = QUERIES["op12_token_files"](spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_texts_of_all_kinds(spark, path):
    rnd = random.Random(4)
    parts = [*"aAbéÉßÑ .,;:!?'\t\n\x0b\x1c\x85  　²½٣1２é中🎉#-", "é", "́", "'ll", "'S", "İ", "ς", "Σ", "K", "Ǆ", "ŉ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "the ", "word.", "été, "]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))) for i in range(600)]
    assert back(spark, written(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), path)) == library(path, rows)


def test_odd_rows(spark):
    rows = [(None, "b"), (None, None), (3, "x y"), (3, "x y"), (3, ""), (-5, "long words " * 200_000), (7, None), (8, "tail")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", F.lit("z").alias("TEXT"), F.lit(1).alias("part"), F.lit(2).alias("id"))
    got = back(spark, written(spark, docs, end_id=40))
    assert [r[0] for r in got] == [None, None, -5, 3, 3, 3, 7, 8]
    assert [r[1] for r in got] == np.cumsum([0, *(len(r[2]) for r in got[:-1])]).tolist()
    assert sorted(map(repr, ((k, ids) for k, _, ids in got))) == sorted(map(repr, ((k, ids) for k, _, ids in library(WORDS, rows, 40))))
    assert back(spark, written(spark, docs.where("false"))) == []
    names = spark.createDataFrame([("b", "one"), ("a", "two")], "doc_id string, text string")
    assert [r[0] for r in back(spark, written(spark, names))] == ["a", "b"]
    with pytest.raises(ValueError):
        written(spark, docs, end_id=rangecoder.TOP_ID)


def test_one_key_is_dealt_to_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    docs = spark.range(4000).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit("same text").alias("text"))
    at = written(spark, docs)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(at).groupBy("part").agg(F.sum(F.size("keys")).alias("n")).agg(F.max("n")).first()[0] < 2500
    assert [r[1] for r in back(spark, at)] == list(range(0, 12000, 3))


@pytest.mark.parametrize("lanes", [3, 4096])
def test_blocks_round_trip(monkeypatch, lanes):
    monkeypatch.setattr(rangecoder, "LANES", lanes)
    rnd = np.random.default_rng(lanes)
    lengths = (0, 1, 2047, 2048, 2049, 9000)
    kinds = [
        [rnd.integers(0, 49408, n) for n in lengths],
        [rnd.geometric(0.01, n) for n in lengths],
        [np.zeros(n, int) for n in lengths],
        [np.tile([262143, 0, 1], n // 3 + 1)[:n] for n in lengths],
        [np.arange(n) * 29 for n in lengths],
    ]
    for rows in kinds:
        rows = [r.astype(np.int32) for r in rows]
        high = max(int(r.max()) >> 8 for r in rows if len(r)) + 1
        again = rangecoder.unpack_frames(rangecoder.pack_frames(rows, high))
        assert all(np.array_equal(a, b) for a, b in zip(rows, again, strict=True))
    assert rangecoder.unpack_frames([]) == []


def test_repeats_compress_and_blocks_stand_alone():
    ids = np.random.default_rng(1).integers(0, 49408, 100).astype(np.int32)
    once, often = (rangecoder.pack_frames([np.tile(ids, n)], 193)[0] for n in (1, 20))
    assert len(often) < 4 * len(once)
    two = rangecoder.pack_frames([ids, np.tile(ids, 20)], 193)
    assert two == [once, often]


def test_damage_is_found(spark):
    frame = rangecoder.pack_frames([np.arange(5000, dtype=np.int32)], 20)[0]
    rnd = random.Random(2)
    for at in [0, 5, 9, 20, *rnd.sample(range(len(frame)), 40)]:
        bad = bytearray(frame)
        bad[at] ^= 1 << rnd.randrange(8)
        try:
            got = rangecoder.unpack_frames([bytes(bad)])[0]
        except ValueError:
            continue
        assert np.array_equal(got, np.arange(5000)), at  # bits that end a block may not matter
    for n in (0, 3, 11, 40, len(frame) - 1):
        with pytest.raises(ValueError):
            rangecoder.unpack_frames([frame[:n]])
    at = written(spark, spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string"))
    other = scratch_path(spark, "damaged")
    spark.read.parquet(at).withColumn("blocks", F.expr("overlay(blocks PLACING X'0102' FROM 30 FOR 2)")).write.parquet(other)
    with pytest.raises(PythonException):
        token_files.read(spark, other).collect()


def tokens(path=WORDS):
    with open(path, encoding="utf-8") as f:
        return token_files.Tokens(f.read())


def listed(tool, texts):
    ids, sizes = tool.encode([t.encode() for t in texts])
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_plain_words_pass_no_step_that_leaves_them_alone():
    tool, texts = tokens(), ["The word, été;### 12 word!!", "", "words (naïve) a_b <|x|> 7", "!? ÿ"]
    assert tool.by_word
    tool.tool = None
    assert listed(tool, texts) == [ids[:-1] for _, _, ids in library(WORDS, list(enumerate(texts)))]


def test_pieces_of_all_sizes_and_tables_that_grow_and_are_emptied(monkeypatch):
    monkeypatch.setattr(token_files, "PIECES_KEPT", 40_000)
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdeéàÿß") for _ in range(rnd.randint(1, 30)))
    odd = ["don't", "É", "x<|endoftext|>y", "Abc", "<|STARTOFTEXT|>", "a\x00b", "1²3", "«mot»", "÷", "`'s"]
    tool = tokens()
    for _ in range(4):
        texts = [" ".join(rnd.choice(odd) if rnd.random() < 0.02 else word() + rnd.choice(["", ",", "...", "42", "###"]) for _ in range(3000)) for _ in range(9)]
        texts += ["Abc word", "", " ", "a" * 16, "a" * 17]
        assert listed(tool, texts) == [ids[:-1] for _, _, ids in library(WORDS, list(enumerate(texts)))]
    assert tool.pieces.used < 80_000
    monkeypatch.setattr(tool, "last", np.zeros_like(tool.last))  # ends that do not tell pieces apart
    tool._forget()
    assert listed(tool, texts) == [ids[:-1] for _, _, ids in library(WORDS, list(enumerate(texts)))]


def test_pieces_that_meet_in_a_slot():
    rnd = np.random.default_rng(3)
    keys = rnd.integers(1, 1 << 63, (5000, 2)).astype(np.uint64)
    table = token_files.Pieces(bits=4)
    for part in np.split(np.arange(5000), [3, 7, 9, 400]):
        assert (table.find(*keys[part].T) == -1).all()
        table.add(*keys[part].T, part)
        assert np.array_equal(table.find(*keys[: part[-1] + 1].T), np.arange(part[-1] + 1))
    assert table.used == 5000 and (table.value >= 0).sum() == 5000


def test_blocks_modelled_at_a_time_are_what_the_decoder_follows(monkeypatch):
    rnd = np.random.default_rng(5)
    rows = [(rnd.zipf(1.3, n) % 49408).astype(np.int32) for n in (*range(0, 2100, 300), 2048, 33, 32, 129, 1153)]
    frames = rangecoder.pack_frames(rows, 193)
    monkeypatch.setattr(rangecoder, "MODELLED", 2)
    assert rangecoder.pack_frames(rows, 193) == frames
    again = rangecoder.unpack_frames(frames)
    assert all(np.array_equal(a, b) for a, b in zip(rows, again, strict=True))
