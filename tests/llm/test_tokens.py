"""Piece encoding and token records, held against the libraries themselves."""

import random
import struct
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelloom.llm import pieces, records
from panelloom.llm.catalog import QUERIES, tokenizer_path

DIR = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n", "a  b", "  a b ", "a\tb\nc", "x" * 3000, " " * 37, "▁x▁", "ﬁ ①", "é É ÿ÷×", "日本語 😀",
    "it's don't .'s ''t 'LL", "<|startoftext|>a<|endoftext|>", "<|STARTOFTEXT|>", "<s>a</s><0x41>", "a\x1cb\x85c\xa0d", "\x00a",
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces.load(tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def definition():
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def rows_of(spark, texts):
    rows = [(i, t, "x", t) for i, t in enumerate(texts)] + [(3, "again", "x", None), (3, "again", "x", None), (None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens string")


def random_texts(count, alphabet, longest, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def test_pieces_match_the_library(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = [t or "" for t in ODD] + random_texts(800, "ab  \n▁éthersion.日́😀0_<>", 60) + random_texts(2, "etaoinsh", 4000)
    # A slice in the middle of an array: offsets that do not begin at zero.
    ids = vocabulary.encode(pa.array(["lead", *texts]).slice(1))
    assert ids.to_pylist() == model.encode(texts)
    assert vocabulary.decode(ids) == [model.decode(i) for i in model.encode(texts)]
    broken = [[vocabulary.byte + b for b in b"\xe2\x82A\xff"], [], [0, 1, 2]]
    assert vocabulary.decode(pa.array(broken, pa.list_(pa.int32())))[:2] == [model.decode(broken[0]), ""]


def test_round_trip_query(spark, vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    docs = rows_of(spark, ODD)
    got = sorted(map(tuple, pieces.round_trip(docs, vocabulary).collect()), key=str)
    want = []
    for r in docs.collect():
        ids = model.encode(r["text"] or "")
        digest = [sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), model.decode(ids))]
        want.append((r["doc_id"], len(ids), *digest))
    assert got == sorted(want, key=str)
    encoded = pieces.encode(docs, vocabulary)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, vocabulary).collect()}
    assert back[4] == "a  b"
    assert pieces.round_trip(docs.limit(0), vocabulary).count() == 0


def test_word_encoder_matches_the_library(definition):
    from tokenizers import Tokenizer

    full = Tokenizer.from_str(definition)
    texts = [t or "" for t in ODD] + random_texts(1500, "ab  \n\t\r\x0b\x1c\x85\xa0's't'll.,|!$$1239ȩ́́Éßİ日😀_<>|S'D​", 40)
    got = records.WordEncoder(definition).encode(pa.array(["lead", *texts]).slice(1))
    assert [g.tolist() for g in got] == [full.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("bound", [16 << 20, 4000, 1])
def test_words_stay_known_from_chunk_to_chunk(definition, monkeypatch, bound):
    from tokenizers import Tokenizer

    monkeypatch.setattr(records, "KNOWN_BYTES", bound)
    full, encoder, asked, held = Tokenizer.from_str(definition), records.WordEncoder(definition), [], []
    encode_words = encoder.word_ids
    encoder.word_ids = lambda words: (asked.append(len(words)), encode_words(words))[1]
    common = random_texts(40, "abé", 6, seed=1)
    for seed in range(6):
        rare = random_texts(20, "abcé1.😀", 12, seed=10 + seed) + (["z" * 9000] if seed == 3 else [])
        texts = [" ".join([*common, *rare]), "", *rare, " ".join(common)]
        got = encoder.encode(pa.array(texts))
        assert [g.tolist() for g in got] == [full.encode(t, add_special_tokens=False).ids for t in texts]
        held.append(encoder.known.nbytes + encoder.lists.nbytes)
        if bound == 1:
            assert encoder.known.get_total_buffer_size() + encoder.lists.get_total_buffer_size() < 100
    assert max(held) <= bound
    if bound > 1:
        assert max(asked[1:3]) < asked[0]  # common words are not encoded again
        asked.clear()
        encoder.encode(pa.array([" ".join(rare)]))
        assert not asked


def plain_records(docs, definition):
    from tokenizers import Tokenizer

    full = Tokenizer.from_str(definition)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, out = 0, []
    for doc_id, text in rows:
        ids = full.encode(text, add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_records_come_back(spark, definition, tmp_path):
    docs = rows_of(spark, ODD)
    got = sorted(map(tuple, records.write_and_read(docs, definition, 2, str(tmp_path / "r")).collect()), key=lambda r: r[1])
    assert got == plain_records(docs, definition)
    index = spark.read.parquet(str(tmp_path / "r/index"))
    some = index.where(F.col("doc_id").isin(4, 9))
    back = {r["doc_id"]: r["ids"] for r in records.read_records(spark, str(tmp_path / "r/data"), some).collect()}
    assert set(back) == {4, 9} and back[4][-1] == 2
    empty = records.write_and_read(docs.limit(0), definition, 2, str(tmp_path / "e"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_record_query_over_the_table(spark, definition):
    got = sorted(map(tuple, QUERIES["op8_token_records"](spark, DIR).collect()))
    assert got == plain_records(spark.read.parquet(f"{DIR}/documents.parquet"), definition)


def test_damage_is_seen():
    whole = records.frame(7, np.array([1, 2, 300]), 2) + b"\n"
    assert [(a, d, ids.tolist()) for a, _, d, ids in records.frames(whole)] == [(0, 7, [1, 2, 300])]
    for at in (0, 10, len(whole) - 7, len(whole) - 1):
        broken = bytearray(whole)
        broken[at] ^= 1
        with pytest.raises((ValueError, struct.error)):
            list(records.frames(bytes(broken)))


def test_no_file_is_large_whatever_the_ids(spark, definition):
    """A third of all rows under one id, some with the same text, and very long texts in a row of ids."""
    rng = random.Random(8)
    words = lambda n: " ".join(rng.choice(["one", "two", "Three", "4"]) for _ in range(n))
    rows = [(7, words(60)) for _ in range(100)] + [(7, "same text " * 20)] * 100 + [(i, words(40)) for i in range(300)]
    rows += [(1000 + i, words(3000)) for i in range(20)] + [(None, words(10))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path, limit = records.scratch_path(spark, "records"), 16_000
    records.write_records(docs, definition, 2, path, file_bytes=limit)
    index = records.read_index(spark, path)
    sizes = {r["file"]: r["size"] for r in index.groupBy("file").agg(F.sum("length").alias("size")).collect()}
    assert len(sizes) > 10 and max(sizes.values()) < 2 * limit
    assert index.where("doc_id = 7").select("file").distinct().count() > 1
    listed = [r["doc_id"] for r in index.orderBy("file", "position").select("doc_id").collect()]
    assert listed == sorted(listed, key=lambda i: (i is not None, i or 0)) and len(listed) == len(rows)
    counts = records.with_starts(index).orderBy("file", "position").select("start", "n_tokens").collect()
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(counts, counts[1:]))
