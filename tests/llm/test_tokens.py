import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waypost.llm.packing import cuts, pack_documents, write_buckets
from waypost.llm.token_counts import token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, n_tokens string, ids string"


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    bits = ["the", "Thing", "don't", " ", " ", " ", "  ", "\n", "\n ", " \n", "\t", "é", "é", "漢字", "123", "!!", "<|endoftext|>",
            "<|startoftext|>", " ", " ", "\x1c", "\x85", "İ", "'ll", "😀", "_", "\r\n", "Σας"]
    made = ["".join(r.choice(bits) for _ in range(r.choice([0, 1, 2, 5, 20, 300]))) for _ in range(700)]
    return made + ["", None, " ", "   ", "x" * 30_000, "a   ", "   a", "word " * 9000, "word " * 9000]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], SCHEMA)


def test_counts_equal_the_library(spark, texts, tmp_path):
    tokenizer = Tokenizer.from_file(BYTES)
    docs = frame(spark, texts)
    for _ in range(2):  # the second run finds everything in the cache
        got = {r.doc_id: r for r in token_counts(docs, BYTES, str(tmp_path / "cache")).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
            assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 512), repr(t)[:200]


def test_only_misses_are_encoded(spark, tmp_path):
    cache = str(tmp_path / "cache")
    first = spark.createDataFrame([(1, "a b"), (2, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(map(tuple, token_counts(first, BYTES, cache).select("n_tokens").collect())) == [(0,), (2,), (2,)]
    stored = spark.read.parquet(cache)
    assert stored.count() == 2
    token_counts(first.union(spark.createDataFrame([(3, "c")], "doc_id long, text string")), BYTES, cache).collect()
    assert spark.read.parquet(cache).count() == 3
    assert token_counts(first.limit(0), BYTES, cache).collect() == []


def test_pieces_hold_every_id_once(spark, texts, tmp_path):
    tokenizer = Tokenizer.from_file(WORDS)
    packed = pack_documents(frame(spark, texts), WORDS)
    rows = packed.collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    by_doc = {}
    for r in rows:
        assert r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0 and len(r.ids) == 4 * r.length
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        data = b"".join(x.to_bytes(4, "little") for x in ids)
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert b"".join(p.ids for p in pieces) == data, repr(t)[:200]
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert {p.doc_tokens for p in pieces} == {len(ids)}
    crc = {(r.doc_id, r.start): r.c for r in packed.select("doc_id", "start", F.crc32("ids").alias("c")).collect()}
    assert all(crc[r.doc_id, r.start] == zlib.crc32(r.ids) for r in rows)
    write_buckets(packed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_cuts_and_edges(spark):
    assert cuts(0) == [] and cuts(1) == [1] and cuts(2048) == [2048] and cuts(4101) == [2048, 2048, 4, 1]
    docs = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert [(r.doc_id, r.length) for r in pack_documents(docs, WORDS).collect()] == [(None, 1)] * 2
    assert pack_documents(docs.limit(0), WORDS).collect() == []
    with pytest.raises(ValueError):
        pack_documents(docs, WORDS, longest=1000)
