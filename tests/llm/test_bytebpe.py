"""Ids and texts against the library for rank files."""

import base64
import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from headway.llm import bytebpe

LINES = bytebpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
RANKS = bytebpe.parse_ranks(LINES)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER, DECODER = bytebpe.coder(LINES, public_tokenizers.PATTERN)
HARD = [
    "", " ", "   a", "a  b   c    ", "\n\n\ta", "<|endoftext|>", "日本語のテキスト 🙂👍🏽", "é", "\x00a\x00", "﻿ x", "�", "x" * 3000,
    "ab" * 900, " " * 900, "\xa0 \xa0 a", "\r\n", "1234567890" * 90, "aaaaab" * 400, "I'll don't they've 's 'S", "\x1c\x1d a\x85b", "ǅǈ߷㐀", "=" * 777 + "-" * 555,
]


def ids_of(encoder, text):
    return np.frombuffer(b"".join(encoder.encode(text)), "<u4").tolist()


def assert_same(text):
    ids = ids_of(ENCODER, text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert DECODER.decode(np.array(ids, "<u4").tobytes()) == text.encode()


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    assert_same(text)


def test_random_texts():
    rng = random.Random(0)
    letters = list(" abcdeththeingtion\n\té🙂ß日本.,1234567890'") + ["tion", "  ", "der"]
    for _ in range(4000):
        assert_same("".join(rng.choices(letters, k=rng.randint(1, 50))))


def test_pieces_of_any_bytes_encode_as_by_merging():
    rng = random.Random(1)
    tokens = list(RANKS)
    for _ in range(3000):
        piece = b"".join(rng.choices(tokens, k=rng.randint(1, 5))) + bytes(rng.choices(range(256), k=rng.randint(0, 4)))
        expected = [RANKS[piece]] if piece in RANKS else ENCODER.merger.merged(piece)
        assert list(ENCODER.encode_piece(piece)) == expected


def small_vocabulary(rng, shuffled):
    """All bytes and some tokens over three letters, each made of two that are there; in the order they were made, or in any."""
    tokens = [bytes([b]) for b in range(256)]
    parts = [b"a", b"b", b"c"]
    for _ in range(rng.randint(1, 25)):
        new = rng.choice(parts) + rng.choice(parts)
        if new not in tokens and len(new) < 10:
            tokens.append(new)
            parts.append(new)
    if shuffled:
        rng.shuffle(tokens)
    return {t: i for i, t in enumerate(tokens)}


def test_small_vocabularies_backtrack_like_the_library(monkeypatch):
    """Among them are tokens that merging never makes, ties between places and dead ends."""
    rng = random.Random(2)
    monkeypatch.setattr(bytebpe, "BLOCK", 16)
    orders = set()
    for n in range(200):
        ranks = small_vocabulary(rng, n % 4 == 3)
        encoder = bytebpe.Encoder(ranks, r"[a-z]+|[^a-z]+")
        orders.add(encoder.in_order)
        library = tiktoken.Encoding("t", pat_str=r"[a-z]+|[^a-z]+", mergeable_ranks=ranks, special_tokens={})
        for _ in range(20):
            text = "".join(rng.choices("abc", k=rng.randint(1, 60)))
            assert ids_of(encoder, text) == library.encode_ordinary(text), (ranks, text)
    assert orders == {True, False}


def test_sample_documents():
    for (text,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall():
        assert_same(text)


def test_stretches_of_long_texts(monkeypatch):
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices("ab  \n\t.'s1é\x1c\x85", k=rng.randint(0, 200)))
        cut = list(bytebpe.stretches(text, 7))
        assert "".join(cut) == text
        assert sum((LIBRARY.encode_ordinary(s) for s in cut), []) == LIBRARY.encode_ordinary(text)
    unbroken = "日" * 20_000 + "ab" * 40_000
    assert list(bytebpe.stretches(unbroken, 7)) == [unbroken]
    assert_same(unbroken)


def test_pairs_fit_as_merging_says():
    rng = random.Random(4)
    ids = [i for t, i in RANKS.items() if ENCODER.merger.merged(t) == [i]]
    assert ENCODER.in_order
    for a, b in zip(rng.choices(ids, k=3000), rng.choices(ids, k=3000)):
        assert ENCODER.fits(a, b) == (ENCODER.merger.merged(ENCODER.token[a] + ENCODER.token[b]) == [a, b])


def test_rows(spark):
    rows = [(1, "ein Text", "x"), (1, "ein Text", "y"), (None, None, "z"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("n_tokens", F.lit(9))
    got = {(r.doc_id, tuple(r.ids), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bytebpe.encode(docs, LINES, public_tokenizers.PATTERN).collect()}
    ids, none = LIBRARY.encode_ordinary("ein Text"), hashlib.sha256(b"").hexdigest()
    digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert got == {(1, tuple(ids), len(ids), digest, hashlib.sha256(b"ein Text").hexdigest()), (None, (), 0, none, none), (3, (), 0, none, none)}
    assert bytebpe.encode(docs, LINES, public_tokenizers.PATTERN).count() == 4
    assert bytebpe.encode(docs.where("false"), LINES, public_tokenizers.PATTERN).count() == 0


def test_decoded_texts(spark):
    docs = spark.createDataFrame([(1, "naïve 日本 text"), (2, None), (3, "")], "doc_id long, text string")
    coded = bytebpe.encode(docs, LINES, public_tokenizers.PATTERN)
    assert {r.doc_id: r.t for r in coded.select("doc_id", bytebpe.decode(F.col("ids"), LINES).alias("t")).collect()} == {1: "naïve 日本 text", 2: "", 3: ""}
    assert spark.range(1).select(bytebpe.decode(F.lit(None).cast("array<int>"), LINES).alias("t")).first().t is None


def test_query(spark):
    from headway.llm.queries import QUERIES

    texts = dict(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())
    rows = QUERIES["op11_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode_bytes(ids)).hexdigest()


def test_bad_rank_files():
    with pytest.raises(ValueError, match="single bytes"):
        bytebpe.Merger({b"a": 0})
    assert bytebpe.parse_ranks(base64.b64encode(b"a") + b" 0\n\n") == {b"a": 0}
