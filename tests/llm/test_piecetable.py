"""Ids and texts against the library that owns the vocabulary."""

import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from headway.llm import piecetable, viterbi

MODEL = piecetable.read_model(public_tokenizers.path("piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ENCODER, DECODER = piecetable.coder(MODEL)
HARD = [
    "", " ", "  ", "   a", "a  b   c    ", "\n\n\ta▁b", "▁", "▁▁ ▁ x", "</s><s>[INST] <0x0A>", "日本語のテキスト 🙂👍🏽", "é", "\x00a\x00", "﻿ x",
    "�", " a ", "x" * 3000, "ab" * 900, " " * 300, "\xa0 \xa0", "߷㐀", "\r\n", "1234567890" * 9, "the " * 50, "aaaaab" * 40,
]


def assert_same(text):
    ids = np.frombuffer(ENCODER.encode(text), "<u4")
    assert ids.tolist() == LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert DECODER.decode(ids.tobytes()).decode() == LIBRARY.decode(ids.tolist())


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    assert_same(text)


def test_memory_may_be_forgotten():
    small, _ = piecetable.coder(MODEL, 4)
    rng = random.Random(3)
    words = ["the", "quick", "日本語", "x" * 70, "été", "", "fox"]
    for _ in range(300):
        text = " ".join(rng.choices(words, k=rng.randint(0, 9)))
        assert small.encode(text) == ENCODER.encode(text)
        assert max(len(small.word), len(small.word.older)) <= 4 and max(len(small.part), len(small.part.older)) <= 2


def test_random_texts():
    rng = random.Random(0)
    letters = list(" ▁abcdeththeingtion\né🙂ß日本\t.,1234567890")
    for _ in range(3000):
        assert_same("".join(rng.choices(letters, k=rng.randint(1, 40))))


def test_sample_documents():
    for (text,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall():
        assert_same(text)


def test_any_ids_decode_alike():
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000), 1, 2, 0]) for _ in range(rng.randint(1, 9))]
        assert DECODER.decode(np.array(ids, "<u4").tobytes()).decode() == LIBRARY.decode(ids), ids


def test_merging_one_by_one_gives_the_same():
    rng = random.Random(4)
    for _ in range(500):
        part = "▁" + "".join(rng.choices("abcdeioux", k=rng.randint(1, 20)))
        assert ENCODER.encode_part(part) == [ENCODER.words.ids[p] for p in ENCODER.words.merged(part)]


def test_frame(spark):
    rows = [(1, "Some text", "x"), (1, "Some text", "x"), (2, None, None), (None, "", "y"), (3, "lang " * 20000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, made string")
    out = piecetable.encode(docs, MODEL)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in out.collect())
    want = sorted((i is None, i or 0, LIBRARY.encode(t or "", add_bos=True, add_eos=True)) for i, t, _ in rows)
    assert got == want
    back = out.select("doc_id", piecetable.decode(F.col("ids"), MODEL).alias("back")).where("doc_id = 1").first()
    assert back.back == "Some text"
    assert piecetable.encode(docs.limit(0), MODEL).count() == 0


def test_unigram_counts_equal_the_library():
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = viterbi.unigram_vocabulary(MODEL)
    special = sum(score == 0.0 for _, score in vocabulary)
    counter = viterbi.Counter(vocabulary, special)
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace()
    rng = random.Random(1)
    letters = list(" ▁abcdeththeingtion\né🙂ß日本\t.,1234567890\x00\x01☃")
    texts = [t for t in HARD if "<s>" not in t] + ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(2000)]
    for text in texts:
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_unigram_ties_take_the_longest_last_piece():
    counter = viterbi.Counter([("<unk>", 0.0), ("a", -1.0), ("aa", -2.0), ("▁", -1.0)], 1)
    assert counter.count_word("▁aaa") == 3  # ▁ a aa: of equal scores the longest last piece, not four pieces


def test_unigram_frame(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "x" * 5000)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in viterbi.token_counts(docs, MODEL).collect()}
    assert got[1] == got[2] == 0 and got[None] > 1 and got[3] > 0
    assert viterbi.token_counts(docs.limit(0), MODEL).count() == 0
