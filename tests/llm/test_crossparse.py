"""Phrases of a cross parse against brute force, and languages of held-out documents."""

import random

import pytest
from pyspark.sql import functions as F

from headway.llm import crossparse


def test_phrases_are_the_longest_matches():
    words = ["abcab", "cabd", "xaba", "abcab", "é"]
    automaton = crossparse.SuffixAutomaton(words)
    known = {f" {w} "[i:j] for w in words for i in range(len(w) + 2) for j in range(i + 1, len(w) + 3)}
    rng = random.Random(0)
    for _ in range(3000):
        text = "".join(rng.choices(" abcdxzé", k=rng.randint(0, 12)))
        at, want = 0, []
        while at < len(text):
            size = max([k for k in range(1, len(text) - at + 1) if text[at : at + k] in known], default=1)
            want.append(size)
            at += size
        assert automaton.longest_matches(text) == want
        assert automaton.phrases(text) == len(want)


def test_memory_may_be_forgotten():
    words = {"a": ["aba", "abb", "bab"], "b": ["cdc", "dcd", "ccd"]}
    languages, small = crossparse.Languages(words), crossparse.Languages(words, 5)
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("abcd", k=rng.choice([1, 4, 90]))) for _ in range(40)) for _ in range(30)]
    assert [languages.predict(t.encode()) for t in texts] == [small.predict(t.encode()) for t in texts]


def test_cases(spark):
    words = {"de": ["der", "die", "und"], "en": ["the", "and", "of"]}
    rows = [(1, None), (2, ""), (3, "123 !? ²_"), (4, "und die"), (5, "THE of"), (5, "THE of"), (None, "the " * 30000), (6, "日本語")]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, lang_pred string, n int")
    out = crossparse.identify(docs, words).select("doc_id", "lang_pred", "language.score", F.col("language")["lang_pred"].alias("found"))
    got = [(r.doc_id, r.found) for r in out.collect()]
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (5, "en"), (5, "en"), (None, "en"), (6, "en")]
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert crossparse.identify(docs, {}).where("language.lang_pred <> 'und'").count() == 0
    assert crossparse.learned_from(spark.createDataFrame([], "doc_id long, text string, lang string")) == {}
    unlabelled = spark.createDataFrame([(1, "a", None), (2, None, "en"), (None, "b", None)], "doc_id long, text string, lang string")
    assert crossparse.learned_from(unlabelled) in ({}, {"en": []})


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_held_out_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = crossparse.identify(docs, crossparse.learned_from(docs)).where(crossparse.held_out(F.col("doc_id")))
    right, n = found.agg(F.sum((F.col("language")["lang_pred"] == F.col("lang")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n > 0.98
