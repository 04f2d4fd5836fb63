"""Rankings against scoring every document for every query."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import lexsearch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, queries, top=10):
    """(query id, rank, id, score) by full scoring; ids that are null come first among equal scores."""
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_words = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for q, text in queries:
        scores = []
        for i, c in counted:
            m = 100 - 90 + 90 * c.total() * n_docs // n_words
            score = 0
            for t in set(words(text)):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is not None, i or 0))
        out += [(q, r, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def sample(seed, n_docs=150, n_queries=20):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Über", "日本", "X1", "a"]
    weights = [40 / (i + 1) for i in range(len(vocabulary))]

    def text(most):
        return rng.choice([" ", "-", ", "]).join(rng.choices(vocabulary, weights, k=rng.randint(0, most)))

    docs = [(i, text(60)) for i in rng.sample(range(-500, 500), n_docs)]
    docs += [(docs[0][0], docs[0][1]), (None, docs[1][1]), (999, docs[1][1]), (7, None), (8, ""), (9, "...")]
    queries = [(f"q{i}", text(8)) for i in range(n_queries)] + [("q0", "w1 W1 w2"), ("none", None), ("empty", "-"), ("unseen", "zzz"), (None, "a w3")]
    return docs, queries


def searched(spark, docs, queries, **how):
    docs = spark.createDataFrame(docs, "doc_id int, text string").withColumn("score", F.lit("x")).withColumn("query", F.lit(1))
    queries = spark.createDataFrame(queries, "item_id string, text string").withColumn("doc_id", F.lit(1))
    got = lexsearch.search(docs.repartition(4), queries, **how)
    assert got.dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize(
    "how", [{}, dict(top=3, chunk=300, short=4, width=8), dict(top=1, chunk=200, short=0, width=5), dict(top=200, short=9, block_bytes=30)]
)
def test_rankings_are_those_of_full_scoring(spark, how):
    docs, queries = sample(len(how))
    assert searched(spark, docs, queries, **how) == plain(docs, queries, how.get("top", 10))


def test_empty_tables(spark):
    assert searched(spark, [], [("q", "a")]) == []
    assert searched(spark, [(1, "a b"), (2, "b")], []) == []
    assert searched(spark, [(1, None), (2, "...")], [("q", "a")]) == []


def test_a_term_that_all_documents_hold_may_weigh_nothing(spark):
    """With very many documents its weight rounds to 0, and a score of 0 gives no row."""
    assert lexsearch.weight(10**6, 10**6) == 0
    docs = [(i, "same") for i in range(3000)]
    assert searched(spark, docs, [("q", "same")]) == plain(docs, [("q", "same")]) == []


def test_chunks_skip_what_cannot_reach_the_floor():
    """A frequent term is looked up only in the documents that a rare one brings, and a hopeless chunk is passed over."""
    rng = np.random.default_rng(0)
    n = 20_000
    lengths = np.full(n, 50, np.int64)
    common, rare = np.arange(n), np.sort(rng.choice(n, 100, replace=False))
    term = np.concatenate([np.zeros(n, np.int32), np.ones(100, np.int32)])
    chunk = lexsearch.Chunk(term, np.concatenate([common, rare]), lengths, np.array([40, 6000]), n, n * 50)
    best = lexsearch.Best(10)
    ids, known = np.arange(n), np.ones(n, bool)
    assert chunk.search([0, 1], best, known, ids, short=500, width=1000) < n / 2
    assert best.ids.tolist() == rare[:10].tolist()
    weaker = lexsearch.Chunk(term[:n], common, lengths, np.array([40, 6000]), n, n * 50)
    assert weaker.search([0, 1], best, known, ids, short=500) == 0


def test_long_texts_are_read_in_runs(monkeypatch):
    monkeypatch.setattr(lexsearch, "STRETCH", 10)
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choices("aB1é日 .-\n", k=rng.randint(0, 90)))
        assert [w.decode() for run in lexsearch.word_runs(text.encode()) for w in run] == words(text)
    assert list(lexsearch.word_runs(None)) == [[]]


def test_blocks_of_queries(spark):
    queries = spark.createDataFrame([(i, f"w{i} x") for i in range(7)] + [(8, None)], "item_id int, text string").coalesce(1)
    assert [[i for i, _ in b] for b in lexsearch.blocks(queries, "item_id", "text", 8)] == [[0, 1], [2, 3], [4, 5], [6]]
