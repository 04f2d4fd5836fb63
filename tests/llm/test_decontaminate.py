"""Windows of benchmark items in documents against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from headway.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(text, items):
    own, hit, met = words(text), set(), set()
    for item, body in items:
        other = words(body)
        size = min(10, len(other))
        for j in range(max(1, len(other) - 9) if other else 0):
            window = other[j : j + size]
            for i in range(len(own) - size + 1):
                if own[i : i + size] == window:
                    hit.update(range(i, i + size))
                    met.add(str(item))
    return len(own), len(hit), sorted(met)


def examples():
    rng = random.Random(11)
    vocabulary = ["a", "b", "Über", "straße", "x1", "Z", "é"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(30)]
    items += [(30, None), (31, ""), (32, " .,! "), (33, "é"), (33, "second row"), (None, "a b")]
    docs = [(i, " ,".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 60])))) for i in range(40)]
    docs += [(i + 100, "zz - " + (body or "") + "... zz " + (body or "")) for i, (_, body) in enumerate(items)]
    docs += [(200, None), (201, ""), (None, "second ROW"), (202, "second\x85row"), (5, "word " * 30000), (5, "word " * 30000)]
    return docs, items


@pytest.mark.parametrize("block", [16_000_000, 60])
def test_equals_brute_force(spark, block):
    docs, items = examples()
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, hits string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.mark(frame, bench, into="found", block_bytes=block).collect()
    known = [(i, t) for i, t in items if i is not None]
    want = sorted((i is None, i or 0, *plain(t, known)) for i, t in docs)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.found.n_words, r.found.n_hit, list(r["found"]["items"])) for r in out)
    assert got == want
    for r in out:
        flat = r.found.places
        spans = list(zip(flat[::2], flat[1::2], strict=True))
        assert spans == sorted(spans)
        assert sum(len(words(r.text[a:b])) for a, b in spans) == r.found.n_hit
    clean = decontaminate.clean(frame, bench, block_bytes=block)
    assert clean.columns == frame.columns
    assert clean.count() == sum(w[3] == 0 for w in want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.mark(docs, bench).select(F.col("benchmark_hits")["n_hit"]).first()[0] == 0
    assert decontaminate.mark(docs.limit(0), bench).count() == 0


def test_columns_with_clashing_names_stay(spark):
    names = ["benchmark_hits", "benchmark_hits_0", "benchmark_hits_1"]
    docs = spark.createDataFrame([(1, "a b c", 1, 2, 3), (2, "d", 4, 5, 6)], ["doc_id", "text", *names])
    bench = spark.createDataFrame([(1, "b c"), (2, "x y")], "item_id long, text string")
    marked = decontaminate.mark(docs, bench, block_bytes=1)
    assert set(marked.columns) == set(docs.columns)
    assert [(r.benchmark_hits.n_hit, r.benchmark_hits_0, r.benchmark_hits_1) for r in marked.orderBy("doc_id").collect()] == [(2, 2, 3), (0, 5, 6)]
    assert [tuple(r) for r in decontaminate.clean(docs, bench).collect()] == [(2, "d", 4, 5, 6)]
