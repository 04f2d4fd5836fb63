"""Probabilities of word 3-grams against a plain model of each half; what the model gathers, and what moves its score."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from headway.llm import perplexity, wordmodel


def plain(texts):
    """p(c | a, b) of the interpolated Kneser-Ney model; texts are lists of words of one language."""
    tables = {3: Counter()}
    for t in texts:
        tables[3].update(zip(["", "", *t], ["", *t], t, strict=False))
    for k in (2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    total, follow, discount = defaultdict(Counter), defaultdict(Counter), {}
    for k, table in tables.items():
        n = Counter(table.values())
        discount[k] = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        for g, c in table.items():
            total[k][g[:-1]] += c
            follow[k][g[:-1]] += 1

    def p(gram, vocabulary):
        k = len(gram)
        if not k:
            return 1 / (vocabulary + 1)
        q, t = p(gram[1:], vocabulary), total[k][gram[:-1]]
        return (max(tables[k][gram] - discount[k], 0) + discount[k] * follow[k][gram[:-1]] * q) / t if t else q

    return p


def test_scores_equal_a_plain_model_of_the_other_half(spark):
    rng = random.Random(5)
    texts = [[" ".join(rng.choices("the a cat dog sat é on mat 日本".split(), k=rng.randint(1, 12)))] * rng.choice([1, 1, 2]) for _ in range(40)]
    rows = [(i, t, 3) for i, group in enumerate(texts) for t in group] + [(99, " \t", 3)]
    docs = spark.createDataFrame(rows, "doc long, text string, lang long").repartition(3)
    found = {r.doc: r.word_log_perplexity for r in wordmodel.log_perplexities(docs).collect()}
    split = {i: [w if isinstance(w, str) else w.decode() for w in wordmodel.words(t.encode())] for i, t, _ in rows}
    models = [plain([split[i] for i, _, _ in rows if i % 2 == h]) for h in (0, 1)]
    vocabulary = len({w for t in split.values() for w in t})
    assert set(found) == {i for i, t in split.items() if t}
    for i, cost in found.items():
        t = split[i]
        logs = [math.log(models[1 - i % 2](g, vocabulary)) for g in zip(["", "", *t], ["", *t], t, strict=False)]
        assert cost == pytest.approx(-sum(logs) / len(logs), abs=1e-5)


def test_long_texts_are_cut_without_loss():
    rows, old = [(4, " ".join(map(str, range(25))), 1), (6, "x y", 0)], wordmodel.ROWS
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["doc", "text", "lang"])
    whole = pa.Table.from_batches(wordmodel.grams(iter([batch]))).to_pylist()
    try:
        wordmodel.ROWS = 7
        assert pa.Table.from_batches(wordmodel.grams(iter([batch]))).to_pylist() == whole
    finally:
        wordmodel.ROWS = old
    assert len(whole) == 27 and whole[-2]["a"] == whole[-2]["b"] == 0


def test_rows_of_the_model_grow_with_the_corpus(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=50)), 0) for i in range(400)]
    sizes = [wordmodel.count(spark.createDataFrame(rows[:n], "doc long, text string, lang long")).count() for n in (40, 400)]
    assert sizes[1] > 9 * sizes[0]


def test_word_order_moves_the_score(spark):
    rng = random.Random(7)
    text = "the old man went down to the sea and took his small boat out before the sun was up over the hills".split()
    rows = [(i, " ".join(text[k:] + text[:k]), "en") for i in range(200) for k in [rng.randrange(len(text))]]
    rows.append((900, " ".join(rng.sample(text, len(text))), "en"))
    out = {r.doc_id: r for r in perplexity.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert out[900].word_log_perplexity > 2 * max(out[i].word_log_perplexity for i in range(200))


def test_buckets_passes_and_spread_words_change_nothing(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(["the", "a", *vocabulary], [60, 20, *[1] * 60], k=rng.randint(1, 40))) for _ in range(60)]
    texts += ["the the the the the the", texts[0], "日本 the 語"]
    rows = [(texts.index(t), t, texts.index(t) % 4 // 2) for t in texts]
    docs = spark.createDataFrame(rows, "doc long, text string, lang long").repartition(3)
    whole = {r.doc: r[1] for r in wordmodel.log_perplexities(docs, passes=(1, 1)).collect()}
    # 'the' has far over a quarter of a bucket, so its pairs lie in several.
    cut = {r.doc: r[1] for r in wordmodel.log_perplexities(docs, bucket=150, passes=(2, 3)).collect()}
    assert cut == pytest.approx(whole, abs=2e-6) and set(cut) == {d for d, _, _ in rows}


def test_what_is_dealt_out_is_small():
    import pyarrow as pa

    rng = random.Random(10)
    texts = [" ".join(f"w{int(rng.paretovariate(0.8)) % 30000}" for _ in range(400)) for _ in range(250)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (range(250), texts, [1] * 250)], ["doc", "text", "lang"])
    for docs, most in ((False, 9), (True, 11)):
        blocks = [b.column(1)[0].as_py() for turn in range(3) for b in wordmodel._dealt(6, {}, 3, turn, docs)(iter([batch]))]
        assert sum(map(len, blocks)) < most * 400 * 250  # the rows before took 22 bytes a 3-gram
        assert sum(int((wordmodel.unpack(b)[5] + wordmodel.unpack(b)[6]).sum()) for b in blocks) == 400 * 250


def test_words_by_hash_are_those_of_the_pattern():
    rng = random.Random(12)
    texts = ["".join(rng.choices(["a", "b", "é", "日", "\U00020001", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0"], k=60)) for _ in range(200)]
    keys = {}
    for t in texts:
        _, found = wordmodel._keys(t + "\n", [wordmodel.np.zeros(0, wordmodel.np.uint64)] * 2)
        split = wordmodel.WORD.findall(t)
        assert len(found) == len(split)
        for w, k in zip(split, found.tolist(), strict=True):
            assert keys.setdefault(w, k) == k
    assert len(set(keys.values())) == len(keys)


def test_shuffles_of_a_step_are_freed(spark):
    import contextlib

    from headway.llm.shared import freeing_shuffles

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    with contextlib.suppress(ZeroDivisionError), freeing_shuffles(spark):
        assert spark.conf.get(name) == "true"
        1 / 0  # noqa: B018
    assert spark.conf.get(name, None) == old


def test_a_bucket_gives_a_row_per_lot_of_documents_not_per_document():
    import pyarrow as pa

    texts = [f"a{i} b{i} c{i % 7} d e{i % 3} f g" for i in range(250)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (range(250), texts, [0] * 250)], ["doc", "text", "lang"])
    dealt = [r for b in wordmodel._dealt(6, {}, 1, 0, True)(iter([batch])) for r in b.to_pylist()]
    of_lang = {0: {(k, h): 1.0 for k in "tuq" for h in (0, 1)} | {("d", h, k): 0.5 for h in (0, 1) for k in (1, 2, 3)}}
    run = wordmodel._scored({}, of_lang, type("Sent", (), {"value": wordmodel.NO_WORDS}))
    got = pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.binary())})
    made = [run(pa.Table.from_pylist([r]), got) for r in dealt]
    assert sum(t.num_rows for t in made) == 7  # six buckets and the lot's documents; a row per document and bucket before
    out = wordmodel._summed_up(pa.concat_tables(made)).to_pylist()
    assert [(r["doc"], r["n"]) for r in out] == [(i, 7) for i in range(250)]


def test_numbered_words_make_blocks_smaller_and_change_nothing(spark, monkeypatch):
    import pyarrow as pa

    rng = random.Random(13)
    texts = [" ".join(f"w{int(rng.paretovariate(0.8)) % 3000}" for _ in range(40)) for _ in range(100)]
    docs = spark.createDataFrame(list(zip(range(100), texts, [1] * 100, strict=True)), "doc long, text string, lang long").repartition(2)
    whole = {r.doc: r[1] for r in wordmodel.log_perplexities(docs, bucket=1000).collect()}
    monkeypatch.setattr(wordmodel, "DICTIONARY", 20)
    assert {r.doc: r[1] for r in wordmodel.log_perplexities(docs, bucket=1000).collect()} == pytest.approx(whole, abs=2e-6)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (range(100), texts, [1] * 100)], ["doc", "text", "lang"])
    named = pa.Table.from_batches(list(wordmodel._frequent(iter([batch])))).to_pydict()
    assert named["n"][0] == 4000 and sum(named["n"][1:]) == 4000
    sent = type("Sent", (), {"value": wordmodel.Dictionary([b for b in named["b"] if b >= 0])})
    size = [sum(len(b.column(1)[0].as_py()) for b in wordmodel._dealt(6, {}, 1, 0, True, d)(iter([batch]))) for d in (None, sent)]
    assert size[1] < 0.8 * size[0]


def test_discarded_tables_leave_no_files(spark):
    import os

    from headway.llm import shared

    kept = shared.keep(spark.range(5))
    path = shared._kept[kept]
    assert kept.count() == 5
    shared.discard(kept)
    assert not os.path.exists(path)
