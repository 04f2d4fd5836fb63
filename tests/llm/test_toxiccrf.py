"""Marginals against all taggings, training on planted words, and held-out documents."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from headway.llm import toxiccrf


def test_marginals_equal_all_taggings():
    model = toxiccrf.Field({"=bad": 2.5, "^awf": 1.5, "=hmm": -1.0}, -1.2, [[0.0, -0.7], [0.3, 1.1]])
    tagger = toxiccrf.Tagger(model)
    rng = random.Random(5)
    for _ in range(200):
        words = rng.choices(["bad", "awful", "hmm", "plain", "Ünsinn"], k=rng.randint(1, 9))
        own = [sum(model.weights.get(f, 0) for f in toxiccrf.features(w.lower())) + model.bias for w in words]
        total, marginal = 0.0, [0.0] * len(words)
        for tags in itertools.product((0, 1), repeat=len(words)):
            score, before = 0.0, 0
            for tag, o in zip(tags, own, strict=True):
                score += model.pairs[before][tag] + (o if tag else 0)
                before = tag
            total += math.exp(score)
            for i, tag in enumerate(tags):
                marginal[i] += tag * math.exp(score)
        got = tagger.marginals(" , ".join(words).encode())
        assert [i for i, _ in got] == [i for i, w in enumerate(words) if w in ("bad", "awful", "hmm")]
        for i, p in got:
            assert p == pytest.approx(marginal[i] / total, abs=1e-9)


def test_long_runs_between_marked_words():
    tagger = toxiccrf.Tagger(toxiccrf.Field({"=bad": 2.0}, -1.0, [[0.0, -0.5], [0.2, 0.9]]))
    near, far = (tagger.marginals(("bad " + "x " * n + "bad").encode()) for n in (300, 200_000))
    assert near[0][1] == pytest.approx(far[0][1]) and near[1][1] == pytest.approx(far[1][1])


def labelled(spark, n=600):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 5 == 0)
        words = rng.choices(vocabulary, k=60)
        if toxic:
            for k in rng.sample(range(60), 3):
                words[k] = rng.choice(["Vilest", "scoundrel", "grumbo" + rng.choice("abcdef")])
        docs.append((i, " ".join(words), "x"))
        labels.append((i, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int"), docs


def test_learns_planted_words(spark):
    docs, labels, rows = labelled(spark)
    model = toxiccrf.learned_from(docs, labels)
    out = toxiccrf.score(docs, model).where(toxiccrf.held_out(F.col("doc_id"))).select("doc_id", "text", "toxicity").collect()
    assert len(out) > 100
    for r in out:
        assert (r.toxicity.score >= 0.3) == (r.doc_id % 5 == 0)
        flat = r.toxicity.places
        found = [r.text[a:b] for a, b in zip(flat[::2], flat[1::2], strict=True)]
        assert all(w.lower().startswith(("vilest", "scoundrel", "grumbo")) for w in found) and len(found) == r.toxicity.n_toxic
    hard = [(1, None), (2, ""), (3, "vilest " * 50000), (3, "vilest " * 50000), (None, "fine")]
    got = toxiccrf.score(spark.createDataFrame(hard, "doc_id long, text string"), model).select("toxicity.score").collect()
    assert [r.score for r in got][:2] == [0.0, 0.0] and got[2].score == got[3].score > 0.9 and got[4].score == 0.0


def test_without_labels(spark):
    docs, labels, _ = labelled(spark, 10)
    for none in (labels.limit(0), labels.withColumn("toxic", F.lit(0)), labels.withColumn("toxic", F.lit(None).cast("int"))):
        model = toxiccrf.learned_from(docs, none)
        assert {r.score for r in toxiccrf.score(docs, model).select("toxicity.score").collect()} == {0.0}
    assert toxiccrf.score(docs.limit(0), toxiccrf.Field()).count() == 0


def test_copies_count_once(spark):
    rows = [("one two three four five", True)] * 4 + [("one two three four six", True), ("other words stand here now", False)]
    frame = spark.createDataFrame(rows, "text string, toxic boolean")
    assert toxiccrf.without_copies(frame).count() <= 3


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxiccrf.learned_from(docs, labels)
    rows = toxiccrf.score(docs.join(labels, "doc_id").where(toxiccrf.held_out(F.col("doc_id"))), model)
    table = {(r.toxic, r.p): r.n for r in rows.groupBy("toxic", (F.col("toxicity")["score"] >= 0.3).alias("p")).agg(F.count("*").alias("n")).collect()}
    caught, missed, wrong = table.get((1, True), 0), table.get((1, False), 0), table.get((0, True), 0)
    assert caught / (caught + missed) > 0.8 and wrong / (caught + wrong) < 0.3
