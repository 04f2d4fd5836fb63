"""Phrases against counting all of them."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import collocations


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def plain(rows, least, top, share=80):
    """The same over all phrases, by counting every one."""
    f, n = {}, Counter()
    for lang, text in rows:
        counts = f.setdefault(lang or "und", Counter())
        for words in pieces(text):
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            if any(
                len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in candidates.items()
            ):
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def made_rows(seed, docs=120):
    """Texts of few words, of which some go together, with all kinds of space and breaks between them."""
    rng = random.Random(seed)
    words = ["a", "B", "é", "New York", "new york CITY", "c d e f", "c d e", "x\x1cy", "\xa0", "ÄB"]
    rows = []
    for _ in range(docs):
        text = ""
        for w in rng.choices(words, weights=[9, 6, 4, 3, 2, 3, 1, 1, 1, 1], k=rng.randint(0, 40)):
            text += w + rng.choices([" ", "\t  ", ". ", "\n", " , "], weights=[9, 1, 1, 1, 1])[0]
        rows.append((rng.choice(["en", "de", None]), text))
    return rows + [("en", None), ("en", ""), ("fr", "only once"), (None, " . ")]


def mined(spark, rows, **how):
    docs = spark.createDataFrame([(l, t, "x") for l, t in rows], "lang string, text string, phrase string").repartition(5)
    got = collocations.mine(docs.withColumn("f", F.lit(1)), **how)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("how", [dict(least=5, top=6, depth=2, slots=64, chunk=40), dict(least=3, top=2000, depth=4000), dict(least=8, top=12, depth=3, chunk=500)])
def test_phrases_are_those_of_full_counts(spark, how):
    rows = made_rows(how["least"])
    assert mined(spark, rows, **how) == plain(rows, how["least"], how["top"])


def test_ties_at_the_end_of_a_list(spark):
    """Pairs of equal score and count beyond the last rank: the least in byte order stay, whatever was counted first."""
    rows = [("en", f"{c}1 {c}2. ") for c in "zyxwvédcba"] * 4
    assert mined(spark, rows, least=4, top=3, depth=1) == plain(rows, 4, 3)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.mine(docs, least=1).count() == 0
    assert mined(spark, [("en", None), (None, "")], least=1) == []


def test_stretches_hold_every_phrase_once():
    rng = random.Random(1)
    for n in range(300):
        data = bytes(rng.choices(b"ab \xff", weights=[4, 4, 3, 1], k=rng.randint(0, 80)))
        size, limit = n % 4 + 1, rng.randint(1, 30)
        whole, parts = Counter(), Counter()
        for piece in data.split(b"\xff"):
            words = piece.split()
            whole.update(b" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
        slots = np.full(16, 15, np.uint8)
        for run in collocations.runs(data, size, limit):
            parts.update(dict(zip(*(x if isinstance(x, list) else x.tolist() for x in collocations.count_run(run, size, "en", slots)))))
        assert parts == whole, (data, size, limit)


def test_slots_say_what_was_packed(spark):
    rows = [("en", "a b"), ("en", "é ß"), ("de", "a b"), ("", "x y")]
    phrases = spark.createDataFrame(rows, "lang string, phrase string")
    slots = collocations._unpacked(collocations.pack(phrases, 2, F.lit(11), 1 << 12))
    assert sorted(slots[slots > 0].tolist()) == [11] * 4
    for lang, phrase in rows:
        # With only its halves asked for, a phrase of three words made of a packed pair twice is found by its hash.
        first, second = phrase.encode().split()
        found, _ = collocations.count_run(b" ".join([first, second]), 2, lang, np.full(16, 1, np.uint8))
        assert found == [phrase.encode()]
        ids = np.array([1, 2, 1])
        flags = slots.copy()
        at = collocations._wanted(3, ids, [b"\xff", first, second], lang, flags)
        assert at.tolist() == []  # the second pair was not packed


def test_query_on_whole_sample(spark):
    """More phrases than are returned, so that the frontier is cut; against counts of all phrases in SQL."""
    from headway.llm.queries import SQL

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = sorted(tuple(r) for r in collocations.mine(docs, least=10, top=50, depth=60).collect())
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    sql = SQL["op13_phrase_collocations"].replace("f >= 30", "f >= 10").replace("rank <= 2000", "rank <= 50")
    assert got == sorted(duck.execute(sql).fetchall())
    assert len(got) == 200
