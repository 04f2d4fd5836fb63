"""Fingerprints and groups of near duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from headway.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().translate(simhash.LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """{fingerprint: smallest reachable fingerprint} over all pairs."""
    found = {}
    for f in prints:
        if f in found:
            continue
        group, front = {f}, [f]
        while front:
            x = front.pop()
            for y in prints:
                if y not in group and (x ^ y).bit_count() <= 3:
                    group.add(y)
                    front.append(y)
        found |= dict.fromkeys(group, min(group))
    return found


TEXTS = ["", None, "   ", "one", "One two", "a b c", "a b c d", "Ärger mit Öl und ÖL", "x " * 500, "\x0b\x0c a\tb\r\nc d", "a b c"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode() if text is not None else None) % (1 << 64) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("über drei Wörter")).alias("h")).first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest("über drei Wörter".encode(), 42)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def prints_with_groups(seed, n=150):
    rng = random.Random(seed)
    made = set()
    for _ in range(n):
        x = rng.getrandbits(64)
        made.add(x)
        for _ in range(rng.choice([0, 0, 1, 3, 9])):
            y = x
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                y ^= 1 << b
            made.add(y)
            x = rng.choice([x, y])
    return sorted(made)


@pytest.mark.parametrize("limit", [2048, 3])
def test_links_connect_the_same_groups(spark, limit):
    """With small lists too, which sends nearly all members through the finer ones."""
    prints = prints_with_groups(5)
    rows = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(rows, limit)).collect()}
    expected = plain_groups(prints)
    groups, plain = {}, {}
    for p in prints:
        groups.setdefault(roots.get(signed(p), signed(p)), set()).add(p)
        plain.setdefault(expected[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))
    assert any(len(g) > 4 for g in plain.values())


def test_finer_masks_keep_every_pair_together():
    rng = random.Random(1)
    for mask in (simhash.byte_masks()[7], simhash.finer_masks(simhash.byte_masks()[3])[2]):
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(300):
            x = rng.getrandbits(64)
            y = x
            for b in rng.sample(free, 3):
                y ^= 1 << b
            assert any(not (x ^ y) & (m % (1 << 64)) for m in simhash.finer_masks(mask))


def test_groups_of_a_list():
    prints = prints_with_groups(9, 60)
    pairs = simhash._groups(np.array(prints, np.uint64))
    expected = plain_groups(prints)
    assert {m % (1 << 64) for m, _ in pairs} == {p for p in prints if p != expected[p]}
    assert all(expected[m % (1 << 64)] == expected[f % (1 << 64)] for m, f in pairs)


def test_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_near_duplicates_of_texts(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=300)) for _ in range(12)]
    texts = [*TEXTS, *base]
    for t in base[:6]:
        w = t.split()
        w[rng.randrange(300)] = "other"
        texts += [" ".join(w), t.upper()]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(2, texts[2], "x", 1), (None, "a b c", "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, id int")
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    prints = {i: plain_fingerprint(t) for i, t, *_ in rows if i is not None}
    groups = plain_groups(sorted(set(prints.values())))
    smallest = {}
    for i, p in prints.items():
        smallest[groups[p]] = min(smallest.get(groups[p], i), i)
    for r in out:
        if r.doc_id is not None:
            assert r.fingerprint % (1 << 64) == prints[r.doc_id]
            assert r.component_id == smallest[groups[prints[r.doc_id]]]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(set(smallest.values()))
    assert kept.where("doc_id is null").count() == 1


def test_one_of_each_with_repeated_ids(spark):
    """Of an id with two texts only the copy goes; texts of one id that copy nothing both stay, as do clashing columns."""
    rows = [
        (5, "one two three four"), (5, "totally other words in here now"), (1, "one two three four"), (7, "p q r s t u"),
        (7, "v w x y z aa"), (7, "V W X Y Z AA"), (9, "alone in here"), (9, "alone in here"), (8, "v w x y z aa"), (None, "p q r s t u"),
    ]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, fp string, place int, root string")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text) for r in kept.collect())) == [
        (0, "p q r s t u"), (1, "one two three four"), (5, "totally other words in here now"), (7, "V W X Y Z AA"), (7, "p q r s t u"), (9, "alone in here"),
    ]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0
