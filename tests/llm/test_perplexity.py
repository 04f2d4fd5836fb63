"""Word statistics, counts and probabilities against plain versions; both ways to score against each other."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from headway.llm import perplexity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(hit),
    )


def texts():
    rng = random.Random(4)
    out = ["", None, " \t\n\x0b\x0c\r", "a\nb\na\n \n \na", "x y z u v x y z u v", "a " * 30, "é# ü* \x1c\x85 \xa0 <b>&|%$", "one"]
    for _ in range(60):
        out.append("".join(rng.choice(["a", "b", "é", "Z9", " ", " ", "\n", "|"]) for _ in range(rng.randint(1, 120))))
    out += [" ".join(rng.choices("abcdefgh", k=400)), "word " * 20000]
    return out


@pytest.mark.parametrize("size", [5])
def test_word_statistics(size):
    for text in texts():
        assert perplexity.word_statistics(None if text is None else text.encode()) == plain_statistics(text), text


def test_repeated_words_of_large_vocabularies():
    rng = random.Random(2)
    words = [f"w{rng.randrange(9000)}".encode() for _ in range(12000)]
    words += words[100:150] + words[90:97]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    assert perplexity.repeated_words(words) == len(hit) > 0


def plain_model(docs):
    """{order: {(symbols): probability}} of the modified Kneser-Ney model of one language."""
    counts = Counter()
    for text in docs:
        symbols = [95] * 4 + [int(perplexity.SYMBOL[ord(c)]) for c in text]
        counts.update(tuple(symbols[i : i + 5]) for i in range(len(symbols) - 4))
    tables = {5: counts}
    for k in (4, 3, 2, 1):
        tables[k] = Counter(gram[1:] for gram in tables[k + 1])
    probability = {0: defaultdict(lambda: 1 / 128)}
    for k in range(1, 6):
        table = tables[k]
        n = [sum(c == i for c in table.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0

        def discount(c):
            i = min(c, 3)
            if not n[1] or not n[i]:
                return min(i / 2, c)
            return min(max(i - (i + 1) * y * n[i + 1] / n[i], 0), i, c)

        total, free = Counter(), Counter()
        for gram, c in table.items():
            total[gram[:-1]] += c
            free[gram[:-1]] += discount(c)
        probability[k] = {
            g: (c - discount(c)) / total[g[:-1]] + free[g[:-1]] / total[g[:-1]] * probability[k - 1][g[1:]] for g, c in table.items()
        }
    return probability


def test_scores_equal_a_plain_model(spark):
    rng = random.Random(8)
    langs = {"en": "the and of to in ".split(), "de": "der die und ist für ".split()}
    rows = [(i, " ".join(rng.choices(langs[lang], k=30)), lang) for i, lang in enumerate(["en", "de"] * 12)]
    rows += [(50, None, "en"), (51, "", "de"), (52, "the lone text without any language at all here", None), (53, "zu kurz", "de")]
    rows += [rows[0], (None, "the the of of in to and and the of to", "en")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, key string, n int").repartition(3)
    got = sorted(map(tuple, perplexity.score(docs).collect()), key=str)
    joined = sorted(map(tuple, perplexity.score(docs, limit=0).collect()), key=str)
    assert [g[:6] + g[7:] for g in got] == [j[:6] + j[7:] for j in joined]
    assert all(g[6] == pytest.approx(j[6], rel=1e-5) if g[6] is not None else j[6] is None for g, j in zip(got, joined, strict=True))
    models = {lang: plain_model([t for _, t, own in rows if own == lang and t]) for lang in ("en", "de", None)}
    by_id = {g[0]: g for g in got}
    for i, text, lang in rows:
        row = by_id[i]
        assert row[1:6] == plain_statistics(text)
        assert row[7] == (row[1] < 10 or 100 * row[5] > 20 * row[1])
        assert not (row[7] and row[8])
        if not text:
            assert row[6] is None and row[8] is False
            continue
        symbols = [95] * 4 + [int(perplexity.SYMBOL[ord(c)]) for c in text]
        logs = [math.log(models[lang][5][tuple(symbols[k : k + 5])]) for k in range(len(text))]
        assert row[6] == pytest.approx(-sum(logs) / len(text), rel=1e-4)


def test_unseen_grams_back_off(spark):
    text = "abracadabra and some more words for the table"
    rows = spark.createDataFrame([(text, 0)], "text string, lang long")
    arrays = perplexity.arrays(perplexity.kneser_ney(perplexity.count_ngrams(rows)))
    plain = plain_model([text])

    def key(gram):
        out = 0
        for s in gram:
            out = out << 7 | s
        return out

    symbol = lambda s: [int(perplexity.SYMBOL[ord(c)]) for c in s]
    # Not the padding before the text: as the beginning of a text it follows nothing.
    for context in (symbol("brac"), symbol("abra"), symbol("zzzz"), symbol("xxda")):
        shares = arrays.log_probability(perplexity.np.array([key([*context, s]) for s in range(128)]))
        assert float(perplexity.np.exp(shares).sum()) == pytest.approx(1, abs=1e-3)
    seen = arrays.log_probability(perplexity.np.array([key(symbol("cadab"))]))[0]
    assert seen == pytest.approx(math.log(plain[5][tuple(symbol("cadab"))]), rel=1e-5)


def test_bands_reject_outliers_on_both_sides(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 8))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=80)), "en") for i in range(200)]
    rows.append((900, " ".join("".join(rng.choices("QXZJ#@!", k=6)) for _ in range(30)), "en"))
    out = {r.doc_id: r for r in perplexity.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not out[900].kept and not out[900].base_failed
    assert sum(out[i].kept for i in range(200)) >= 198


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    out = perplexity.score(docs)
    assert out.count() == 0 and out.select(F.col("kept")).columns == ["kept"]


def laden_documents():
    """(rows, ids of symbol-laden ones): real words in sentences of two languages, a twelfth with symbols at a third of the words."""
    rng, rows, laden = random.Random(11), [], set()
    for lang, line in (
        ("en", "the of and to in is that for it as was with be by on not he his but at are this have from which or had one all were"),
        ("de", "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach"),
    ):
        common = line.split()
        rare = [rng.choice(common) + rng.choice(common) + rng.choice(common) for _ in range(800)]
        for i in range(240):
            doc = len(rows)
            text = [rng.choice(common if rng.random() < 0.6 else rare) for _ in range(90)]
            if i % 12 == 0:
                laden.add(doc)
                text = [w + rng.choice("#*$%&") * 3 if rng.random() < 0.35 else w for w in text]
            rows.append((doc, " ".join(text), lang))
    return rows, laden


def test_bands_reject_symbol_laden_sentences(spark):
    rows, laden = laden_documents()
    out = {r.doc_id: r for r in perplexity.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for lang in ("en", "de"):
        own = [(i in laden, out[i].kept) for i, _, x in rows if x == lang]
        assert sum(k for junk, k in own if junk) <= 2  # of 20
        assert sum(k for junk, k in own if not junk) >= 0.97 * sum(not junk for junk, _ in own)
