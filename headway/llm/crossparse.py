"""Language identification by cross-parsing entropy.

Each language has a suffix automaton over words of labelled text. A word of a document, with a space on either side, is
parsed into the fewest phrases that the automaton contains: always the longest match next. A phrase from an automaton of n
letters costs log2(n) bits, and the language that needs the fewest bits for all words of the text wins. Costs of words add
up, so words are parsed once per worker and remembered.

The training words are bounded: `docs_per_language` documents picked by hash (as many as expected, the hash decides) and
their `words_per_language` most frequent words, each learned only for languages where it is about as frequent as anywhere.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.shared import Memo, keep, once, over_texts

LETTERS = re.compile(r"[^\W\d_]+")
UNDECIDED = "und"
REMEMBERED = 120_000


class SuffixAutomaton:
    """All substrings of a set of words, each word with a space before and after."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        for word in words:
            last = 0
            for letter in f" {word} ":
                last = self._add(letter, last, link, length)
        self.letters = sum(len(w) + 2 for w in words)

    def _add(self, letter: str, last: int, link: list[int], length: list[int]) -> int:
        nxt = self.next
        there = nxt[last].get(letter)
        if there is not None and length[there] == length[last] + 1:
            return there
        if there is not None:
            copy = len(nxt)
            nxt.append(dict(nxt[there]))
            length.append(length[last] + 1)
            link.append(link[there])
            link[there] = copy
            at = last
            while at >= 0 and nxt[at].get(letter) == there:
                nxt[at][letter] = copy
                at = link[at]
            return copy
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and letter not in nxt[at]:
            nxt[at][letter] = new
            at = link[at]
        if at >= 0:
            there = nxt[at][letter]
            if length[there] == length[at] + 1:
                link[new] = there
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[there]))
                length.append(length[at] + 1)
                link.append(link[there])
                link[there] = link[new] = copy
                while at >= 0 and nxt[at].get(letter) == there:
                    nxt[at][letter] = copy
                    at = link[at]
        return new

    def longest_matches(self, text: str) -> list[int]:
        """Lengths of the phrases of a text: the longest match next, or one letter that the automaton lacks."""
        lengths, nxt, at, size = [], self.next, 0, 0
        for letter in text:
            there = nxt[at].get(letter)
            if there is not None:
                at, size = there, size + 1
                continue
            if size:
                lengths.append(size)
            at = nxt[0].get(letter, 0)
            size = 1
            if not at:
                lengths.append(1)
                size = 0
        return lengths + [size] if size else lengths

    def phrases(self, text: str) -> int:
        count, nxt, at = 0, self.next, 0
        for letter in text:
            there = nxt[at].get(letter)
            if there is None:
                count += 1
                there = nxt[0].get(letter, 0)
                # A letter without any match is a phrase; the first letter of a phrase is counted when the phrase begins.
            elif not at:
                count += 1
            at = there
        return count


class Languages:
    """Phrases of words in every language. A word's counts stand side by side in one number, `WIDTH` bits each, so that
    the counts of a text are one sum."""

    WIDTH = 40

    def __init__(self, words: dict[str, list[str]], remembered: int = REMEMBERED):
        self.names = sorted(words)
        self.automata = [SuffixAutomaton(words[name]) for name in self.names]
        self.bits = np.log2([max(2, a.letters) for a in self.automata])
        self.seen = Memo(self._parse, remembered)

    def _parse(self, word: str) -> int:
        padded = f" {word} "
        return sum(a.phrases(padded) << i * self.WIDTH for i, a in enumerate(self.automata))

    def phrases(self, text: str) -> np.ndarray:
        """Phrases that the text needs in each language."""
        total = sum(map(self.seen.__getitem__, LETTERS.findall(text.lower())))
        mask = (1 << self.WIDTH) - 1
        return np.array([total >> i * self.WIDTH & mask for i in range(len(self.names))], np.float64)

    def predict(self, text: bytes | None) -> tuple[str, float]:
        """The language of fewest bits, the first by name of equals, and its share: 2^-bits over the sum for all languages."""
        decoded = (text or b"").decode()
        if not self.names or not any(map(str.isalpha, decoded)):
            return UNDECIDED, 0.0
        bits = self.phrases(decoded) * self.bits
        best = int(np.argmin(bits))
        return self.names[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def training_words(
    labelled: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    docs_per_language: int = 250,
    words_per_language: int = 8000,
    share: float = 0.25,
) -> dict[str, list[str]]:
    """Words to learn for each language, from rows with a non-null text and language.

    The sample takes each row of a language with the same chance, by a hash of its id. A word is learned for a language if
    its rate there is at least `share` of its highest rate in any.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    if not sizes:
        return {}
    chance = F.create_map([F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, docs_per_language / n))])
    drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < chance[F.col("lang")] * (1 << 20))
    words = drawn.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    counts = keep(words.groupBy("word", "lang").agg(F.count("*").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counts.where(F.length("word") <= 64).join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    highest = rated.groupBy("word").agg(F.max("rate").alias("highest"))
    own = rated.join(highest, "word").where(F.col("rate") >= share * F.col("highest"))
    # Bounded: the words of the sample.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = own.withColumn("place", F.row_number().over(order)).where(F.col("place") <= words_per_language)
    learned: dict[str, list[str]] = {name: [] for name in sorted(sizes)}
    for row in top.select("lang", "word").toLocalIterator():
        learned[row.lang].append(row.word)
    return {name: sorted(words) for name, words in learned.items() if words}


def predicted(words: dict[str, list[str]], remembered: int = REMEMBERED):
    """Spark function of a text: lang_pred and score. The word lists are bounded, see `training_words`.

    `remembered` bounds a worker's memory of parsed words; it changes the time only.
    """
    key = uuid.uuid4().hex

    def start():
        languages = once(key, lambda: Languages(words, remembered))

        def work(texts):
            pairs = [languages.predict(t) for t in texts]
            return [[p[0] for p in pairs], [p[1] for p in pairs]]

        return work

    return over_texts(start, lang_pred="string", score="double")


def identify(docs: DataFrame, words: dict[str, list[str]], text: str = "text", into: str = "language", remembered: int = REMEMBERED) -> DataFrame:
    """`docs` with the struct `into` of lang_pred and score (0 to 1).

    Null texts, texts without letters, and all texts if no language was learned, give `und` with score 0. The prediction
    reads the text alone. Empty tables give empty ones; repeated rows give repeated rows.
    """
    return docs.withColumn(into, predicted(words, remembered)(F.col(text)))


def held_out(id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 by 3. A null id counts as the text ''."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learned_from(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", **bounds) -> dict[str, list[str]]:
    """`training_words` of the rows that are not held out."""
    return training_words(docs.where(~held_out(F.col(id))), id, text, lang, **bounds)
