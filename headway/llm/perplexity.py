"""Quality rules: word statistics of a text, and bands for its perplexity under a character n-gram model of its language.

The model is a modified Kneser-Ney model of order 5 over 128 symbols: printable ASCII with all digits alike, white space,
other control characters, and 31 classes of other characters. Spark counts the n-grams of all documents; the model's tables
of probabilities come out of joins over these counts. For scoring they become sorted arrays of 64-bit keys, in which a
task looks up its sorted n-grams. An n-gram's key is its language number and symbols side by side, so keys never collide.

The arrays go to every task only if the tables have at most `limit` rows (about 20 bytes each). Beyond it the n-grams of
each document meet the tables in a join instead, with the same result.

Word order and unlikely words are the matter of a second model, of word 3-grams (`wordmodel`), which is never sent to tasks.

A document is rejected if the log of its perplexity under either lies outside the band of its language: the median less or plus so many
robust standard deviations on that side, each the distance to the quartile by 0.6745, so that a language's own spread sets
its band: by default 4 below and 3 above. Quartiles are exact, over all documents, in steps of 0.001.
The band by words has no lower end: near copies in the other half make a text likely, and that is no fault of the text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm import wordmodel
from headway.llm.shared import freeing_shuffles, keep, map_batches

ORDER = 5
BITS = 7
SYMBOLS = 1 << BITS
DOC_BITS = 12
LANG_BITS = 63 - DOC_BITS - ORDER * BITS
PIECE = 1_000_000
SPACE = b" \t\n\x0b\x0c\r"
MARKS = b"#*$%&|<>"
NO_CHARACTER = SPACE + bytes(range(0x80, 0xC0))  # of UTF-8: white space, and bytes that go on with a character
STEP = 0.001
# A normal distribution's quartile lies 0.6745 standard deviations from its median: 4 such deviations below, 3 above.
LOWER, UPPER = 4 / 0.6745, 3 / 0.6745


def _symbols() -> np.ndarray:
    codes = np.arange(0x110000, dtype=np.uint32)
    table = (97 + codes % 31).astype(np.uint8)
    table[:0x20] = 96
    table[0x20:0x7F] = np.arange(95)
    table[0x7F] = 96
    table[0x30:0x3A] = 0x30 - 0x20
    table[list(SPACE[1:])] = 95
    return table


SYMBOL = _symbols()
ASCII_SYMBOL = bytes(SYMBOL[:0x80]).ljust(256)
WINDOW = 5
GROUP = 250_000
# A group of texts ends with the text that makes it larger than GROUP, and each may be as large.
POWERS = wordmodel._powers(wordmodel.FACTOR, 4 * GROUP), wordmodel._powers(wordmodel.INVERSE, 4 * GROUP)


def ngrams(text: bytes) -> Iterator[np.ndarray]:
    """The n-gram at each character of a text, the text's start padded with line ends, in pieces of at most a million."""
    if text.isascii():
        codes = np.frombuffer(text.translate(ASCII_SYMBOL), np.uint8)
    else:
        codes = SYMBOL[np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)]
    codes = np.concatenate((np.full(ORDER - 1, 95, np.uint8), codes))
    for at in range(0, len(codes) - ORDER + 1, PIECE):
        part = codes[at : at + PIECE + ORDER - 1]
        n = len(part) - ORDER + 1
        grams = part[:n]
        for k in range(1, ORDER):
            # In the smallest type that holds so many symbols.
            kind = np.uint16 if k < 2 else np.uint32 if k < 4 else np.int64
            part = part.astype(kind, copy=False)
            grams = grams.astype(kind) if grams.dtype != kind else grams
            grams <<= BITS
            grams |= part[k : k + n]
        yield grams


def _pieces(texts: list[bytes | None], langs: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys with the document's place in the lowest bits, about a million at a time; and the places of those documents."""
    held, docs, size = [], [], 0
    for i, (text, lang) in enumerate(zip(texts, langs, strict=True)):
        for grams in ngrams(text) if text else ():
            if docs and (size + len(grams) > PIECE or len(docs) >= 1 << DOC_BITS):
                yield np.concatenate(held), np.array(docs)
                held, docs, size = [], [], 0
            grams <<= DOC_BITS
            grams |= lang << ORDER * BITS + DOC_BITS | len(docs)
            held.append(grams)
            docs.append(i)
            size += len(grams)
    if docs:
        yield np.concatenate(held), np.array(docs)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) to (key, n), added up within the task as far as memory of a few million keys allows."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out():
        for at in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 100_000]), pa.array(counts[at : at + 100_000])], ["key", "n"])

    for batch in batches:
        texts = batch.column(0).cast(pa.binary()).to_pylist()
        for packed, _ in _pieces(texts, batch.column(1).to_pylist()):
            new, n = np.unique(packed >> DOC_BITS, return_counts=True)
            both = np.concatenate((keys, new))
            order = np.argsort(both, kind="stable")
            both, weight = both[order], np.concatenate((counts, n))[order]
            starts = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
            keys, counts = both[starts], np.add.reduceat(weight, starts)
            if len(keys) > 4_000_000:
                yield from out()
                keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield from out()


def languages(docs: DataFrame, lang: str) -> list[str | None]:
    """The languages of the documents, null among them, in order; one number of the key each."""
    found = sorted((r[0] for r in docs.select(lang).distinct().toLocalIterator()), key=lambda x: (x is not None, x or ""))
    if len(found) > 1 << LANG_BITS:
        raise ValueError(f"more than {1 << LANG_BITS} languages")
    return found


def language_number(known: list[str | None], lang: Column) -> Column:
    numbers = F.create_map([F.lit(x) for i, k in enumerate(known) if k is not None for x in (k, i)]) if any(k is not None for k in known) else None
    null = F.lit(known.index(None)) if None in known else F.lit(0)
    return F.coalesce(numbers[lang], null).cast("long") if numbers is not None else null.cast("long")


def count_ngrams(rows: DataFrame) -> DataFrame:
    """(key, n) of the rows (text, lang number)."""
    return map_batches(rows, _counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(size, key, logp, backoff) of an interpolated modified Kneser-Ney model from counts (key, n) of the highest order.

    Order 0 is one row per language, the uniform distribution. Lower orders count distinct symbols before. `backoff` is the log weight of the next lower order after these symbols as
    a context, null for n-grams that are no context. Discounts are those of Chen and Goodman for each language and order,
    held between 0 and the count; where counts of counts are missing they are 0.5, 1 and 1.5.
    """
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        lower = F.shiftright("key", (k + 1) * BITS).alias("lang"), F.col("key").bitwiseAND(F.lit((1 << k * BITS) - 1)).alias("rest")
        key = F.shiftleft("lang", k * BITS).bitwiseOR(F.col("rest")).alias("key")
        tables[k] = keep(tables[k + 1].select(*lower).groupBy("lang", "rest").agg(F.count("*").alias("n")).select(key, "n"))
    below, out = None, []
    for k in range(1, ORDER + 1):
        rows = tables[k].withColumn("lang", F.shiftright("key", k * BITS)).withColumn("context", F.shiftright("key", BITS))
        tally = rows.groupBy("lang").agg(*(F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in range(1, 5)))
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        discounts = tally.select(
            "lang",
            *(
                F.when(
                    (F.col(f"n{i}") > 0) & (F.col("n1") > 0),
                    F.least(F.greatest(i - (i + 1) * y * F.col(f"n{i + 1}") / F.nullif(F.col(f"n{i}"), F.lit(0.0)), F.lit(0.0)), F.lit(float(i))),
                )
                .otherwise(i / 2)
                .alias(f"d{i}")
                for i in (1, 2, 3)
            ),
        )
        rows = rows.join(F.broadcast(discounts), "lang")  # one row per language
        taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = rows.withColumn("taken", F.least(taken, F.col("n").cast("double")))
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("taken").alias("free"))
        rows = rows.join(contexts, "context")
        own, rest = (F.col("n") - F.col("taken")) / F.col("total"), F.col("free") / F.col("total")
        weight = F.log(rest)
        if k == 1:
            made = rows.select("key", (own + rest / SYMBOLS).alias("p"))
            uniform = F.lit(-math.log(SYMBOLS)).alias("logp")
            out.append(contexts.select(F.lit(0).alias("size"), F.col("context").alias("key"), uniform, weight.alias("backoff")))
        else:
            suffix = F.shiftleft("lang", (k - 1) * BITS).bitwiseOR(F.col("key").bitwiseAND(F.lit((1 << (k - 1) * BITS) - 1)))
            made = rows.withColumn("suffix", suffix).join(below.select(F.col("key").alias("suffix"), F.col("p").alias("q")), "suffix")
            made = made.select("key", (own + rest * F.col("q")).alias("p"))
            weights = contexts.select(F.col("context").alias("key"), weight.alias("backoff"))
            out[-1] = out[-1].join(weights, "key", "left").select("size", "key", "logp", "backoff")
        below = keep(made)
        out.append(below.select(F.lit(k).alias("size"), "key", F.log("p").alias("logp")))
    out[-1] = out[-1].withColumn("backoff", F.lit(None).cast("double"))
    model = out[0]
    for table in out[1:]:
        model = model.unionByName(table)
    return model


class Arrays:
    """The model in sorted arrays, one set per order."""

    def __init__(self, size: np.ndarray, key: np.ndarray, logp: np.ndarray, backoff: np.ndarray):
        self.keys, self.logp, self.backoff = {}, {}, {}
        for k in range(ORDER + 1):
            at = np.flatnonzero(size == k)
            at = at[np.argsort(key[at])]
            self.keys[k], self.logp[k] = key[at], logp[at].astype(np.float32)
            self.backoff[k] = np.nan_to_num(backoff[at], nan=0.0).astype(np.float32)

    def _find(self, k: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        table = self.keys[k]
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def log_probability(self, keys: np.ndarray, k: int = ORDER) -> np.ndarray:
        """Of each key's last symbol after those before it; keys in order are found fastest."""
        at, seen = self._find(k, keys)
        out = self.logp[k][at].astype(np.float64) if len(self.keys[k]) else np.zeros(len(keys))
        if not seen.all():
            lost = np.flatnonzero(~seen)
            rest = keys[lost]
            if k == 0:
                out[lost] = -math.log(SYMBOLS)
            else:
                lang = rest >> k * BITS
                out[lost] = self.log_probability(lang << (k - 1) * BITS | rest & ((1 << (k - 1) * BITS) - 1), k - 1)
                at, known = self._find(k - 1, rest >> BITS)
                out[lost[known]] += self.backoff[k - 1][at[known]]
        return out


def arrays(model: DataFrame) -> Arrays:
    table = model.toArrow()
    column = lambda name: table.column(name).to_numpy()
    return Arrays(column("size"), column("key"), column("logp"), column("backoff"))


def word_statistics(text: bytes | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols of `#*$%&|<>`, repeated lines, and words in repeated 5-word windows."""
    return tuple(statistics([text])[0].tolist())


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """The word statistics of each text, texts of about GROUP bytes at a time."""
    out = np.zeros((len(texts), 5), np.int64)
    held, size = [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        out[i, 1:4] = len(text.translate(None, NO_CHARACTER)), len(text) - len(text.translate(None, MARKS)), _repeated_lines(text)
        if len(text) > GROUP:
            words = text.split()
            out[i, [0, 4]] = len(words), repeated_words(words)
            continue
        held.append(i)
        size += len(text)
        if size > GROUP:
            out[held, 0], out[held, 4] = _words([texts[k] for k in held])
            held, size = [], 0
    if held:
        out[held, 0], out[held, 4] = _words([texts[k] for k in held])
    return out


def _repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _windows(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the windows of WINDOW words from the words' hashes: same words, same hash."""
    n = max(len(hashes) - WINDOW + 1, 0)
    out = hashes[:n].copy()
    for k in range(1, WINDOW):
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out += hashes[k : k + n]
    return out


def _again(hashes: np.ndarray) -> np.ndarray:
    """Where hashes stand that occur twice or more."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    same = np.flatnonzero(ordered[1:] == ordered[:-1])
    found = np.zeros(len(hashes), bool)
    found[order[same]] = found[order[same + 1]] = True
    return np.flatnonzero(found)


def _repeated(words: list[bytes], hashes: np.ndarray) -> int:
    """Words inside windows that occur twice or more, the first occurrence included; `hashes` are those of the windows.

    Whether windows of the same hash have the same words is looked up.
    """
    at = _again(hashes)
    if not len(at):
        return 0
    found = [tuple(words[i : i + WINDOW]) for i in at.tolist()]
    times = Counter(found)
    at = at[np.fromiter((times[w] > 1 for w in found), bool, len(found))]
    hit = np.zeros(len(words) + 1, np.int64)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(hit)))


def repeated_words(words: list[bytes]) -> int:
    return _repeated(words, _windows(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words and repeated words of texts, none empty. Only texts with two windows of the same hash are split into words."""
    codes = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = (codes == 32) | (codes - np.uint8(9) < 5)
    cuts = np.flatnonzero(space[1:] != space[:-1]) + 1
    cuts = cuts if space[0] else np.concatenate(([0], cuts))
    start, end = cuts[::2], cuts[1::2]
    number = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, "right")
    n = np.bincount(number, minlength=len(texts))
    # A word's hash is a polynomial of its bytes.
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * POWERS[0][: len(codes)], out=sums[1:])
    hashes = _windows((sums[end] - sums[start]) * POWERS[1][start])
    # Windows that begin and end in the same text; the lowest bits of a hash give way to the text's number.
    own = np.flatnonzero(number[WINDOW - 1 :] == number[: len(hashes)])
    of_text = number[own].astype(np.uint64)
    low = np.uint64((1 << len(texts).bit_length()) - 1)
    hashes = hashes[own] & ~low | of_text
    ordered = np.sort(hashes)
    again = ordered[1:][ordered[1:] == ordered[:-1]] & low
    repeated, bounds = np.zeros(len(texts), np.int64), np.searchsorted(of_text, np.arange(len(texts) + 1, dtype=np.uint64))
    for i in np.flatnonzero(np.bincount(again.astype(np.int64))).tolist():
        repeated[i] = _repeated(texts[i].split(), hashes[bounds[i] : bounds[i + 1]])
    return n, repeated


STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _scored(model):
    """(lang number, text) batches with one more column: the struct of word statistics, characters and log probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.value if model is not None else None
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            logp, size = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for packed, docs in _pieces(texts, batch.column(2).to_pylist()) if tables else ():
                packed.sort()
                place = packed & ((1 << DOC_BITS) - 1)
                packed >>= DOC_BITS
                starts = np.flatnonzero(np.concatenate(([True], packed[1:] != packed[:-1])))
                values = np.repeat(tables.log_probability(packed[starts]), np.diff(np.append(starts, len(packed))))
                found = np.bincount(place, values, len(docs))
                np.add.at(logp, docs, found)
                np.add.at(size, docs, np.bincount(place, minlength=len(docs)))
            stats = statistics(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(stats[:, i]) for i in range(5)), batch.column(2), pa.array(size), pa.array(logp)],
                ["id", *(x.split()[0] for x in STATISTICS.split(", ")), "lang", "size", "logp"],
            )

    return run


def _joined(rows: DataFrame, model: DataFrame) -> DataFrame:
    """(row, size, logp) by a join of each row's n-grams with the model: for tables too large for a task.

    Every n-gram of a scored document was counted, so the highest order has them all.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for packed, docs in _pieces(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                keys, n = np.unique(packed, return_counts=True)
                row = ids[docs[keys & ((1 << DOC_BITS) - 1)]]
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(keys >> DOC_BITS), pa.array(n)], ["row", "key", "n"])

    highest = model.where(F.col("size") == ORDER).select("key", "logp")
    met = map_batches(rows, grams, "row long, key long, n long").join(highest, "key")
    return met.groupBy("row").agg(F.sum("n").alias("size"), F.sum(F.col("n") * F.col("logp")).alias("logp"))


def score(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    lower: float = LOWER,
    upper: float = UPPER,
    limit: int = 6_000_000,
) -> DataFrame:
    """One row per document: id, word statistics, log_perplexity, base_failed, kept and word_log_perplexity.

    base_failed: fewer than 10 words, or over a fifth of the words in repeated 5-word windows. kept is false then, and
    where either log of the perplexity, by characters or by words, lies outside the language's band. Null and empty texts have no words and fail. Rows
    without a language form a group of their own. A band of no width (one document, or all alike) rejects nothing that
    lies on it. Repeated rows give repeated rows and count as often; an empty table gives an empty one; other columns are
    not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = languages(rows, "lang")
    rows = rows.select("id", "text", language_number(known, F.col("lang")).alias("lang"))
    rows = rows.withColumn("doc", F.when(F.length("text") > 0, F.xxhash64("text", "lang")))
    with freeing_shuffles(spark):
        by_words = wordmodel.log_perplexities(rows.where("doc IS NOT NULL").select("doc", "text", "lang"))
        rows = rows.select(F.struct("id", "doc").alias("id"), "text", "lang")
        kind = f"struct<id: {docs.schema[id].dataType.simpleString()}, doc: bigint>"
        model = keep(kneser_ney(keep(count_ngrams(rows.select("text", "lang")))))
        schema = f"id {kind}, {STATISTICS}, lang long, size long, logp double"
        if model.count() <= limit:
            sent = spark.sparkContext.broadcast(arrays(model))
            scored = keep(map_batches(rows, _scored(sent), schema))
        else:
            # Row numbers are written down once, so that both uses see the same.
            numbered = keep(rows.withColumn("row", F.monotonically_increasing_id()))
            plain = map_batches(
                numbered.select(F.struct("id", "row").alias("id"), "text", "lang"), _scored(None), schema.replace(f"id {kind}", f"id struct<id: {kind}, row: bigint>")
            )
            sums = _joined(numbered.select("row", "text", "lang"), model)
            plain = plain.drop("size", "logp").withColumn("row", F.col("id")["row"]).withColumn("id", F.col("id")["id"])
            scored = keep(plain.join(sums, "row", "left").drop("row").fillna({"size": 0, "logp": 0.0}))
        scored = scored.withColumn("log_perplexity", F.when(F.col("size") > 0, -F.col("logp") / F.col("size")))
        scored = keep(scored.withColumn("doc", F.col("id")["doc"]).withColumn("id", F.col("id")["id"]).join(by_words, "doc", "left"))
    judged, inside = scored, F.lit(True)
    for column in ("log_perplexity", "word_log_perplexity"):
        steps = F.round(F.col(column) / STEP).cast("long")
        bins = scored.where(F.col(column).isNotNull()).groupBy("lang", steps.alias("step")).agg(F.count("*").alias("n"))
        quartiles = bins.groupBy("lang").agg(F.percentile("step", [0.25, 0.5, 0.75], F.col("n")).alias("q"))
        band = quartiles.select(
            "lang",
            ((F.col("q")[1] - lower * (F.col("q")[1] - F.col("q")[0]) - 0.5) * STEP).alias(f"{column}_low"),
            ((F.col("q")[1] + upper * (F.col("q")[2] - F.col("q")[1]) + 0.5) * STEP).alias(f"{column}_high"),
        )
        judged = judged.join(F.broadcast(band), "lang", "left")  # one row per language
        within = F.col(column) <= F.col(f"{column}_high")
        if column == "log_perplexity":
            within &= F.col(column) >= F.col(f"{column}_low")
        inside &= F.coalesce(within, F.lit(False))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        F.col("id").alias(id),
        *(x.split()[0] for x in STATISTICS.split(", ")),
        "log_perplexity",
        failed.alias("base_failed"),
        (~failed & inside).alias("kept"),
        "word_log_perplexity",
    )
