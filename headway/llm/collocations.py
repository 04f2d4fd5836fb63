"""Collocations: phrases whose words stand together more often than apart, by best-first branch and bound.

A phrase that begins with p, or ends in it, occurs at most f(p) times. So a phrase grown from p to the right scores at most
`2000000 * f(p) / (f(first word of p) + f(p))`, by its cut after the first word, and one grown to the left the same with the
last word of p. These bounds only fall as phrases grow.

Words and pairs are counted first. Then each language has a score down to which its phrases are known, at first the score of
its 4000th pair. The frontier are the pairs, then the triples, whose bound reaches it: only phrases grown from these are
counted. That gives every phrase of this score or more, and every longer phrase that could drop it. Where fewer than `top`
phrases survive, ties at the end included, the score is lowered and the frontier grows, until all languages are settled.

What a frontier holds grows with the data, so tasks get it as a table of `SLOTS` half bytes by hash. A phrase that meets a
slot by chance is counted too, which changes no result. Tasks count within chunks of text, Spark adds up by phrase; no task
holds a list of phrases beyond its chunk.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.shared import give_back, keep, map_batches, once

LEAST, LONGEST, TOP, SHARE = 30, 4, 2000, 80
SCALE = 2_000_000
SLOTS = 1 << 23
CHUNK = 4_000_000
SEED = 42
TURN = 21
UNDEFINED = "und"
BREAK = b"\xff"  # in no UTF-8 text
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c == 9 else 255 if c in b".,;:!?\x0a\x0b\x0c\x0d" else c for c in range(256)
)
FREQUENT, GROWS_RIGHT, GROWS_LEFT, GOOD = 1, 2, 4, 8


def runs(data: bytes, size: int, limit: int = CHUNK) -> Iterator[bytes]:
    """Stretches of normalised text in which every phrase of `size` words occurs once, cut at breaks if there are any."""
    at, before = 0, b""
    while len(data) - at > limit:
        cut = data.rfind(BREAK, at + 1, at + limit)
        broken = cut >= 0
        if not broken:
            cut = data.rfind(b" ", at + 1, at + limit)
        if cut < 0:  # one word, as long as that
            ends = [e for e in (data.find(b" ", at + limit), data.find(BREAK, at + limit)) if e >= 0]
            cut = min(ends, default=len(data))
        run = before + data[at:cut]
        yield run
        # The next stretch begins with the words that a phrase can have on this side of the cut.
        words = [] if broken or size == 1 else run.replace(BREAK, b" \xff ").split()[1 - size :]
        before, at = b"".join(w + b" " for w in words), cut
    yield before + data[at:]


def _turned(h: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    return (h << np.uint64(by)) | (h >> np.uint64(64 - by)) if by else h


def _wanted(size: int, ids: np.ndarray, uniq: list[bytes], lang: str, slots: np.ndarray) -> np.ndarray:
    """Places where a phrase of `size` words begins that the slots ask for."""
    seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in uniq), np.uint64, len(uniq))
    word = hashes[ids]
    n = len(ids) - size + 2
    if n < 2:
        return np.empty(0, np.int64)
    at = word[:n]
    for j in range(1, size - 1):
        at = at ^ _turned(word[j : n + j], TURN * j)
    flags = slots[at & np.uint64(len(slots) - 1)]
    left, right = flags[:-1], flags[1:]
    unbroken = np.ones(n - 1, bool)
    for j in range(size):
        unbroken &= ids[j : n - 1 + j] != 0  # id 0 is the break
    frequent = (left & right & FREQUENT) > 0
    if size == 2:
        wanted = frequent
    elif size == 3:
        wanted = frequent & (((left & GROWS_RIGHT) | (right & GROWS_LEFT)) > 0)
    else:
        # To be ranked it grows from both halves; to drop a good half it need not, and the other may be beyond the frontier.
        wanted = (((left & GROWS_RIGHT) > 0) & ((right & GROWS_LEFT) > 0)) | (((left | right) & GOOD) > 0)
    return np.flatnonzero(wanted & unbroken)


def count_run(data: bytes, size: int, lang: str, slots: np.ndarray | None) -> tuple[list[bytes], np.ndarray]:
    """Phrases of `size` words of a stretch that the slots ask for, each once, and how often they occur in it."""
    words = data.replace(BREAK, b" \xff ").split()
    if not words:
        return [], np.empty(0, np.int64)
    index = dict.fromkeys(words)
    index.pop(BREAK, None)
    uniq = [BREAK, *index]
    index = dict(zip(uniq, range(len(uniq))))
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    if size == 1:
        return uniq[1:], np.bincount(ids, minlength=len(uniq))[1:]
    at = _wanted(size, ids, uniq, lang, slots)
    code = ids[at]
    for j in range(1, size):
        if j > 1:  # numbers of the phrases so far, so that none outgrows 64 bits
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(uniq) + ids[at + j]
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return [b" ".join(words[p : p + size]) for p in at[first].tolist()], counts


def _counter(size: int, packed: bytes | None, chunk: int):
    def flush(held: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        slots = None if packed is None else once(hashlib.sha256(packed).hexdigest(), lambda: _unpacked(packed))
        for lang, texts in held.items():
            for run in runs(BREAK.join(texts).translate(NORMAL), size, chunk):
                phrases, counts = count_run(run, size, lang, slots)
                for at in range(0, len(phrases), 100_000):
                    some = pa.array(phrases[at : at + 100_000], pa.binary()).cast(pa.string())
                    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(some), np.int32)))
                    yield pa.RecordBatch.from_arrays([langs, some, pa.array(counts[at : at + 100_000], pa.int64())], ["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bytes_held = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                held.setdefault(lang, []).append(text)
                bytes_held += len(text) + 1
                if bytes_held >= chunk:
                    yield from flush(held)
                    held, bytes_held = {}, 0
                    give_back()
        yield from flush(held)
        give_back()

    return run


def _unpacked(packed: bytes) -> np.ndarray:
    halves = np.frombuffer(zlib.decompress(packed), np.uint8)
    return np.stack([halves & 15, halves >> 4], axis=1).ravel()


def count(texts: DataFrame, size: int, packed: bytes | None = None, least: int = LEAST, chunk: int = CHUNK) -> DataFrame:
    """(lang, phrase, f) of the phrases of `size` words that occur `least` times or more, of those the slots ask for."""
    parts = map_batches(texts, _counter(size, packed, chunk), "lang string, phrase string, f long")
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _slot(size: int, slots: int) -> Column:
    words = F.split("phrase", " ")

    def turned(h: Column, by: int) -> Column:
        by %= 64
        return F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by)) if by else h

    hashes = [turned(F.xxhash64("lang", words[j]), TURN * j) for j in range(size)]
    return reduce(Column.bitwiseXOR, hashes).bitwiseAND(F.lit(slots - 1))


def pack(phrases: DataFrame, size: int, flags: Column, slots: int = SLOTS) -> bytes:
    """The flags of phrases of `size` words as half bytes by hash; of the size of the table, whatever the number of phrases."""
    placed = phrases.select(_slot(size, slots).alias("slot"), flags.cast("long").alias("flags"))
    by_long = placed.groupBy(F.shiftright("slot", 4).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(flags, cast(4 * (slot & 15) as int))")).alias("bits")
    )
    found = by_long.toArrow()
    table = np.zeros(slots // 16, np.int64)
    table[found["at"].to_numpy()] = found["bits"].to_numpy()
    return zlib.compress(table.astype("<i8").tobytes(), 1)


def _ratio(top: Column, below: Column) -> Column:
    """floor(SCALE * top / below), exactly."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * top.cast("decimal(20,0)"), below.cast("decimal(21,0)"))


def scored(phrases: DataFrame, size: int, parts: DataFrame) -> DataFrame:
    """Phrases with l, r and score of their lowest cut, and the counts of their first and last word.

    `parts` has the counts of shorter phrases. Phrases of which a part is not there are left out.
    """
    words = F.split("phrase", " ")
    cuts = F.array(
        *(
            F.struct(
                F.lit(k).alias("k"),
                F.array_join(F.slice(words, 1, k), " ").alias("head"),
                F.array_join(F.slice(words, k + 1, size - k), " ").alias("tail"),
            )
            for k in range(1, size)
        )
    )
    cut = phrases.select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    each = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    each = each.withColumn("score", _ratio(F.col("a"), F.col("l") + F.col("r")))
    lowest = F.min(F.struct("score", "k", "l", "r"))
    return (
        each.groupBy("lang", "phrase")
        .agg(
            F.first("a").alias("a"),
            lowest.alias("low"),
            F.max(F.when(F.col("k") == 1, F.col("l"))).alias("first_f"),
            F.max(F.when(F.col("k") == size - 1, F.col("r"))).alias("last_f"),
            F.count("*").alias("cuts"),
        )
        .where(F.col("cuts") == size - 1)
        .select("lang", "phrase", "a", "low.l", "low.r", "low.score", "first_f", "last_f")
    )


def _frontier(phrases: DataFrame, floors: DataFrame) -> tuple[DataFrame, Column]:
    """Phrases of the languages in `floors`, and their flags for growth."""
    a, floor = F.col("a"), F.col("floor")
    right, left = _ratio(a, F.col("first_f") + a) >= floor, _ratio(a, F.col("last_f") + a) >= floor
    flags = F.lit(FREQUENT)
    for held, flag in ((right, GROWS_RIGHT), (left, GROWS_LEFT), (F.col("score") >= floor, GOOD)):
        flags = flags + F.when(held, flag).otherwise(0)
    return phrases.join(floors, "lang"), flags


def _floors(pairs: DataFrame, depth: int) -> DataFrame:
    """(lang, floor): the score of the pair at `depth`, 0 where there are fewer."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"))
    best = pairs.withColumn("n", F.row_number().over(order)).where(F.col("n") <= depth)
    return best.groupBy("lang").agg(F.when(F.max("n") >= depth, F.min("score")).otherwise(0).alias("floor"))


def _survivors(found: DataFrame, longer: DataFrame, share: int) -> DataFrame:
    """Candidates without the ones that a phrase one word longer contains in `share` percent of their places or more.

    A phrase two words longer need not be looked at: the one between occurs as often as it does.
    """
    words = F.split("phrase", " ")
    n = F.size(words)
    inner = F.array(F.array_join(F.slice(words, 1, n - 1), " "), F.array_join(F.slice(words, 2, n - 1), " "))
    over = longer.select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("over"))
    covered = F.lit(100).cast("decimal(3,0)") * F.col("over").cast("decimal(20,0)") >= F.lit(share).cast("decimal(3,0)") * F.col("a").cast("decimal(20,0)")
    return found.join(over, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))


def mine(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    share: int = SHARE,
    depth: int = 2 * TOP,
    slots: int = SLOTS,
    chunk: int = CHUNK,
) -> DataFrame:
    """The first `top` phrases of two to four words of every language: lang, rank, phrase, a, l, r, n, score.

    `a` is how often the phrase occurs, `l` and `r` how often the two sides of its lowest-scoring cut do, `n` how many words the
    language has. Order: score descending, a descending, phrase in byte order. A null lang is `und`, null texts have no
    words, repeated rows count again. A language without phrases that occur `least` times has no row, an empty table gives
    an empty result. Other columns are not read. `depth` (pairs that set the first score), `slots` (a power of two) and
    `chunk` (bytes) change the work, never the result.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNDEFINED)).alias("lang"), F.col(text).alias("text"))
    texts = texts.where(F.col("text").isNotNull())
    every = keep(count(texts, 1, None, 1, chunk))
    totals = keep(every.groupBy("lang").agg(F.sum("f").alias("n")))
    words = every.where(F.col("f") >= least)
    frequent = pack(words, 1, F.lit(FREQUENT), slots)
    counted_pairs = keep(count(texts, 2, frequent, least, chunk))
    pairs = keep(scored(counted_pairs, 2, words))

    floors = keep(_floors(pairs, depth))
    settled: list[DataFrame] = []
    while True:
        now, flags = _frontier(pairs, floors)
        here = texts.join(floors.select("lang"), "lang", "left_semi") if settled else texts
        counted_triples = keep(count(here, 3, pack(now, 2, flags, slots), least, chunk))
        triples = keep(scored(counted_triples, 3, words.unionByName(counted_pairs)))
        now, flags = _frontier(triples, floors)
        counted_fours = keep(count(here, 4, pack(now, 3, flags, slots), least, chunk))
        fours = scored(counted_fours, 4, words.unionByName(counted_pairs).unionByName(counted_triples))
        found = pairs.unionByName(triples).unionByName(fours).join(floors, "lang").where(F.col("score") >= F.col("floor"))
        left = keep(_survivors(found, counted_triples.unionByName(counted_fours), share).select("lang", "phrase", "a", "l", "r", "score", "floor"))
        reached = keep(
            floors.join(left.groupBy("lang").agg(F.count("*").alias("n")), "lang", "left").select(
                "lang", "floor", ((F.col("floor") <= 0) | (F.coalesce("n", F.lit(0)) >= top)).alias("done")
            )
        )
        settled.append(left.join(reached.where("done").select("lang"), "lang", "left_semi"))
        open_langs = reached.where("not done").select("lang")
        if open_langs.isEmpty():
            break
        depth *= 8
        floors = keep(_floors(pairs.join(open_langs, "lang", "left_semi"), depth))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = reduce(DataFrame.unionByName, settled).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
