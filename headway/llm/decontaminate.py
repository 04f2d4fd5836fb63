"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items, run once over each text.

Texts and items are normalised alike: A-Z lower-cased, words are runs of letters a-z, digits and all characters beyond ASCII,
put apart by one space. A match starts and ends at a space, so it covers whole words; word numbers lead back to places in
the original text.

The automaton is sent to every task, so its size is measured before: items whose texts add up to more than `block_bytes` are
scanned for in blocks, one automaton after the other in a chain of steps over the same rows. No block is larger than the
bound and one item.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import once, over_texts

WINDOW = 10
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
NORMAL = bytes(
    (c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(NORMAL).split() if text else []


def windows(words: list[bytes], size: int = WINDOW) -> list[list[bytes]]:
    """Runs of `size` words; all words as one window if there are fewer, but not none."""
    return [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []


def build(items: list[tuple[str, bytes]], size: int = WINDOW) -> ahocorasick.Automaton:
    """The automaton over the windows of (item id, text); a window carries its number of words and the ids of its items."""
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows(normal_words(text), size):
            owners.setdefault(b" ".join(window), set()).add(item)
    automaton = ahocorasick.Automaton()
    for window, ids in owners.items():
        automaton.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, frozenset(ids)))
    if owners:
        automaton.make_automaton()
    return automaton


def scan(text: bytes | None, automaton: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, runs of hit words (first, past the last), and the items whose windows occur."""
    words = normal_words(text)
    if not words or not len(automaton):
        return len(words), [], set()
    # One character per byte: the automaton then walks bytes, and UTF-8 keeps characters apart.
    line = f" {b' '.join(words).decode('latin-1')} "
    found = list(automaton.iter(line))
    if not found:
        return len(words), [], set()
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(spaces, [end for end, _ in found])
    first = last - [n for _, (n, _) in found]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, last, -1)
    hit = np.concatenate(([0], (np.cumsum(edges) > 0).astype(np.int8), [0]))
    starts, ends = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
    return len(words), list(zip(starts.tolist(), ends.tolist())), set().union(*(ids for _, (_, ids) in found))


def places(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as places (code points, end exclusive) in the original text."""
    words = [m.span() for m in WORD.finditer(text.decode())]
    return [(words[a][0], words[b - 1][1]) for a, b in runs]


def _scanned(items: list[tuple[str, bytes]], size: int):
    key = uuid.uuid4().hex

    def start():
        automaton = once(key, lambda: build(items, size))

        def work(texts):
            columns = [[], [], [], []]
            for text in texts:
                n, runs, ids = scan(text, automaton)
                at = places(text, runs) if runs else []
                row = (n, [x for r in runs for x in r], [x for p in at for x in p], sorted(ids))
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            return columns

        return work

    return over_texts(start, n_words="long", runs="array<long>", places="array<long>", items="array<string>")


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_bytes: int):
    """Items with an id in blocks of bounded size, read from Spark one partition at a time."""
    rows = benchmark.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")
    )
    block, size = [], 0
    for row in rows.toLocalIterator():
        text = row.text.encode()
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row.item, text))
        size += len(text)
    yield block


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    into: str = "benchmark_hits",
    window: int = WINDOW,
    block_bytes: int = 16_000_000,
) -> DataFrame:
    """`docs` with the struct `into`: n_words, n_hit, items (ids as strings, sorted) and places of hit runs in the text.

    A document word is hit if it lies inside an occurrence of a window of an item. `places` are (start, end) pairs in code
    points, end exclusive, of runs of hit words. Null texts have no words; items without words or without an id match
    nothing; items that repeat an id count once. Empty tables are fine on both sides. A column of `docs` that is called like
    `into` is replaced, all others stay.
    """
    names = []
    for k, block in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        name = f"{into}_{k}"
        while name in docs.columns:
            name += "_"
        names.append(name)
        docs = docs.withColumn(names[-1], _scanned(block, window)(F.col(text)))
    runs = F.flatten(F.array(*(F.col(n)["runs"] for n in names)))
    if len(names) == 1:
        hits, spans = runs, F.col(names[0])["places"]
    else:
        # Runs of different blocks can overlap: count words once.
        hits, spans = _merged(runs), _merged(F.flatten(F.array(*(F.col(n)["places"] for n in names))))
    pairs = F.transform(F.sequence(F.lit(0), F.size(hits) - 1), lambda i: F.when(i % 2 == 1, hits[i]).otherwise(-hits[i]))
    n_hit = F.when(F.size(hits) == 0, F.lit(0).cast("long")).otherwise(F.aggregate(pairs, F.lit(0).cast("long"), lambda a, x: a + x))
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*(F.col(n)["items"] for n in names)))))
    made = F.struct(F.col(names[0])["n_words"].alias("n_words"), n_hit.alias("n_hit"), items.alias("items"), spans.alias("places"))
    return docs.withColumn(into, made).drop(*names)


def _merged(flat):
    """The union of (start, end) pairs in a flat array, as a flat array in order."""
    numbers = F.sequence(F.lit(0), F.size(flat) - 2, F.lit(2))
    pairs = F.array_sort(F.transform(numbers, lambda i: F.struct(flat[i].alias("a"), flat[i + 1].alias("b"))))

    def add(done, pair):
        n = F.size(done)
        joins = (n > 0) & (F.try_element_at(done, F.greatest(n, F.lit(1))) >= pair["a"])
        longer = F.concat(F.slice(done, 1, F.greatest(n - 1, F.lit(0))), F.array(F.greatest(F.try_element_at(done, F.greatest(n, F.lit(1))), pair["b"])))
        return F.when(joins, longer).otherwise(F.concat(done, F.array(pair["a"], pair["b"])))

    empty = F.array().cast("array<bigint>")
    return F.when(F.size(flat) == 0, empty).otherwise(F.aggregate(pairs, empty, add))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """The rows of `docs` without any hit, with their columns as they were."""
    into = "benchmark_hits"
    while into in docs.columns:
        into += "_"
    return mark(docs, benchmark, text, into=into, **names).where(F.col(into)["n_hit"] == 0).drop(into)


def items_digest(items: Column) -> Column:
    """Digest of sorted item ids joined by commas."""
    return F.sha2(F.array_join(items, ","), 256)
