"""Word 3-grams of a corpus, and each text's log perplexity under a model of texts that are not its own.

Words are runs without ASCII white space, as they stand; in scripts without spaces each character is one. A word's key has
its language number in the upper 16 bits and 48 bits of a hash, so languages share no n-grams. Nothing is pruned: what is
counted grows with the corpus, stays in Spark, and is never sent to all tasks.

Texts fall into two halves by their digest, copies into the same, and a text is scored by the interpolated Kneser-Ney model
of the other half: under a model that has seen it, the unique words of a text would make each other likely. An n-gram that
the other half lacks backs off, down to one share for all words that it lacks.

All that the model says of a 3-gram but the share of its last word comes from 3-grams with the same middle word. So they are
dealt out by it, into buckets of about `BUCKET` words, and twice: first each bucket tells after how many of its words each
word stands, then it gets these numbers from all buckets and scores. A word with over a quarter of a bucket is spread by the
word before; its pairs are then summed up over buckets like single words. Tasks pack what they deal out. Each time it goes in
`PASSES` passes, a share of the buckets in each, so that the disk holds one share at a time.

Most of a block would be the hashes of its words. Words that are frequent in the corpus, `DICTIONARY` of them, whatever its
size, are known to all tasks by rank, and only the others stand in blocks by hash. A block names documents by their place among
those dealt out with it, and what comes back from a bucket is one packed row for each such lot of documents, not a row for
each document: a document's words lie in as many buckets as it has different words.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import discard, freeing_shuffles, give_back, keep, map_batches, ship

HASH_BITS = 48
ROWS = 500_000
BUCKET = 1_500_000
PASSES = 2, 2  # to count, to score
HELD = 1_500_000
# A task names this many of its words, and as many as `DICTIONARY` are numbered for all: which ones changes no result.
NAMED = 1 << 16
DICTIONARY = 1 << 17
ALONE = "฀-໿က-႟ក-៿⺀-꓏豈-﫿\U00020000-\U0003ffff"
WORD = re.compile(rf"[{ALONE}]|[^\x20\t-\r{ALONE}]+")
BREAK = re.compile(rf"[\x20\t-\r{ALONE}]")
SPACE, SINGLE = 1, 2


def words(text: bytes) -> list:
    """The words of a UTF-8 text; bytes if all are ASCII."""
    return text.split() if text.isascii() else WORD.findall(text.decode())


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose results look random (the last steps of SplitMix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _kinds() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    table[[0x20, *range(9, 14)]] = SPACE
    for first, last in re.findall("(.)-(.)", ALONE):
        table[ord(first) : ord(last) + 1] = SINGLE
    return table


KIND = _kinds()
VALUE = mixed(np.arange(1, 0x110001))
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, base, np.uint64)))) if n > 1 else np.ones(n, np.uint64)


def _keys(text: str, powers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a text that ends with white space begins, and its hash: a polynomial of its code points, mixed."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.intp)  # the type that arrays are indexed with
    if len(powers[0]) < len(codes):
        powers[:] = _powers(FACTOR, len(codes)), _powers(INVERSE, len(codes))
    kind = KIND[codes]
    cut = kind != 0
    begins = kind != SPACE
    begins[1:] &= cut[1:] | cut[:-1]
    bounds = np.flatnonzero(begins | (kind == SPACE))
    at = np.flatnonzero(begins[bounds])
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(VALUE[codes] * powers[0][: len(codes)], out=sums[1:])
    start, end = bounds[at], bounds[at + 1]
    keys = mixed((sums[end] - sums[start]) * powers[1][start]) >> np.uint64(64 - HASH_BITS)
    return start, np.maximum(keys, np.uint64(1)).astype(np.int64)


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about ROWS code points, cut where no word is."""
    at = 0
    while len(text) - at > ROWS and (found := BREAK.search(text, at + ROWS)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc, text, lang number) to arrays (doc, a, b, c), one place for each word c after a and b; two words 0 stand before a text."""
    powers = [np.zeros(0, np.uint64)] * 2
    held, size = [], 0  # (doc, lang, piece, whether the text begins with it)
    before = (0, 0)

    def out() -> tuple[np.ndarray, ...]:
        nonlocal before
        start, keys = _keys("\n".join(h[2] for h in held) + "\n", powers)
        lengths = np.array([len(h[2]) + 1 for h in held])
        piece = np.searchsorted(np.cumsum(lengths), start, "right")
        n = np.bincount(piece, minlength=len(held))
        langs = np.array([h[1] for h in held], np.int64) << HASH_BITS
        row = np.zeros(len(keys) + 2 * len(held), np.int64)
        last = np.arange(len(keys)) + 2 * (piece + 1)
        row[last] = keys
        # The two places before a piece: nothing, or the last words of the same text.
        first = np.cumsum(n + 2) - n - 2
        for i in range(len(held)):
            if not held[i][3]:
                row[first[i] : first[i] + 2] = before if i == 0 else row[first[i] - 2 : first[i]]
        row |= np.repeat(langs, n + 2)
        before = tuple(row[-2:] & (1 << HASH_BITS) - 1)
        doc = np.array([h[0] for h in held], np.int64)[piece]
        return doc, row[last - 2], row[last - 1], row[last]

    for batch in batches:
        for doc, text, lang in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            for k, piece in enumerate(_pieces(text.as_py())) if text.is_valid else ():
                held.append((doc, lang, piece, k == 0))
                size += len(piece) + 1
                if size >= ROWS:
                    yield out()
                    held, size = [], 0
    if held:
        yield out()


def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, lang number) to one row (doc, a, b, c) per word c after a and b."""
    for columns in _triples(batches):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "a", "b", "c"])


GRAMS = "doc long, a long, b long, c long"


def half(doc: Column) -> Column:
    return doc.bitwiseAND(F.lit(1))


def count(rows: DataFrame) -> DataFrame:
    """(a, b, c, n0, n1): how often each 3-gram of the rows (doc, text, lang) occurs in either half."""
    found = map_batches(rows, grams, GRAMS)
    return found.groupBy("a", "b", "c").agg(*(F.count(F.when(half(F.col("doc")) == h, 1)).alias(f"n{h}") for h in (0, 1)))


def places(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers in order, and each one's place there; by hashing, as sorting all is slower."""
    at, found = pd.factorize(x)
    order = np.argsort(found)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return found[order], rank[at]


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(b, n) of a task's most frequent middle words, and (-1, n) of all."""
    total, keys, counts = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
    held, size = [], 0

    def added() -> None:
        nonlocal keys, counts
        new = np.sort(np.concatenate(held))
        starts = np.flatnonzero(_first(new))
        keys = np.concatenate((keys, new[starts]))
        counts = np.concatenate((counts, np.diff(np.append(starts, len(new)))))
        order = np.argsort(keys, kind="stable")  # two runs in order
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(_first(keys))
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        if len(keys) > 4 * NAMED:
            # What is rare so far is forgotten: a count may only be too low then.
            named(2 * NAMED)

    def named(most: int) -> None:
        nonlocal keys, counts
        if len(keys) > most:
            own = np.sort(np.argpartition(counts, -most)[-most:])
            keys, counts = keys[own], counts[own]

    for _, _, b, _ in _triples(batches):
        total += len(b)
        held.append(b)
        size += len(b)
        if size >= HELD:
            added()
            held, size = [], 0
    if size:
        added()
    named(NAMED)
    columns = np.concatenate(([-1], keys)), np.concatenate(([total], counts))
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["b", "n"])


class Dictionary:
    """Words that have a number: their rank in `words`."""

    def __init__(self, words: np.ndarray):
        self.words = np.asarray(words, np.int64)
        self.rank = np.argsort(self.words)
        self.ordered = self.words[self.rank]

    def listed(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words in order: an order of them, numbered ones by number before the others, and as differences those numbers and the others' hashes."""
        at = np.minimum(np.searchsorted(self.ordered, words), max(len(self.ordered) - 1, 0))
        known = self.ordered[at] == words if len(self.ordered) else np.zeros(len(words), bool)
        own, others = np.flatnonzero(known), np.flatnonzero(~known)
        rank = self.rank[at[own]] if len(own) else np.zeros(0, np.int64)
        order = np.argsort(rank)
        return np.concatenate((own[order], others)), np.diff(rank[order], prepend=0), np.diff(words[others], prepend=0)

    def among(self, words: np.ndarray, packed: list[list[np.ndarray]]) -> list[np.ndarray]:
        """The places in `words`, which are in order, of the words of each unpacked block.

        Differences of hashes are a block's first array, and those of numbers its last.
        """
        spot = np.empty(len(self.words), np.int32)
        spot[self.rank] = np.searchsorted(words, self.ordered)
        added = lambda x: np.cumsum(x, dtype=np.int64)
        return [np.concatenate((spot[added(p[-1])], np.searchsorted(words, added(p[0])).astype(np.int32))) for p in packed]

    def together(self, packed: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The different words of unpacked blocks, in order, and the places there of the words of each."""
        known = np.zeros(len(self.words), bool)
        for p in packed:
            known[np.cumsum(p[-1], dtype=np.int64)] = True
        others = np.sort(np.concatenate([np.cumsum(p[0], dtype=np.int64) for p in packed]))
        words = np.sort(np.concatenate((self.words[known], others[_first(others)])))
        return words, self.among(words, packed)


NO_WORDS = Dictionary(np.zeros(0, np.int64))


def _inverse(order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int32)
    out[order] = np.arange(len(order), dtype=np.int32)
    return out


def _groups(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number of an array and where it stands."""
    order = np.argsort(x, kind="stable")
    bounds = np.append(np.flatnonzero(_first(x[order])), len(x))
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        yield int(x[order[start]]), order[start:end]


def pack(arrays: list[np.ndarray]) -> bytes:
    """Whole numbers from 0, compressed: the bytes of each place together, as far as they are used."""
    out = []
    for x in arrays:
        x = np.ascontiguousarray(x, np.int64)
        width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        raw = b"".join((x >> 8 * i).astype(np.uint8).tobytes() for i in range(width))
        packed = pa.compress(raw, "zstd", asbytes=True) if raw else b""
        out += struct.pack("<QQB", len(x), len(packed), width), packed
    return b"".join(out)


def unpack(packed: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(packed):
        n, size, width = struct.unpack_from("<QQB", packed, at)
        at += struct.calcsize("<QQB")
        kind = np.int32 if width < 4 else np.int64
        x = np.zeros(n, kind)
        if size:
            raw = np.frombuffer(pa.decompress(packed[at : at + size], n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
            for i in range(width):
                x |= raw[i].astype(kind) << 8 * i
        out.append(x)
        at += size
    return out


def _first(x: np.ndarray) -> np.ndarray:
    """Whether each place of a sorted array differs from that before it."""
    return np.concatenate((np.ones(min(len(x), 1), bool), x[1:] != x[:-1]))


def _sorted(columns: list[np.ndarray], bits: list[int]) -> list[np.ndarray]:
    """The rows of columns, numbers of so many bits, in order: side by side in one number if they fit, as that sorts fastest."""
    if sum(bits) > 63:
        order = np.lexsort(columns[::-1])
        return [x[order] for x in columns]
    key = columns[0].astype(np.int64)
    for x, n in zip(columns[1:], bits[1:], strict=True):
        key <<= n
        key |= x
    key.sort()
    out = []
    for n in bits[::-1]:
        out.append(key & (1 << n) - 1)
        key >>= n
    return out[::-1]


def _ordered(b: np.ndarray, a: np.ndarray, c: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by b, a and c, numbers of so many bits, and where in it a new 3-gram begins."""
    if 3 * bits <= 63:
        key = (b.astype(np.int64) << bits | a) << bits | c
        order = np.argsort(key)
        return order, _first(key[order])
    order = np.lexsort((c, a, b))
    return order, _first(b[order]) | _first(a[order]) | _first(c[order])


def _dealt(buckets: int, hot: dict[int, int], passes: int, turn: int, docs: bool, dictionary=None) -> Callable:
    """(doc, text, lang) to (bucket, block, lot) for the buckets whose turn it is; `dictionary` holds one, as a broadcast value does.

    A block has, packed, its words (differences; see `Dictionary`), places of b, a and c in these for each different 3-gram in order
    (b by lengths of runs), and how often it occurs in each half; with `docs`, the place of each occurrence's document among
    those of the block, and these as twice their place in the lot plus their half (differences). With `docs` each lot has one
    more block, for a bucket -1 - lot of its own, without 3-grams: its documents, and how many words of each were dealt out.
    """
    spread = np.array(sorted(hot), np.int64)
    parts = np.array([hot[b] for b in sorted(hot)], np.uint64)

    def block(words: Dictionary, doc: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> bytes:
        known, at = places(np.concatenate((b, a, c)))
        order, ranks, hashes = words.listed(known)
        b, a, c = np.split(_inverse(order)[at], 3)
        # A document's words stand side by side before they are ordered.
        one = _first(doc) if docs else np.zeros(0, bool)
        number, halves = (np.cumsum(one) - 1, doc[one] & 1) if docs else (doc & 1, np.arange(2))
        bits = (len(known) - 1).bit_length()
        b, a, c, number = _sorted([b, a, c, number], [bits, bits, bits, (len(halves) - 1).bit_length()])
        starts = np.flatnonzero(_first(b) | _first(a) | _first(c))
        n = np.diff(np.append(starts, len(doc)))
        n1 = np.add.reduceat(halves[number], starts)
        b, a, c = b[starts], a[starts], c[starts]
        runs = np.flatnonzero(_first(b))
        out = [hashes, np.diff(b[runs], prepend=0), np.diff(np.append(runs, len(b))), a, c, n - n1, n1]
        if docs:
            out += [number, np.diff(doc[one], prepend=0)]
        return pack([*out, ranks])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary.value if dictionary is not None else NO_WORDS
        context = TaskContext.get()
        lot = (context.partitionId() if context is not None else 0) << 12  # no more lots in a task, or it would hold 6 billion words
        held: list[list[np.ndarray]] = [[], [], [], [], []]
        size = 0

        def row(bucket: int, packed: bytes) -> pa.RecordBatch:
            columns = pa.array([bucket], pa.int32()), pa.array([packed], pa.binary()), pa.array([lot], pa.int32())
            return pa.RecordBatch.from_arrays(list(columns), ["bucket", "block", "lot"])

        def out() -> Iterator[pa.RecordBatch]:
            columns = []
            for x in held:
                columns.append(np.concatenate(x))
                x.clear()
            place = columns.pop(0)
            if docs:
                one = _first(columns[0])
                found, number = columns[0][one], np.cumsum(one) - 1
                n = np.diff(np.append(np.flatnonzero(one), len(one)))
                columns[0] = number << 1 | columns[0] & 1
                split = found.view(np.uint64)  # packing takes no numbers below 0
                none = np.zeros(0, np.int64)
                yield row(-1 - lot, pack([none] * 7 + [split >> np.uint64(32), split & np.uint64(0xFFFFFFFF), n]))
            for bucket, at in _groups(place):
                yield row(bucket, block(words, *(x[at] for x in columns)))

        for doc, a, b, c in _triples(batches):
            group = b.astype(np.uint64)
            if len(spread):
                at = np.minimum(np.searchsorted(spread, b), len(spread) - 1)
                group += np.where(spread[at] == b, mixed(a) % parts[at], np.uint64(0)) * np.uint64(FACTOR)
            place = (mixed(group) % np.uint64(buckets)).astype(np.int16 if buckets < 1 << 15 else np.int32)
            own = np.flatnonzero(place % passes == turn)
            if len(own):
                for x, y in zip(held, (place, doc, a, b, c), strict=True):
                    x.append(y[own])
                size += len(own)
            if size >= HELD:
                yield from out()
                lot, size = lot + 1, 0
        if size:
            yield from out()
        give_back()

    return run


class Bucket:
    """The different 3-grams of the blocks of a bucket with their counts in both halves; words are places in `words`."""

    def __init__(self, blocks: list[bytes], hot: np.ndarray, dictionary: Dictionary):
        parts = [unpack(x) for x in blocks]
        self.words, own = dictionary.together(parts)
        self.bits = max(len(self.words) - 1, 1).bit_length()
        b = np.concatenate([k[np.repeat(np.cumsum(p[1]), p[2])] for k, p in zip(own, parts, strict=True)])
        a, c = (np.concatenate([k[p[i]] for k, p in zip(own, parts, strict=True)]) for i in (3, 4))
        order, new = _ordered(b, a, c, self.bits)
        starts = np.flatnonzero(new)
        self.gram = np.empty(len(order), np.int32)  # of each 3-gram of a block, all blocks side by side
        self.gram[order] = np.cumsum(new) - 1
        counts = [np.concatenate([p[i] for p in parts]) for i in (5, 6)]
        self.times = [p[5] + p[6] for p in parts]
        self.documents = [p[7:-1] for p in parts]
        del parts, own
        self.n = [np.add.reduceat(n[order], starts, dtype=np.int64) for n in counts]
        self.b, self.a, self.c = (x[order][starts] for x in (b, a, c))
        self.lang = self.words >> HASH_BITS
        self.hot = np.isin(self.words, hot)
        pairs = self.b.astype(np.int64) << self.bits | self.c
        places_bits = len(pairs).bit_length()
        if 2 * self.bits + places_bits <= 63:
            # Sorting numbers is faster than finding their order.
            pairs <<= places_bits
            pairs |= np.arange(len(pairs))
            pairs.sort()
            order = pairs & (1 << places_bits) - 1
            pairs >>= places_bits
        else:
            order = np.argsort(pairs)
            pairs = pairs[order]
        new = _first(pairs)
        self.pair = np.empty(len(order), np.int32)
        self.pair[order] = np.cumsum(new) - 1
        pairs = pairs[new]
        self.pair_b, self.pair_c = pairs >> self.bits, pairs & (1 << self.bits) - 1
        self.pair_n = [np.bincount(self.pair, n > 0, len(pairs)).astype(np.int64) for n in self.n]

    def after(self) -> list[np.ndarray]:
        """After how many of its words that are not spread each word stands, in either half."""
        cold = ~self.hot[self.pair_b]
        return [np.bincount(self.pair_c[cold], n[cold] > 0, len(self.words)).astype(np.int64) for n in self.pair_n]


# Either a block, for a share of the words or a bucket, or a number of a language or a word.
FOUND = "part int, bucket int, block binary, kind int, key long, n0 long, n1 long"
TOTAL, AFTER, SIZE, SPREAD_TOTAL, SPREAD_AFTER = 1, 2, 3, 4, 5  # kinds; 10 * order + i: n-grams that occur i times


def _found(blocks: list[tuple[int, int, bytes]], numbers: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    none, n = [None] * len(blocks), sum(len(x[1]) for x in numbers)
    whole = lambda k: np.concatenate([np.zeros(0, np.int64), *(x[k] for x in numbers)]).astype(np.int64).tolist()
    kinds = [x[0] for x in numbers for _ in range(len(x[1]))]
    part, bucket, block = ([x[k] for x in blocks] + [None] * n for k in range(3))
    columns = part, bucket, block, none + kinds, *(none + whole(k) for k in (1, 2, 3))
    types = pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
    return pa.table({f.split()[0]: pa.array(c, t) for f, c, t in zip(FOUND.split(", "), columns, types, strict=True)})


def _occurring(order: int, langs: np.ndarray, counts: list[np.ndarray]) -> list[tuple]:
    found = np.flatnonzero(np.bincount(langs))
    return [(10 * order + i, found, *(np.bincount(langs[m == i], minlength=found[-1] + 1)[found] for m in counts)) for i in (1, 2) if len(found)]


def _summed(kinds: tuple[int, int], keys: np.ndarray, counts: list[np.ndarray]) -> list[tuple]:
    """The sums of the counts by key, and how many are above 0."""
    found, at = places(keys)
    return [(kind, found, *(np.bincount(at, m, len(found)) for m in x)) for kind, x in zip(kinds, (counts, [n > 0 for n in counts]), strict=True)]


def _gathered(hot: np.ndarray, parts: int, dictionary) -> Callable:
    """What a bucket tells: a block for each share of the words, and n-grams of a language that occur once and twice.

    A block has, packed, its last words c (see `Dictionary`) and the numbers of words before each in either half; and
    for pairs of a spread word b and a word c the places of b in `hot` and of c, and the numbers of words before them.
    """

    def run(table: pa.Table) -> pa.Table:
        words = dictionary.value
        x = Bucket(table.column("block").to_pylist(), hot, words)
        bucket, n = table.column("bucket")[0].as_py(), x.after()
        last = np.flatnonzero(np.bincount(x.c, minlength=len(x.words)))
        spread = np.flatnonzero(x.hot[x.pair_b])
        place, pair_place = ((mixed(x.words[k]) % np.uint64(parts)).astype(np.int32) for k in (last, x.pair_c[spread]))
        of_part = dict(_groups(pair_place))
        blocks = []
        for part, at in _groups(place):
            own, pairs = last[at], spread[of_part.get(part, np.zeros(0, np.int64))]
            order, ranks, hashes = words.listed(x.words[own])
            at = np.searchsorted(hot, x.words[x.pair_b[pairs]]), _inverse(order)[np.searchsorted(own, x.pair_c[pairs])]
            own = own[order]
            blocks.append((part, bucket, pack([hashes, n[0][own], n[1][own], *at, x.pair_n[0][pairs], x.pair_n[1][pairs], ranks])))
        cold = ~x.hot[x.pair_b]
        out = _found(blocks, _occurring(3, x.lang[x.b], x.n) + _occurring(2, x.lang[x.pair_b[cold]], [m[cold] for m in x.pair_n]))
        del x
        give_back()
        return out

    return run


def _told(hot: np.ndarray, dictionary) -> Callable:
    """From the blocks of a share of the words what each bucket is told, packed alike: the numbers by all buckets.

    Words that stand in one bucket alone are known there and left out. And the sums of a language and of a spread word.
    """

    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("block").to_pylist()]
        words, own = dictionary.value.together(parts)
        at = np.concatenate(own)
        n = [np.bincount(at, np.concatenate([p[i] for p in parts]), len(words)).astype(np.int64) for i in (1, 2)]
        often = np.bincount(at, minlength=len(words)) > 1
        pairs, pair = places(np.concatenate([p[3].astype(np.int64) << 32 | k[p[4]] for p, k in zip(parts, own, strict=True)]))
        pair_n = [np.bincount(pair, np.concatenate([p[i] for p in parts]), len(pairs)).astype(np.int64) for i in (5, 6)]
        b, c = pairs >> 32, pairs & 0xFFFFFFFF
        for h in (0, 1):
            n[h] += np.bincount(c, pair_n[h] > 0, len(words)).astype(np.int64)
        often[c] = True
        pair = np.split(pair, np.cumsum([len(p[3]) for p in parts])[:-1])
        blocks = []
        for bucket, k, q in zip(table.column("bucket").to_pylist(), own, pair, strict=True):
            k = np.sort(k[often[k]])
            order, ranks, hashes = dictionary.value.listed(words[k])
            at = _inverse(order)[np.searchsorted(k, c[q])]
            k = k[order]
            blocks.append((None, bucket, pack([hashes, n[0][k], n[1][k], b[q], at, pair_n[0][q], pair_n[1][q], ranks])))
        lang = words >> HASH_BITS
        size = np.bincount(lang)
        found = np.flatnonzero(size)
        numbers = [(SIZE, found, size[found], size[found]), *_summed((TOTAL, AFTER), lang, n), *_occurring(1, lang, n)]
        numbers += _occurring(2, lang[c], pair_n) + _summed((SPREAD_TOTAL, SPREAD_AFTER), hot[b], pair_n)
        return _found(blocks, numbers)

    return run


def _interpolated(n, t, u, d, q):
    """Of n-gram count n, context total t with u different words, discount d, and probability q one order below."""
    return np.where(t > 0, (np.maximum(n - d, 0.0) + d * u * q) / np.maximum(t, 1), q)


def _scored(hot: dict[int, tuple], of_lang: dict[int, dict], dictionary) -> Callable:
    """A bucket's blocks and those that it is told, to (lot, block): packed, documents of the lot and their sums of log probabilities.

    The documents of a lot, which come as a bucket of their own, are passed on.

    of_lang: for each half discounts `d` by order, and total `t`, different words `u` and lowest share `q` of single words;
    hot: for each spread word the totals and numbers of different words after it, in either half.
    """
    spread = np.array(sorted(hot), np.int64)
    after_spread = np.array([hot[b] for b in sorted(hot)], np.float64).reshape(-1, 4)

    def run(table: pa.Table, got: pa.Table) -> pa.Table:
        if not table.num_rows or table.column("bucket")[0].as_py() < 0:
            return table.select(["lot", "block"])
        x = Bucket(table.column("block").to_pylist(), spread, dictionary.value)
        n1 = x.after()  # of words that stand in no other bucket
        pairs = x.pair_b.astype(np.int64) << x.bits | x.pair_c
        told = [unpack(block) for block in got.column("block").to_pylist()]
        for p, c in zip(told, dictionary.value.among(x.words, told), strict=True):
            at = np.searchsorted(pairs, np.searchsorted(x.words, spread[p[3]]) << x.bits | c[p[4]])
            for h in (0, 1):
                n1[h][c] = p[1 + h]
                x.pair_n[h][at] = p[5 + h]
        del pairs
        context = np.flatnonzero(_first(x.b) | _first(x.a))
        of_gram = np.cumsum(_first(x.b) | _first(x.a)) - 1
        value = lambda langs, *key: np.array([of_lang.get(i, {}).get(key, 0.0) for i in range(max(of_lang) + 1)])[langs]
        logp = []
        for h in (0, 1):
            q = _interpolated(n1[h], value(x.lang, "t", h), value(x.lang, "u", h), value(x.lang, "d", h, 1), value(x.lang, "q", h))
            n = x.pair_n[h]
            t, u = (np.bincount(x.pair_b, m, len(x.words)) for m in (n, n > 0))
            if len(spread):
                own = np.flatnonzero(x.hot)
                t[own], u[own] = after_spread[np.searchsorted(spread, x.words[own])][:, [h, 2 + h]].T
            q = _interpolated(n, t[x.pair_b], u[x.pair_b], value(x.lang[x.pair_b], "d", h, 2), q[x.pair_c])
            n = x.n[h]
            t, u = (np.add.reduceat(m, context)[of_gram] for m in (n, (n > 0).astype(np.int64)))
            logp.append(np.log(_interpolated(n, t, u, value(x.lang[x.b], "d", h, 3), q[x.pair])))
        blocks, first = [], 0
        for n, (number, found) in zip(x.times, x.documents, strict=True):
            found = np.cumsum(found, dtype=np.int64)
            gram = np.repeat(x.gram[first : first + len(n)], n)
            first += len(n)
            # By the other half.
            sums = np.bincount(number, np.where(found[number] & 1, logp[0][gram], logp[1][gram]), len(found))
            # Doubles from 0 are in the order of their bits, which pack as whole numbers.
            blocks.append(pack([np.diff(found >> 1, prepend=0), (np.maximum(-sums, 0.0) + 0.0).view(np.int64)]))
        out = pa.table({"lot": table.column("lot"), "block": pa.array(blocks, pa.binary())})
        del x
        give_back()
        return out

    return run


def _summed_up(table: pa.Table) -> pa.Table:
    """The blocks of a lot of documents to (doc, words, sum of log probabilities)."""
    parts = [unpack(x) for x in table.column("block").to_pylist()]
    high, low, n = next(p[7:] for p in parts if len(p) > 2)
    sums = np.zeros(len(n))
    for p in parts:
        if len(p) == 2:
            sums[np.cumsum(p[0], dtype=np.int64)] -= p[1].astype(np.int64).view(np.float64)
    doc = (high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)).view(np.int64)
    return pa.table({"doc": doc, "n": n.astype(np.int64), "logp": sums})


def _discount(once: float, twice: float) -> float:
    """n1 / (n1 + 2 n2), 0.5 where no n-gram occurs once."""
    return once / (once + 2 * twice) if once else 0.5


def log_perplexities(rows: DataFrame, bucket: int = BUCKET, passes: tuple[int, int] = PASSES) -> DataFrame:
    """(doc, word_log_perplexity) of the texts of rows (doc, text, lang number); doc is a digest of text and language.

    Rows of the same doc are copies and give one row of the result. Texts without words give none.
    """
    spark = rows.sparkSession
    ship(spark)
    with freeing_shuffles(spark):
        # At most NAMED rows a task; those most often, up to DICTIONARY, and those to be spread come to the driver.
        frequent = keep(map_batches(rows, _frequent, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")))
        least, listed = 1 << 62, 0
        for n, k in sorted((tuple(r) for r in frequent.where("b >= 0").groupBy("n").count().collect()), reverse=True):
            listed += k
            if listed > DICTIONARY:
                break
            least = n
        numbered = frequent.where((F.col("b") >= 0) & (F.col("n") >= least)).toArrow()
        numbered, times = (numbered.column(c).to_numpy() for c in ("b", "n"))
        numbered = numbered[np.lexsort((numbered, -times))]
        frequent = {r.b: r.n for r in frequent.where((F.col("b") == -1) | (4 * F.col("n") > bucket)).collect()}
        buckets = -(-frequent.pop(-1, 0) // bucket) or 1
        parts = {b: -(-4 * n // bucket) for b, n in frequent.items()}
        spread = np.array(sorted(parts), np.int64)
        dictionary = spark.sparkContext.broadcast(Dictionary(numbered))

        def dealt(turn: int, of: int, docs: bool):
            return map_batches(rows, _dealt(buckets, parts, of, turn, docs, dictionary), "bucket int, block binary, lot int").groupBy("bucket")

        union = lambda tables: reduce(DataFrame.unionByName, tables)
        first, second = (min(n, buckets) for n in passes)
        counted = [keep(dealt(i, first, False).applyInArrow(_gathered(spread, buckets, dictionary), FOUND)) for i in range(first)]
        found = union(counted)
        told = keep(found.where("part IS NOT NULL").select("part", "bucket", "block").groupBy("part").applyInArrow(_told(spread, dictionary), FOUND))
        # A row per language or spread word, and kind.
        numbers = found.where("kind IS NOT NULL").unionByName(told.where("kind IS NOT NULL")).groupBy("kind", "key").agg(F.sum("n0"), F.sum("n1"))
        numbers = {(r[0], r[1]): (r[2], r[3]) for r in numbers.collect()}
        for table in counted:
            discard(table)  # told has it all
        of_lang = {}
        for lang in [key for kind, key in numbers if kind == SIZE]:
            get = lambda kind, h, lang=lang: numbers.get((kind, lang), (0, 0))[h]
            own = of_lang[lang] = {}
            for h in (0, 1):
                # The lowest order backs off to an equal share for each word of the language and one more.
                own |= {("t", h): get(TOTAL, h), ("u", h): get(AFTER, h), ("q", h): 1 / (get(SIZE, h) + 1)}
                own |= {("d", h, k): _discount(get(10 * k + 1, h), get(10 * k + 2, h)) for k in (1, 2, 3)}
        hot = {b: numbers[SPREAD_TOTAL, b] + numbers[SPREAD_AFTER, b] for b in parts}

        def scored(turn: int) -> DataFrame:
            got = told.where((F.col("kind").isNull()) & (F.col("bucket") % second == turn)).select("bucket", "block").groupBy("bucket")
            made = dealt(turn, second, True).cogroup(got).applyInArrow(_scored(hot, of_lang, dictionary), "lot int, block binary")
            made = made.groupBy("lot").applyInArrow(_summed_up, "doc long, n long, logp double")
            return keep(made.groupBy("doc").agg(F.sum("n").alias("n"), F.sum("logp").alias("logp")))

        made = union([scored(i) for i in range(second)]).groupBy("doc").agg(F.sum("n").alias("n"), F.sum("logp").alias("logp"))
        return keep(made.select("doc", F.round(-F.col("logp") / F.col("n"), 6).alias("word_log_perplexity")))
