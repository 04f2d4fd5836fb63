"""Toxic spans by a linear-chain conditional random field over words, and document scores from its marginals.

Labels exist for documents only, so training has two steps, both on a bounded sample of labelled rows (`toxic_docs` and
`clean_docs` rows as expected, picked by a hash of the id). First Spark counts in how many documents of either label each
feature occurs: a word, its beginnings of 3 to 6 letters and its last 4 letters. A feature is used if a likelihood-ratio
test finds it typical of toxic documents, at a level that allows for the number of features tested. Words of toxic documents
with such a feature are tagged toxic, all others clean. Then the field learns, by gradient steps on windows around tagged
words, a weight per feature, a bias, and weights for each pair of neighbouring tags.

Words without a used feature all have the same potentials, so a run of k of them is the k-th power of one 2x2 matrix. The
forward and backward passes are therefore exact over whole texts, yet only stop at words with features.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.decontaminate import NORMAL, places
from headway.llm.shared import Memo, keep, map_batches, once, over_texts

TOXIC_DOCS, CLEAN_DOCS = 3000, 12000
MOST_FEATURES = 20_000
AROUND = 8
WINDOWS_PER_DOC = 4
STEPS, RATE, DECAY = 200, 0.1, 1e-4


def features(word: str) -> list[str]:
    """Of a lower-case word: itself, its beginnings of 3 to 6 letters, its last 4 letters."""
    if len(word) > 40:
        return []
    found = ["=" + word]
    found += ["^" + word[:k] for k in range(3, min(7, len(word)))]
    if len(word) > 4:
        found.append("$" + word[-4:])
    return found


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of a-z, digits and characters beyond ASCII, A-Z lower-cased."""
    return text.translate(NORMAL).split() if text else []


def held_out(id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 2 by 4. A null id counts as the text ''."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, toxic_docs: int, clean_docs: int) -> DataFrame:
    """(text, toxic) of sampled labelled documents. A repeated id counts once, as toxic if any of its labels is."""
    rows = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(F.col(id)))
    rows = rows.groupBy(F.col(id).alias("id")).agg((F.max(label) > 0).alias("toxic"))
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    wanted = {True: toxic_docs, False: clean_docs}
    drawn = F.lit(False)
    for toxic, n in sizes.items():
        share = int(min(1.0, wanted[toxic] / n) * (1 << 20))
        drawn = drawn | ((F.col("toxic") == toxic) & (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share))
    # Bounded by the two parameters, so it may go to every task.
    chosen = F.broadcast(rows.where(drawn))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text"))
    return texts.join(chosen, "id").groupBy("id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).drop("id")


def without_copies(rows: DataFrame) -> DataFrame:
    """One row of each set of texts whose 3-word shingles have the same smallest, or the same largest, hash.

    Copies would make every rare word of a toxic text look typical. Nearly equal texts agree in such a hash with a chance
    that equals their shingles' similarity.
    """

    def work(texts):
        low, high = [], []
        for text in texts:
            words = words_of(text)
            hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3])) >> 1 for i in range(max(1, len(words) - 2))]
            low.append(min(hashes))
            high.append(max(hashes))
        return [low, high]

    rows = rows.withColumn("hash", over_texts(lambda: work, low="long", high="long")(F.col("text"))).select("text", "toxic", "hash.*")
    for side in ("low", "high"):
        rows = rows.groupBy(side).agg(F.min(F.struct("text", "toxic", *({"low", "high"} - {side}))).alias("one")).select(side, "one.*")
    return rows.select("text", "toxic")


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) to (feature, toxic documents, clean documents), added up within the task."""
    counts = {True: Counter(), False: Counter()}
    known = Memo(lambda w: features(w.decode().lower()))
    for batch in batches:
        for text, toxic in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[toxic].update({f for w in set(words_of(text)) for f in known[w]})
    names = list(counts[True].keys() | counts[False].keys())
    for at in range(0, len(names), 100_000):
        part = names[at : at + 100_000]
        columns = [pa.array(part), *(pa.array([counts[t][f] for f in part], pa.int64()) for t in (True, False))]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "clean"])


def typical_features(rows: DataFrame, most: int = MOST_FEATURES) -> dict[str, float]:
    """Features typical of toxic documents with the share of toxic ones among documents that have them, both labels weighing alike."""
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    a, b = sizes.get(True, 0), sizes.get(False, 0)
    if not a or not b:
        return {}
    counts = map_batches(rows, _document_counts, "feature string, toxic long, clean long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    tested = keep(counts.where("toxic >= 3"))
    number = tested.count()
    both = F.col("toxic") + F.col("clean")
    x, y = F.col("toxic"), F.col("clean")
    gain = 2 * (x * F.log(x * (a + b) / (both * a)) + F.when(y > 0, y * F.log(F.greatest(y, F.lit(1)) * (a + b) / (both * b))).otherwise(0.0))
    share = (x / a) / (x / a + y / b)
    found = tested.where((share > 0.8) & (gain > 2 * math.log(max(number, 2)))).select("feature", share.alias("share"), gain.alias("gain"))
    return {r.feature: r.share for r in found.orderBy(F.desc("gain"), "feature").limit(most).collect()}


@dataclass
class Field:
    """Weights of the tag toxic against clean (features, bias), and of neighbouring tags. A text begins after a clean tag."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    pairs: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])


def windows(text: bytes, toxic: bool, number: dict[str, int]) -> list[tuple[list[list[int]], list[int]]]:
    """Windows of a training text: feature numbers and tags of each word."""
    found = [[number[f] for f in features(w.decode().lower()) if f in number] for w in words_of(text)]
    if not found:
        return []
    marked = [i for i, fs in enumerate(found) if fs]
    centres, last = [], -math.inf
    for i in marked:
        if i - last > 2 * AROUND and len(centres) < WINDOWS_PER_DOC:
            centres.append(i)
            last = i
    if not marked:
        centres = [len(found) // 2]
    return [
        (part := found[max(0, c - AROUND) : c + AROUND + 1], [int(toxic and bool(fs)) for fs in part]) for c in centres
    ]


def train(rows: DataFrame, most: int = MOST_FEATURES) -> Field:
    """The field of a bounded sample (text, toxic); without both labels, or without typical features, an empty one."""
    typical = typical_features(rows, most)
    if not typical:
        return Field(bias=-math.inf)
    names = sorted(typical)
    number = {f: i for i, f in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                w
                for text, toxic in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for w in windows(text, toxic, number)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w[0] for w in out], pa.list_(pa.list_(pa.int32()))), pa.array([w[1] for w in out], pa.list_(pa.int32()))],
                ["features", "tags"],
            )

    # At most WINDOWS_PER_DOC windows for each document of the sample. Sorted, so that sums do not depend on the order of tasks.
    table = map_batches(rows, cut, "features array<array<int>>, tags array<int>").toArrow()
    pairs = sorted(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True))
    return fit(pairs, names)


def fit(pairs: list[tuple[list[list[int]], list[int]]], names: list[str]) -> Field:
    """Maximum likelihood with a small quadratic penalty, by Adam steps over all windows at once."""
    length = 2 * AROUND + 1
    n = len(pairs)
    tags, inside = np.zeros((length, n), np.int64), np.zeros((length, n), bool)
    at_t, at_w, at_f = [], [], []
    for w, (rows, own) in enumerate(pairs):
        for t, fs in enumerate(rows):
            tags[t, w], inside[t, w] = own[t], True
            at_t += [t] * len(fs)
            at_w += [w] * len(fs)
            at_f += fs
    at_t, at_w, at_f = np.array(at_t, np.int64), np.array(at_w, np.int64), np.array(at_f, np.int64)
    size = len(names)
    x = np.zeros(size + 5)  # feature weights, bias, pairs (0,0), (0,1), (1,0), (1,1); (0,0) stays 0
    seen = tags[at_t, at_w]
    observed = np.zeros(size + 5)
    np.add.at(observed, at_f, seen)
    observed[size] = (tags * inside).sum()
    before = np.concatenate((np.zeros((1, n), np.int64), tags[:-1]))
    for k, (p, q) in enumerate(((0, 1), (1, 0), (1, 1)), size + 2):
        observed[k] = ((before == p) & (tags == q) & inside).sum()
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        own = np.full((length, n), x[size])
        np.add.at(own, (at_t, at_w), x[at_f])
        moves = np.exp(np.array([[0.0, x[size + 2]], [x[size + 3], x[size + 4]]]))
        own = np.exp(np.clip(own, -30, 30))
        forward, backward = np.zeros((length, n, 2)), np.ones((length, n, 2))
        state = np.tile([1.0, 0.0], (n, 1))
        for t in range(length):
            new = state @ moves
            new[:, 1] *= own[t]
            new /= new.sum(axis=1, keepdims=True)
            state = np.where(inside[t][:, None], new, state)
            forward[t] = state
        for t in range(length - 1, 0, -1):
            ahead = backward[t].copy()
            ahead[:, 1] *= own[t]
            new = ahead @ moves.T
            new /= new.sum(axis=1, keepdims=True)
            backward[t - 1] = np.where(inside[t][:, None], new, backward[t])
        expected = np.zeros_like(x)
        tag = forward * backward
        tag /= tag.sum(axis=2, keepdims=True)
        np.add.at(expected, at_f, tag[at_t, at_w, 1])
        expected[size] = (tag[:, :, 1] * inside).sum()
        previous = np.concatenate((np.tile([1.0, 0.0], (1, n, 1)), forward[:-1]))
        after = backward.copy()
        after[:, :, 1] *= own
        pair = previous[:, :, :, None] * moves[None, None] * after[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        total = (pair * inside[:, :, None, None]).sum(axis=(0, 1))
        expected[size + 2 :] = total[0, 1], total[1, 0], total[1, 1]
        slope = (observed - expected) / n - DECAY * x
        slope[size + 1] = 0
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        x += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Field(dict(zip(names, x[:size].tolist(), strict=True)), float(x[size]), [[0.0, float(x[size + 2])], [float(x[size + 3]), float(x[size + 4])]])


class Tagger:
    """Marginals of the tag toxic over whole texts."""

    def __init__(self, model: Field):
        self.model = model
        self.moves = [[math.exp(v) for v in row] for row in model.pairs]
        (a, b), (c, d) = self._step(0.0)
        root = math.sqrt((a - d) ** 2 + 4 * b * c)
        first, second = (a + d + root) / 2, (a + d - root) / 2
        self.ratio = second / first
        self.main = [(a - second) / root, b / root, c / root, (d - second) / root]
        self.fading = [(first - a) / root, -b / root, -c / root, (first - d) / root]
        self.seen = Memo(self._own)
        self.powers = [self._power(k) for k in range(256)]

    def _own(self, word: bytes) -> float | None:
        """Summed weights of a word's features; None without any."""
        own = [self.model.weights[f] for f in features(word.decode().lower()) if f in self.model.weights]
        return sum(own) if own else None

    def _step(self, own: float) -> tuple[tuple[float, float], tuple[float, float]]:
        e = math.exp(max(-30.0, min(30.0, self.model.bias + own)))
        (a, b), (c, d) = self.moves
        return (a, b * e), (c, d * e)

    def _power(self, k: int) -> tuple[float, float, float, float]:
        """k steps over words without features, up to a factor."""
        r = self.ratio**k
        return tuple(max(0.0, m + r * f) for m, f in zip(self.main, self.fading, strict=True))

    def marginals(self, text: bytes | None) -> list[tuple[int, float]]:
        """(word number, probability of the tag toxic) for the words with features."""
        words = words_of(text)
        marked = [(i, own) for i, own in enumerate(map(self.seen.__getitem__, words)) if own is not None]
        forward, x, y, last = [], 1.0, 0.0, -1
        for i, own in marked:
            if i - last > 1:
                a, b, c, d = self._far(i - last - 1)
                x, y = x * a + y * c, x * b + y * d
            (a, b), (c, d) = self._step(own)
            x, y = x * a + y * c, x * b + y * d
            x, y = x / (x + y), y / (x + y)
            forward.append((x, y))
            last = i
        out, x, y, last = [], 1.0, 1.0, len(words)
        for (i, own), (p, q) in zip(reversed(marked), reversed(forward), strict=True):
            if last - i > 1:
                a, b, c, d = self._far(last - i - 1)
                x, y = a * x + b * y, c * x + d * y
            out.append((i, q * y / (p * x + q * y)))
            (a, b), (c, d) = self._step(own)
            x, y = a * x + b * y, c * x + d * y
            x, y = x / (x + y), y / (x + y)
            last = i
        return out[::-1]

    def _far(self, k: int) -> tuple[float, float, float, float]:
        return self.powers[k] if k < 256 else self._power(k)


def scored(model: Field, least: float = 0.5):
    """Spark function of a text: score (the chance that any word is toxic, taking words as independent), places of toxic words, n_toxic."""
    key = uuid.uuid4().hex

    def start():
        tagger = once(key, lambda: Tagger(model)) if model.weights else None

        def work(texts):
            columns = [[], [], []]
            for text in texts:
                found = tagger.marginals(text) if tagger and text else []
                clean = 1.0
                for _, p in found:
                    clean *= 1.0 - p
                runs = [(i, i + 1) for i, p in found if p >= least]
                flat = [x for place in places(text, runs) for x in place] if runs else []
                for column, value in zip(columns, (min(1.0, max(0.0, 1.0 - clean)), flat, len(runs)), strict=True):
                    column.append(value)
            return columns

        return work

    return over_texts(start, score="double", places="array<long>", n_toxic="long")


def learned_from(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS
) -> Field:
    """The field learned from labelled rows that are not held out; rows without id, text or label teach nothing."""
    return train(keep(without_copies(sample(docs, labels, id, text, label, toxic_docs, clean_docs))))


def score(docs: DataFrame, model: Field, text: str = "text", into: str = "toxicity") -> DataFrame:
    """`docs` with the struct `into`: score (0 to 1), places of toxic words (start, end pairs in code points), n_toxic.

    Null and empty texts, and texts without a word that has a learned feature, score 0. Repeated rows give repeated rows,
    an empty table an empty one; a column called like `into` is replaced, others stay and are not read.
    """
    return docs.withColumn(into, scored(model)(F.col(text)))
