"""Ranked lexical search: the best documents for each of many queries, by a hybrid of term-at-a-time and document-at-a-time.

Two passes over the documents and no shuffle of their words. The first counts what the weights need: documents, words, and the
documents of each query term. In the second a task indexes its documents in chunks and answers every query on each chunk:

- The query's short lists are read whole, term at a time, and summed into accumulators; these are one iterator over documents,
  bounded by its greatest sum.
- This iterator and the long lists are then read document at a time, over ranges of documents. Iterators whose bounds together
  stay below the query's 10th best score so far cannot lift a document into the result alone: they are skipped through, and
  looked up only for documents of the others that may still get there with them.

The 10th best score is carried from chunk to chunk, so a chunk whose bounds stay below is passed over. Each task gives its
best for each query; Spark ranks these. Queries are sent to the tasks in blocks of bounded size, one block after the other.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from headway.llm.decontaminate import NORMAL
from headway.llm.shared import give_back, keep, map_batches, once

TOP = 10
SHORT = 1024
RANGE = 2048
CHUNK = 2_000_000
STRETCH = 1_000_000
BLOCK_BYTES = 4_000_000


def word_runs(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, in runs for the stretches of a long one."""
    line, at = (text or b"").translate(NORMAL), 0
    while len(line) - at > STRETCH and (cut := line.find(b" ", at + STRETCH)) >= 0:
        yield line[at:cut].split()
        at = cut
    yield line[at:].split()


def terms(text: bytes | None) -> list[bytes]:
    """Distinct terms of a query, in order."""
    return list(dict.fromkeys(w for run in word_runs(text) for w in run))


def weight(documents: int, holding: int) -> int:
    """Weight of a term that `holding` of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def blocks(queries: DataFrame, id: str, text: str, most: int) -> Iterator[list[tuple]]:
    """Queries with terms as (id, terms), in blocks of at most `most` bytes and one query, one Spark partition at a time."""
    block, size = [], 0
    for row in queries.where(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text")).toLocalIterator():
        found = terms(row.text.encode())
        if not found:
            continue
        block.append((row.id, found))
        size += len(row.text)
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def _statistics(key: str, asked: list[list[bytes]]):
    """(term, n) for the terms of a block: documents that hold it. Term null: documents with terms; empty: all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = once(f"wanted {key}", lambda: frozenset(w for q in asked for w in q))
        holding, documents, words = Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                n, found = 0, set()
                for run in word_runs(text):
                    n += len(run)
                    found |= wanted.intersection(run)
                documents, words = documents + (n > 0), words + n
                holding.update(found)
        give_back()
        names = pa.array([None, b"", *holding], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([names, pa.array([documents, words, *holding.values()], pa.int64())], ["term", "n"])

    return run


class Best:
    """The best (score, id) of a query: highest scores first, equal ones by id, ids that are null first."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.known, self.ids = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        """What a document must score to be looked at: the last score, so that equal ones still compete by id."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        scores, known, ids = (np.concatenate(x) for x in ((self.scores, scores), (self.known, known), (self.ids, ids)))
        order = np.lexsort((ids, known, -scores))[: self.top]
        self.scores, self.known, self.ids = scores[order], known[order], ids[order]


class Chunk:
    """An index over some documents: for each term its documents in order, with what it adds to their scores."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, lengths: np.ndarray, weights: np.ndarray, documents: int, words: int):
        n = len(lengths)
        code, tf = np.unique(term.astype(np.int64) * n + doc, return_counts=True)
        posted, self.docs = np.divmod(code, n)
        m = 10 + 90 * lengths * documents // words
        self.scores = weights[posted] * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.docs]))
        self.begin = np.searchsorted(posted, np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(self.begin))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.scores, self.begin[held])
        self.n = n

    def posting(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.begin[term], self.begin[term + 1])
        return self.docs[at], self.scores[at]

    def summed(self, some: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Accumulators of short lists: their documents in order, with the sum of their scores."""
        docs = np.concatenate([self.posting(t)[0] for t in some])
        order = np.argsort(docs, kind="stable")
        docs, scores = docs[order], np.concatenate([self.posting(t)[1] for t in some])[order]
        first = np.flatnonzero(np.diff(docs, prepend=-1))
        return docs[first], np.add.reduceat(scores, first)

    def search(self, query: list[int], best: Best, known: np.ndarray, ids: np.ndarray, short: int = SHORT, width: int = RANGE) -> int:
        """Puts the chunk's best documents for a query into `best`; gives the number of postings that were summed or met."""
        sizes = {t: int(self.begin[t + 1] - self.begin[t]) for t in query}
        few = [t for t in query if 0 < sizes[t] <= short]
        lists = [(int(self.most[t]), *self.posting(t)) for t in query if sizes[t] > short]
        if sum(x[0] for x in lists) + sum(int(self.most[t]) for t in few) < best.floor:
            return 0
        seen = sum(sizes[t] for t in few)
        if few:
            docs, scores = self.summed(few)
            lists.append((int(scores.max()), docs, scores))
        lists.sort(key=lambda x: x[0])
        bounds = np.cumsum([x[0] for x in lists])
        for low in range(0, self.n, width):
            floor = best.floor
            # Iterators before this one cannot reach the floor together.
            needed = int(np.searchsorted(bounds, floor))
            if needed == len(lists):
                break
            sums = np.zeros(min(width, self.n - low), np.int64)
            for _, docs, scores in lists[needed:]:
                a, b = np.searchsorted(docs, (low, low + width))
                sums[docs[a:b] - low] += scores[a:b]
                seen += int(b - a)
            found = np.flatnonzero(sums)
            for i in range(needed - 1, -1, -1):
                found = found[sums[found] + bounds[i] >= floor]
                if not len(found):
                    break
                _, docs, scores = lists[i]
                at = np.minimum(np.searchsorted(docs, found + low), len(docs) - 1)
                met = docs[at] == found + low
                sums[found[met]] += scores[at[met]]
                seen += len(found)
            found = found[sums[found] >= floor]
            if len(found):
                best.add(sums[found], known[found + low], ids[found + low])
        return seen


def _searcher(key: str, asked: list[list[bytes]], weights: dict[bytes, int], documents: int, words: int, top: int, chunk: int, short: int, width: int):
    def vocabulary():
        index = {w: i for i, w in enumerate(weights)}
        return index, np.array([*weights.values()], np.int64), [[index[w] for w in q if w in index] for q in asked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weighed, queries = once(f"queries {key}", vocabulary)
        best = [Best(top) for _ in queries]
        held: list[tuple] = []  # (id, number of words, numbers of the query terms in it)

        def flush() -> None:
            numbers = np.fromiter((len(x[2]) for x in held), np.int64, len(held))
            if numbers.any():
                known = np.fromiter((x[0] is not None for x in held), bool, len(held))
                ids = np.fromiter((x[0] or 0 for x in held), np.int64, len(held))
                lengths = np.fromiter((x[1] for x in held), np.int64, len(held))
                doc = np.repeat(np.arange(len(held)), numbers)
                index = Chunk(np.concatenate([x[2] for x in held]), doc, lengths, weighed, documents, words)
                for query, found in zip(queries, best):
                    index.search(query, found, known, ids, short, width)
            held.clear()
            give_back()

        size = 0
        for batch in batches:
            for id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                n, numbers = 0, []
                for run in word_runs(text):
                    n += len(run)
                    numbers.append(np.fromiter((index[w] for w in run if w in index), np.int32))
                if n:
                    held.append((id, n, np.concatenate(numbers)))
                    size += len(held[-1][2]) + 16
                if size >= chunk:
                    flush()
                    size = 0
        flush()
        number = pa.array(np.repeat(np.arange(len(best)), [len(b.scores) for b in best]), pa.int64())
        ids = pc.if_else(pa.array(np.concatenate([b.known for b in best])), pa.array(np.concatenate([b.ids for b in best])), None)
        yield pa.RecordBatch.from_arrays([number, ids, pa.array(np.concatenate([b.scores for b in best]))], ["query", "doc", "score"])

    return run


def search(
    docs: DataFrame,
    queries: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    chunk: int = CHUNK,
    short: int = SHORT,
    width: int = RANGE,
) -> DataFrame:
    """The `top` documents of every query with a score above 0: `query_id`, rank (int, from 1), `id` (long), score (long).

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; each term of a query counts once. Equal
    scores rank by ascending id, null ids first. Texts that are null or have no term are no documents, and as queries give
    no row. Every row is a document of its own and every query row a query of its own, whatever ids repeat. Empty tables on
    either side give an empty result. Other columns are not read. Ids must be whole numbers. `block_bytes` (query text sent
    at a time), `chunk` (query terms that a task indexes at a time), `short` (postings of a list that is summed whole) and
    `width` (documents of a range) change the work, never the result.
    """
    spark = docs.sparkSession
    texts = docs.where(F.col(text).isNotNull()).select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"))
    schema = StructType([StructField("query", LongType()), StructField("query_id", queries.schema[query_id].dataType)])
    found = []
    for block in blocks(queries, query_id, query_text, block_bytes):
        key, asked = uuid.uuid4().hex, [q for _, q in block]
        counted = map_batches(texts.select("text"), _statistics(key, asked), "term string, n long")
        numbers = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}
        documents, words = numbers.pop(None, 0), numbers.pop("", 0)
        if not documents:
            break
        weights = {t.encode(): weight(documents, n) for t, n in numbers.items()}
        run = _searcher(key, asked, weights, documents, words, top, chunk, short, width)
        best = map_batches(texts, run, "query long, doc long, score long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(n, q) for n, (q, _) in enumerate(block)], schema)
        found.append(keep(ranked.join(names, "query").select("query_id", "rank", "doc", "score")))
    if not found:
        found = [spark.createDataFrame([], schema).selectExpr("query_id", "0 AS rank", "0L AS doc", "0L AS score")]
    every = reduce(DataFrame.unionByName, found)
    return every.select(F.col("query_id").alias(query_id), "rank", F.col("doc").alias(id), "score")
