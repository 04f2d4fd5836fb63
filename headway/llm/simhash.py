"""Near duplicates by SimHash fingerprints, found with an inverted index on fingerprint bytes.

Two fingerprints with at most three differing bits agree in at least five of their eight bytes, so in at least four of the
first seven. The index has a posting for each choice of four of these positions, under the bytes that stand there. A pair
that meets in a posting list has its shared positional bytes tallied, goes on with five or more, and is then verified.

A list longer than `limit` is not compared pairwise: its members go into finer lists. The bits not yet fixed by the list's
key are cut into four runs; a pair with three differing bits agrees in one of them, so four finer keys find it again.
Fingerprints are distinct and 64 bits long, so after three rounds a list has at most 2^14 members: nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.shared import keep, map_batches, over_texts

BITS = 3
SHARED_BYTES = 8 - BITS
SEED = 42
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SMALLEST_FREE = 14


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text as a signed number; 0 for null and for texts without words.

    Words are runs of other than ASCII white space, A-Z lower-cased; a text of fewer words than a shingle is one shingle.
    """
    words = text.translate(LOWER).split() if text else ()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    ends = ends[-n:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts[at : at + 65536], ends[at : at + 65536])]
        big = np.array(hashes, np.uint64).astype(">u8")
        counts += np.unpackbits(big.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def add_fingerprints(docs: DataFrame, text: str = "text", into: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """`docs` with the fingerprint of `text`, as a long, in the new column `into`."""
    of = over_texts(lambda: lambda texts: [[fingerprint(t, shingle) for t in texts]], fp="long")
    return docs.withColumn(into, of(F.col(text))["fp"])


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def byte_masks() -> list[int]:
    """One mask for each choice of one byte fewer than must be shared, of the first seven."""
    return [_signed(sum(0xFF << 8 * (7 - p) for p in c)) for c in combinations(range(7), SHARED_BYTES - 1)]


def finer_masks(mask: int) -> list[int]:
    """The mask with one of four runs of its free bits added."""
    free = [b for b in range(64) if not (mask >> b) & 1]
    return [_signed((mask % (1 << 64)) | sum(1 << b for b in run.tolist())) for run in np.array_split(free, BITS + 1) if len(run)]


def _groups(x: np.ndarray) -> list[tuple[int, int]]:
    """(member, first member) for the members of each group of linked fingerprints, without its first."""
    found = []
    left = x
    while len(left) > 1:
        first, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            for at in range(0, len(front), 64):
                differ = front[at : at + 64, None] ^ left[None, :]
                shared = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=2)
                hit |= ((shared >= SHARED_BYTES) & (np.bitwise_count(differ) <= BITS)).any(axis=0)
            front, left = left[hit], left[~hit]
            found += [(int(m), int(first)) for m in front.view(np.int64)]
    return [(m, int(np.uint64(f).view(np.int64))) for m, f in found]


LINKS = "overfull boolean, a long, b long"


def _link_lists(limit: int):
    """Rows sorted by list to links (fingerprint, first of its group); members of overfull lists come out as (mask, fingerprint)."""

    def out(overfull: bool, pairs: list) -> pa.RecordBatch:
        a, b = zip(*pairs, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([overfull] * len(pairs), pa.bool_()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
            ["overfull", "a", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, over = None, [], False
        for batch in batches:
            if not batch.num_rows:
                continue
            mask, value, fp = (batch.column(i).to_numpy() for i in range(3))
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
            begins, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(fp)]))
            many = np.flatnonzero(ends - begins > 1).tolist()
            # The first and last list of a batch may go on in its neighbours.
            for i in sorted({0, len(begins) - 1, *many}):
                s, e = begins[i], ends[i]
                this = (mask[s], value[s])
                if this != key:
                    if held and not over and (pairs := _groups(np.concatenate(held))):
                        yield out(False, pairs)
                    key, held, over = this, [], False
                held.append(fp[s:e].view(np.uint64))
                if sum(map(len, held)) > limit or over:
                    over = True
                    rows = np.concatenate(held).view(np.int64).tolist()
                    held = []
                    for at in range(0, len(rows), 50_000):
                        yield out(True, [(int(mask[s]), f) for f in rows[at : at + 50_000]])
        if held and not over and (pairs := _groups(np.concatenate(held))):
            yield out(False, pairs)

    return run


def links(distinct: DataFrame, limit: int = 2048) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` at most three bits apart, enough to connect every linked group.

    Within a list, a member links to the first of its group, so a list of n members gives fewer than n links.
    """

    def listed(rows: DataFrame, most: int) -> DataFrame:
        lists = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
        sorted_lists = lists.repartition("mask", "value").sortWithinPartitions("mask", "value")
        return keep(map_batches(sorted_lists, _link_lists(most), LINKS))

    rows = distinct.select(F.explode(F.array([F.lit(m) for m in byte_masks()])).alias("mask"), "fp")
    found, free = [], 8 * (8 - SHARED_BYTES + 1)
    while True:
        last = free <= SMALLEST_FREE
        result = listed(rows, 1 << SMALLEST_FREE if last else limit)
        found.append(result.where("not overfull").select("a", "b"))
        overfull = result.where("overfull").select(F.col("a").alias("mask"), F.col("b").alias("fp"))
        if last or overfull.isEmpty():
            break
        # Few masks occur: each is one choice of positions, refined by rule.
        masks = [r.mask for r in overfull.select("mask").distinct().toLocalIterator()]
        finer = {m: finer_masks(m) for m in masks}
        choice = F.create_map([x for m, ms in finer.items() for x in (F.lit(m), F.array([F.lit(f) for f in ms]))])
        rows = overfull.select(F.explode(choice[F.col("mask")]).alias("mask"), "fp").distinct()
        free = max(64 - (f % (1 << 64)).bit_count() for ms in finer.values() for f in ms)
    return reduce(DataFrame.unionAll, found)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the smallest node reachable.

    Alternating star steps: each joins a node's neighbours to its smallest one. Steps end when no edge changes; the state
    between two steps is a table in the shared folder. Smallest neighbours are combined before the shuffle.
    """
    now = keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large.where("u > v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small, "u")
        nxt = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = keep(nxt.unionAll(small.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a checksum; equal marks mean equal edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))).first())


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, limit: int = 2048) -> DataFrame:
    """One row per document: `id`, fingerprint (long) and component_id, the smallest id that links of near texts reach.

    Exact copies share a fingerprint and enter the index once. Null, empty and wordless texts have fingerprint 0 and link
    like any other. Repeated rows give repeated rows; a group without any id has component_id null. An empty table gives
    an empty one. Other columns are not read.
    """
    found = _grouped(docs, id, text, shingle, limit)
    return found.select(F.col("id").alias(id), F.col("fp").alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, id: str, text: str, shingle: int, limit: int) -> DataFrame:
    """(id, fp, component_id, root): as above, with the smallest fingerprint of the group, which names it."""
    prints = keep(
        add_fingerprints(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "text", "fp", shingle).select("id", "fp")
    )
    own = keep(prints.groupBy("fp").agg(F.min("id").alias("first")))
    groups = components(links(own.select("fp"), limit)).withColumnRenamed("node", "fp")
    firsts = groups.join(own, "fp").groupBy("root").agg(F.min("first").alias("component"))
    linked = groups.join(firsts, "root").select("fp", "component", "root")
    table = own.join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "first").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return prints.join(table, "fp").select("id", "fp", "component_id", "root")


def _unused(name: str, columns: list[str]) -> str:
    while name in columns:
        name += "_"
    return name


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, limit: int = 2048) -> DataFrame:
    """`docs` with the row of smallest `id` of each group of near duplicates, all columns kept.

    Rows are decided one by one, not by id: of rows that repeat an id, each goes or stays with its own text. Where several rows
    of a group have its smallest id, the one of least text stays. Rows without an id cannot be told apart and stay.
    """
    found = _grouped(docs.where(F.col(id).isNotNull()), id, text, shingle, limit)
    counts = found.groupBy("id").agg(F.count("*").alias("n"), F.max(F.col("id") != F.col("component_id")).alias("copy"))
    marked = keep(counts.where("copy or n > 1").withColumnRenamed("id", id))
    rest = docs.join(marked.where("n = 1").select(id), id, "left_anti").select(docs.columns)
    again = marked.where("n > 1").select(id)
    if again.isEmpty():
        return rest
    # Of ids that repeat, the rows are told apart by their fingerprints.
    fp, component, root = (_unused(name, docs.columns) for name in ("fp", "component_id", "root"))
    repeated = add_fingerprints(rest.join(again, id, "left_semi").select(docs.columns), text, fp, shingle)
    groups = found.select(F.col("id").alias(id), F.col("fp").alias(fp), F.col("component_id").alias(component), F.col("root").alias(root))
    rows = repeated.join(groups.distinct(), [id, fp]).where(F.col(id) == F.col(component))
    place = _unused("place", [*docs.columns, fp, component, root])
    first = rows.withColumn(place, F.row_number().over(Window.partitionBy(root).orderBy(text))).where(F.col(place) == 1)
    return rest.join(again, id, "left_anti").select(docs.columns).unionAll(first.select(docs.columns))
