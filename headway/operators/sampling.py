"""Greedy sampling by minimum gap.

What is kept in a stretch of time depends on what came before only by its last kept moment. So a
chunk of a timeline is a jump function, from the last moment kept before it to the last one kept in
it. Jump functions compose, so the last kept moment at the start of every chunk is found without
going through the moments again, and every chunk is then sampled by itself.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway import constants as K
from headway.functions.times import parse_timestamp

CHUNK_SLOTS = 16
CHUNKS_PER_GROUP = 64
JUMPS = "entry array<long>, last array<long>"
NOTHING_KEPT = -(1 << 61)


def sample_by_gap(
    df: DataFrame,
    key: str,
    ts: str,
    start: str = K.SAMPLING_START,
    gap_seconds: int = K.SAMPLING_GAP_SECONDS,
    chunk_slots: int = CHUNK_SLOTS,
    chunks_per_group: int = CHUNKS_PER_GROUP,
) -> DataFrame:
    """(key, ts) of the moments kept: each more than the gap after the last kept one, in order.

    Only distinct moments matter, so rows are reduced to those before the shuffle. After a silence
    longer than the gap the chain starts afresh; silences are found from the first and last moment
    of gap-wide slots (a few rows per day and key). The stretches between them are cut into chunks
    of ``chunk_slots`` slots, two or more. Chunks that go on from another one wait for the moment kept before
    them: each gives its jumps, groups of chunks compose theirs, the groups of a stretch are gone
    through in order, then the chunks of each group. So a timeline without any silence is spread
    over as many tasks as it has chunks; one task sees a list per group of it, not its moments.
    """
    key_type, ts_type = df.schema[key].dataType.simpleString(), df.schema[ts].dataType.simpleString()
    first = parse_timestamp(F.lit(start))
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds))
    seconds = F.timestamp_diff("SECOND", first, F.col(ts))
    moments = (
        df.filter(F.col(key).isNotNull() & (F.col(ts) > first + gap))
        .select(key, ts)
        .distinct()
        .withColumn("_slot", F.floor(seconds / gap_seconds))
    )
    in_order = Window.partitionBy(key).orderBy("_slot")
    slots = (
        moments.groupBy(key, "_slot")
        .agg(F.min(ts).alias("_low"), F.max(ts).alias("_high"))
        .withColumn("_before", F.lag("_high").over(in_order))
        .withColumn("_fresh", F.col("_before").isNull() | (F.col("_low") > F.col("_before") + gap))
        .withColumn("_stretch", F.max(F.when(F.col("_fresh"), F.col("_slot"))).over(in_order))
    )
    if chunk_slots < 2:
        raise ValueError("a chunk must reach beyond the gap")
    width = F.lit(chunk_slots)
    chunks = slots.select(
        key,
        "_slot",
        "_stretch",
        F.floor((F.col("_slot") - F.col("_stretch")) / width).cast("long").alias("_chunk"),
        # Whether the stretch goes beyond its first chunk: most do not, and need no jumps.
        (F.max("_slot").over(Window.partitionBy(key, "_stretch")) >= F.col("_stretch") + width).alias("_long"),
    )
    place = [key, "_stretch", "_chunk"]
    micros = F.timestamp_diff("MICROSECOND", first, F.col(ts)).alias("_at")
    placed = moments.join(chunks, [key, "_slot"]).select(*place, "_long", ts, micros)
    step = gap_seconds * 1_000_000
    kinds = f"{key} {key_type}, _stretch long, _chunk long"
    ordered = placed.filter("_long").repartition(*place).sortWithinPartitions(*place, "_at")
    jumps = ordered.select(*place, "_at").mapInPandas(_jumps(place, step), f"{kinds}, {JUMPS}")
    jumps = jumps.withColumn("_group", F.floor(F.col("_chunk") / chunks_per_group).cast("long"))
    group = [key, "_stretch", "_group"]
    grouped = jumps.repartition(*group).sortWithinPartitions(*group, "_chunk")
    by_group = grouped.mapInPandas(
        _composed(group, step), f"{key} {key_type}, _stretch long, _group long, {JUMPS}"
    )
    in_stretch = by_group.repartition(key, "_stretch").sortWithinPartitions(*group)
    kept_before_groups = in_stretch.mapInPandas(
        _carried([key, "_stretch"], "_group", step),
        f"{key} {key_type}, _stretch long, _group long, _carry long",
    )
    entered = jumps.join(kept_before_groups, group).repartition(*group).sortWithinPartitions(*group, "_chunk")
    kept_before = entered.mapInPandas(_carried(group, "_chunk", step), f"{kinds}, _carry long")
    carried = placed.join(kept_before, place, "left").drop("_long")
    return (
        carried.withColumn("_carry", F.coalesce("_carry", F.lit(NOTHING_KEPT)))
        .repartition(*place)
        .sortWithinPartitions(*place, "_at")
        .mapInPandas(_keeper(key, ts, place, step), f"{key} {key_type}, {ts} {ts_type}")
    )


# The functions for the tasks refer to nothing else in this package, so that they travel with the
# query and workers need no copy of the package.


def _jumps(place: list[str], step: int):
    """Rows of moments, sorted by chunk and time, to the jump function of every chunk.

    With x the last moment kept before, the first moment after x + gap is kept, ``entry``, and in
    the end ``last``. As x lies before the chunk, only the moments up to the first one that is a gap
    after the chunk's first can be entries. Of entries with the same end the last one stands for all.
    """

    def function(at: np.ndarray) -> tuple[list, list]:
        following = np.searchsorted(at, at + step, side="right")
        end = np.arange(min(len(at), int(following[0]) + 1))
        while (following[end] < len(at)).any():
            end = np.where(following[end] < len(at), following[end], end)
        last = at[end]
        stays = np.append(last[1:] != last[:-1], True)
        return at[: len(end)][stays].tolist(), last[stays].tolist()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, held = None, []

        def closed() -> pd.DataFrame:
            entry, last = function(np.concatenate(held))
            return pd.DataFrame([(*unit, entry, last)], columns=[*place, "entry", "last"])

        for batch in batches:
            names = list(zip(*(batch[c] for c in place)))
            at = batch["_at"].to_numpy()
            bounds = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
            for begin, end in zip(bounds, [*bounds[1:], len(names)]):
                if names[begin] != unit:
                    if held:
                        yield closed()
                    unit, held = names[begin], []
                held.append(at[begin:end])
        if held:
            yield closed()

    return run


def _composed(group: list[str], step: int):
    """Jump functions sorted by group and chunk to one function per group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, entry, last = None, None, None

        def closed() -> pd.DataFrame:
            stays = np.append(last[1:] != last[:-1], True)
            return pd.DataFrame(
                [(*unit, entry[stays].tolist(), last[stays].tolist())], columns=[*group, "entry", "last"]
            )

        for batch in batches:
            for *name, entries, lasts in batch[[*group, "entry", "last"]].itertuples(index=False):
                entries, lasts = np.asarray(entries, np.int64), np.asarray(lasts, np.int64)
                if tuple(name) != unit:
                    if unit is not None:
                        yield closed()
                    unit, entry, last = tuple(name), entries, lasts
                else:
                    # A chunk without a moment after the gap leaves the last one as it is.
                    found = np.searchsorted(entries, last + step, side="right")
                    last = np.where(found < len(entries), lasts[np.minimum(found, len(lasts) - 1)], last)
        if unit is not None:
            yield closed()

    return run


def _carried(unit_of: list[str], number: str, step: int):
    """Jump functions in order, from the moment kept before each unit, to the one before each of them.

    Without a column ``_carry`` nothing was kept before a unit."""
    nothing = NOTHING_KEPT

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, kept = None, nothing
        for batch in batches:
            before = batch["_carry"] if "_carry" in batch else [nothing] * len(batch)
            out = []
            for *name, n, entry, last, carry in zip(
                *(batch[c] for c in unit_of), batch[number], batch["entry"], batch["last"], before
            ):
                if tuple(name) != unit:
                    unit, kept = tuple(name), carry
                out.append((name[0], name[1], n, kept))
                found = np.searchsorted(entry, kept + step, side="right")
                if found < len(entry):
                    kept = int(last[found])
            yield pd.DataFrame(out, columns=[*unit_of[:2], number, "_carry"])

    return run


def _keeper(key: str, ts: str, place: list[str], step: int):
    """Moments sorted by chunk and time to the ones kept. Batches stream past a single remembered
    moment; no group is held in memory."""
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, last = None, 0
        for batch in batches:
            at = batch["_at"].to_numpy()
            columns = [batch[c].to_numpy() for c in place]
            before = batch["_carry"].to_numpy()
            changed = np.zeros(max(len(at) - 1, 0), bool)
            for c in columns:
                changed |= c[1:] != c[:-1]
            bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), len(at)]
            kept = []
            for begin, end in zip(bounds, bounds[1:]):
                if begin == end:
                    continue
                name = tuple(c[begin] for c in columns)
                if name != unit:
                    unit, last = name, int(before[begin])
                n = begin + int(np.searchsorted(at[begin:end], last + step, side="right"))
                while n < end:
                    kept.append(n)
                    last = int(at[n])
                    n = n + 1 + int(np.searchsorted(at[n + 1 : end], last + step, side="right"))
            yield batch[[key, ts]].iloc[kept]

    return keep
