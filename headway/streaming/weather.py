"""Weather snapshot and refresh moments on a stream."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from headway import constants as K
from headway.operators.filters import any_row
from headway.plans.weather import check_weather, decode_weather, weather_snapshot
from headway.sinks.tables import write_part, write_version
from headway.sources.messages import ARRIVAL
from headway.streaming.running import start


def replace_weather(
    messages: DataFrame, table: str, rejects: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """The forecast of the last valid message becomes the newest version of the table. A batch
    without a valid message leaves the table alone. Other messages are kept with the reason."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_weather(batch, keep=[*ARRIVAL, "value"]).persist()
        try:
            rows = weather_snapshot(decoded, ARRIVAL)
            if not any_row(rows, F.lit(True)).isEmpty():
                write_version(rows, table, batch_id)
            rejected = check_weather(decoded)[1].select(*ARRIVAL, "value", "reason")
            write_part(rejected, rejects, batch_id)
        finally:
            decoded.unpersist()

    return start(messages, each_batch, checkpoint, every)


def _gap_sampler(key_name: str, ts: str, start: str, gap_seconds: int) -> StatefulProcessor:
    """A processor that holds the moments of a key until the watermark has passed them, and the last
    kept one. Defined in here so that it travels with the query and workers need no copy of the
    package."""

    class GapSampler(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "micros long")
            self.waiting = handle.getMapState("waiting", "micros long", "seen boolean")
            self.timer = handle.getValueState("timer", "millis long")

        def wake_at(self, micros: int) -> None:
            """One timer per key, at its earliest waiting moment."""
            millis = -(-micros // 1000)
            if self.timer.exists():
                before = self.timer.get()[0]
                if before <= millis:
                    return
                self.handle.deleteTimer(before)
            self.handle.registerTimer(millis)
            self.timer.update((millis,))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            moments = set().union(*[batch[ts].dropna() for batch in rows])
            micros = [pd.Timestamp(m).value // 1000 for m in moments]
            for m in micros:
                self.waiting.updateValue((m,), (True,))
            if micros:
                self.wake_at(min(micros))
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            last = self.last.get()[0] if self.last.exists() else pd.Timestamp(start).value // 1000
            waiting = sorted(m for (m,) in self.waiting.keys())
            kept = []
            for m in waiting:
                if m > passed:
                    break
                if m > last + gap_seconds * 1_000_000:
                    last = m
                    kept.append(m)
                self.waiting.removeKey((m,))
            self.timer.clear()
            later = [m for m in waiting if m > passed]
            if later:
                self.wake_at(later[0])
            if kept:
                self.last.update((last,))
                yield pd.DataFrame({key_name: [key[0]] * len(kept), ts: pd.to_datetime(kept, unit="us")})

        def close(self) -> None:
            pass

    return GapSampler()


def sample_stream(
    stream: DataFrame,
    key: str,
    ts: str,
    start: str = K.SAMPLING_START,
    gap_seconds: int = K.SAMPLING_GAP_SECONDS,
    delay: str = "1 hour",
) -> DataFrame:
    """Moments more than the gap after the last kept one of their key.

    A moment waits until the watermark, ``delay`` behind the latest moment of the stream, has passed
    it; only then is it decided. So rows may come in any order and in any batch within the delay,
    and the result is that of the batch operator over them. Rows that come later than that are left
    out. State per key is the last kept moment and the distinct moments of one delay. Needs the
    RocksDB state store. Times are read in the session's zone, which must have no clock changes.
    """
    moments = stream.filter(F.col(key).isNotNull()).select(key, ts)
    timed = moments.withColumn("_event", F.col(ts).cast("timestamp")).withWatermark("_event", delay)
    return timed.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_gap_sampler(key, ts, start, gap_seconds),
        outputStructType=moments.schema,
        outputMode="Append",
        timeMode="EventTime",
    )
