"""Raw ingest of messages."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from headway.schemas import SENSOR_MESSAGE, TICKET_MESSAGE
from headway.sinks.keyindex import add_keys, first_ever, fold_keys
from headway.sinks.logs import fold_now
from headway.sinks.tables import missing_rows, write_part
from headway.sources.messages import ARRIVAL, bad_messages, decode_messages, good_rows
from headway.streaming.running import start


def ingest(
    messages: DataFrame,
    schema: StructType,
    table: str,
    rejects: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Append decoded messages to a table and undecodable ones to a reject table."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_messages(batch, schema).persist()
        try:
            write_part(good_rows(decoded, schema), table, batch_id)
            write_part(bad_messages(decoded), rejects, batch_id)
        finally:
            decoded.unpersist()

    return start(messages, each_batch, checkpoint, every)


def ingest_once(
    messages: DataFrame,
    schema: StructType,
    key: str,
    existing: Callable[[SparkSession], DataFrame],
    append: Callable[[DataFrame], None],
    rejects: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """K1, K2: append to a table that cannot replace the part of a batch, such as a database.

    ``existing`` gives the table as it is, ``append`` adds rows to it. Keys that are there already
    are left out, so the first message of a key wins and a repeated batch adds nothing. Messages
    without the key, or not decodable, go to the reject table with the reason.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_messages(batch, schema).persist()
        try:
            rows = good_rows(decoded, schema, [*ARRIVAL, "value"])
            fresh = missing_rows(rows, existing(batch.sparkSession), key, ARRIVAL)
            append(fresh.select(*schema.names))
            undecodable = bad_messages(decoded).select(
                *ARRIVAL, "value", F.lit("undecodable").alias("reason")
            )
            keyless = rows.filter(F.col(key).isNull()).select(
                *ARRIVAL, "value", F.lit(f"{key}: missing").alias("reason")
            )
            write_part(undecodable.unionByName(keyless), rejects, batch_id)
        finally:
            decoded.unpersist()

    return start(messages, each_batch, checkpoint, every)


def ingest_tickets_and_sensors(
    messages_of: Callable[[str], DataFrame],
    folder: str,
    checkpoints: str,
    every: str | None = None,
) -> list[StreamingQuery]:
    """One query per topic, each with its own checkpoint. ``messages_of`` gives the stream of a
    topic, such as a subscription of its own, so that no query fetches what another one needs."""
    jobs = {
        "raw_sensors": ("sensors.topic", SENSOR_MESSAGE),
        "raw_tickets": ("ticketing.topic", TICKET_MESSAGE),
    }
    return [
        ingest(
            messages_of(topic).filter(F.col("topic") == topic),
            schema,
            f"{folder}/{table}",
            f"{folder}/{table}_rejects",
            f"{checkpoints}/{table}",
            every,
        )
        for table, (topic, schema) in jobs.items()
    ]


def ingest_first_ever(
    stream: DataFrame,
    key: str,
    order: Sequence[str],
    table: str,
    index: str,
    checkpoint: str,
    fold_every: int = 32,
    every: str | None = None,
) -> StreamingQuery:
    """The first row of every key, for ever. A batch reads of the keys before it only the
    buckets that its own keys may be in (``headway.sinks.keyindex``); streaming state holds none."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        fresh = first_ever(batch, key, list(order), index, batch_id).persist()
        try:
            write_part(fresh, table, batch_id)
            add_keys(fresh.select(key), key, index, batch_id)
        finally:
            fresh.unpersist()
        if fold_now(batch_id, fold_every):
            fold_keys(batch.sparkSession, index, batch_id - 1)

    return start(stream, each_batch, checkpoint, every)


def first_seen(stream: DataFrame, keys: Sequence[str], delay: str) -> DataFrame:
    """The first row per key. A key is forgotten once ``timestamp`` has moved on by the
    delay, so state stays bounded; copies further apart than that both pass (``ingest_first_ever``
    forgets none)."""
    timed = stream.withColumn("event_time", F.col("timestamp").cast("timestamp"))
    firsts = timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys))
    return firsts.drop("event_time")


def first_of_shape(stream: DataFrame) -> DataFrame:
    """The first row per shape, forever; state grows with the number of shapes only."""
    return stream.dropDuplicates(["shape_id"])
