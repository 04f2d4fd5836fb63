"""JSON messages: streams, parsing, routing and bounded reads.

A message is a row with a ``value`` column; ``topic``, ``partition`` and ``offset`` are used where
they are needed. Everything but the two stream readers works on any such DataFrame, so that a file
stream, a batch of files or a broker all do.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from headway import constants as K
from headway.functions.times import parse_timestamp
from headway.operators.expand import with_parsed
from headway.schemas import schema

MESSAGE_SCHEMA = schema("topic string, partition int, offset long, sent_at timestamp, value string")
# Offsets count per partition, so the broker's time comes first in the order of arrival.
ARRIVAL = ("sent_at", "partition", "offset")
_PLACE = ["topic", "partition"]
_DATA, _BROKEN = "_data", "_broken"


def broker_options(
    servers: str, topics: Sequence[str], max_offsets: int = K.MAX_OFFSETS_PER_TRIGGER
) -> dict[str, str]:
    """From the earliest message, a bounded number of messages per trigger."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(max_offsets),
    }


def broker_stream(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    """Message stream of a broker (the connector must be on the class path)."""
    reader = spark.readStream.format("kafka").options(
        **(broker_options(servers, topics) | {k: str(v) for k, v in options.items()})
    )
    return reader.load().select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("sent_at"),
        F.col("value").cast("string").alias("value"),
    )


def file_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Message stream over a folder of JSON-lines files holding the message columns."""
    return (
        spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files).json(path)
    )


def parse_messages(
    messages: DataFrame, fields: StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """Fields of the messages, ``timestamp`` zone-free. Undecodable messages are dropped."""
    return good_rows(decode_messages(messages, fields), fields, keep)


def split_messages(
    messages: DataFrame, fields: StructType, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, undecodable messages). A wrong field type rejects the message."""
    decoded = decode_messages(messages, fields)
    return good_rows(decoded, fields, keep), bad_messages(decoded)


def decode_messages(messages: DataFrame, fields: StructType) -> DataFrame:
    """Messages with their fields as a struct; persist this to read both halves of it."""
    wanted = StructType([*fields.fields, StructField(_BROKEN, StringType())])
    data = F.from_json("value", wanted, {"columnNameOfCorruptRecord": _BROKEN})
    return with_parsed(messages, _DATA, data)


def good_rows(decoded: DataFrame, fields: StructType, keep: Sequence[str] = ()) -> DataFrame:
    columns = [F.col(f"{_DATA}.{name}").alias(name) for name in fields.names]
    good = decoded.filter(~_is_broken()).select(*keep, *columns)
    if "timestamp" in fields.names and fields["timestamp"].dataType == StringType():
        good = good.withColumn("timestamp", parse_timestamp(F.col("timestamp")))
    return good


def bad_messages(decoded: DataFrame) -> DataFrame:
    return decoded.filter(_is_broken()).drop(_DATA)


def _is_broken() -> Column:
    return F.col(_DATA).isNull() | F.col(f"{_DATA}.{_BROKEN}").isNotNull()


def route_topics(messages: DataFrame) -> DataFrame:
    """Add the archive collection and its unique field; unknown topics are dropped."""
    targets = F.create_map(
        *[
            part
            for topic, (collection, unique) in K.TOPICS.items()
            for part in (F.lit(topic), F.struct(F.lit(collection), F.lit(unique)))
        ]
    )
    target = targets[F.col("topic")]
    return (
        messages.withColumn("_target", target)
        .filter(F.col("_target").isNotNull())
        .select(
            *messages.columns,
            F.col("_target.col1").alias("collection"),
            F.col("_target.col2").alias("unique_field"),
        )
    )


def recent_messages(
    messages: DataFrame, order: Sequence[str] = ARRIVAL, limit: int = K.RECENT_MESSAGES
) -> DataFrame:
    """L1: the last messages in arrival order (each task keeps its own top rows first)."""
    newest = messages.orderBy(*[F.col(name).desc() for name in order]).limit(limit)
    return newest.orderBy(*order)


def latest_message(messages: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    return recent_messages(messages, order, limit=1)


def recent_for_route(
    messages: DataFrame,
    route: str,
    order: Sequence[str] = ARRIVAL,
    limit: int = K.RECENT_MESSAGES,
) -> DataFrame:
    """rows of a route among the last messages; older ones of the route do not count."""
    return recent_messages(messages, order, limit).filter(F.col("route") == route)


def read_page(messages: DataFrame, cursor: DataFrame, limit: int = 10) -> DataFrame:
    """Up to ``limit`` messages after the cursor, one row (topic, partition, offset) per place.

    A place without a row is read from its beginning. Pages follow the offsets, so within a
    partition no message comes before an earlier one, and none is passed over.
    """
    at = cursor.select(*_PLACE, F.col("offset").alias("_read"))
    unread = messages.join(at, _PLACE, "left").filter(
        F.col("_read").isNull() | (F.col("offset") > F.col("_read"))
    )
    return unread.select(messages.columns).orderBy("offset", *_PLACE).limit(limit)


def next_cursor(page: DataFrame, cursor: DataFrame) -> DataFrame:
    """Cursor after a page; places that the page does not touch stay where they are."""
    both = cursor.select(*_PLACE, "offset").unionByName(page.select(*_PLACE, "offset"))
    return both.groupBy(*_PLACE).agg(F.max("offset").alias("offset"))
